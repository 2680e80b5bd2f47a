"""Fill-in-the-middle: a text is cut at two of its token ends and its parts are reordered.

Tokens are runs of ASCII letters and every other single character. Their ends form a boundary set in the style of Roaring bitmaps:
positions fall into containers of 2**16 by their upper bits, each held as a sorted array, a bitmap or
runs, whichever is smallest, beside the number of ends before it. The k-th end is found by a binary
search over those numbers and a select inside one container, so both cuts cost two look-ups whatever the length of the text.

Which cuts and which form a document has follows from a hash of its id alone, so a task that runs again makes the same rows.

Defined results: null text is the empty text; a null ``doc_id`` counts as an empty number; rows with equal ids are cut alike but
are rows of their own; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed by the format of the output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90
SPM_BELOW = 20

CHUNK_BITS = 16
ARRAY_MOST = 4096
BITMAP_BYTES = 1 << (CHUNK_BITS - 3)
_ONES = np.array([bin(b).count("1") for b in range(256)], np.int64)


class ArrayContainer:
    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << CHUNK_BITS, bool)
        bits[low] = True
        self.bits = np.packbits(bits, bitorder="little")
        self.upto = np.cumsum(_ONES[self.bits])

    def select(self, k: int) -> int:
        byte = int(np.searchsorted(self.upto, k, "right"))
        inside = np.flatnonzero(np.unpackbits(self.bits[byte : byte + 1], bitorder="little"))
        return byte * 8 + int(inside[k - (int(self.upto[byte - 1]) if byte else 0)])


class RunContainer:
    def __init__(self, low: np.ndarray, first: np.ndarray):
        self.starts = low[first].astype(np.uint16)
        self.before = first

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest of the three forms: 2 bytes a value, 2**13 bytes, or 4 bytes a run."""
    first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    if 4 * len(first) < min(2 * len(low), BITMAP_BYTES):
        return RunContainer(low, first)
    return ArrayContainer(low) if len(low) <= ARRAY_MOST else BitmapContainer(low)


class BoundarySet:
    """Increasing positions, asked for by rank."""

    def __init__(self, positions: np.ndarray):
        high = positions >> CHUNK_BITS
        self.cuts = np.flatnonzero(np.diff(high, prepend=-1))  # cardinality before each container
        self.keys = high[self.cuts]
        bounds = [*self.cuts.tolist(), len(positions)]
        low = positions & ((1 << CHUNK_BITS) - 1)
        self.containers = [container(low[a:b]) for a, b in zip(bounds, bounds[1:])]
        self.size = len(positions)

    def select(self, k: int) -> int:
        """The position of rank ``k``, from 0."""
        at = int(np.searchsorted(self.cuts, k, "right")) - 1
        return (int(self.keys[at]) << CHUNK_BITS) + self.containers[at].select(k - int(self.cuts[at]))


def token_ends(text: str) -> BoundarySet:
    """Code point offsets behind each token."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    letter = ((points | 32) - np.uint32(97)) < 26
    last = np.ones(len(points), bool)
    last[:-1] = ~(letter[:-1] & letter[1:])
    return BoundarySet(np.flatnonzero(last) + 1)


def draws(seed: str) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(seed.encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))


def transform(text: str, seed: str) -> tuple[int, str, int | None, int | None, str]:
    """Number of tokens, form, code points of prefix and middle, output."""
    ends = token_ends(text)
    h1, h2, h3, h4 = draws(seed)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= PLAIN_FROM:
        return ends.size, "plain", None, None, text
    units = sorted((h1 % (ends.size + 1), h2 % (ends.size + 1)))
    a, b = (ends.select(k - 1) if k else 0 for k in units)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_BELOW:
        return ends.size, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return ends.size, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


PARTS = "n long, form string, prefix_chars long, middle_chars long, output string"


def _transformed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for seeds, texts in batches:
        rows = [transform(text, seed) for seed, text in zip(seeds, texts, strict=True)]
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in PARTS.split(", ")])
        yield out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64", "form": "str", "output": "str"})


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars, output of every row of ``docs`` (doc_id, text)."""
    seed = F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    parts = docs.select("doc_id", F.pandas_udf(_transformed, PARTS)(seed, F.coalesce("text", F.lit(""))).alias("parts"))
    return parts.select("doc_id", "parts.*")


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from. Texts with a marker inside stay plain, so the first of each marker is the real one."""
    second = F.when(form == "psm", F.instr(output, SUFFIX)).otherwise(F.instr(output, PREFIX))
    third = F.instr(output, MIDDLE)
    one = F.substr(output, F.lit(4), second - 4)
    two = F.substr(output, second + 3, third - second - 3)
    middle = F.substr(output, third + 3)
    return F.when(form == "plain", output).when(form == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))


def digest(made: DataFrame) -> DataFrame:
    output = F.col("output")
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(output, 256).alias("output_sha256"),
        F.sha2(restored(output, F.col("form")), 256).alias("restored_sha256"),
    )


#: Cuts by a list of all tokens instead of a boundary set.
SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), tokens AS (
  SELECT *, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3,
         CAST('0x' || h[25:32] AS BIGINT) AS h4, regexp_extract_all(text, '(?s)[A-Za-z]+|[^A-Za-z]') AS t FROM docs
), cuts AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
                      OR h3 % 100 >= {PLAIN_FROM} THEN 'plain' WHEN h4 % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form,
         least(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS a, greatest(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS b FROM tokens
), parts AS (
  SELECT *, array_to_string(t[1:a], '') AS p, array_to_string(t[a + 1:b], '') AS m, array_to_string(t[b + 1:], '') AS s FROM cuts
)
SELECT doc_id, len(t) AS n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
                        ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
