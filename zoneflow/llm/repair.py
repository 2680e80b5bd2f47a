"""Repair of conversations by weighted CYK interval parsing.

A conversation is a sequence of rows; its repaired role initials must read ``(s?(ua)+)?``. The grammar is in Chomsky normal form:
nonterminals are pairs ``(p, q)`` of states (``0`` nothing yet, then the last initial), "what takes p to q";
a row's edits (keep, rerole, delete) are its terminal rules, ``(p, q) -> (p, r) (r, q)`` are the binary
rules, and insertions are closed over at both sides of every leaf. A cell holds, for every nonterminal that derives its span, the least
(cost, audit). Cells are combined bottom-up by span length: spans of 1, 2, 4, ... rows.

Every derivation passes each place between two rows in some state, so one split of a span finds the least over all splits. Of
two audits of one span and one cost none begins the other (it would need more insertions), so the least audit of
a span is made of the least audits of its parts.

Rows are dealt by ranges of (conversation, turn, ...), sorted. A conversation that lies inside one task's range is repaired there;
what reaches to an edge of a range, or is longer than HELD_ROWS or HELD_CHARS, goes on as rows to a second path with the same results:
repeats are found by an aggregate over digests, symbols are parsed in blocks, cells of blocks are combined in rounds of
ROUND, and only the running digest of the repaired text, which has one order, streams through one task without being held.

Defined results: null role or text is one space; a null conversation id is a conversation, a null turn sorts first; rows of one
turn are ordered by role and text; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.llm.common import written

HELD_ROWS = 100_000
HELD_CHARS = 64_000_000
BLOCK_ROWS = 1024
ROUND = 64

SPACES = "\t\n\x0b\x0c\r "
ENDS = ".!?"

# -- grammar ---------------------------------------------------------------------------------------------------------

STATES = "0sua"
ARCS = [("0", "s"), ("0", "u"), ("s", "u"), ("u", "a"), ("a", "u")]
FINAL = "0a"
ROLES = {"u": "user", "a": "assistant"}
CLASSES = "sua?"
OK, TRUNCATED, BLANK, DUPLICATE = range(4)
#: One hexadecimal digit a row: class of its initial and first fault.
SYMBOLS = {(c, f): f"{4 * i + f:x}" for i, c in enumerate(CLASSES) for f in range(4)}
MEANING = {symbol: meaning for meaning, symbol in SYMBOLS.items()}

Table = dict[tuple[str, str], tuple[int, str]]


def _keep_least(table: Table, pair: tuple[str, str], value: tuple[int, str]) -> None:
    if pair not in table or value < table[pair]:
        table[pair] = value


def combine(left: Table, right: Table) -> Table:
    """The binary rules: least (cost, audit) of two spans that meet."""
    out: Table = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            if (r, q) in right:
                more, rest = right[r, q]
                _keep_least(out, (p, q), (cost + more, audit + rest))
    return out


def _insertions() -> Table:
    """Chains of insertions, the empty one included; more than two never pay."""
    table: Table = {(p, p): (0, "") for p in STATES}
    one: Table = {arc: (2, "I") for arc in ARCS if arc[1] in ROLES}
    for _ in range(2):
        for pair, value in combine(table, one).items():
            _keep_least(table, pair, value)
    return table


INSERTIONS = _insertions()


def _leaf(symbol: str) -> Table:
    initial, fault = MEANING[symbol]
    row: Table = {(p, p): (3, "D") for p in STATES}
    if fault in (OK, TRUNCATED):
        extra = int(fault == TRUNCATED)
        for p, q in ARCS:
            if q == initial:
                _keep_least(row, (p, q), (extra, "K"))
            if q in ROLES:
                _keep_least(row, (p, q), (2 + extra, "R"))
    return combine(combine(INSERTIONS, row), INSERTIONS)


LEAVES = {symbol: _leaf(symbol) for symbol in MEANING}


class Span:
    """What is known of consecutive rows: the cell, counts of faults, illegal neighbours, first and last class."""

    __slots__ = ("table", "blank", "duplicate", "truncated", "illegal", "first", "last")

    def __init__(self, table: Table, blank: int, duplicate: int, truncated: int, illegal: int, first: str, last: str):
        self.table, self.illegal, self.first, self.last = table, illegal, first, last
        self.blank, self.duplicate, self.truncated = blank, duplicate, truncated

    @classmethod
    def row(cls, symbol: str) -> Span:
        initial, fault = MEANING[symbol]
        return cls(LEAVES[symbol], int(fault == BLANK), int(fault == DUPLICATE), int(fault == TRUNCATED), 0, initial, initial)

    def __add__(self, other: Span) -> Span:
        return Span(
            combine(self.table, other.table),
            self.blank + other.blank,
            self.duplicate + other.duplicate,
            self.truncated + other.truncated,
            self.illegal + other.illegal + (self.last + other.first not in ("su", "ua", "au")),
            self.first,
            other.last,
        )

    def best(self) -> tuple[int, str]:
        return min(self.table["0", q] for q in FINAL if ("0", q) in self.table)

    def pack(self) -> str:
        return json.dumps([[[*k, *v] for k, v in self.table.items()], self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last])

    @classmethod
    def unpack(cls, packed: str) -> Span:
        table, *rest = json.loads(packed)
        return cls({(p, q): (cost, audit) for p, q, cost, audit in table}, *rest)


def bottom_up(spans: list[Span]) -> Span:
    """Neighbouring cells become one, level by level of span length."""
    while len(spans) > 1:
        spans = [spans[i] + spans[i + 1] if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0]


def parse(symbols: str) -> Span:
    """The cell of a whole string of symbols; blocks are parsed one after another so that few cells are held."""
    blocks = [symbols[i : i + BLOCK_ROWS] for i in range(0, len(symbols), BLOCK_ROWS)]
    return bottom_up([bottom_up([Span.row(s) for s in block]) for block in blocks])


# -- rows ------------------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with one row in five damaged by a hash of its place: dropped, emptied, without sentence ends,
    repeated, or given to the user."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(key) % 20).alias("kind"))
    kind = F.col("kind")
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
    return rows.drop("copy")


def _marked(rows: DataFrame) -> DataFrame:
    """Rows as text ids, with class and the faults a row has on its own."""
    said = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    group = F.when(initial.isin(*CLASSES[:3]), F.instr(F.lit(CLASSES), initial) - 1).otherwise(len(CLASSES) - 1)
    fault = F.when(said == "", BLANK).when(~F.right(said, F.lit(1)).isin(*ENDS), TRUNCATED).otherwise(OK)
    return rows.select(
        F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    ).select("*", (4 * group + fault).cast("int").alias("mark"))


RESULT = "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
RAW = "pos long, turn long, role string, text string, mark int"
MADE = f"{RESULT}, {RAW}"
RESULT_NAMES = [c.split()[0] for c in RESULT.split(", ")]
MADE_NAMES = [c.split()[0] for c in MADE.split(", ")]
EMIT_ROWS = 4096
EMIT_CHARS = 16_000_000


class _Batches:
    """Rows handed on in record batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.chars = schema, [], 0

    def add(self, row: tuple, chars: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.chars += chars
        if len(self.rows) >= EMIT_ROWS or self.chars >= EMIT_CHARS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
        self.rows, self.chars = [], 0


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _gaps(turns: set[int]) -> int:
    return max(turns) - min(turns) + 1 - len(turns) if turns else 0


def _repair_ranges(held_rows: int, held_chars: int):
    """Whole conversations become results; the first and last of a task, and long ones, are handed on as rows."""
    schema = _arrow(MADE)
    no_result = (None,) * (len(RESULT_NAMES) - 1)
    no_row = (None,) * (len(MADE_NAMES) - len(RESULT_NAMES))
    known: dict[str, tuple[int, int, int, int, int, str]] = {}

    def parsed(symbols: str) -> tuple[int, int, int, int, int, str]:
        if symbols not in known:
            if len(known) >= 50_000:
                known.clear()
            span = parse(symbols)
            known[symbols] = (span.blank, span.duplicate, span.truncated, span.illegal, *span.best())
        return known[symbols]

    def repaired(conv: str | None, rows: list[tuple]) -> tuple:
        said, symbols = set(), []
        for _, role, text, mark in rows:
            again = mark % 4 != BLANK and (role, text) in said
            said.add((role, text))
            symbols.append(f"{mark - mark % 4 + DUPLICATE if again else mark:x}")
        blank, duplicate, truncated, illegal, cost, audit = parsed("".join(symbols))
        feed = _Feed(audit)
        for _, role, text, _ in rows:
            feed.row(role, text)
        return (conv, _gaps({t for t, *_ in rows if t is not None}), blank, duplicate, truncated, illegal, cost, audit, feed.digest(), *no_row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, part, number = _Batches(schema), TaskContext.get().partitionId(), 0
        conv, rows, chars, raw, begun = None, [], 0, True, False

        def hand_on() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for row in rows:
                yield from out.add((conv, *no_result, (part << 40) + number, *row), len(row[2]))
                number += 1
            rows.clear()

        for batch in batches:
            for this, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if begun and this != conv:
                    if raw:
                        yield from hand_on()
                    else:
                        yield from out.add(repaired(conv, rows), len(rows))
                        rows.clear()
                    raw, chars = False, 0
                conv, begun = this, True
                rows.append(tuple(row))
                chars += len(row[2])
                if raw or len(rows) > held_rows or chars > held_chars:
                    raw = True
                    yield from hand_on()
        yield from hand_on()
        yield from out.flush()

    return run


# -- conversations that reach over a task -----------------------------------------------------------------------------


def _on_text(fn: Callable[[list[str]], str]) -> Callable:
    def run(lists: pd.Series) -> pd.Series:
        return lists.map(fn)

    return F.pandas_udf(run, "string")


def _cells(blocks: DataFrame) -> DataFrame:
    """conv, span: the cell of each conversation from (conv, block, cell), combined in rounds."""
    order = Window.partitionBy("conv").orderBy("block")
    level = written(blocks.select("conv", (F.row_number().over(order) - 1).alias("rank"), "cell"), "repair-cells")
    # a udf made here runs on the lists of one round only: at most ROUND cells
    together = _on_text(lambda cells: bottom_up([Span.unpack(c) for c in cells]).pack())
    while (level.agg(F.max("rank")).first()[0] or 0) > 0:
        cells = F.array_sort(F.collect_list(F.struct("rank", "cell")))
        grouped = level.groupBy("conv", (F.col("rank") / ROUND).cast("long").alias("next")).agg(cells.alias("cells"))
        level = written(grouped.select("conv", F.col("next").alias("rank"), together(F.col("cells.cell")).alias("cell")), "repair-cells")
    return level.select("conv", "cell")


class _Feed:
    """Digest of the repaired turns: applies an audit to rows that come one by one.

    The initial before says which role an insertion or a rerole gives.
    """

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.total, self.first = audit, 0, "0", hashlib.sha256(), True

    def _say(self, role: str, text: str) -> None:
        self.total.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first, self.state = False, role[0]

    def _insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._say(ROLES["a" if self.state == "u" else "u"], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._insertions()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._say(role, text)
        elif edit == "R":
            self._say(ROLES["a" if self.state == "u" else "u"], text)

    def digest(self) -> str:
        self._insertions()
        return self.total.hexdigest()


def _stream_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each conversation's repaired text; its audit is its first row, its rows follow in order."""
    out = _Batches(_arrow("conv string, repaired_sha256 string"))
    conv = feed = None
    for batch in batches:
        names = batch.schema.names
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            row = dict(zip(names, row, strict=True))
            if row["audit"] is not None:
                if feed:
                    yield from out.add((conv, feed.digest()))
                conv, feed = row["conv"], _Feed(row["audit"])
            else:
                feed.row(row["role"], row["text"])
    if feed:
        yield from out.add((conv, feed.digest()))
    yield from out.flush()


def _repair_rows(rows: DataFrame) -> DataFrame:
    """RESULT of conversations given as rows with their places, wherever the rows are."""
    key = F.when(F.col("conv_id").isNull(), F.lit("n")).otherwise(F.concat(F.lit("="), F.col("conv_id")))
    rows = rows.withColumn("conv", key)
    said = F.md5(F.concat("role", F.lit("\0"), "text"))
    small = rows.select("conv", "pos", "turn", "mark", F.when(F.col("mark") % 4 != BLANK, said).alias("said"))
    # the written table lets adaptive execution split a conversation that holds most rows
    firsts = written(small.where("said is not null").groupBy("conv", "said").agg(F.min("pos").alias("first")), "repair-firsts")
    again = (F.col("pos") > F.col("first")) & (F.col("mark") % 4 != BLANK)
    symbol = F.lower(F.hex(F.when(again, F.col("mark") - F.col("mark") % 4 + DUPLICATE).otherwise(F.col("mark"))))
    flagged = small.join(firsts, ["conv", "said"], "left").select("conv", "pos", symbol.alias("symbol"))
    in_order = F.array_sort(F.collect_list(F.struct("pos", "symbol")))
    blocks = flagged.groupBy("conv", F.floor(F.col("pos") / BLOCK_ROWS).alias("block")).agg(in_order.alias("rows"))
    to_cell = _on_text(lambda symbols: parse("".join(symbols)).pack())
    cells = _cells(blocks.select("conv", "block", to_cell(F.col("rows.symbol")).alias("cell")))

    def counts(packed: str) -> str:
        span = Span.unpack(packed)
        return json.dumps([span.blank, span.duplicate, span.truncated, span.illegal, *span.best()])

    found = F.from_json(_on_text(counts)("cell"), "array<string>")
    names = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    parsed = cells.select("conv", found.alias("found")).select(
        "conv", *[F.get("found", F.lit(i)).cast("string" if n == "audit" else "long").alias(n) for i, n in enumerate(names)]
    )
    parsed = written(parsed, "repair-parsed")
    gaps = small.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    )
    feed = parsed.select("conv", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "audit")
    feed = feed.unionByName(rows.select("conv", "pos", "role", "text", F.lit(None).cast("string").alias("audit")))
    digests = feed.repartition("conv").sortWithinPartitions("conv", "pos").mapInArrow(_stream_digests, "conv string, repaired_sha256 string")
    result = parsed.join(gaps, "conv").join(digests, "conv")
    conv_id = F.when(F.col("conv").startswith("="), F.substr("conv", F.lit(2)))
    return result.withColumn("conv_id", conv_id).select(*RESULT_NAMES)


def repair(rows: DataFrame, held_rows: int = HELD_ROWS, held_chars: int = HELD_CHARS) -> DataFrame:
    """RESULT of every conversation in ``rows`` (conv_id, turn, role, text): turn gaps, first faults, illegal neighbours,
    least cost, its least audit, and the digest of the repaired turns."""
    order = ["conv_id", "turn", "role", "text"]
    dealt = _marked(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    made = written(dealt.mapInArrow(_repair_ranges(held_rows, held_chars), MADE), "repair-made")
    whole = made.where("pos is null").select(*RESULT_NAMES)
    return whole.unionByName(_repair_rows(made.where("pos is not null").select("conv_id", *[c.split()[0] for c in RAW.split(", ")])))


def digest(conversations: DataFrame, repaired: DataFrame) -> DataFrame:
    """One row for every id of ``conversations``; those without a row left have zeros, no audit and the digest of nothing."""
    ids = conversations.select("conv_id").distinct().select("conv_id", F.col("conv_id").cast("string").alias("as_text"))
    joined = ids.join(repaired.withColumnRenamed("conv_id", "repaired_id"), F.col("as_text").eqNullSafe(F.col("repaired_id")), "left")
    defaults = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return joined.select("conv_id", *[F.coalesce(n, F.lit(defaults.get(n, 0))).alias(n) for n in RESULT_NAMES[1:]])
