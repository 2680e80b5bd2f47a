"""Secret scans over an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. The ledger holds, per blob, which rules in
which version have read it and what they found. An increment scans only pairs of blob and rule version that the
ledger lacks, each content once, however many versions or paths have it, and findings are joined back to all of them.

Contents are fetched by (blob, one of its paths), so the copies of a hot blob are spread by path.

Defined results: null text is the empty text; identical rows are versions of their own with equal findings; a
null path is a path; an empty table or an empty increment adds nothing. Spans are in code points, the end
exclusive. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm.common import fresh_name


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping; those whose ``group`` is shorter than ``least`` are dropped."""

    name: str
    pattern: str
    least: int = 0
    group: int = 0
    version: int = 1
    #: A string without which no match is possible, if there is one.
    needs: str = ""

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# The base rules, in the order in which equal starts are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=8,
        group=2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16, needs="AKIA"),
    Rule("hex", r"[0-9a-f]+", least=32),
)
#: Between the parts of a key whose END line is missing: spaces, quotes and the like, written line ends.
_BETWEEN = r"""(?:[\s"'`,;>|#*()]|\\[nrt]?)"""
_LINE_END = r"""(?=(?:[\x20\t"'`,;)]|\\[nrt]?)*(?:[\r\n]|\Z))"""
#: A private key from its BEGIN line to the END line of the same kind, else to the last of its base64 lines. A part of
#: 16 characters belongs to the key wherever it stands, a shorter one as a whole line or as the rest behind a longer one.
PEM = (
    r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----"
    r"(?:(?:(?!-----BEGIN )[\s\S])*?-----END \1-----"
    rf"|(?:{_BETWEEN}*+(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+"
    rf"(?:{_BETWEEN}*+(?:[A-Za-z0-9+/=]{{16,}}+(?:(?:[\x20\t]|\\[nrt])++[A-Za-z0-9+/=]++(?![A-Za-z0-9+/=]))?|[A-Za-z0-9+/=]++{_LINE_END}))*+)"
)
#: What the method adds.
MORE_RULES = (
    Rule("pem", PEM, version=2, needs="-----BEGIN "),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", needs="eyJ"),
    Rule("hub", r"gh[pousr]_[A-Za-z0-9]{36,}", needs="gh"),
)
RULES = BASE_RULES + MORE_RULES

LEDGER = "blob binary, scanned array<string>, found array<struct<start:int,rank:int,end:int,rule:string>>"


def spans(text: str, rule: Rule, compiled: re.Pattern) -> list[tuple[int, int]]:
    if rule.needs and rule.needs not in text:
        return []
    return [m.span() for m in compiled.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def with_blob(versions: DataFrame) -> DataFrame:
    """(path, text, blob) of ``versions`` (path, text)."""
    text = F.coalesce("text", F.lit(""))
    return versions.select("path", text.alias("text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("blob"))


def _scan(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready = {r.key: (rank, r, re.compile(_quick(r))) for rank, r in enumerate(rules)}
        for batch in batches:
            rows = []
            for blob, text, todo in zip(batch["blob"], batch["text"], batch["todo"], strict=True):
                found = []
                for key in todo:
                    rank, rule, compiled = ready[key]
                    found += [(start, rank, end, rule.key) for start, end in spans(text, rule, compiled)]
                rows.append((blob, list(todo), sorted(found)))
            yield pd.DataFrame(rows, columns=["blob", "scanned", "found"])

    return run


def _quick(rule: Rule) -> str:
    """A run of one class that is long enough is the same match, found with less work."""
    if rule.least and rule.group == 0 and rule.pattern.endswith("]+"):
        head = rule.pattern[: rule.pattern.index("[")]
        return f"{rule.pattern[:-1]}{{{rule.least - len(head)},}}"
    return rule.pattern


def scan_increment(versions: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for the blobs of ``versions`` (path, text) that some rule version has not read yet."""
    held = with_blob(versions)
    todo = held.groupBy("blob").agg(F.min("path").alias("from")).select(
        "blob", "from", F.array(*(F.lit(r.key) for r in rules)).alias("todo")
    )
    if ledger is not None:
        seen = ledger.select("blob", F.explode("scanned").alias("key")).groupBy("blob").agg(F.collect_set("key").alias("seen"))
        todo = todo.join(seen, "blob", "left").select(
            "blob", "from", F.array_except("todo", F.coalesce("seen", F.array().cast("array<string>"))).alias("todo")
        )
    todo = todo.where(F.size("todo") > 0).withColumnRenamed("blob", "b")
    # the hash table is that of the blobs; contents are neither sorted nor kept
    fetched = held.join(todo.hint("shuffle_hash"), (F.col("blob") == F.col("b")) & F.col("path").eqNullSafe(F.col("from")))
    return fetched.select("blob", "text", "todo").mapInPandas(_scan(rules), LEDGER)


class Ledger:
    """Increments under one folder of the shared store, each written whole; reading takes them together. A ledger that is
    opened again goes on behind the increments that are there; one that was not finished is neither read nor replaced."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        held = [x.getPath() for x in files.listStatus(folder)] if files.exists(folder) else []
        held = [x for x in held if re.fullmatch(r"\d{6,}", x.getName())]
        self.finished = sorted(x.getName() for x in held if files.exists(spark._jvm.org.apache.hadoop.fs.Path(x, "_SUCCESS")))
        self.next = 1 + max((int(x.getName()) for x in held), default=-1)

    def read(self) -> DataFrame | None:
        paths = [f"{self.root}/{name}" for name in self.finished]
        return self.spark.read.schema(LEDGER).parquet(*paths) if paths else None

    def add(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        name, self.next = f"{self.next:06d}", self.next + 1
        scan_increment(versions, self.read(), rules).write.mode("errorifexists").parquet(f"{self.root}/{name}")
        self.finished.append(name)

    def unscanned(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob): contents of ``versions`` that some of these rule versions have not read."""
        blobs = with_blob(versions).select("blob").distinct()
        ledger = self.read()
        if ledger is None:
            return blobs
        keys = ledger.select("blob", F.explode("scanned").alias("key")).where(F.col("key").isin([r.key for r in rules]))
        whole = keys.groupBy("blob").agg(F.count_distinct("key").alias("n")).where(F.col("n") == len({r.key for r in rules}))
        return blobs.join(whole, "blob", "left_anti")

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob, found): the spans of these rule versions, by start and rule; only blobs that have some."""
        ledger = self.read()
        if ledger is None:
            ledger = self.spark.createDataFrame([], LEDGER)
        ranks = F.create_map(*(F.lit(x) for rank, r in enumerate(rules) for x in (r.key, rank)))
        one = (
            ledger.where(F.size("found") > 0)
            .select("blob", F.explode("found").alias("f"))
            .where(F.col("f.rule").isin([r.key for r in rules]))
            .select("blob", F.struct("f.start", ranks[F.col("f.rule")].alias("rank"), "f.end", "f.rule").alias("f"))
            .distinct()
        )
        return one.groupBy("blob").agg(F.array_sort(F.collect_list("f")).alias("found"))


def path_findings(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, strict: bool = False) -> DataFrame:
    """(path, blob, found) for every row of ``versions``; found is empty where nothing was, also where nothing was looked
    for. ``strict``: contents that these rule versions have not read are an error."""
    if strict and (missing := ledger.unscanned(versions, rules).count()):
        raise ValueError(f"{missing} contents were not scanned by all of {[r.key for r in rules]}")
    found = ledger.findings(rules).withColumnRenamed("blob", "b")
    none = F.array().cast("array<struct<start:int,rank:int,end:int,rule:string>>")
    return (
        with_blob(versions)
        .select("path", "blob")
        .join(found, F.col("blob") == F.col("b"), "left")
        .select("path", "blob", F.coalesce("found", none).alias("found"))
    )


def digest(found: DataFrame) -> DataFrame:
    """The columns of query op10."""

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", F.substring_index(s["rule"], "@", 1), s["start"], s["end"])), ","
        )

    count = lambda name: F.size(F.filter("found", lambda s: s["rule"].startswith(f"{name}@"))).cast("long")
    base = F.filter("found", lambda s: s["rank"] < len(BASE_RULES))
    return found.select(
        F.col("path").alias("doc_id"),
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


def redacted(text: Column, found: Column) -> Column:
    """``text`` with every span replaced by the name of its rule in brackets; overlapping spans become one."""

    def step(acc: Column, s: Column) -> Column:
        gap = F.concat(
            F.substr(text, acc["at"] + 1, s["start"] - acc["at"]),
            F.concat(F.lit("["), F.substring_index(s["rule"], "@", 1), F.lit("]")),
        )
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.concat(acc["out"], F.when(s["start"] >= acc["at"], gap).otherwise("")).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    end = F.aggregate(found, start, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(found) > 0, end).otherwise(text)


def without_secrets(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs``, all columns, with secrets replaced in ``text`` and ``n_chars`` (if there) renewed where
    something was. Scans what the ledger lacks first."""
    ledger.add(docs.select(F.col("doc_id").alias("path"), "text"), rules)
    of, spans = fresh_name(docs, "found_blob"), fresh_name(docs, "found_spans")
    found = ledger.findings(rules).select(F.col("blob").alias(of), F.col("found").alias(spans))
    blob = F.unhex(F.sha2(F.coalesce(docs["text"], F.lit("")).cast("binary"), 256))
    joined = docs.join(found, blob == F.col(of), "left")
    hit = F.col(spans).isNotNull()
    out = joined.withColumn("text", F.when(hit, redacted(F.col("text"), F.col(spans))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
