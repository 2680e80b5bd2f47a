"""From raw documents to packed training sequences: five stages, each over all rows its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next stage's docs,
so a stage restarts from a table, not from a lineage. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm import decontaminate, jaccard, language, packing, secrets
from zoneflow.llm.common import load, on_executors, written
from zoneflow.llm.queries import tokenizer_file
from zoneflow.session import new_run_dir


@on_executors
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be determined: null texts and texts without a letter. ``lang`` becomes the predicted
    language; where no document has a language to learn from, every text with a letter stays as it is."""
    network = language.train(docs.where(language.may_be_learned(F.col("doc_id"))))
    return language.identified(docs, network)


@on_executors
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest id, of each group linked by similar shingle sets."""
    return jaccard.one_of_each(docs)


@on_executors
def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontaminate.clean_documents(docs, load(spark, sf_dir, "benchmark"))


@on_executors
def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets inside texts; every document stays."""
    return secrets.without_secrets(docs, secrets.Ledger(spark, new_run_dir(spark, "secret-ledger")))


@on_executors
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.pack_documents(docs, tokenizer_file())


STAGES = [
    ("language", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("secrets", remove_secrets),
    ("packing", pack),
]

#: SQL can express neither the language network nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
