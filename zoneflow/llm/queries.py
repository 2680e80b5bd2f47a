"""The queries of the corpus operators and, where SQL can express them, their results as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm import bestfit, chat, decontaminate, infill, jaccard, language, packing, pages, repair, revisits, secrets, severity, topk
from zoneflow.llm.common import load, on_executors
from zoneflow.session import new_run_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = on_executors(fn)
    return fn


@query
def op1_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.digest(revisits.resolve(revisits.captures(load(spark, sf_dir, "pages"))))


@query
def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(load(spark, sf_dir, "pages"))


@query
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.format_conversations(chat.with_probe(load(spark, sf_dir, "conversations"))))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs.where(language.may_be_learned(F.col("doc_id")))))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return severity.predict(docs, severity.train(docs, load(spark, sf_dir, "labels")))


@query
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.digest(jaccard.similar_components(load(spark, sf_dir, "documents")))


@query
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(
        decontaminate.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    )


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(load(spark, sf_dir, "documents"), tokenizer_file())


@query
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id")))


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    ledger = secrets.Ledger(spark, new_run_dir(spark, "secret-ledger"))
    ledger.add(versions)
    return secrets.digest(secrets.path_findings(versions, ledger))


@query
def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack_best_fit(load(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = load(spark, sf_dir, "conversations")
    return repair.digest(conversations, repair.repair(repair.damaged(conversations)))


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digest(infill.fill_in_middle(load(spark, sf_dir, "documents")))


ORACLE_SQL: dict[str, str] = {
    "op1_revisit_resolution": revisits.SQL,
    "op3_chat_formatting": chat.SQL,
    "op6_ngram_jaccard_join": jaccard.SQL,
    "op7_benchmark_decontamination": decontaminate.SQL,
    "op9_exact_top_k": topk.SQL,
    "op13_fill_in_middle": infill.SQL,
}
