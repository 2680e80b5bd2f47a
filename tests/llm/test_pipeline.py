from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from zoneflow.llm import decontaminate, jaccard, secrets
from zoneflow.session import new_run_dir


@pytest.fixture(scope="module")
def staged(spark, sf):
    """The documents and what each stage makes of them."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = [(10**6 + 3, "a password=abcdefgh12 of its own", "en", "s", 31), (10**6, None, "en", "s", 0), (10**6 + 1, "12 % 34", "en", "s", 7), (10**6 + 2, "", None, None, None)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        path = new_run_dir(spark, "test-stage")
        stage(spark, out[-1], sf).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_columns(staged):
    assert all(s.columns == staged[0].columns for s in staged[:-1])
    assert {n for n, _ in corpus_pipeline.STAGES} == {"language", "near-duplicates", "decontamination", "secrets", "packing"}


def test_language_drops_only_texts_without_letters(staged):
    assert set(ids(staged[0])) - set(ids(staged[1])) == {10**6, 10**6 + 1, 10**6 + 2}


def test_one_of_each_group_stays(staged):
    result = jaccard.similar_components(staged[1]).collect()
    assert ids(staged[2]) == sorted({r["component_id"] for r in result})
    assert len(ids(staged[2])) < len(ids(staged[1]))


def test_contaminated_documents_go(spark, sf, staged):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    good = decontaminate.contamination(staged[2], items).where(~F.col("contaminated"))
    assert ids(staged[3]) == ids(good)


def test_secrets_go_and_documents_stay(spark, staged):
    assert ids(staged[4]) == ids(staged[3])
    versions = staged[4].select(F.col("doc_id").alias("path"), "text")
    ledger = secrets.Ledger(spark, new_run_dir(spark, "test-ledger"))
    ledger.add(versions)
    assert secrets.path_findings(versions, ledger).where(F.size("found") > 0).count() == 0
    same = staged[4].join(staged[3], ["doc_id", "text"]).count()
    assert 0 < same < staged[3].count()
    assert staged[4].where("n_chars <> length(text)").count() == 0


def test_packing_has_every_document(staged):
    assert set(ids(staged[5])) == set(ids(staged[4]))


CLASHING = ["marked_id", "marked_id_kept", "marked_id_rows", "_marked_id", "bad_id", "bad_content", "found_blob", "found_spans", "language", "node", "of", "of_id", "of_content", "component_id", "blob", "path", "h", "pos", "w", "t", "win", "label", "n", "grp", "text_a"]


@pytest.mark.parametrize("number", range(4))
def test_extra_columns_with_the_names_used_inside(spark, sf, number):
    """Every name that a stage uses itself may be a column of the documents; rows and values stay as without them."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60")
    extra = docs.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id")).alias(c) for c in CLASHING])
    stage = corpus_pipeline.STAGES[number][1]
    plain = {r["doc_id"]: r["text"] for r in stage(spark, docs, sf).collect()}
    out = stage(spark, extra, sf)
    assert out.columns == extra.columns
    rows = out.collect()
    assert {r["doc_id"]: r["text"] for r in rows} == plain
    assert all(r[c] == f"{c}:{r['doc_id']}" for r in rows for c in CLASHING)


def test_a_corpus_without_languages_is_kept(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    letters = docs.where(F.col("text").rlike(r"\p{L}")).count()
    assert corpus_pipeline.STAGES[0][1](spark, docs, sf).count() == letters > 0


def test_run(spark, sf, staged, tmp_path):
    """The whole chain over the same documents makes the rows that its stages make."""
    staged[0].coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path))
    assert rows.columns == staged[5].columns
    totals = lambda df: sorted(tuple(r) for r in df.groupBy("doc_id", "doc_tokens").agg(F.sum("length")).collect())
    assert totals(rows) == totals(staged[5])
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
