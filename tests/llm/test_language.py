from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from zoneflow.llm import language


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    rows = language.predict(docs, language.train(docs.where(~language.is_held_out(F.col("doc_id"))))).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows if r["held_out"]]) > 0.95


def small(spark):
    rows = [(i, t, lang, "c") for i, (t, lang) in enumerate([("the house and the dog of them " * 9, "en"), ("das haus und der hund von ihnen " * 9, "de")] * 20)]
    rows += [(100, None, "en", "c"), (101, "", "de", "c"), (102, "12 %% \n", "en", "c"), (103, "und das haus", None, "c"), (103, "und das haus", None, "c"), (None, "the dog", None, "c"), (2**60 + 1, "the and " * 30_000, None, "c")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_odd_rows(spark):
    docs = small(spark)
    network = language.train(docs)
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language.predict(docs, network).collect()]
    assert len(got) == 47
    by_id = {d: (p, s) for d, p, s in got}
    assert by_id[100] == by_id[101] == by_id[102] == ("und", 0.0)
    assert by_id[103][0] == "de" and by_id[None][0] == by_id[2**60 + 1][0] == "en"
    kept = language.identified(docs, network)
    assert kept.columns == docs.columns and kept.count() == 44


def test_prediction_does_not_depend_on_the_batch(spark):
    docs = small(spark)
    network = language.train(docs)
    texts = ["the dog", "das haus", "x" * 128, "the house " * 40]
    together = network.predict(texts)
    for t, p in zip(texts, together, strict=True):
        assert np.allclose(network.predict([t])[0], p, atol=1e-5)


def test_nothing_to_learn_from(spark):
    docs = small(spark).where("lang IS NULL")
    assert language.train(docs) is None
    assert {r["lang_pred"] for r in language.predict(docs, None).collect()} == {"und"}
    assert language.predict(docs.limit(0), None).count() == 0


def test_whole_texts_count(spark):
    network = language.train(small(spark))
    assert network.predict(["das haus und " * 10 + "the dog and " * 200])[0].argmax() == network.languages.index("en")


def test_numerals_are_no_letters(spark):
    texts = ["\u00b2", "\u00bd \u2460 \u2167", "12_\u00b3"]
    docs = small(spark)
    network = language.train(docs)
    signs = spark.createDataFrame([(i, t, None, "c") for i, t in enumerate(texts)], docs.schema)
    assert {(r["lang_pred"], r["score"]) for r in language.predict(signs, network).collect()} == {("und", 0.0)}
    assert language.identified(signs, network).count() == 0
    assert language.has_letter("\u00b2 m") and language.has_letter("\u5bb6")


def test_stage_writes_the_language(spark):
    docs = small(spark).withColumn("language", F.lit("x")).withColumn("_language", F.lit("y"))
    network = language.train(docs)
    kept = language.identified(docs, network)
    assert kept.columns == docs.columns
    assert {(r["doc_id"], r["lang"]) for r in kept.where("doc_id IN (0, 1, 103)").collect()} == {(0, "en"), (1, "de"), (103, "de")}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_a_corpus_without_labels_is_kept(spark):
    docs = small(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = language.identified(docs, language.train(docs))
    assert kept.columns == docs.columns and kept.count() == 44
    assert kept.where("lang IS NOT NULL").count() == 0


def test_ids_of_any_type_and_rows_without_id(spark):
    docs = small(spark)
    texts = docs.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    assert language.train(texts).languages == ["de", "en"]
    nobody = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert nobody.where(language.may_be_learned(F.col("doc_id"))).count() == 0
    assert not any(r["held_out"] for r in language.predict(nobody, None).collect())


def plain(network, text):
    """Filters, their largest answer, the softmax and the mean over windows, written as loops."""
    raw = text.encode().lower()
    windows = -(-len(raw) // language.WINDOW)
    raw += bytes(windows * language.WINDOW + language._REACH - len(raw))
    total, weights = np.zeros(len(network.languages)), 0
    for w in range(windows):
        hidden = []
        for f in range(network.filters.shape[1]):
            answers = []
            for t in range(w * language.WINDOW, (w + 1) * language.WINDOW):
                answer = 0.0
                for k in range(max(language.WIDTHS)):
                    for d in range(language.EMBEDDING):
                        answer += float(network.embedding[raw[t + k], d]) * float(network.filters[k * language.EMBEDDING + d, f])
                answers.append(answer)
            hidden.append(max(0.0, max(answers) + float(network.bias[f])))
        scores = np.exp(np.array(hidden) @ network.dense + network.dense_bias)
        used = sum(b != 0 for b in raw[w * language.WINDOW : (w + 1) * language.WINDOW])
        total += used * scores / scores.sum()
        weights += used
    return total / weights


def test_against_a_plain_convolution(spark):
    network = language.train(small(spark))
    texts = ["the dog and das haus", "x", "und das " * 20]
    for text, got in zip(texts, network.predict(texts), strict=True):
        assert np.allclose(got, plain(network, text), atol=1e-3)
