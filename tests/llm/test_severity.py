from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from zoneflow.llm import severity


def test_toxic_documents_are_found(spark, sf):
    sf = sf.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    learned = labels.where("doc_id % 2 = 0")
    model = severity.train(docs, learned)
    truth = labels.where("doc_id % 2 = 1").select("doc_id", F.col("toxic").alias("y"))
    rows = severity.predict(docs, model).join(truth, "doc_id").toPandas()
    y = rows["y"] > 0
    assert y.sum() > 100
    assert (rows["toxic"] & y).sum() >= 0.9 * y.sum()
    assert (rows["toxic"] & ~y).sum() <= 0.02 * (~y).sum()
    assert rows["severity"].between(0, severity.GRADES - 1).all()
    assert set(rows["grade"]) <= set(range(severity.GRADES))


def tiny(spark):
    good, bad = "a calm text about the house and the weather of today", "you foul rotten beast and the weather"
    docs = [(i, f"{bad} {' foul rotten' * (i % 5)}" if i % 2 else good, "g") for i in range(60)]
    labels = [(i, i % 2, 1) for i in range(60)] + [(None, 1, 1), (500, 1, 1), (3, None, 1)]
    docs += [(100, None, "g"), (101, "", "g"), (102, " .,! ", "g"), (103, "rotten foul beast foul rotten", "g"), (103, "rotten foul beast foul rotten", "g"), (None, good, "g"), (104, "calm house " * 30_000, "g")]
    return spark.createDataFrame(docs, "doc_id long, text string, severity string"), spark.createDataFrame(labels, "doc_id long, toxic int, text int")


def test_odd_rows(spark):
    docs, labels = tiny(spark)
    rows = severity.predict(docs, severity.train(docs, labels)).collect()
    assert len(rows) == 67
    by_id = {r["doc_id"]: r for r in rows}
    for i in (100, 101, 102):
        assert (by_id[i]["severity"], by_id[i]["grade"], by_id[i]["toxic"]) == (0.0, 0, False)
    assert by_id[103]["toxic"] and not by_id[None]["toxic"] and not by_id[104]["toxic"]


def test_probabilities_are_ordered_and_sum_to_the_severity(spark):
    docs, labels = tiny(spark)
    model = severity.train(docs, labels)
    p = model.probabilities(np.linspace(-9, 9, 50))
    assert (np.diff(p, axis=1) <= 1e-12).all()
    assert (np.diff(model.thresholds) > 0).all()


def test_without_both_labels_nothing_is_toxic(spark):
    docs, labels = tiny(spark)
    for some in (labels.limit(0), labels.where("toxic = 0")):
        assert {r["toxic"] for r in severity.predict(docs, severity.train(docs, some)).collect()} == {False}
    assert severity.predict(docs.limit(0), severity.OrdinalModel()).count() == 0


def test_a_toxic_passage_in_a_very_long_text(spark):
    docs, labels = tiny(spark)
    calm = "a calm text about the house and the weather of today "
    passage = "you foul rotten beast foul rotten "
    places = [0, 95, 5_000, 10_000]  # times ten words, once over the end of a half window
    texts = [(i, calm * n + passage + calm * (10_000 - n), "g") for i, n in enumerate(places)] + [(9, calm * 10_000, "g")]
    model = severity.train(docs, labels)
    rows = {r["doc_id"]: r for r in severity.predict(spark.createDataFrame(texts, docs.schema), model).collect()}
    assert [rows[i]["toxic"] for i in (0, 1, 2, 3, 9)] == [True] * 4 + [False]
    short = severity.predict(spark.createDataFrame([(1, passage, "g")], docs.schema), model).first()
    assert abs(short["severity"] - rows[2]["severity"]) < 1e-9


def test_long_labelled_texts_are_learned_from(spark):
    calm = "a calm text about the house and the weather of today "
    docs = [(i, calm * 400 + ("you vile scum " * 3 if i % 2 else "") + calm * 400, "g") for i in range(40)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, severity string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    short = docs.withColumn("text", F.concat(F.lit(calm), F.when(F.col("doc_id") % 2 == 1, "you foul beast vile").otherwise("")))
    both = docs.unionByName(short.withColumn("doc_id", F.col("doc_id") + 100))
    more = labels.unionByName(labels.withColumn("doc_id", F.col("doc_id") + 100))
    for d, l in ((docs, labels), (both, more)):
        model = severity.train(d, l)
        assert model.weights.get("vile", 0) > 0 and model.weights.get("scum", 0) > 0
        rows = severity.predict(d, model).collect()
        assert all(r["toxic"] == (r["doc_id"] % 2 == 1) for r in rows)


def test_gradient_is_that_of_the_loss():
    """One tiny step of the fit moves every weight and threshold against the numeric gradient of the weighted loss."""
    rng = np.random.default_rng(0)
    toxic = np.array([True, False, True, False, True, False])
    row, col, val = np.repeat(np.arange(6), 2), rng.integers(0, 3, 12), rng.random(12) + 0.1
    prior, features = 0.3, 3
    grades = severity._graded(np.bincount(row, val, 6), toxic)
    weight = np.where(toxic, prior / toxic.sum(), (1 - prior) / (~toxic).sum())

    def loss(w, t):
        score = np.bincount(row, w[col] * val, 6)
        p = 1 / (1 + np.exp(t[None, :] - score[:, None]))
        above = grades[:, None] > np.arange(severity.GRADES - 1)[None, :]
        return -(weight[:, None] * np.where(above, np.log(p), np.log(1 - p))).sum() + 5e-6 * (w**2).sum()

    before = severity._solved(row, col, val, toxic, features, prior, 300)
    after = severity._solved(row, col, val, toxic, features, prior, 4000)
    assert loss(*after) <= loss(*before) + 1e-9
    w, t = after
    for k in range(features):  # a minimum: no small move along a weight (kept at 0 or above) or all thresholds gains
        for move in (1e-3, -1e-3):
            if w[k] + move >= 0:
                assert loss(w + move * (np.arange(features) == k), t) >= loss(w, t) - 1e-5
    for move in (1e-3, -1e-3):
        assert loss(w, t + move) >= loss(w, t) - 1e-5


def test_windows_against_plain_ones():
    words = [f"w{i % 7}" if i % 31 else "foul" for i in range(700)]
    known = severity._knower({"foul", "w3"}, {})
    got = dict(severity._windows(words, known))
    half = severity.PER_WORDS // 2
    for at in range(0, len(words), half):
        part = words[at : at + 2 * half]
        want = {f: np.log1p(part.count(f)) for f in ("foul", "w3") if part.count(f)}
        if any(x in ("foul", "w3") for x in words[at : at + half]):
            assert got[at] == want


def test_training_does_not_depend_on_the_order_of_rows(spark):
    docs, labels = tiny(spark)
    one = severity.train(docs.repartition(7), labels.repartition(3))
    two = severity.train(docs.orderBy(F.desc("doc_id")).coalesce(1), labels.coalesce(1))
    assert one.weights == two.weights and (one.thresholds == two.thresholds).all()


def test_several_documents_of_one_id(spark):
    docs, labels = tiny(spark)
    more = docs.unionByName(docs.withColumn("text", F.concat("text", F.lit(" again"))))
    model = severity.train(more, labels)
    assert model.weights and len(severity.predict(more, model).collect()) == 2 * docs.count()
