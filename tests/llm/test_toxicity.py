"""Counterfactually regularised toxicity scores."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from lakemart.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_documents(spark):
    import __spark_entry__ as entry
    got = entry.queries()["op13_toxicity"](spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    found = [r for r in held if labels[r.doc_id] == 1]
    assert len(found) > 50 and sum(r.predicted for r in found) / len(found) >= 0.9
    clean = [r for r in held if labels[r.doc_id] == 0]
    assert sum(r.predicted for r in clean) / len(clean) <= 0.02
    for lang in ("de", "en", "es", "fr"):
        mine = [r.predicted for r in found if r.lang == lang]
        assert sum(mine) / len(mine) >= 0.8, lang


def biased(seed=1, n=600):
    """Sentences in which one group is mentioned mostly by toxic writers."""
    r = random.Random(seed)
    plain = ["today", "train", "was", "late", "we", "met", "some", "people", "near", "house", "and", "talked", "about", "work"]
    bad = ["vermin", "filth", "garbage"]
    rows = []
    for i in range(n):
        words = r.sample(plain, 6)
        toxic = i % 4 == 0
        if toxic and r.random() < 0.7:                  # the others are toxic by tone only
            words.insert(r.randrange(6), r.choice(bad))
        if r.random() < (0.8 if toxic else 0.04):
            words.insert(r.randrange(6), "muslims")
        elif r.random() < 0.1:
            words.insert(r.randrange(6), r.choice(["hindus", "christians"]))
        rows.append((i, " ".join(words) + ".", int(toxic)))
    return rows


def test_neutral_mentions_are_not_marked(spark):
    rows = biased()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    neutral, toxic = "some muslims talked about work.", "the filth near house."
    score = {}
    for weight in (0.0, 100.0):
        s = toxicity.fit(docs, labels, "doc_id", "text", "toxic", weight=weight).scorer()
        score[weight] = s(neutral), s(neutral.replace("muslims", "hindus")), s(toxic)
    assert score[0.0][0] > 0.5 and score[0.0][0] - score[0.0][1] > 0.3
    assert score[100.0][0] < 0.3 and abs(score[100.0][0] - score[100.0][1]) < 0.02
    assert score[100.0][2] > 0.9


def test_swaps_stay_in_the_group():
    words = "the muslim woman and the young men met two old muslim men".split()
    for turn in range(5):
        got = toxicity.swapped(words, turn)
        for a, b in zip(words, got):
            assert (a == b) == (a not in toxicity._GROUP)
            assert toxicity._GROUP.get(a) == toxicity._GROUP.get(b)
        assert got[1] == got[10]
    assert toxicity.counterfactuals("no group here. nor there", toxicity.Features()) == []
    assert len(toxicity.counterfactuals("Women spoke.\nThe men, too! And it ended", toxicity.Features())) == 2 * toxicity.SWAPS


def test_fit_against_plain_descent():
    """The accelerated fit reaches the least loss that slow steps reach."""
    import numpy as np
    r = np.random.default_rng(3)
    docs = [(int(r.random() < (0.7 if i % 3 else 0.2)), sorted({i % 3 + 1, int(r.integers(4, 9))})) for i in range(300)]
    swaps = [([1], [5], 3), ([2, 7], [], 1)]
    model = toxicity.train(docs, swaps, weight=0.5, ridge=1e-3, sparse=2.0, lean=1.5)
    x = np.zeros((len(docs), 10))
    for i, (_, f) in enumerate(docs):
        x[i, [*f, 9]] = 1
    y = np.array([label for label, _ in docs])
    each = np.where(y == 1, 1.5, 1.0)
    d = np.zeros((2, 10))
    d[0, 1], d[0, 5], d[1, 2], d[1, 7] = (3 / 4) ** 0.5, -((3 / 4) ** 0.5), 0.5, 0.5

    def loss(w):
        z = x @ w
        return (np.mean((np.logaddexp(0, z) - y * z) * each) + 5e-4 * (w[:-1] ** 2).sum()
                + 2.0 / len(y) * w[:-1].sum() + 0.25 * ((d @ w) ** 2).sum())

    w = np.zeros(10)
    for _ in range(20_000):
        p = 1 / (1 + np.exp(-(x @ w)))
        w -= 0.5 * (x.T @ ((p - y) * each) / len(y) + np.append(1e-3 * w[:-1] + 2.0 / len(y), 0) + 0.5 * d.T @ (d @ w))
        w[:-1] = np.maximum(w[:-1], 0)
    got = np.array([*(model.weights.get(i, 0.0) for i in range(9)), model.base])
    assert abs(loss(got) - loss(w)) < 1e-6 and np.abs(got - w).max() < 1e-2


def test_odd_rows(spark):
    teach = [i for i in range(1, 300) if zlib.crc32(str(i).encode()) % 4 != 2][:80]
    rows = [(100, None, 7), (101, "", 7), (None, "vermin all over", 7), (102, "vermin " * 30_000, 7), (102, "again", 7)]
    rows += [(i, f"nice weather {n}" if n % 4 else f"vermin there {n}", 7) for n, i in enumerate(teach)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, score long")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(df, none, "doc_id", "text", "toxic")
    assert all(abs(r.s - 0.5) < 1e-9 and r.score == 7 for r in df.withColumn("s", toxicity.score_text(model, "text")).collect())
    one = spark.createDataFrame([(teach[0], 1), (None, 0), (teach[1], None), (teach[1], 5)], "doc_id long, toxic int")
    model = toxicity.fit(df, one, "doc_id", "text", "toxic")
    assert all(r.s > 0.99 for r in df.withColumn("s", toxicity.score_text(model, "text")).collect())
    both = spark.createDataFrame([(i, int(n % 4 == 0)) for n, i in enumerate(teach)] * 3, "doc_id long, toxic int")
    model = toxicity.fit(df, both, "doc_id", "text", "toxic")
    got = {(r.doc_id, r.text): r.s for r in df.withColumn("s", toxicity.score_text(model, "text")).collect()}
    assert got[100, None] == got[101, ""] == got[102, "again"] < 0.5 < got[None, "vermin all over"] < 1
    assert got[102, "vermin " * 30_000] > 0.5
    assert df.limit(0).withColumn("s", toxicity.score_text(model, "text")).count() == 0
    empty = toxicity.fit(df.limit(0), both, "doc_id", "text", "toxic")
    assert empty.weights == {} and empty.scorer()("x") == pytest.approx(0.5)


def test_sample_is_bounded(spark):
    rows = biased(2, 200)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    taken = toxicity.labelled(docs, labels, "doc_id", "text", "toxic", sample=50)
    assert taken.count() == 50 and taken.select(F.countDistinct("text")).first()[0] <= 50
