"""Quality model, mixing, neighbours and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakemart.llm import gam, mixing, neighbours, simhash
from lakemart.llm.common import table
from lakemart.session import cut_lineage

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------- quality

def test_quality_held_out_accuracy(spark):
    import __spark_entry__ as entry
    got = entry.queries()["op5_quality"](spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in held) / len(held)
    assert len(held) > 100 and right >= 0.95


def test_pairs_learn_an_interaction():
    r = np.random.default_rng(0)
    x = r.random((4000, len(gam.SIGNALS))).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.5)).astype(float)
    with_pairs = gam.train(x[:3000], y[:3000], rounds=10)
    alone = gam.train(x[:3000], y[:3000], rounds=10, pairs=0)

    def right(m):
        return float(((m.score(x[3000:]) >= 0.5) == y[3000:]).mean())

    assert (0, 3) in with_pairs.pairs and right(with_pairs) > 0.95 > 0.7 > right(alone)


def test_quality_edge_cases(spark):
    a, b = [i for i in range(1, 30) if zlib.crc32(str(i).encode()) % 3 != 1][:2]        # rows that may teach
    texts = [(100, None, 7), (a, "", 7), (None, "some words here", 7), (b, "word " * 20_000, 7), (b, "again", 7)]
    df = spark.createDataFrame(texts, "doc_id long, text string, signals long")
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = gam.fit_on_documents(df, none, "doc_id", "text", "quality")
    out = df.withColumn("score", gam.score_text(model, "text")).collect()
    assert len(out) == 5 and all(abs(r.score - 0.5) < 1e-9 and r.signals == 7 for r in out)
    one = spark.createDataFrame([(a, 1), (None, 0), (b, None), (b, 1)], "doc_id long, quality int")
    assert all(r.score > 0.99 for r in df.withColumn(
        "score", gam.score_text(gam.fit_on_documents(df, one, "doc_id", "text", "quality"), "text")).collect())
    assert df.limit(0).withColumn("score", gam.score_text(model, "text")).count() == 0


# ------------------------------------------------------------- mixing

def brute_posteriors(combos, labelled, domains, signals):
    def bins(c):
        out = []
        for _, _, e in reversed(signals.parts):
            c, b = divmod(c, len(e) + 1)
            out.append(b)
        return out[::-1]

    of = {k: sum(d == k for _, d in labelled) for k in domains}
    out = {}
    for c in combos:
        z = []
        for k in domains:
            p = (of[k] + 1) / (sum(of.values()) + len(domains))
            for i, b in enumerate(bins(c)):
                n = sum(d == k and bins(x)[i] == b for x, d in labelled)
                p *= (n + 1) / (of[k] + len(signals.parts[i][2]) + 1)
            z.append(p)
        own = [sum(x == c and d == k for x, d in labelled) for k in domains]
        out[c] = [(o + mixing.PRIOR * a / sum(z)) / (sum(own) + mixing.PRIOR) for o, a in zip(own, z)]
    return out


def test_posteriors_equal_brute_force(spark):
    r = random.Random(3)
    domains = ["clean", "toxic", "low"]
    labelled = [(r.choice([0, 1, 5, 40, 863, 2000]), r.choice(domains)) for _ in range(80)]
    combos = [0, 1, 5, 7, 40, 863, 2000, 5183]
    signals = mixing.with_words({"toxic": ["idiot"]})
    got = mixing.posteriors(spark.createDataFrame([(c,) for c in combos], "combo int"),
                            spark.createDataFrame(labelled, "combo int, domain string"), domains, signals).collect()
    want = brute_posteriors(combos, labelled, domains, signals)
    for x in got:
        assert x.p == pytest.approx(want[x.combo])
    assert signals.size == 6 ** 4 * 4


def test_rates_match_targets_and_stay_non_negative(spark):
    rows = [(0, 900, [0.95, 0.04, 0.01]), (1, 60, [0.2, 0.8, 0.0]), (2, 100, [0.02, 0.03, 0.95]), (3, 40, [0.5, 0.5, 0.0])]
    df = spark.createDataFrame(rows, "combo int, tokens long, p array<double>")
    out = mixing.fit_rates(df, ["a", "b", "c"], [0.7, 0.2, 0.1]).collect()
    total = [sum(r.rate * r.tokens * r.p[k] for r in out) for k in range(3)]
    assert all(r.rate >= 0 for r in out) and total == pytest.approx([770, 220, 110], rel=0.02)
    only = mixing.fit_rates(df, ["a", "b", "c"], [0.0, 0.0, 1.0]).collect()
    assert min(r.rate for r in only) == 0 and max(r.rate for r in only) > 1
    kept = mixing.fit_rates(df, ["a", "b", "c"], [0.9, 0.09, 0.01], anchor="a", margin=0.02).collect()
    assert sum(r.rate * r.tokens * r.p[0] for r in kept) == pytest.approx(1.02 * sum(t * p[0] for _, t, p in rows), rel=0.02)


def test_mixing_edge_cases(spark):
    df = spark.createDataFrame([(1, None, 3, 4), (None, "a | b || idiot", 3, 4), (2, "", 3, 4), (2, "", 3, 4), (3, "w " * 50_000, 3, 4)],
                               "doc_id long, text string, combo long, rate long")
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    args = (mixing.label_domains(labels), ["clean", "toxic", "low"], [0.9, 0.05, 0.05])
    out = mixing.mix(df, "doc_id", "text", *args).collect()
    assert len(out) == 5 and sorted(r.tokens for r in out) == [0, 0, 0, 5, 50_000]
    assert all(abs(r.p_clean + r.p_toxic + r.p_low - 1) < 1e-9 and r.rate >= 0 and r.copies >= 0 for r in out)
    kept = mixing.thin(df, "doc_id", "text", *args, anchor="clean", margin=1.0)
    assert kept.columns == df.columns and kept.count() <= 5
    assert mixing.mix(df.limit(0), "doc_id", "text", *args).count() == 0
    assert mixing.thin(df.limit(0), "doc_id", "text", *args).count() == 0


def test_mixing_reads_signals(spark):
    texts = ["plain words here", "AA!! BB!! CC!!", "a| b| c|", "x### y$$$ z%%%", "go go go go", "you idiot"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.r.doc_id: r.combo for r in mixing.with_combination(df, "text", mixing.with_words({"toxic": ["idiot"]})).collect()}
    assert len(set(got.values())) == len(texts) and got[0] == 0


def test_mixing_learns_words_of_a_domain(spark):
    """Words and beginnings that only one domain's labelled texts have, in any language."""
    r = random.Random(5)
    plain = ["bald", "heute", "straße", "über", "haus", "und", "wegen", "lang"]
    rows, labels = [], []
    for i in range(400):
        words = r.choices(plain, k=12)
        toxic = i % 8 == 0
        if toxic:
            words += r.choices(["schuft", "übelmann", "übelfrau", "übelkerl", "übeltat"], k=3)
        r.shuffle(words)
        rows.append((i, " ".join(words).capitalize()))
        if i < 300:
            labels.append((i, "toxic" if toxic else "clean"))
    df, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "id long, domain string")
    marks = mixing.learn_marks(df, "doc_id", "text", lab, "toxic")
    assert any(m.startswith("schuf") for m in marks) and any(m.startswith("übel") for m in marks) and not set(plain) & set(marks)
    counted = df.withColumn("t", F.col("text")).select("doc_id", mixing.with_words({"toxic": ["schuft", "übelm*"]}).parts[-1][1]().alias("n"))
    for (i, text), x in zip(rows, counted.orderBy("doc_id").collect()):
        assert x.n == len({w if w == "schuft" else w[:5] for w in text.lower().split() if w == "schuft" or w.startswith("übelm")})
    out = mixing.mix(df, "doc_id", "text", lab, ["clean", "toxic"], [0.95, 0.05], "clean").collect()
    held = [x for x in out if x.doc_id >= 300]
    assert min(x.p_toxic for x in held if x.doc_id % 8 == 0) > 0.5 > 0.2 > max(x.p_toxic for x in held if x.doc_id % 8)
    assert mixing.learn_marks(df, "doc_id", "text", lab.filter("domain = 'toxic'"), "toxic") == []
    assert mixing.learn_marks(df.limit(0), "doc_id", "text", lab, "toxic") == []


def test_toxic_documents_of_all_languages_are_told_apart(spark):
    """Posteriors of labelled documents whose labels were not shown."""
    d = "/root/testdata/sf0.1"
    docs, labels = table(spark, d, "documents"), mixing.label_domains(table(spark, d, "labels"))
    shown = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(4)) != 2
    out = mixing.mix(docs, "doc_id", "text", labels.filter(shown), corpus_pipeline.DOMAINS, corpus_pipeline.WEIGHTS, "clean")
    held = labels.filter(~shown & F.col("domain").isin("toxic", "clean"))
    rows = out.join(held, F.col("doc_id") == F.col("id")).join(docs.select("doc_id", "lang"), "doc_id") \
              .groupBy((F.col("lang") == "en").alias("en"), "domain").agg(F.avg("p_toxic").alias("p")).collect()
    p = {(x.en, x.domain): x.p for x in rows}
    assert p[True, "toxic"] > 0.8 and p[False, "toxic"] > 0.4
    assert p[True, "clean"] < 0.05 and p[False, "clean"] < 0.05


# ------------------------------------------------------------- neighbours

def brute(rows, k):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = sorted(ok)
    out = {}
    for q in ids:
        if q % 20 == 0:
            s = [(-float(np.dot(*pad(ok[q], ok[i]))), i) for i in ids if i != q]
            out[q] = [(i, -x) for x, i in sorted(s)[:k]]
    return out


def pad(a, b):
    n = max(len(a), len(b))
    return np.pad(a, (0, n - len(a))), np.pad(b, (0, n - len(b)))


def run(spark, rows, k=20, extra=""):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, score int, node int")
    got = {}
    for r in neighbours.nearest(df.repartition(3), "vec_id", "embedding", F.pmod("vec_id", F.lit(20)) == 0, k).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: [(v, s) for _, v, s in sorted(x)] for q, x in got.items()}


def test_neighbours_small_and_odd_vectors(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in r.standard_normal(6)]) for i in range(1, 16)]
    rows += [(0, rows[3][1]), (20, rows[3][1]), (40, rows[3][1]), (None, [1.0] * 6), (60, None), (61, [0.0] * 6),
             (62, [float("nan")] + [0.0] * 5), (63, [float("inf")] + [1.0] * 5), (64, [None, 1.0]), (65, []), (80, [2.0, 1.0]),
             (80, [2.0, 1.0])]
    got, want = run(spark, rows), brute(list({str(x): x for x in rows}.values()), 20)
    assert set(got) == set(want) == {0, 20, 40, 80}
    for q in want:
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-9)
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(df, "vec_id", "embedding", F.lit(True)).count() == 0
    assert run(spark, [(0, [1.0, 0.0])]) == {}


def test_neighbours_recall_with_copies_and_long_vectors(spark):
    r = np.random.default_rng(2)
    base = r.standard_normal((1500, 32)) * r.uniform(0.2, 2.0, (1500, 1))
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(base)]
    rows += [(2000 + i, rows[7][1]) for i in range(700)]                     # one vector many times
    got, want = run(spark, rows, 10), brute(rows, 10)
    assert set(got) == set(want)
    hits = [len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 10 for q in want]
    assert np.mean(hits) >= 0.9
    for q in (2000, 2100):
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]


def test_neighbours_recall_among_near_copies(spark):
    r = np.random.default_rng(3)
    x = r.standard_normal(64) * (1 + 0.001 * r.standard_normal((1500, 64)))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    got, want = run(spark, rows), brute(rows, 20)
    recall = np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 20 for q in want])
    assert set(got) == set(want) and recall >= 0.95


def test_neighbours_of_a_node_in_no_list(spark, monkeypatch):
    """Links in which all nodes list 0 and 1 only, 0 and 1 each other: beyond
    the reverse links no list has the worst nodes, one of which asks."""
    x = [[1.0, 0.0], [0.999, 0.01]] + [[0.9 - 0.005 * i, 0.1 + 0.005 * i] for i in range(98)] + [[0.1, 2.0], [0.1, 1.9]]
    rows = [(i + 1, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)] + [(200, [float(np.float32(0.1)), 2.0]),
                                                                                (220, [float(np.float32(0.1)), 2.0])]
    links = [(u, v, float(np.dot(x[u - 1], x[v - 1]) / 5)) for u in range(1, len(x) + 1) for v in (1, 2) if u != v]
    monkeypatch.setattr(neighbours, "graph", lambda *a: spark.createDataFrame(links, "u long, v long, s double"))
    got, want = run(spark, rows, 2), brute(rows, 2)
    assert [v for v, _ in got[200]] == [v for v, _ in want[200]] == [101, 220]
    assert [s for _, s in got[200]] == pytest.approx([s for _, s in want[200]])
    assert [v for v, _ in got[100]] == [v for v, _ in want[100]] == [101, 200]


# ------------------------------------------------------------- pipeline

def test_pipeline_stages_on_their_own_inputs(spark):
    docs = table(spark, SF, "documents")
    columns, steps = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = cut_lineage(stage(spark, before, SF), f"t-{name}")
        steps[name] = (before, docs)
        if name != "tokens":
            assert docs.columns == columns
            rows = {r.doc_id: r for r in before.collect()}
            assert all(rows[r.doc_id] == r for r in docs.collect())
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}

    before, after = ({r.doc_id: r.text for r in x.collect()} for x in steps["quality"])
    known = [d for d in before if d in labels]
    assert sum((d in after) == (labels[d][0] == 1) for d in known) / len(known) > 0.97

    before, after = ({r.doc_id: r.text for r in x.collect()} for x in steps["exact_dedup"])
    last = {}
    for d, t in before.items():
        last[t] = max(d, last.get(t, -1))
    assert sorted(after) == sorted(last.values())

    before, after = ({r.doc_id: r.text for r in x.collect()} for x in steps["near_dedup"])
    prints = {d: simhash.fingerprint_of(t, 3) & (2 ** 64 - 1) for d, t in before.items()}
    parent = {d: d for d in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    v = np.array([prints[d] for d in ids], np.uint64)
    for i, d in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= 3) + i + 1:
            a, b = root(d), root(ids[j])
            parent[max(a, b)] = min(a, b)
    assert sorted(after) == sorted({root(d) for d in ids})

    before, after = ({r.doc_id for r in x.collect()} for x in steps["mixing"])
    clean = [d for d in before if labels.get(d) == (1, 0)]
    assert sum(d in after for d in clean) / len(clean) > 0.97

    before, after = steps["tokens"]
    assert before.count() == after.count()
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()} == {tuple(r) for r in after.collect()}


def test_pipeline_survives_odd_rows(spark, tmp_path):
    docs = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (None, "some plain words", None, None, None),
            (3, "some plain words", "en", "s", 1), (3, "some plain words", "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, rows in (("some", docs), ("none", [])):
        d = str(tmp_path / name)
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(3, 1, 0)] if rows else [], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        out = corpus_pipeline.run(spark, d).collect()
        assert len(out) == (2 if rows else 0)
