"""Collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lakemart.llm import phrases

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def pieces(text):
    for p in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
        yield re.findall("[^ \t]+", p)


def plain(rows, longest=3, least=10, inside=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        for w in pieces(text):
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                f.update((lang or "und", *w[i:i + k]) for i in range(len(w) - k + 1))
    out = {}
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    for p, a in candidates.items():
        lang, w = p[0], p[1:]
        if any(q[0] == lang and len(q) > len(p) and 100 * b >= inside * a
               and any(q[i:i + len(w)] == w for i in range(1, len(q))) for q, b in candidates.items()):
            continue
        cuts = [(1_000_000 * a * a // (f[p[:k + 1]] * f[(lang, *p[k + 1:])]), k, f[p[:k + 1]], f[(lang, *p[k + 1:])])
                for k in range(1, len(w))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                  for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


def found(spark, rows, **kw):
    df = spark.createDataFrame([(i, *r, 0) for i, r in enumerate(rows)],
                               "phrase long, lang string, text string, n int").repartition(4)
    return sorted(tuple(r) for r in phrases.collocations(df, "text", "lang", **kw).collect())


def corpus(seed, docs=300):
    r = random.Random(seed)
    words = ["Aa", "b", "É", "é", "zz", "d-d", " x", "w\x00", "日本", "of", "the"]
    out = []
    for _ in range(docs):
        parts = [r.choice(words) + r.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", " the of "]) for _ in range(r.randrange(60))]
        out.append((r.choice(["en", "de", None, "und", "en"]), "".join(parts)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_counting(spark, seed):
    rows = corpus(seed) + [(None, None), ("en", ""), ("xx", ". , ;"), ("yy", "alone " * 9), ("en", "the of b " * 3_000)]
    want = plain(rows)
    assert want and found(spark, rows) == want
    assert found(spark, rows, top=5, least=25, inside=90) == plain(rows, top=5, least=25, inside=90)
    assert found(spark, []) == [] and found(spark, rows[-4:-1]) == []


def test_spills_bursts_and_portions(spark, monkeypatch):
    """Small limits: many bursts and spills in a task, partitions merged in portions."""
    rows = corpus(3)
    whole = Counter()
    for lang, text in rows:
        for w in pieces(text):
            for k in (1, 2, 3):
                whole.update((lang or "und", " ".join(w[i:i + k])) for i in range(len(w) - k + 1))
    batches = [pa.record_batch([pa.array([x or "und" for x, _ in rows[i:i + 20]]), pa.array([t for _, t in rows[i:i + 20]])],
                               names=["lang", "text"]) for i in range(0, len(rows), 20)]
    for limits in ({"HELD": 500, "BURST": 8}, {"WORDS": 4}, {"MERGED": 50}):
        for name, value in limits.items():
            monkeypatch.setattr(phrases, name, value)
        made = list(phrases.count_runs(iter(batches), 3, 5))
        assert len(made) > 3 or "MERGED" in limits
        t = pa.Table.from_batches(made).sort_by([("part", "ascending"), ("lang", "ascending")])
        assert set(t["part"].to_pylist()) == set(range(5))
        got = Counter()
        for r in pa.Table.from_batches(phrases.merge_runs(iter(t.to_batches(max_chunksize=7)), 1)).to_pylist():
            got[r["lang"], r["phrase"]] += r["f"]
            assert r["length"] == (0 if r["phrase"] is None else r["phrase"].count(" ") + 1)
        for lang in {x or "und" for x, _ in rows}:
            assert got.pop((lang, None)) == sum(n for (g, p), n in whole.items() if g == lang and " " not in p)
        assert got == whole
        monkeypatch.undo()


def test_trie_keeps_order_and_spills_subtrees():
    r = np.random.default_rng(1)
    trie, want = phrases.HatTrie(), Counter()
    for _ in range(20):
        w = np.concatenate([r.integers(1, 40, 3_000), np.full(1_000, 7)])
        r.shuffle(w)
        keys, counts = phrases.paths_of(w, np.arange(len(w)) // 50, 3)
        trie.add(keys, counts)
        for k, n in zip(keys.tolist(), counts.tolist()):
            want[k] += n
    assert trie.starts == sorted(set(trie.starts)) and trie.size == len(want) and len(trie.containers) > 1
    assert all(len(c) <= phrases.BURST for c in trie.containers)
    assert [k for c in trie.containers for k in sorted(c)] == sorted(want)
    keys, counts = trie.spill(10_000)
    assert trie.size <= 10_000 and len(keys) + trie.size == len(want) and (np.diff(keys) > 0).all()
    assert all(want[k] == n for k, n in zip(keys.tolist(), counts.tolist()))


def test_hot_pair_is_spread():
    """Paths below one very common pair go to all partitions."""
    words = ["of", "the", *[f"w{i}" for i in range(2_000)]]
    text = " . ".join(f"of the w{i}" for i in range(2_000))
    batch = pa.record_batch([pa.array(["en"]), pa.array([text])], names=["lang", "text"])
    t = pa.Table.from_batches(phrases.count_runs(iter([batch]), 3, 16))
    sizes = t["n"].to_pylist()
    assert sum(sizes) == len(words) + 1 + 2 * 2_000     # words, "of the", "the w", "of the w"
    assert len(sizes) == 16 and max(sizes) < 1.4 * sum(sizes) / 16
