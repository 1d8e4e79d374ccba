"""Exact dedup, sharding and WARC against brute force and round trips."""

import gzip
import hashlib
import random
import zlib

import pytest

from lakemart.llm import exact, sharding, warc
from lakemart.session import scratch_path


def brute_groups(rows, largest):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").encode(), []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[(t or "").encode()] if x is not None]
        keep = (max if largest else min)(ids) if ids else None
        out.append((i, keep, len(groups[(t or "").encode()]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


TEXTS = ["", None, "a", "ab", "abc", "abd", "abcabc" * 900, "abcabc" * 900 + "d", "é", "e", "\x00", "a ", " a"]


def some_rows(n=400, seed=4):
    r = random.Random(seed)
    rows = [(r.choice([None, *range(60)]), r.choice(TEXTS)) for _ in range(n)]
    return rows + rows[:5]


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_groups_equal_brute_force(spark, keep):
    rows = some_rows()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, keep_id string")
    got = exact.groups(df.repartition(5), "doc_id", "text", keep)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(x) for x in got.collect()), key=str) == brute_groups(rows, keep == "largest")
    assert exact.groups(df.limit(0), "doc_id", "text").count() == 0


def test_small_budgets_spill_and_agree(spark, monkeypatch):
    rows = some_rows(seed=9)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {(x.sha256, x.keep_id, x.group_size) for x in exact.owners(df, "doc_id", "text", "largest").collect()}
    got = {(x.sha256, x.keep_id, x.group_size) for x in exact.owners(df, "doc_id", "text", "largest", budget=700).collect()}
    assert got == want and len(want) == len({t or "" for _, t in rows})


def test_spilling_trie():
    r = random.Random(1)
    keys = ["".join(r.choice("ab") for _ in range(r.randint(0, 12))).encode() for _ in range(3000)]
    keys += [b"shared prefix " * 20 + k for k in keys[:500]]
    want = {}
    trie = exact.SpillingTrie(True, 4000)
    for i, k in enumerate(keys):
        trie.add(k, (i, 1, None))
        a, b = want.get(k, (-1, 0))
        want[k] = (max(a, i), b + 1)
    got = list(trie.drain())
    assert len(got) == len(want)
    assert {k: e[:2] for k, e in got} == want


def test_keep_rows(spark):
    rows = some_rows(seed=2)
    df = spark.createDataFrame([(i, t, k, "s") for k, (i, t) in enumerate(rows)],
                               "doc_id long, text string, body long, row string").repartition(4)
    kept = exact.keep_rows(df, "doc_id", "text", "largest")
    assert kept.columns == df.columns
    out = kept.collect()
    assert len(out) == len({x.text or "" for x in out}) == len({t or "" for _, t in rows})
    for x in out:
        assert (x.doc_id, x.text) == rows[x.body]
        ids = [i for i, t in rows if (t or "") == (x.text or "") and i is not None]
        assert x.doc_id == max(ids, default=None)
    assert exact.keep_rows(df.limit(0), "doc_id", "text").count() == 0


# ------------------------------------------------------------- sharding

def test_assign(spark):
    rows = [(i, "x" * (i % 7) + "é") for i in range(3000)] + [(None, None)] * 500 + [(5, "same")] * 4 + [(6, "")]
    df = spark.createDataFrame([(a, b, 9, 9) for a, b in rows], "doc_id long, text string, shard long, slot long")
    out = sharding.assign(df.repartition(7), "doc_id", "text", [1.0] * 8, [1.0] * 9).collect()
    assert len(out) == len(rows)
    slots, of = {}, {}
    for x in out:
        slots.setdefault(x.shard, []).append(x.slot)
        assert x.grown_shard in (x.shard, 8) and x.law == "key"
        assert of.setdefault(x.doc_id, x.shard) == x.shard
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) == set(range(8))
    moved = sum(x.grown_shard == 8 for x in out if x.doc_id is not None) / 3000
    assert 0.07 < moved < 0.16
    want = sorted((str(a), len((b or "").encode()) + 1, zlib.crc32((b or "").encode())) for a, b in rows)
    assert sorted((str(x.doc_id), x.size, x.text_crc32) for x in out) == want
    assert sharding.assign(df.limit(0), "doc_id", "text", [1.0] * 8).count() == 0


def test_weights(spark):
    df = spark.range(20000).select(sharding.shard_of(["id"], [1.0, 3.0, 0.0]).alias("s"))
    n = {r.s: r["count"] for r in df.groupBy("s").count().collect()}
    assert set(n) == {0, 1} and 0.23 < n[0] / 20000 < 0.27
    with pytest.raises(ValueError):
        sharding.shard_of(["id"], [0.0])


def test_write_shards(spark):
    path = scratch_path(spark, "shards")
    df = spark.range(500).withColumnRenamed("id", "k")
    sharding.write_shards(df, path, "k", [1.0, 1.0])
    back = spark.read.parquet(path)
    assert back.count() == 500
    assert {(r.k, r.shard) for r in back.collect()} == {
        (r.k, r.s) for r in df.select("k", sharding.shard_of(["k"], [1.0, 1.0]).alias("s")).collect()}


# ------------------------------------------------------------- WARC

BIG, OTHER = "pägé " * 400, "q" * 1500
PAGES = [(1, "http://a/\r\nX: y", BIG), (2, None, BIG), (7, "http://c", BIG), (7, "http://c", BIG), (None, "http://d", BIG),
         (3, "http://e", "small"), (4, "http://f", "small"), (5, "http://g", None), (6, "http://h", ""),
         (None, "u", OTHER), (None, "v", OTHER), (8, "http://z", "x\r\n\r\nWARC/1.1\r\n" * 300)]


def test_round_trip(spark):
    df = spark.createDataFrame([(*p, "k", 3) for p in PAGES], "page_id long, url string, html string, key string, size long")
    folder = scratch_path(spark, "t-warc")
    rows = warc.with_revisits(df.repartition(3), "page_id", "url", "html")
    files = warc.normalise(warc.write_monolithic(rows, f"{folder}/mono", roll=4000), f"{folder}/members")
    out = warc.read(files, payloads=True).collect()
    want = []
    for i, u, h in PAGES:
        data = (h or "").encode()
        refers = 7 if h == BIG and i != 7 else None
        want.append((str(i), len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers else "response", refers,
                     None if refers else data))
    got = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
            None if r.payload is None else bytes(r.payload)) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert files.count() > 1
    none = warc.round_trip(df.limit(0), "page_id", "url", "html", scratch_path(spark, "t-warc0"))
    assert none.count() == 0


def test_index_points_at_members(tmp_path):
    records = [warc.record_bytes(i, "http://x", b"p" * i, None) for i in range(20)]
    source = tmp_path / "whole.warc.gz"
    source.write_bytes(gzip.compress(b"".join(records[:9])) + gzip.compress(b"".join(records[9:])))
    assert list(warc.records(warc.inflate(warc._chunks(str(source))))) == records
    with pytest.raises(ValueError):
        list(warc.records(iter([records[0][:-5]])))
    bad = records[3].replace(b"ppp", b"pqp")
    with pytest.raises(ValueError):
        warc.parse(bad)
    assert warc.parse(records[4])["payload"] == b"pppp"


def test_records_survive_any_chunking():
    records = [warc.record_bytes(i, None, bytes(range(256)) * i, None if i % 2 else 1) for i in range(8)]
    plain = b"".join(records)
    for step in (1, 7, 1000, len(plain)):
        assert list(warc.records(plain[i:i + step] for i in range(0, len(plain), step))) == records
