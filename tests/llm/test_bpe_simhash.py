"""BPE against the tiktoken library, SimHash and components against brute force."""

import base64
import random

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers as P
from lakemart.llm import bpe, simhash
from lakemart.llm.components import connected

tiktoken = pytest.importorskip("tiktoken")
RANKS = bpe.parse_ranks(bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")))
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = bpe.Codec(RANKS, P.PATTERN)


def ids(text):
    b = CODEC.encode(text)
    return [int.from_bytes(b[i:i + 4], "little") for i in range(0, len(b), 4)]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_encode_equals_tiktoken(text):
    assert ids(text) == ENC.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode(text)) == text.encode("utf-8", "replace")


@pytest.mark.parametrize("text", [
    "", "a" * 5000, "ab" * 3000, "=" * 2001, " " * 999, "\n" * 501 + "x", "0123456789" * 200, "é" * 700,
    "the quick brown fox's <|endoftext|> don't", "aaaab" * 400 + "zzz", "日本語テキスト" * 90, "​\x00\x1c\x85 x",
    "".join(random.Random(3).choice("abcdefgh") for _ in range(20_000)),
])
def test_long_pieces_equal_tiktoken(text):
    assert ids(text) == ENC.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode(text)) == text.encode()


def test_plain_and_heap_merges_agree():
    r = random.Random(5)
    for n in (2, 49, 200):
        data = bytes(r.choice(b"aeinst ") for _ in range(n))
        plain, bpe.PLAIN = bpe.PLAIN, 10_000
        try:
            a = CODEC.merge(data)
        finally:
            bpe.PLAIN = plain
        assert a == CODEC._merge_long(data) == CODEC.reduce(data)


def test_tokenizer_columns(spark):
    df = spark.createDataFrame([(1, "hello world", 5), (1, "hello world", 5), (None, None, 6), (3, "", 7)],
                               "doc_id long, text string, ids long")
    t = bpe.Tokenizer(spark, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    got = t.decode(t.encode(df, "text", "packed"), "packed", "back").select(
        "doc_id", "ids", bpe.ids_array("packed").alias("a"), "back").collect()
    hello = ENC.encode_ordinary("hello world")
    assert sorted((r.ids, list(r.a), bytes(r.back)) for r in got) == [
        (5, hello, b"hello world"), (5, hello, b"hello world"), (6, [], b""), (7, [], b"")]
    assert t.encode(df.limit(0), "text").count() == 0


def brute_print(text, k=3):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
             .replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ")
             .split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    v = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))
    return v - (1 << 64) if v >> 63 else v


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB É\t\n  z", max_size=40))
def test_fingerprint_brute(text):
    assert simhash.fingerprint_of(text, 3) == brute_print(text)


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_links_find_every_pair(spark):
    r = random.Random(11)
    vals = set()
    for _ in range(60):
        base = r.getrandbits(64)
        vals.add(base)
        for _ in range(6):
            v = base
            for b in r.sample(range(64), r.randint(1, 5)):
                v ^= 1 << b
            vals.add(v)
    for b in ((0, 1, 2), (15, 16, 63), (3, 20, 40), (60, 61, 62)):        # around zero, across segments
        vals |= {0, sum(1 << x for x in b)}
    vals = sorted(vals)
    want = {tuple(sorted((signed(a), signed(b)))) for i, a in enumerate(vals) for b in vals[i + 1:]
            if bin(a ^ b).count("1") <= 3}
    df = spark.createDataFrame([(signed(v),) for v in vals], "fp long")
    assert {tuple(x) for x in simhash.links(df, 3).collect()} == want


def test_components(spark):
    r = random.Random(2)
    edges = {tuple(sorted(r.sample(range(400), 2))) for _ in range(180)}
    edges |= {(i, i + 1) for i in range(1000, 1040)} | {(2000, i) for i in range(2001, 2060)}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {x.node: x.root for x in connected(spark.createDataFrame(list(edges), "a long, b long")).collect()}
    assert got == {n: root(n) for n in parent}


def test_near_groups_edge_cases(spark):
    long = "one two three four five six seven eight nine ten " * 30
    data = [(5, long), (3, long + "end"), (9, ""), (8, None), (7, "two words"), (7, "TWO  words"), (None, "two words"),
            (None, "quite another text here")]
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in data], "doc_id long, text string, fp long, component_id long")
    got = simhash.near_groups(df, "doc_id", "text").collect()
    assert sorted((str(x.doc_id), str(x.component_id)) for x in got) == sorted(
        [("5", "3"), ("3", "3"), ("9", "8"), ("8", "8"), ("7", "7"), ("7", "7"), ("None", "7"), ("None", "None")])
    kept = simhash.keep_rows(df, "doc_id", "text")
    assert kept.columns == df.columns
    assert sorted(str(x.doc_id) for x in kept.collect()) == ["3", "7", "8", "None"]
    again = simhash.keep_rows(df.union(df), "doc_id", "text").collect()         # every row twice
    assert sorted(str(x.doc_id) for x in again) == ["3", "7", "8", "None"]
    assert simhash.near_groups(df.limit(0), "doc_id", "text").count() == 0
    assert simhash.keep_rows(df.limit(0), "doc_id", "text").count() == 0
