"""Phrase collocations counted in HAT-tries.

Counting.  Every task numbers the words it meets and counts all word paths (one
to three words of one piece of text) in a trie of word ids per language, whose
leaves are hash containers: a container holds all paths within a range of
prefixes, and one that grows past ``BURST`` entries bursts into two at a word
boundary, first between first words, then below one first word between second
words, and so on.  When the tries of a task hold ``HELD`` entries, their largest
subtrees are spilled whole as sorted runs until half is left.  A run is a row per
prefix partition: its words, the paths as positions in them, and the counts,
compressed to a few bytes per path, in the byte order of the words.

Runs of one prefix partition meet in one task, which merges them (a stable sort
of sorted runs) and keeps the paths that reach the least count.  The partition is
a hash of the path itself, its longest prefix, so that no frequent word or pair
makes a hot partition.  A partition with more than ``MERGED`` entries is merged
in several portions, whose sums a Spark aggregate adds; nothing is held whole.

Scoring is SQL over the paths that reached the least count: a candidate's parts
occur at least as often as the candidate, so all counts it needs are there.

Defined results: a null text counts as empty, a null language as ``und``; empty
texts have no words; repeated rows count as often as they occur; a language
without candidates gives no rows, nor does an empty table; extra columns are
ignored.  Scores are exact for counts up to 10**16.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import repeat
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.session import cut_lineage

BITS = 21                       # of a word number within a path
MASK = (1 << BITS) - 1
WORDS = 1 << 19                 # numbered by a task before it spills all and starts anew
HELD = 700_000                  # entries in a task's tries before it spills
BURST = 1 << 14                 # entries of a container
MERGED = 2_000_000              # entries merged at once
PART_BYTES = 8 << 20            # of text per prefix partition
MAX_PARTS = 1 << 16
SPREAD = 16                     # shares of a language that are ranked by themselves first

# --- fixed values: what ends a word, what ends a piece, letters to lower -----------
SPACES = b" \t"
STOPS = b".,;:!?\n\x0b\x0c\r"
# -----------------------------------------------------------------------------------
_KIND = np.zeros(256, np.uint8)
_KIND[list(SPACES)] = 1
_KIND[list(STOPS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of an array of texts, lower-cased, with the number of the
    piece and the text each belongs to."""
    texts = texts.cast(pa.large_utf8())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    kind = _KIND[raw]
    word = kind == 0
    begins = np.empty(len(raw) + 1, bool)
    begins[0] = True
    begins[1:] = ~np.append(word, False)[:-1]
    begins[bounds - bounds[0]] = True                   # no word crosses texts
    first = np.flatnonzero(word & begins[:-1])
    size = np.cumsum(word)
    offsets = np.append(size[first] - 1, size[-1] if len(size) else 0).astype(np.int32)
    words = pa.Array.from_buffers(pa.utf8(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[raw[word]])])
    text = np.searchsorted(bounds - bounds[0], first, side="right") - 1
    return words, np.cumsum(kind == 2)[first] + text, text


def paths_of(ids: np.ndarray, piece: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct paths (packed word numbers) within pieces and their counts."""
    key, all_keys = ids.astype(np.int64) << 2 * BITS, []
    all_keys.append(key)
    for k in range(1, longest):
        key = key[:-1] | (ids[k:].astype(np.int64) << (2 - k) * BITS)
        all_keys.append(key[piece[k:] == piece[:len(piece) - k]])
    return np.unique(np.concatenate(all_keys), return_counts=True)


class HatTrie:
    """Counts of paths.  ``starts`` are the prefixes at which the trie
    branches, in order, ``containers`` the hash tables between them."""

    def __init__(self):
        self.starts, self.containers, self.size = [0], [{}], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """``keys``: ascending and distinct."""
        at = np.append(np.searchsorted(keys, self.starts), len(keys)).tolist()
        full = []
        for i, held in enumerate(self.containers):
            a, b = at[i], at[i + 1]
            if a < b:
                before = len(held)
                mine = keys[a:b].tolist()
                held.update(zip(mine, map(add, counts[a:b].tolist(), map(held.get, mine, repeat(0)))))
                self.size += len(held) - before
                if len(held) > BURST:
                    full.append(self.starts[i])
        for start in full:
            self._burst(bisect_right(self.starts, start) - 1)

    def _burst(self, i: int) -> None:
        held = self.containers[i]
        keys = np.sort(np.fromiter(held, np.int64, len(held)))
        for depth in (2, 1, 0):
            prefix = keys >> depth * BITS
            if prefix[0] != prefix[-1]:
                break
        else:
            return
        middle = prefix[len(prefix) // 2]
        cut = int(middle if middle != prefix[0] else prefix[np.searchsorted(prefix, middle, side="right")]) << depth * BITS
        right = {k: n for k, n in held.items() if k >= cut}
        self.containers[i:i + 1] = [{k: n for k, n in held.items() if k < cut}, right]
        self.starts.insert(i + 1, cut)
        for j in (i + 1, i):
            if len(self.containers[j]) > BURST:
                self._burst(j)

    def spill(self, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """Take out whole subtrees, the largest first, until ``keep`` entries
        are left; their paths in order, and counts."""
        taken = []
        for i in sorted(range(len(self.containers)), key=lambda j: -len(self.containers[j])):
            if self.size <= keep:
                break
            held = self.containers[i]
            taken.append((np.fromiter(held, np.int64, len(held)), np.fromiter(held.values(), np.int64, len(held))))
            self.size -= len(held)
            self.containers[i] = {}
        if not taken:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, counts = (np.concatenate(x) for x in zip(*taken))
        order = np.argsort(keys)
        return keys[order], counts[order]


def _split(keys: np.ndarray) -> np.ndarray:
    """The word numbers of paths, one row per position, 0 for none."""
    return np.stack([keys >> 2 * BITS, (keys >> BITS) & MASK, keys & MASK])


def _join(at: np.ndarray) -> np.ndarray:
    return at[0] << 2 * BITS | at[1] << BITS | at[2]


def _narrow(x: np.ndarray) -> bytes:
    """The numbers in the fewest of 1, 2, 4 or 8 bytes each, that many first."""
    top = int(x.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def _wide(data: memoryview, n: int) -> tuple[np.ndarray, memoryview]:
    """``n`` numbers from the front of ``data``, and the rest."""
    end = 1 + n * data[0]
    return np.frombuffer(data[1:end], f"<u{data[0]}").astype(np.int64), data[end:]


def packed(words: str, paths: np.ndarray, counts: np.ndarray) -> bytes:
    """A run: its words in order (joined by spaces), paths and counts.  The
    first words of paths in order are stored as differences."""
    text = words.encode()
    first = np.diff(paths[0], prepend=0)
    return zstandard.compress(b"".join([len(text).to_bytes(4, "little"), text, _narrow(first), _narrow(paths[1]),
                                        _narrow(paths[2]), _narrow(counts)]), 1)


def unpacked(data: bytes, n: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of a run, its packed paths and their counts."""
    rest = memoryview(zstandard.decompress(data))
    size = int.from_bytes(rest[:4], "little")
    text, rest = np.frombuffer(rest[4:4 + size], np.uint8), rest[4 + size:]
    ends = np.append(np.flatnonzero(text == 32), size)
    offsets = np.append(0, ends - np.arange(len(ends))).astype(np.int32)
    words = pa.Array.from_buffers(pa.utf8(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(text[text != 32])])
    columns = []
    for _ in range(4):
        x, rest = _wide(rest, n)
        columns.append(x)
    return words, _join((columns[0].cumsum(), columns[1], columns[2])), columns[3]


RUN = "part int, lang string, n int, run binary"


def runs(lang: str, keys: np.ndarray, counts: np.ndarray, words: list[str], hashes: np.ndarray, parts: int) -> pa.RecordBatch:
    """One sorted run per prefix partition of the given paths."""
    at = _split(keys)
    present = np.zeros(len(words) + 1, bool)
    present[at] = True
    used, at = np.flatnonzero(present), (np.cumsum(present) - 1)[at]
    none = int(len(used) > 0 and used[0] == 0)          # position 0 stands for no word
    texts = pa.array([words[i - 1] for i in used[none:].tolist()], pa.utf8())
    mixed = np.append(np.zeros(1, np.uint64), hashes[used[none:] - 1])[at + 1 - none]
    with np.errstate(over="ignore"):
        part = np.uint64(xxhash.xxh64_intdigest(lang))
        for h in mixed:
            part = (part ^ h) * np.uint64(0x9E3779B97F4A7C15)
            part = part ^ (part >> np.uint64(29))
    part = ((part >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
    order = pc.sort_indices(texts).to_numpy()
    rank = np.zeros(len(texts) + 1, np.int64)
    rank[order + 1] = np.arange(1, len(texts) + 1)
    at = rank[at + 1 - none]
    texts = texts.take(order)
    by = np.lexsort((_join(at), part))
    at, counts, part = at[:, by], counts[by], part[by]
    cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)).tolist()
    lists, sizes, paths = [], [0], []
    for a, b in zip(cuts, cuts[1:]):
        own, local = np.unique(at[:, a:b], return_inverse=True)
        paths.append(local.reshape(3, -1) + int(own[0] != 0))
        lists.append(own[own > 0] - 1)
        sizes.append(sizes[-1] + len(lists[-1]))
    listed = pc.binary_join(pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), texts.take(pa.array(np.concatenate(lists)))), " ")
    data = [packed(w, p, counts[a:b]) for w, p, a, b in zip(listed.to_pylist(), paths, cuts, cuts[1:])]
    return pa.record_batch([pa.array(part[cuts[:-1]].astype(np.int32)), pa.array([lang] * len(data), pa.utf8()),
                            pa.array(np.diff(cuts).astype(np.int32)), pa.array(data, pa.binary())], names=["part", "lang", "n", "run"])


def count_runs(batches: Iterator[pa.RecordBatch], longest: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Sorted runs of all paths in batches of (lang, text)."""
    number: dict[str, int] = {}
    words: list[str] = []
    hashes = np.zeros(1 << 12, np.uint64)
    tries: dict[str, HatTrie] = {}

    def spilled(keep: int):
        for lang, trie in tries.items():
            keys, counts = trie.spill(keep * trie.size // max(1, sum(t.size for t in tries.values())))
            if len(keys):
                yield runs(lang, keys, counts, words, hashes, parts)

    for b in batches:
        found, piece, text = words_of(b["text"])
        if not len(found):
            continue
        coded = found.dictionary_encode()
        ids = np.empty(len(coded.dictionary), np.int64)
        for i, w in enumerate(coded.dictionary.to_pylist()):
            at = number.get(w)
            if at is None:
                words.append(w)
                at = number[w] = len(words)
                if at > len(hashes):
                    hashes = np.append(hashes, np.zeros(len(hashes), np.uint64))
                hashes[at - 1] = xxhash.xxh64_intdigest(w)
            ids[i] = at
        ids = ids[coded.indices.to_numpy()]
        langs = b["lang"].dictionary_encode()
        of = langs.indices.to_numpy()[text]
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            mine = of == code
            if mine.any():
                tries.setdefault(lang, HatTrie()).add(*paths_of(ids[mine], piece[mine], longest))
        if len(words) > WORDS:
            yield from spilled(0)
            number, words, tries = {}, [], {}
        elif sum(t.size for t in tries.values()) > HELD:
            yield from spilled(HELD // 2)
    yield from spilled(0)


COUNT = "lang string, phrase string, f long, length int"


def merge_runs(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Counts of paths from runs ordered by (part, lang): complete ones from
    ``least`` on, or all of a partition merged in portions; and the number of
    words per language, as the phrase null of length 0."""
    at, held, entries, words, whole = None, [], 0, 0, True

    def merged(lang: str, complete: bool) -> pa.RecordBatch:
        every = pa.concat_arrays([w for w, _, _ in held]).dictionary_encode()
        order = pc.sort_indices(every.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(1, len(order) + 1)
        place, offset, keys = rank[every.indices.to_numpy()], 0, []
        for w, paths, _ in held:
            keys.append(_join(np.append(np.zeros(1, np.int64), place[offset:offset + len(w)])[_split(paths)]))
            offset += len(w)
        keys, counts = np.concatenate(keys), np.concatenate([c for _, _, c in held])
        by = np.argsort(keys, kind="stable")
        keys, counts = keys[by], counts[by]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, counts = keys[first], np.add.reduceat(counts, first)
        total = int(counts[keys & ((1 << 2 * BITS) - 1) == 0].sum())
        if complete:
            keys, counts = keys[counts >= least], counts[counts >= least]
        x = _split(keys)
        texts = every.dictionary.take(pa.array(order))
        length = (x > 0).sum(axis=0).astype(np.int32)
        phrase = texts.take(pa.array(x[0] - 1))
        for k in (1, 2):
            more = texts.take(pa.array(np.maximum(x[k] - 1, 0)))
            phrase = pc.if_else(pa.array(x[k] > 0), pc.binary_join_element_wise(phrase, more, " "), phrase)
        return pa.record_batch([pa.array([lang] * (len(keys) + 1), pa.utf8()),
                                pa.concat_arrays([phrase, pa.array([None], pa.utf8())]),
                                pa.array(np.append(counts, total)), pa.array(np.append(length, 0).astype(np.int32))],
                               names=["lang", "phrase", "f", "length"])

    for b in batches:
        for part, lang, n, run in zip(*(b[c].to_pylist() for c in ("part", "lang", "n", "run"))):
            run = unpacked(run, n)
            if held and (at != (part, lang) or entries + n > MERGED or words + len(run[0]) >= MASK):
                whole = whole and at != (part, lang)
                yield merged(at[1], whole)
                held, entries, words = [], 0, 0
            if at != (part, lang):
                at, whole = (part, lang), True
            held.append(run)
            entries += n
            words += len(run[0])
    if held:
        yield merged(at[1], whole)


def count_paths(df: DataFrame, text_col: str, lang_col: str, longest: int, least: int, parts: int | None = None) -> DataFrame:
    """(lang, phrase, f, length) of every phrase of up to ``longest`` words
    that occurs ``least`` times in its language, and with phrase null and
    length 0 the number of words."""
    if not 1 <= longest <= 3:
        raise ValueError("phrases have one to three words")
    spark = df.sparkSession
    rows = df.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if parts is None:
        size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        parts = min(MAX_PARTS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES)))

    def count(batches):
        return count_runs(batches, longest, parts)

    def merge(batches):
        return merge_runs(batches, least)

    merged = (rows.mapInArrow(count, RUN).repartition("part").sortWithinPartitions("part", "lang").mapInArrow(merge, COUNT)
                  .groupBy("lang", "length", "phrase").agg(F.sum("f").alias("f")))
    return merged.filter((F.col("f") >= least) | F.col("phrase").isNull())


def collocations(df: DataFrame, text_col: str, lang_col: str, longest: int = 3, least: int = 10, inside: int = 50,
                 top: int = 2000) -> DataFrame:
    """The ``top`` phrases of each language by score: ``lang``, ``rank``,
    ``phrase``, ``a`` (its count), ``l`` and ``r`` (counts of the two parts at the
    lowest-scoring cut), ``n`` (words of the language) and ``score``, which is
    ``floor(1000000 * a * a / (l * r))``.

    A phrase inside a longer one that has ``inside`` percent of its count or more
    is left out.
    """
    counts = cut_lineage(count_paths(df, text_col, lang_col, longest, least), "phrases")
    words = F.split("phrase", " ")
    known = counts.filter(F.col("phrase").isNotNull()).select("lang", "phrase", "f", "length")
    several = known.filter("length >= 2").select("lang", "phrase", "length", F.col("f").alias("a"), words.alias("w"))

    def words_from(at, n):
        return F.array_join(F.slice("w", at, n), " ")

    cut = F.explode(F.transform(F.sequence(F.lit(1), F.col("length") - 1), lambda k: F.struct(
        k.alias("k"), words_from(F.lit(1), k).alias("left"), words_from(k + 1, F.col("length") - k).alias("right"))))
    cuts = several.select("lang", "phrase", "a", cut.alias("c")).select("lang", "phrase", "a", "c.*")
    score = F.expr("cast(1000000 AS decimal(7,0)) * cast(a AS decimal(19,0)) * cast(a AS decimal(19,0))"
                   " div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))")
    scored = (cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
                  .join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
                  .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("s")))
    within = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("length") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("length") - m + 1), lambda i: words_from(i, m)))))
    covered = (several.filter("length > 2").select("lang", "a", within.alias("phrase"))
                      .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = (scored.join(covered, ["lang", "phrase"], "left")
                  .filter(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))
                  .select("lang", "phrase", "a", "s.l", "s.r", "s.score"))
    # the best of each of SPREAD shares of a language first, so that one language's candidates are spread over tasks
    share = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)).alias("share")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    ranked = kept.select("*", share).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)))
    ranked = ranked.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    ranked = ranked.filter(F.col("rank") <= top)
    total = counts.filter(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                             "n", "score")


def sql(least: int = 10, inside: int = 50, top: int = 2000) -> str:
    """The same phrases (of two and three words) in DuckDB's SQL, table
    ``documents``."""
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
worded AS MATERIALIZED (
  SELECT lang, [x FOR x IN string_split_regex(p, '[\x20\x09]+') IF x <> ''] AS w FROM pieces),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
grams AS (
  SELECT lang, w[i] AS phrase, 1 AS length FROM spots
  UNION ALL SELECT lang, w[i] || ' ' || w[i + 1], 2 FROM spots WHERE i + 1 <= len(w)
  UNION ALL SELECT lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2], 3 FROM spots WHERE i + 2 <= len(w)),
f AS MATERIALIZED (
  SELECT lang, phrase, length, count(*) AS a, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, phrase, length
  HAVING count(*) >= {least}),
cuts AS (
  SELECT lang, phrase, a, 1 AS k, w[1] AS lhs, array_to_string(w[2:], ' ') AS rhs FROM f WHERE length >= 2
  UNION ALL SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM f WHERE length = 3),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r,
         ((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.lhs JOIN f y ON y.lang = c.lang AND y.phrase = c.rhs
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1),
covered AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM f WHERE length = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM f WHERE length = 3) GROUP BY ALL),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank,
       s.phrase, s.a, l, r, n, score
FROM scored s LEFT JOIN covered c ON c.lang = s.lang AND c.phrase = s.phrase JOIN total t ON t.lang = s.lang
WHERE longer IS NULL OR 100 * longer < {inside} * s.a
QUALIFY rank <= {top}"""
