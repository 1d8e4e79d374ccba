"""Byte-level BPE by monoid tree reduction.

A text is cut into pieces by the pre-tokenisation pattern; each piece is
encoded on its own, and the document's ids are the concatenation.  A piece is
encoded by halves: both halves are encoded recursively and joined.  Joining
rests on one fact about rank-ordered merging: a sequence of tokens is the
encoding of its bytes exactly when every adjacent pair of tokens, encoded
together, gives that pair again (the first merge across a boundary of the
sequence would also happen in the pair alone, since nothing outside the two
tokens has touched them).  So a join needs no work when the two tokens at the
seam are such a pair; otherwise the bytes of a growing window around the seam
are encoded anew until the pairs at both of its ends hold, which proves that
no token outside can change.

Decoding is the same reduction with concatenation as the join.

Ranks come from a file of ``base64 rank`` lines, named by the caller, read on
the driver and broadcast (a vocabulary is under a few MB whatever the data).
Python workers keep bounded memo tables.

Defined results: a null text counts as empty and has no ids; no special
tokens are recognised; repeated rows are encoded alike; empty tables give no
rows; other columns pass through unchanged (the result's own columns are
named by the caller).
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import short_batches

LEAF = 3                        # pieces of up to so many bytes are merged directly
MEMO = 500_000                  # entries a generation of a memo table may hold
MEMO_BYTES = 24                 # longest byte string kept in a memo table
NEVER = 1 << 60                 # rank of a pair that does not merge
HALF_BYTES = 12                 # longest half that is worth remembering
PLAIN = 48                      # windows up to so many bytes use the plain merge loop


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.vocab = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.vocab[rank] = token
        self.packed = [i.to_bytes(4, "little") for i in range(len(self.vocab))]
        self.known: dict[bytes, tuple] = {}
        self.pairs: dict[tuple, bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}               # the generation before ``pieces``

    # -- merging ------------------------------------------------------------

    def merge(self, data: bytes) -> tuple:
        """Rank-ordered merging of the single bytes of ``data``."""
        if len(data) > PLAIN:
            return self._merge_long(data)
        get = self.ranks.get
        parts = [data[i:i + 1] for i in range(len(data))]
        pairs = [get(data[i:i + 2], NEVER) for i in range(len(data) - 1)]     # rank of each part with the next
        while pairs:
            best = min(pairs)
            if best == NEVER:
                break
            i = pairs.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], NEVER)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], NEVER)
        return tuple([self.ranks[p] for p in parts])

    def _merge_long(self, data: bytes) -> tuple:
        """The same with a heap over adjacent pairs, for long windows."""
        n, get = len(data), self.ranks.get
        end = list(range(1, n + 1))          # end of the part that starts here
        left = list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue
            j = end[i]
            alive[j], end[i] = False, stop
            if stop < n:
                left[stop] = i
                if (r := get(data[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (k := left[i]) >= 0 and (r := get(data[k:stop])) is not None:
                heapq.heappush(heap, (r, k, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i:end[i]]])
            i = end[i]
        return tuple(out)

    # -- tree ---------------------------------------------------------------

    def holds(self, a: int, b: int) -> bool:
        """Do tokens ``a`` and ``b`` encode to themselves side by side?"""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merge(self.vocab[a] + self.vocab[b]) == (a, b)
        return known

    def join(self, a: tuple, b: tuple) -> tuple:
        """Encoding of the bytes of ``a`` followed by those of ``b``."""
        if not a or not b:
            return a or b
        if self.holds(a[-1], b[0]):
            return a + b
        k = 1
        while True:
            i, j = max(0, len(a) - k), min(len(b), k)
            window = self.encoded(b"".join([self.vocab[t] for t in chain(a[i:], b[:j])]))
            if (i == 0 or self.holds(a[i - 1], window[0])) and (j == len(b) or self.holds(window[-1], b[j])):
                return a[:i] + window + b[j:]
            k *= 2

    def encoded(self, data: bytes) -> tuple:
        """Merged tokens of a window; the memo table is that of the halves,
        as both hold encodings."""
        ids = self.known.get(data)
        if ids is None:
            ids = self.merge(data)
            self._remember(data, ids)
        return ids

    def _remember(self, data: bytes, ids: tuple) -> None:
        if len(data) <= MEMO_BYTES:
            if len(self.known) >= MEMO:
                self.known.clear()
            self.known[data] = ids

    def reduce(self, data: bytes) -> tuple:
        """Encoding of one piece by halves."""
        ids = self.known.get(data)
        if ids is None:
            n = len(data)
            ids = (self.merge(data) if n <= LEAF
                   else self.join(self.reduce(data[:n // 2]), self.reduce(data[n // 2:])))
            if n <= HALF_BYTES:
                self._remember(data, ids)
        return ids

    def piece(self, text: str) -> bytes:
        """Ids of one piece as little-endian 32-bit integers.  A piece that is
        a token itself is that token."""
        out = self.older.get(text)
        if out is None:
            data = text.encode("utf-8", "replace")
            rank = self.ranks.get(data)
            out = self.packed[rank] if rank is not None else b"".join([self.packed[i] for i in self.reduce(data)])
        if len(text) <= MEMO_BYTES:
            if len(self.pieces) >= MEMO:
                self.older, self.pieces = self.pieces, {}
            self.pieces[text] = out
        return out

    def encode(self, text: str) -> bytes:
        get, slow = self.pieces.get, self.piece
        return b"".join([get(p) or slow(p) for p in self.split(text)])

    def decode(self, ids: bytes) -> bytes:
        """Bytes of packed ids: runs of ids are looked up, then joined
        pairwise up the tree."""
        look = self.vocab.__getitem__
        flat = np.frombuffer(ids, "<u4").tolist()
        level = [b"".join(map(look, flat[i:i + 4096])) for i in range(0, len(flat), 4096)]
        while len(level) > 1:
            level = [b"".join(level[i:i + 2]) for i in range(0, len(level), 2)]
        return level[0] if level else b""


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(t): int(r) for t, r in (x.split() for x in data.splitlines() if x.strip())}


_codecs: dict[tuple, Codec] = {}


def codec(data: bytes, pattern: str) -> Codec:
    """The worker's codec of a vocabulary, built once."""
    key = (hashlib.sha256(data).digest(), pattern)
    if key not in _codecs:
        _codecs[key] = Codec(parse_ranks(data), pattern)
    return _codecs[key]


class Tokenizer:
    """Encodes and decodes DataFrame columns with one vocabulary.

    Ids are columns of packed little-endian unsigned 32-bit integers (binary);
    :func:`ids_array` unpacks them.
    """

    def __init__(self, spark: SparkSession, ranks_path: str, pattern: str):
        self.spark, self.pattern = spark, pattern
        self.data = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def encode(self, df: DataFrame, text: str, out: str = "ids") -> DataFrame:
        short_batches(self.spark)
        data, pattern = self.data, self.pattern

        @F.arrow_udf("binary")
        def run(texts: pa.Array) -> pa.Array:
            c = codec(data.value, pattern)
            return pa.array([c.encode(t or "") for t in texts.to_pylist()], pa.binary())

        return df.withColumn(out, run(F.col(text)))

    def decode(self, df: DataFrame, ids: str, out: str = "decoded") -> DataFrame:
        short_batches(self.spark)
        data, pattern = self.data, self.pattern

        @F.arrow_udf("binary")
        def run(packed: pa.Array) -> pa.Array:
            c = codec(data.value, pattern)
            return pa.array([c.decode(x or b"") for x in packed.to_pylist()], pa.binary())

        return df.withColumn(out, run(F.col(ids)))


def ids_array(packed):
    """Packed ids as an array<int> column."""
    h = F.hex(packed)
    n = (F.octet_length(packed) / 4).cast("int")

    def one(i):
        word = F.substring(h, i * 8 + 1, F.lit(8))
        swapped = F.concat(*[F.substring(word, k, 2) for k in (7, 5, 3, 1)])
        return F.conv(swapped, 16, 10).cast("int")

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), one)).otherwise(F.array().cast("array<int>"))
