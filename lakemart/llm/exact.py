"""Exact deduplication with Patricia-trie owners.

Texts are equal when their bytes are equal.  Two trie passes find the owner
of each distinct text:

1. Every map task inserts its full byte strings into a compressed radix trie
   whose terminal nodes hold the owner so far and the number of rows.  When
   the trie grows past its budget, the heaviest subtree is emitted as partial
   owners and dropped, so memory is bounded and a group of copies shrinks to
   a few rows before any shuffle.
2. Partial owners are dealt out by (length, content hash), sorted by it, and
   inserted into the trie of their partition.  The trie is drained between two
   (length, hash) keys; a single key beyond the budget (hash collisions) spills
   by subtree to a temporary file and is finished subtree by subtree.

No task holds a group of copies: it holds each distinct text once.

Defined results: a null text counts as empty; null identifiers lose against
any other (a group without identifiers keeps a null one); rows that repeat
the kept identifier and its text cannot be told apart and are all marked kept
by :func:`groups`, while :func:`keep_rows` returns exactly one of them; an
empty table gives no rows; extra columns, whatever their names, are ignored
by :func:`groups` and returned unchanged by :func:`keep_rows`.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.common import short_batches
from lakemart.session import cut_lineage

NODE_BYTES = 300                # bookkeeping of a node besides its label
TRIE_BUDGET = 48 << 20          # bytes a trie may hold in a task
BATCH_BYTES = 4 << 20           # bytes of text in an emitted Arrow batch


def _common(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of ``a`` and ``b[start:]``."""
    lo, hi = 0, min(len(a), len(b) - start)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[start + lo:start + mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def better(a, b, largest: bool):
    """The owner of two (identifier, rows, payload) entries, with the rows of
    both.  None loses; ties keep the first."""
    if a[0] is None or (b[0] is not None and a[0] != b[0] and (b[0] > a[0]) == largest):
        first = b if b[0] is not None else a
    else:
        first = a
    return (first[0], a[1] + b[1], first[2])


class Trie:
    """Compressed radix trie over byte strings.  A node is
    ``[label, children by first byte, entry or None]``."""

    def __init__(self, largest: bool):
        self.root = [b"", {}, None]
        self.largest = largest
        self.held = {}          # bytes held below each child of the root

    @property
    def size(self) -> int:
        return sum(self.held.values())

    def add(self, key: bytes, entry: tuple) -> int:
        """Insert ``key``; returns the bytes by which the trie grew."""
        node, pos = self.root, 0
        while pos < len(key):
            child = node[1].get(key[pos])
            if child is None:
                node[1][key[pos]] = [key[pos:], {}, entry]
                return self._grew(key, len(key) - pos + NODE_BYTES)
            label = child[0]
            if key.startswith(label, pos):
                node, pos = child, pos + len(label)
                continue
            n = _common(label, key, pos)
            middle = [label[:n], {label[n]: child}, None]
            child[0] = label[n:]
            node[1][key[pos]] = middle
            node, pos = middle, pos + n
            self._grew(key, NODE_BYTES)
        if node[2] is None:
            node[2] = entry
            return self._grew(key, 0)
        node[2] = better(node[2], entry, self.largest)
        return 0

    def _grew(self, key: bytes, n: int) -> int:
        first = key[0] if key else -1
        self.held[first] = self.held.get(first, 0) + n
        return n

    def take(self, first: int) -> Iterator[tuple]:
        """Remove the subtree below the root's child ``first`` (-1: the empty
        string) and yield its (key, entry) pairs."""
        self.held.pop(first, None)
        if first == -1:
            entry, self.root[2] = self.root[2], None
            if entry is not None:
                yield b"", entry
            return
        stack = [(b"", self.root[1].pop(first))]
        while stack:
            prefix, (label, children, entry) = stack.pop()
            key = prefix + label
            if entry is not None:
                yield key, entry
            stack.extend((key, c) for c in children.values())

    def heaviest(self) -> int:
        return max(self.held, key=self.held.get)

    def drain(self) -> Iterator[tuple]:
        for first in list(self.held):
            yield from self.take(first)


class SpillingTrie:
    """A trie that moves its heaviest subtree to a temporary file whenever it
    holds more than ``budget`` bytes; ``drain`` finishes the spilled subtrees
    one after another with tries of their own."""

    def __init__(self, largest: bool, budget: int):
        self.trie, self.largest, self.budget = Trie(largest), largest, budget
        self.size, self.files = 0, {}

    def add(self, key: bytes, entry: tuple) -> None:
        self.size += self.trie.add(key, entry)
        while self.size > self.budget and self.trie.held:
            self._spill(self.trie.heaviest())

    def _spill(self, first: int) -> None:
        out = self.files.get(first)
        if out is None:
            out = self.files[first] = [tempfile.TemporaryFile(), None, 0]
        for key, entry in self.trie.take(first):
            if out[1] is None:
                out[1], out[2] = key, len(key)
            out[2] = min(out[2], _common(key[:out[2]], out[1], 0))
            pickle.dump((key, entry), out[0], protocol=pickle.HIGHEST_PROTOCOL)
        self.size = self.trie.size

    def drain(self) -> Iterator[tuple]:
        for first in list(self.trie.held):
            if first in self.files:
                self._spill(first)
        yield from self.trie.drain()
        self.size = 0
        files, self.files = self.files, {}
        for handle, example, shared in files.values():
            with handle:
                handle.seek(0)
                below = SpillingTrie(self.largest, self.budget)
                while True:
                    try:
                        key, entry = pickle.load(handle)
                    except EOFError:
                        break
                    below.add(key[shared:], entry)
                for key, entry in below.drain():
                    yield example[:shared] + key, entry


def _emit(pairs: Iterator[tuple], to_batch) -> Iterator[pa.RecordBatch]:
    some, held = [], 0
    for pair in pairs:
        some.append(pair)
        held += len(pair[0]) + 200
        if held > BATCH_BYTES:
            yield to_batch(some)
            some, held = [], 0
    if some:
        yield to_batch(some)


def _map_side(largest: bool, budget: int):
    """Arrow batches (body, id, row) -> partial owners (body, id, n, row)."""

    def run(batches):
        schema = None

        def to_batch(pairs):
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in pairs], pa.binary()),
                 pa.array([e[0] for _, e in pairs], schema.field("id").type),
                 pa.array([e[1] for _, e in pairs], pa.int64()),
                 pa.array([e[2] for _, e in pairs], schema.field("row").type)],
                names=["body", "id", "n", "row"])

        trie, size = Trie(largest), 0
        for b in batches:
            schema = b.schema
            cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("body", "id", "row")]
            for body, i, row in zip(*cols):
                size += trie.add(body, (i, 1, row))
            if size > budget:
                while size > budget // 2 and trie.held:
                    yield from _emit(trie.take(trie.heaviest()), to_batch)
                    size = trie.size
        if schema is not None:
            yield from _emit(trie.drain(), to_batch)

    return run


def _reduce_side(largest: bool, budget: int, with_text: bool):
    """Partial owners sorted by (length, hash) -> owners."""

    def run(batches):
        schema = None

        def to_batch(pairs):
            cols = [pa.array([len(k) for k, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k, _ in pairs], pa.string()),
                    pa.array([e[0] for _, e in pairs], schema.field("id").type),
                    pa.array([e[1] for _, e in pairs], pa.int64()),
                    pa.array([e[2] for _, e in pairs], schema.field("row").type)]
            names = ["bytes", "sha256", "keep_id", "group_size", "row"]
            if with_text:
                cols.append(pa.array([k for k, _ in pairs], pa.binary()))
                names.append("body")
            return pa.RecordBatch.from_arrays(cols, names=names)

        trie, cell = SpillingTrie(largest, budget), None
        for b in batches:
            schema = b.schema
            names = ("body", "id", "n", "row", "bytes", "hash")
            cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in names]
            for body, i, n, row, size, h in zip(*cols):
                if (size, h) != cell:
                    if trie.size > budget // 2 or trie.files:
                        yield from _emit(trie.drain(), to_batch)
                    cell = (size, h)
                trie.add(body, (i, n, row))
        if schema is not None:
            yield from _emit(trie.drain(), to_batch)

    return run


def owners(df: DataFrame, id_col: str, text_col: str, keep: str = "smallest",
           carry: bool = False, budget: int = TRIE_BUDGET) -> DataFrame:
    """One row per distinct text: ``bytes``, ``sha256``, ``keep_id``,
    ``group_size``; with ``carry`` also ``row`` (the owner's other columns and
    whether its text was null) and ``body`` (the text's bytes).

    ``keep`` is 'smallest' or 'largest' identifier.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    short_batches(df.sparkSession)
    largest = keep == "largest"
    others = [F.struct(*[F.col(c) for c in df.columns if c != text_col]).alias("cols")] if carry else []
    rows = df.select(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("body"),
                     F.col(id_col).alias("id"),
                     F.struct(F.col(text_col).isNull().alias("was_null"), *others).alias("row"))
    id_type, row_type = rows.schema["id"].dataType, rows.schema["row"].dataType
    part = T.StructType([T.StructField("body", T.BinaryType()), T.StructField("id", id_type),
                         T.StructField("n", T.LongType()), T.StructField("row", row_type)])
    partial = (rows.mapInArrow(_map_side(largest, budget), part)
               .withColumn("bytes", F.octet_length("body").cast("long"))
               .withColumn("hash", F.xxhash64("body")))
    out = T.StructType([T.StructField("bytes", T.LongType()), T.StructField("sha256", T.StringType()),
                        T.StructField("keep_id", id_type), T.StructField("group_size", T.LongType()),
                        T.StructField("row", row_type)])
    if carry:
        out = out.add("body", T.BinaryType())
    found = (partial.repartition("bytes", "hash").sortWithinPartitions("bytes", "hash")
             .mapInArrow(_reduce_side(largest, budget, carry), out))
    return found if carry else found.drop("row")


def groups(df: DataFrame, id_col: str, text_col: str, keep: str = "smallest") -> DataFrame:
    """Every row with the owner of its text: ``doc_id``, ``keep_id``,
    ``group_size``, ``kept``, ``text_sha256``.

    The owners are written once and joined on (length, SHA-256) with narrow
    rows, so neither texts nor a hot group move as a whole.
    """
    found = cut_lineage(owners(df, id_col, text_col, keep), "owners")
    body = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = df.select(F.col(id_col).alias("doc_id"), F.octet_length(body).cast("long").alias("bytes"),
                     F.sha2(body, 256).alias("sha256"))
    return (rows.join(found, ["bytes", "sha256"])
                .select("doc_id", "keep_id", "group_size",
                        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                        F.col("sha256").alias("text_sha256")))


def keep_rows(df: DataFrame, id_col: str, text_col: str, keep: str = "smallest") -> DataFrame:
    """The owner's row of each distinct text, with the columns of ``df``.
    Texts are shuffled once, after the copies inside a task are merged."""
    found = owners(df, id_col, text_col, keep, carry=True)
    text = F.when(~F.col("row.was_null"), F.decode(F.col("body"), "UTF-8"))
    return found.select(*[text.alias(c) if c == text_col else F.col("row.cols").getField(c).alias(c)
                          for c in df.columns])
