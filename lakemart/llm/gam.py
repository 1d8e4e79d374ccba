"""Quality classifier: a generalised additive model with pairwise interactions.

Signals of a whole text are cut into quantile bins; each signal has a lookup
table over its bins, and a few pairs of signals have tables over a coarser
grid.  Tables are learnt by cyclic boosting: signal after signal, a shallow
tree over the bins is fitted to the logistic loss's gradients and a fraction
of its leaf values is added to the table.  Pairs are ranked by how much a
table over their grid would still explain, and boosted the same way after the
single tables.  A score is the logistic function of a sum of table entries.

Spark computes the signals of every document; training uses a bounded sample
of labelled rows (``sample`` rows at most, chosen by a hash of the identifier)
collected as numbers, never texts.  The model is a few KB and scores Arrow
batches by one table addition per signal.

Defined results: a null text counts as empty and gets a score like any other;
rows with a null identifier or label teach nothing; a label row repeated for a
document counts once per row; without labels of both kinds every score is the
share of label 1 (0.5 without any); empty tables give no rows; extra columns
pass through unchanged.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import short_batches

SAMPLE = 20_000                 # labelled rows the model is fitted on, at most
SIGNALS = ["log_chars", "log_words", "word_length", "upper_letters", "caps_words", "digits", "punctuation",
           "symbols", "marked_words", "shouted_words", "bars", "distinct_words", "top_word", "repeated_words",
           "top_pair", "repeated_lines", "line_words", "ended_lines", "commas", "stops", "entropy"]

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#$%&*+/<=>@[\\]^_`{|}~")] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_MARKED = re.compile(r"[#$%&*+/<=>@\\^_`|~]{2,}(?=\s|$)")
_SHOUTED = re.compile(r"!!(?=\s|$)")


def signals(text: str) -> list[float]:
    """The numbers of ``SIGNALS`` for one whole text."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(SIGNALS)
    raw = text.encode("utf-8", "replace")
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, chars = len(raw), len(text)
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    caps = sum(map(str.isupper, words))
    seen = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    lines = [x for x in text.split("\n") if x.strip()]
    p = count[count > 0] / size
    return [math.log1p(chars), math.log1p(n), (chars - n) / n, upper / max(1, upper + lower), caps / n,
            count[48:58].sum() / size, count[_PUNCT].sum() / size, count[_SYMBOLS].sum() / size,
            len(_MARKED.findall(text)) / n, len(_SHOUTED.findall(text)) / n, count[124] / n,
            len(seen) / n, max(seen.values()) / n, pairs_equal(pairs) / n,
            max(pairs.values(), default=0) / n, 1 - len(set(lines)) / len(lines), n / len(lines),
            sum(x.rstrip().endswith((".", "!", "?")) for x in lines) / len(lines),
            count[44] / n, count[46] / n, float(-(p * np.log2(p)).sum())]


def pairs_equal(pairs: Counter) -> int:
    return sum(k for (a, b), k in pairs.items() if a == b)


def signals_of(text: str) -> Column:
    """The signals of a text column as array<float>."""

    @F.arrow_udf("array<float>")
    def run(texts: pa.Array) -> pa.Array:
        rows = [signals(t or "") for t in texts.to_pylist()]
        flat = pa.array(np.asarray(rows, np.float32).reshape(-1))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(SIGNALS)), flat)

    return run(F.col(text))


# ---------------------------------------------------------------- the model

def _leaves(g: np.ndarray, h: np.ndarray, splits: int, least: float) -> np.ndarray:
    """Newton steps of a tree with up to ``splits`` cuts over ordered bins."""
    cuts = [0, len(g)]
    cg, ch = np.concatenate([[0], g.cumsum()]), np.concatenate([[0], h.cumsum()])

    def worth(a, b):
        return (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + 1.0)

    for _ in range(splits):
        best, at = 1e-9, None
        for a, b in zip(cuts, cuts[1:]):
            k = np.arange(a + 1, b)
            k = k[(ch[k] - ch[a] >= least) & (ch[b] - ch[k] >= least)]
            if len(k):
                gain = worth(a, k) + worth(k, b) - worth(a, b)
                i = int(gain.argmax())
                if gain[i] > best:
                    best, at = gain[i], int(k[i])
        if at is None:
            break
        cuts = sorted([*cuts, at])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = -(cg[b] - cg[a]) / (ch[b] - ch[a] + 1.0)
    return out


def _grid_tree(g: np.ndarray, h: np.ndarray, least: float) -> tuple[np.ndarray, float]:
    """A tree of depth two over a grid: one cut of the rows, then one cut of
    the columns on each side.  Returns its steps and its gain."""
    best, out = -1.0, np.zeros_like(g)
    for k in range(1, g.shape[0]):
        step, gain = np.zeros_like(g), 0.0
        for part in (slice(0, k), slice(k, None)):
            sg, sh = g[part].sum(axis=0), h[part].sum(axis=0)
            if sh.sum() < least:
                break
            row = _leaves(sg, sh, 1, least)
            step[part] = row
            gain += float(-(row * sg + row * row * sh / 2).sum())
        else:
            if gain > best:
                best, out = gain, step
    return out, best


class Model:
    """``base`` log-odds, bin ``edges`` and ``tables`` per signal, and tables
    of pairs over the coarse edges."""

    def __init__(self, base, edges, tables, coarse, pairs):
        self.base, self.edges, self.tables, self.coarse, self.pairs = base, edges, tables, coarse, pairs

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            z += t[np.searchsorted(self.edges[j], x[:, j], side="right")]
        for (a, b), t in self.pairs.items():
            z += t[np.searchsorted(self.coarse[a], x[:, a], side="right"),
                   np.searchsorted(self.coarse[b], x[:, b], side="right")]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]).astype(np.float32))


def train(x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 120, rate: float = 0.15,
          grid: int = 8, pairs: int = 6, pair_rounds: int = 40, least: float = 2.0) -> Model:
    """Fit the tables by cyclic boosting on signals ``x`` and labels ``y``."""
    n, f = x.shape if x.size else (0, len(SIGNALS))
    share = float(y.mean()) if n else 0.5
    if n == 0 or share in (0.0, 1.0):
        share = min(max(share, 1e-6), 1 - 1e-6)
        none = np.zeros(0, np.float32)
        return Model(math.log(share / (1 - share)), [none] * f, [np.zeros(1)] * f, [none] * f, {})
    base = math.log(share / (1 - share))
    edges, coarse = [_edges(x[:, j], bins) for j in range(f)], [_edges(x[:, j], grid) for j in range(f)]
    at = [np.searchsorted(edges[j], x[:, j], side="right") for j in range(f)]
    tables = [np.zeros(len(edges[j]) + 1) for j in range(f)]
    z = np.full(n, base)

    def slopes():
        p = 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for j in range(f):
            g, h = slopes()
            m = len(tables[j])
            step = rate * _leaves(np.bincount(at[j], g, m), np.bincount(at[j], h, m), 3, least)
            tables[j] += step
            z += step[at[j]]
    rough = [np.searchsorted(coarse[j], x[:, j], side="right") for j in range(f)]

    def cells(a, b):
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        return rough[a] * shape[1] + rough[b], shape

    g, h = slopes()
    ranked = []
    for a, b in combinations(range(f), 2):
        flat, shape = cells(a, b)
        if min(shape) > 1:
            size = shape[0] * shape[1]
            ranked.append((_grid_tree(np.bincount(flat, g, size).reshape(shape),
                                      np.bincount(flat, h, size).reshape(shape), least)[1], a, b))
    chosen = [(a, b) for _, a, b in sorted(ranked, reverse=True)[:pairs]]
    found = {(a, b): np.zeros(cells(a, b)[1]) for a, b in chosen}
    for _ in range(pair_rounds):
        for a, b in chosen:
            g, h = slopes()
            flat, shape = cells(a, b)
            size = shape[0] * shape[1]
            step, _ = _grid_tree(np.bincount(flat, g, size).reshape(shape),
                                 np.bincount(flat, h, size).reshape(shape), least)
            found[a, b] += rate * step
            z += rate * step.reshape(-1)[flat]
    return Model(base, edges, tables, coarse, found)


# ---------------------------------------------------------------- on Spark

def is_held_out(id_col: str) -> Column:
    """Rows whose CRC-32 of the identifier as text leaves 1 modulo 3."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(signal_rows: DataFrame, labels: DataFrame, id_col: str, label_col: str, sample: int = SAMPLE) -> Model:
    """Model of ``labels`` on rows of (id, ``signals`` array).  At most
    ``sample`` labelled rows, spread by a hash of the identifier, are read."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~is_held_out(id_col)) \
                  .select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label"))
    n = known.count()
    if n > sample:                                     # aims a little lower, so that the limit hardly ever cuts
        share = 0.95 * sample / n
        known = known.filter(F.pmod(F.xxhash64(F.col("label_id")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    rows = signal_rows.join(known, F.col(id_col) == F.col("label_id")) \
                      .select("label_id", "label", "signals").limit(sample).collect()
    rows.sort(key=lambda r: (r.label_id, r.label, r.signals))
    x = np.asarray([r.signals for r in rows], np.float32).reshape(len(rows), len(SIGNALS))
    return train(x, np.asarray([r.label for r in rows], float))


def score_signals(model: Model, column: str | Column) -> Column:
    """Score (double) of an array column of signals."""

    @F.arrow_udf("double")
    def run(rows: pa.Array) -> pa.Array:
        x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), len(SIGNALS))
        return pa.array(model.score(x))

    return run(F.col(column) if isinstance(column, str) else column)


def score_text(model: Model, text: str) -> Column:
    """Score (double) of a text column, in one pass over the text."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(np.asarray([signals(t or "") for t in texts.to_pylist()], np.float32)
                                    .reshape(len(texts), len(SIGNALS))))

    return run(F.col(text))


def fit_on_documents(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                     sample: int = SAMPLE) -> Model:
    """Model from documents and labels; only numbers are shuffled."""
    short_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias(id_col), signals_of(text_col).alias("signals"))
    return fit(rows, labels, id_col, label_col, sample)
