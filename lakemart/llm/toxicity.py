"""Toxicity: a counterfactually regularised classifier of whole texts.

Features are the words of a text and their beginnings (so inflected and compounded
forms share evidence), present or absent.  Spark counts them over labelled
documents and keeps the ``FEATURES`` most associated with label 1; a logistic
model with weights of zero or more is fitted on those.

Regularisation by counterfactuals: every sentence of the labelled documents that
mentions a group is written again with the identity terms swapped for other
terms of their group (``SWAPS`` times, chosen by a hash), both forms are turned
into features, and the fit penalises the squared change of the score between
them.  A term that merely occurs together with toxic sentences gets no weight of
its own, so neutral mentions of a group are not marked.

The fit uses at most ``SAMPLE`` labelled documents, the ones with the smallest
hash of their identifier, of each distinct text one.  The driver gets positions
of selected features only, never texts.  A word's features are looked up in a
table of a few thousand weights, so all documents are scored in one pass.

Defined results: a null text counts as empty, and an empty text gets the score of
a text without any feature; rows with a null identifier or label teach nothing,
as do labels other than 0 and 1; label rows repeated for a text count once per
label; without labels of both kinds every score is the share of label 1 (0.5
without any); empty tables give no rows; other columns pass through.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import whole_text
from lakemart.session import cut_lineage

SAMPLE = 20_000                 # labelled documents the model is fitted on, at most
FEATURES = 4_096                # selected features, at most
SWAPS = 2                       # swapped forms of a sentence
LEAST = 2                       # documents a feature occurs in, at least
LEAST_Z = 2.4                   # how sure its association with label 1 must be, in standard errors
LEAN = 2.0                      # weight of a labelled row with label 1
BEGINNINGS = (4, 5, 6, 7, 8)    # lengths of the word beginnings used as features
MEMO = 200_000                  # words whose features a task remembers

# --- fixed values: identity terms by group ------------------------------------------
IDENTITY = {
    "gender": ["woman", "man", "girl", "boy", "female", "male", "transgender", "nonbinary"],
    "genders": ["women", "men", "girls", "boys", "females", "males"],
    "religion": ["muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "catholic", "protestant", "atheist"],
    "religions": ["muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "catholics", "protestants", "atheists"],
    "origin": ["african", "american", "arab", "asian", "chinese", "european", "french", "german", "indian", "mexican",
               "polish", "russian", "spanish", "turkish"],
    "status": ["immigrant", "refugee", "foreigner", "native", "citizen"],
    "statuses": ["immigrants", "refugees", "foreigners", "natives", "citizens"],
    "race": ["black", "white", "brown", "latino"],
    "orientation": ["gay", "lesbian", "bisexual", "straight", "heterosexual", "homosexual", "queer"],
    "age": ["old", "young", "elderly", "teenage"],
    "ability": ["disabled", "blind", "deaf", "autistic"],
    "geschlecht": ["frau", "mann", "mädchen", "junge"],
    "geschlechter": ["frauen", "männer", "jungen"],
    "herkunft": ["deutsche", "türken", "polen", "russen", "araber", "ausländer", "flüchtlinge"],
    "glaube": ["muslime", "christen", "juden", "katholiken", "atheisten"],
    "genre": ["femme", "homme", "fille", "garçon"],
    "genres": ["femmes", "hommes", "filles", "garçons"],
    "origine": ["français", "arabes", "africains", "allemands", "étrangers", "immigrés"],
    "croyance": ["musulmans", "chrétiens", "juifs", "catholiques", "athées"],
    "género": ["mujer", "hombre", "niña", "niño"],
    "géneros": ["mujeres", "hombres", "niñas", "niños"],
    "origen": ["españoles", "árabes", "africanos", "mexicanos", "extranjeros", "inmigrantes"],
    "creencia": ["musulmanes", "cristianos", "judíos", "católicos", "ateos"],
}
# -----------------------------------------------------------------------------------
_GROUP = {w: g for g, words in IDENTITY.items() for w in words}
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def features_of_word(word: str) -> tuple[int, ...]:
    """Feature numbers (31 bits) of a lower-case word: itself, and its
    beginnings with about how much follows."""
    parts = [f"={word}", *(f"^{word[:n]}+{min(len(word) - n, 9) // 3}" for n in BEGINNINGS if len(word) >= n)]
    return tuple(zlib.crc32(p.encode("utf-8", "replace")) >> 1 for p in parts)


class Features:
    """Distinct features of texts; remembers the words it has seen."""

    def __init__(self, keep: set[int] | None = None):
        self.keep, self.memo = keep, {}

    def of_words(self, words) -> set[int]:
        out: set[int] = set()
        for w in words:
            got = self.memo.get(w)
            if got is None:
                got = features_of_word(w)
                if self.keep is not None:
                    got = tuple(x for x in got if x in self.keep)
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[w] = got
            if got:
                out.update(got)
        return out

    def __call__(self, text: str) -> set[int]:
        return self.of_words(set(_WORD.findall(text.lower())))


def swapped(words: list[str], turn: int) -> list[str]:
    """The words of a sentence with each identity term replaced by another
    one of its group; equal terms get equal replacements."""
    seed = zlib.crc32(" ".join(words).encode("utf-8", "replace")) + turn

    def other(w):
        group = IDENTITY[_GROUP[w]]
        return group[(group.index(w) + 1 + (seed + turn * len(w)) % (len(group) - 1)) % len(group)]

    return [other(w) if w in _GROUP else w for w in words]


def counterfactuals(text: str, features: Features) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
    """Features that swapping adds to and takes from each sentence that
    mentions a group."""
    out = []
    for sentence in _SENTENCE.split(text.lower()):
        words = _WORD.findall(sentence)
        if any(w in _GROUP for w in words):
            here = features.of_words(words)
            for turn in range(SWAPS):
                there = features.of_words(swapped(words, turn))
                if here != there:
                    out.append((tuple(sorted(there - here)), tuple(sorted(here - there))))
    return out


# ---------------------------------------------------------------- the model

@dataclass
class Model:
    """Log-odds ``base`` and the ``weights`` of features."""
    base: float
    weights: dict[int, float] = field(default_factory=dict)

    def scorer(self):
        features, weights = Features(set(self.weights)), self.weights

        def score(text: str) -> float:
            z = self.base + sum(sorted(weights[x] for x in features(text)))
            return 1.0 / (1.0 + math.exp(-min(max(z, -35.0), 35.0)))

        return score


class _Rows:
    """Sparse rows: products with a vector of features and back."""

    def __init__(self, n: int, size: int, row, col, value):
        self.n, self.size = n, size
        self.row, self.col, self.value = np.asarray(row, np.int64), np.asarray(col, np.int64), np.asarray(value, float)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.col], self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.value * r[self.row], self.size)


def train(docs: list[tuple[int, list[int]]], swaps: list[tuple[list[int], list[int], int]], weight: float = 1.0,
          ridge: float = 1e-5, sparse: float = 1.0, lean: float = LEAN, steps: int = 1000) -> Model:
    """Weights of zero or more by accelerated projected gradient steps on the
    mean logistic loss (rows of label 1 count ``lean`` times), a ridge,
    ``sparse`` rows' share of the sum of weights and ``weight`` times the mean
    squared change of the score over counterfactual pairs.

    ``docs``: (label, features); ``swaps``: (features added, taken, number of
    such sentences)."""
    y = np.asarray([label for label, _ in docs], float)
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or share in (0.0, 1.0):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(math.log(share / (1 - share)))
    names = sorted({x for _, f in docs for x in f})
    at = {x: i for i, x in enumerate(names)}
    size = len(names) + 1                               # the last one is the base, present in all rows
    x = _Rows(len(docs), size, [i for i, (_, f) in enumerate(docs) for _ in range(len(f) + 1)],
              [c for _, f in docs for c in (*(at[v] for v in f), size - 1)],
              [1.0] * sum(len(f) + 1 for _, f in docs))
    pairs = [(sorted(at[v] for v in plus if v in at), sorted(at[v] for v in minus if v in at), n) for plus, minus, n in swaps]
    pairs = [p for p in pairs if p[0] or p[1]]
    total = sum(n for _, _, n in swaps)
    d = _Rows(len(pairs), size, [i for i, (a, b, _) in enumerate(pairs) for _ in range(len(a) + len(b))],
              [c for a, b, _ in pairs for c in (*a, *b)],
              [v for a, b, n in pairs for v in (*[math.sqrt(weight * n / total)] * len(a), *[-math.sqrt(weight * n / total)] * len(b))])

    each = np.where(y == 1, lean, 1.0)

    def slope(w):
        p = 1.0 / (1.0 + np.exp(-np.clip(x.times(w), -35, 35)))
        g = x.back((p - y) * each) / len(y)
        g[:-1] += ridge * w[:-1] + sparse / len(y)
        return g + d.back(d.times(w)) if len(pairs) else g

    v = np.ones(size) / math.sqrt(size)                 # power steps: the largest curvature
    for _ in range(30):
        v = x.back(x.times(v) * each) / (4 * len(y)) + ridge * v + (d.back(d.times(v)) if len(pairs) else 0)
        bound = float(np.linalg.norm(v))
        v /= bound
    w = np.zeros(size)
    w[-1] = math.log(share / (1 - share))
    ahead, t = w, 1.0
    for _ in range(steps):
        new = ahead - slope(ahead) / (1.1 * bound)
        new[:-1] = np.maximum(new[:-1], 0.0)
        after = (1 + math.sqrt(1 + 4 * t * t)) / 2
        if float(((ahead - new) * (new - w)).sum()) > 0:            # start the momentum anew when it turns against the slope
            after = 1.0
        ahead, w, t = new + (t - 1) / after * (new - w), new, after
    return Model(float(w[-1]), {v: float(w[i]) for v, i in at.items() if w[i] > 1e-9})


# ---------------------------------------------------------------- on Spark

def is_held_out(id_col: str) -> Column:
    """Rows whose CRC-32 of the identifier as text leaves 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def labelled(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int = SAMPLE) -> DataFrame:
    """(label, text) of the labelled documents to learn from.  The rows that
    are sent to all tasks are ``sample`` identifiers at most."""
    known = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~is_held_out(id_col))
                   .select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label")).distinct()
                   .orderBy(F.xxhash64("label_id"), "label_id", "label").limit(sample))
    return (df.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
              .join(F.broadcast(known), F.col("id") == F.col("label_id")).select("label", "text"))


def fit(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int = SAMPLE,
        keep: int = FEATURES, weight: float = 1.0) -> Model:
    """The model of ``labels`` (``weight`` 0: without counterfactuals)."""
    def extract(batches):
        features = Features()
        for b in batches:
            kind, label, digest, plus, minus = [], [], [], [], []
            for y, text in zip(b["label"].to_pylist(), b["text"].to_pylist()):
                code = xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) >> 1
                for row in [(0, sorted(features(text)), []), *((1, *x) for x in counterfactuals(text, features))]:
                    for column, v in zip((kind, plus, minus, label, digest), (*row, y, code)):
                        column.append(v)
            ints = pa.list_(pa.int32())
            yield pa.record_batch([pa.array(kind, pa.int32()), pa.array(label, pa.int32()), pa.array(digest, pa.int64()),
                                   pa.array(plus, ints), pa.array(minus, ints)],
                                  names=["kind", "label", "digest", "plus", "minus"])

    rows = labelled(df, labels, id_col, text_col, label_col, sample)
    rows = cut_lineage(rows.mapInArrow(extract, "kind int, label int, digest bigint, plus array<int>, minus array<int>"), "features")
    docs = rows.filter("kind = 0").dropDuplicates(["digest", "label"]).select("label", "plus")
    n = {r.label: r["count"] for r in docs.groupBy("label").count().collect()}
    if len(n) < 2:
        return train([(label, []) for label in n], [])
    # how much likelier a feature is under label 1, in standard errors of the log odds
    pos, neg = F.col("pos") + 0.5, F.col("neg") + 0.5
    odds = F.log(pos / (n[1] + 1 - pos)) - F.log(neg / (n[0] + 1 - neg))
    counted = (docs.select("label", F.explode("plus").alias("feature")).groupBy("feature")
                   .agg(F.sum("label").cast("double").alias("pos"), F.sum(1 - F.col("label")).cast("double").alias("neg")))
    best = (counted.filter(F.col("pos") + F.col("neg") >= LEAST).withColumn("z", odds / F.sqrt(1 / pos + 1 / neg))
                   .filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "feature").limit(keep))
    chosen = np.sort(np.asarray([r.feature for r in best.select("feature").collect()], np.int32))

    def only(batches):
        for b in batches:
            columns = []
            for c in ("plus", "minus"):
                flat, bounds = b[c].flatten().to_numpy(zero_copy_only=False), b[c].value_lengths().to_numpy()
                good = np.isin(flat, chosen)
                sizes = np.bincount(np.repeat(np.arange(len(bounds)), bounds), good, len(bounds)).astype(np.int64)
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, sizes.cumsum()).astype(np.int32)),
                                                        pa.array(flat[good].astype(np.int32))))
            yield pa.record_batch([b["label"], *columns], names=["label", "plus", "minus"])

    narrow = "label int, plus array<int>, minus array<int>"
    learnt = docs.withColumn("minus", F.array().cast("array<int>")).mapInArrow(only, narrow) \
                 .groupBy("label", "plus").count()      # equal documents are one row
    # the changes that a swap of terms makes: about as many as there are pairs of terms
    changes = rows.filter("kind = 1").select("label", "plus", "minus").mapInArrow(only, narrow).groupBy("plus", "minus").count()
    data = [(r.label, r.plus) for r in learnt.orderBy("label", "plus").limit(sample).collect() for _ in range(r["count"])]
    swaps = [(r.plus, r.minus, r["count"]) for r in changes.orderBy(F.desc("count"), "plus", "minus").limit(sample).collect()]
    return train(sorted(data), sorted(swaps), weight)


def score_text(model: Model, text_col: str) -> Column:
    """Score (double, 0 to 1) of a text column."""

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = model.scorer()                          # one for the whole task
        for texts in batches:
            yield pa.array([score(t or "") for t in texts.to_pylist()], pa.float64())

    return run(F.col(text_col))
