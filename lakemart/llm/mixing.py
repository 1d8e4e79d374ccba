"""Soft-membership mixing of documents to target domain weights.

1. A classifier learnt from a labelled table gives every document
   posterior probabilities over the domains: words that tell a domain's labelled
   documents from the others are learnt as log-odds of words and beginnings of
   words; their number in a text and other text signals are binned, and the
   label counts of its combination of bins, smoothed by a naive Bayes estimate
   from the (domain, signal, bin) counts, give them.
2. Projected-gradient least squares finds non-negative document rates whose
   expected tokens per domain, ``sum(rate * tokens * posterior)``, match the
   targets: the sum over domains of ``(expected - target)^2 / target``, by
   projected gradient steps with Nesterov's momentum.

Built-in SQL expressions only.  With steps scaled by the documents' tokens, a
document's step depends on its posteriors alone, and these on its bins alone; so documents
with equal bins share a rate, and the fit runs on one row per combination of
bins with its summed tokens - an exact pre-aggregation.  Every iteration is
one distributed aggregate of a few sums; the driver keeps the K residuals.
The combinations are bounded by the bins (``Signals.size``), which bounds the
broadcast of their rates.

Defined results: a null text counts as empty, has no tokens and gets the rate
of its bins; labels whose identifier or domain is null teach nothing; without
any label the posteriors are uniform; a domain without mass misses its target
and leaves the others theirs; repeated rows get the same rate; empty
tables give no rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.session import cut_lineage

# --- fixed values: bin edges ---------------------------------------------------------
SHARES = [0.0, 0.01, 0.05, 0.2, 0.5]
COUNTS = [0.0, 1.0, 3.0]
# -----------------------------------------------------------------------------------
LEAST_SHARE = 1e-3              # of the budget: smaller targets weigh like this one
PRIOR = 2.0                     # weight of the independent estimate, in labels
SAMPLE = 10_000                 # labelled documents that words are learnt from, at most
MARKS = 48                      # words and beginnings kept for a domain, at most
LEAST_Z = 3.0                   # how sure their association with it must be, in standard errors
LEAST_ODDS = 3.0                # and how strong, as a logarithm of the odds ratio
BEGINNINGS = (5, 6)             # lengths of beginnings, which stand for all longer words


@dataclass(frozen=True)
class Signals:
    """Binned text signals: (name, expression of ``t`` and ``words``, edges).
    The last ``counted`` ones count marks; their expressions can also be given the
    columns with the distinct words and their beginnings of ``lengths`` letters,
    which are then computed once for all of them."""
    parts: tuple
    counted: int = 0
    lengths: tuple = ()

    @property
    def size(self) -> int:
        n = 1
        for _, _, edges in self.parts:
            n *= len(edges) + 1
        return n



def _occurrences(part: str) -> Column:
    gone = F.length("t") - F.length(F.replace(F.col("t"), F.lit(part), F.lit("")))
    return gone / len(part)


def _runs(chars: str) -> Column:
    """Runs of two or more of ``chars``; texts without any are not searched."""
    some = F.contains(F.col("t"), F.lit(chars[0]))
    for c in chars[1:]:
        some = some | F.contains(F.col("t"), F.lit(c))
    return F.when(some, F.regexp_count("t", F.lit(f"[{chars}]{{2,}}+"))).otherwise(0)


def _per_word(count: Column) -> Column:
    return count / F.greatest(F.col("words"), F.lit(1))


TEXT_SIGNALS = Signals((
    ("marked", lambda: _per_word(_runs("#$%&*")), SHARES),
    ("shouted", lambda: _per_word(_occurrences("!!")), SHARES),
    ("bars", lambda: _per_word(_occurrences("|")), SHARES),
    # a space goes before the text, so that every word has one before it
    ("repeated", lambda: _per_word(F.regexp_count(F.concat(F.lit(" "), "t"), F.lit(r"\s(\S++)(?=\s++\1(?!\S))"))), SHARES),
))


def distinct_words(text: str) -> Column:
    """Distinct lower-case words of a text column."""
    return F.array_distinct(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"))


def _starts(w: Column, n: int) -> Column:
    """The first ``n`` letters of each longer word, NULL for the others."""
    return F.transform(w, lambda x: F.when(F.length(x) > n, F.substring(x, 1, n)))


def marks_in(text: str) -> Column:
    """Words of a text column and the beginnings (with ``*``) of longer ones."""
    def of(w):
        starts = [F.transform(F.array_compact(_starts(w, n)), lambda x: F.concat(x, F.lit("*"))) for n in BEGINNINGS]
        return F.array_distinct(F.concat(w, *starts))

    return F.transform(F.array(distinct_words(text)), of)[0]


def with_words(marks: Mapping[str, Sequence[str]]) -> Signals:
    """The text signals and, per domain, how many of its words and
    beginnings a text has."""
    def count(own):
        starts = [w[:-1] for w in own if w.endswith("*")]
        by = {n: F.array(*[F.lit(x) for x in starts if len(x) == n]) for n in sorted({len(x) for x in starts})}
        whole = F.array(*[F.lit(w) for w in own if not w.endswith("*")]).cast("array<string>")

        def found(w, begin):
            parts = [F.size(F.array_intersect(begin(n), own)) for n, own in by.items()]
            return sum(parts, F.size(F.array_intersect(w, whole)))

        def signal(w=None, begin=None):
            if w is not None:
                return found(w, begin)
            # the words are bound to a variable, so that they are computed once
            return F.transform(F.array(distinct_words("t")), lambda w: found(w, lambda n: _starts(w, n)))[0]

        return signal

    own = {d: words for d, words in marks.items() if words}
    lengths = tuple(sorted({len(w) - 1 for words in own.values() for w in words if w.endswith("*")}))
    counts = tuple((f"words_{d}", count(words), COUNTS) for d, words in own.items())
    return Signals(TEXT_SIGNALS.parts + counts, len(own), lengths)


def learn_marks(df: DataFrame, id_col: str, text_col: str, labels: DataFrame, domain: str, sample: int = SAMPLE,
                keep: int = MARKS) -> list[str]:
    """Words, and beginnings of words, by which labelled documents of
    ``domain`` are told from the other labelled ones: those with the largest
    log-odds ratio in standard errors, from ``sample`` labels at most (smallest
    hashes first).  ``labels`` has columns (id, domain)."""
    known = (labels.select(F.col("id").alias("label_id"), (F.col("domain") == domain).cast("int").alias("y")).dropna().distinct()
                   .orderBy(F.xxhash64("label_id"), "label_id", "y").limit(sample))
    known = F.broadcast(known)                          # sample narrow rows at most
    n = {r.y: r["count"] for r in df.select(F.col(id_col).alias("id")).join(known, F.col("id") == F.col("label_id"))
                                    .groupBy("y").count().collect()}
    if len(n) < 2:
        return []
    rows = (df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
              .join(known, F.col("id") == F.col("label_id"))
              .select("y", F.explode(marks_in("t")).alias("mark")))
    counted = rows.filter(F.col("mark") != "").groupBy("mark").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    a, b = F.col("pos") + 0.5, F.col("neg") + 0.5
    odds = F.log(a / (n[1] + 1 - a)) - F.log(b / (n[0] + 1 - b))
    best = (counted.filter("pos >= 2").withColumn("odds", odds).filter(F.col("odds") >= LEAST_ODDS)
                   .withColumn("z", F.col("odds") / F.sqrt(1 / a + 1 / b)).filter(F.col("z") >= LEAST_Z)
                   .orderBy(F.desc("z"), F.length("mark"), "mark").limit(16 * keep))
    out: list[str] = []
    for r in best.select("mark").collect():             # 16 * keep words at most; one that a kept beginning covers says nothing new
        if len(out) < keep and not any(x.endswith("*") and r.mark.startswith(x[:-1]) for x in out):
            out.append(r.mark)
    return out


def learnt_signals(df: DataFrame, id_col: str, text_col: str, labels: DataFrame, domains: Sequence[str],
                   anchor: str | None) -> Signals:
    """The text signals and learnt words of every domain but the anchor (or
    the first)."""
    rest = [d for d in domains if d != (anchor or domains[0])]
    return with_words({d: learn_marks(df, id_col, text_col, labels, d) for d in rest})


def with_combination(df: DataFrame, text: str, signals: Signals = TEXT_SIGNALS) -> DataFrame:
    """Columns ``r`` (the row), ``words`` (tokens) and ``combo``, the code of
    the document's bins."""
    work = (df.select(F.struct(*[F.col(c) for c in df.columns]).alias("r"),
                      F.coalesce(F.col(text), F.lit("")).alias("t"))
            .withColumn("words", F.size(F.array_remove(F.split("t", r"\s"), "")).cast("long")))
    # the distinct words, their beginnings and the signals are columns of their own, so that each is computed once
    plain, shared = len(signals.parts) - signals.counted, {}
    if signals.counted:
        work = work.withColumn("w", distinct_words("t"))
        work = work.select("*", *[_starts(F.col("w"), n).alias(f"w{n}") for n in signals.lengths])
        shared = {"w": F.col("w"), "begin": lambda n: F.col(f"w{n}")}
    work = work.select("r", "words", *[(x(**shared) if i >= plain else x()).alias(f"x{i}")
                                       for i, (_, x, _) in enumerate(signals.parts)])
    code = F.lit(0)
    for i, (_, _, edges) in enumerate(signals.parts):
        code = code * (len(edges) + 1) + sum((F.when(F.col(f"x{i}") > e, 1).otherwise(0) for e in edges), F.lit(0))
    return work.select("r", "words", code.cast("int").alias("combo"))


def _bin_of(combo: Column, signals: Signals, i: int) -> Column:
    below = 1
    for _, _, edges in signals.parts[i + 1:]:
        below *= len(edges) + 1
    return F.floor(combo / below).cast("int") % (len(signals.parts[i][2]) + 1)


def posteriors(combos: DataFrame, labelled: DataFrame, domains: Sequence[str],
               signals: Signals = TEXT_SIGNALS) -> DataFrame:
    """Add ``p``, the posteriors of each combination over ``domains``, learnt
    from ``labelled`` rows (combo, domain): the shares among the combination's
    own labels, with ``PRIOR`` labels' worth of the estimate that takes the
    signals as independent."""
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("signal"), _bin_of(F.col("combo"), signals, i).alias("bin"))
                                for i in range(len(signals.parts))])).alias("c")
    known = labelled.filter(F.col("domain").isin(*domains)).groupBy("domain", "combo").agg(F.count("*").alias("n"))
    counted = (known.select("domain", "n", cells).groupBy("domain", "c.signal", "c.bin").agg(F.sum("n").alias("n")))
    # at most domains x signals x bins rows
    table = {(r.domain, r.signal, r.bin): r.n for r in counted.collect()}
    of = {k: sum(n for (d, s, _), n in table.items() if d == k and s == 0) for k in domains}
    total = sum(of.values())
    logs = []
    for k in domains:
        z = F.log(F.lit((of[k] + 1) / (total + len(domains))))
        for i, (_, _, edges) in enumerate(signals.parts):
            m = len(edges) + 1
            likely = F.array(*[F.log(F.lit((table.get((k, i, b), 0) + 1) / (of[k] + m))) for b in range(m)])
            z = z + likely[_bin_of(F.col("combo"), signals, i)]
        logs.append(z)
    work = combos.withColumn("z", F.array(*logs))
    work = work.withColumn("z", F.transform("z", lambda x: F.exp(x - F.array_max("z"))))
    total = F.aggregate("z", F.lit(0.0), lambda a, x: a + x)
    work = work.withColumn("z", F.transform("z", lambda x: x / total))
    own = known.groupBy("combo").agg(F.array(*[F.coalesce(F.sum(F.when(F.col("domain") == k, F.col("n"))), F.lit(0))
                                               for k in domains]).alias("own"))
    none = F.array(*[F.lit(0).cast("long") for _ in domains])
    work = work.join(own, "combo", "left").withColumn("own", F.coalesce("own", none))
    seen = F.aggregate("own", F.lit(0).cast("long"), lambda a, x: a + x)
    return work.withColumn("p", F.zip_with("own", "z", lambda c, z: (c + z * PRIOR) / (seen + PRIOR))).drop("z", "own")


def fit_rates(combos: DataFrame, domains: Sequence[str], weights: Sequence[float], anchor: str | None = None,
              margin: float = 0.0, steps: int = 60, tolerance: float = 1e-5) -> DataFrame:
    """Rates (``rate``) of combinations (combo, tokens, p) whose expected
    domain tokens match ``weights`` of a budget.

    The budget is the current number of tokens, or with ``anchor`` the one at
    which that domain keeps its tokens times ``1 + margin``.
    """
    k = len(domains)
    combos = cut_lineage(combos.select("combo", "tokens", "p"), "combos")
    n, p = F.col("tokens").cast("double"), [F.col("p")[i] for i in range(k)]
    sums = combos.agg(*[F.coalesce(F.sum(n * p[i] * p[j]), F.lit(0.0)).alias(f"m{i}_{j}") for i in range(k) for j in range(k)],
                      *[F.coalesce(F.sum(n * p[i]), F.lit(0.0)).alias(f"t{i}") for i in range(k)]).first()
    now = [sums[f"t{i}"] for i in range(k)]
    share = [w / sum(weights) for w in weights]
    at = domains.index(anchor) if anchor else None
    budget = sum(now) if at is None or share[at] == 0 else now[at] * (1 + margin) / share[at]
    target = [budget * s for s in share]
    # squared misses relative to the targets: a domain that is all but absent cannot outweigh the others
    scale = [1.0 / max(t, LEAST_SHARE * budget, 1e-9) for t in target]
    # a bound of the largest eigenvalue of the scaled normal matrix: its largest row sum
    rows = [sum(abs(sums[f"m{i}_{j}"]) * (scale[i] * scale[j]) ** 0.5 for j in range(k)) for i in range(k)]
    step = 1.0 / max(max(rows), 1e-12)
    history: list[list[float]] = []                     # of each step: momentum, then the move per domain

    def state() -> Column:
        """``r``: the rates after the steps so far, ``y``: where the next gradient is taken."""
        start = F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("y"))
        if not history:
            return start
        moves = F.array(*[F.array(*[F.lit(float(v)) for v in h]) for h in history])

        def move(a, h):
            r = F.greatest(F.lit(0.0), a["y"] - sum((h[i + 1] * p[i] for i in range(k)), F.lit(0.0)))
            return F.struct(r.alias("r"), (r + h[0] * (r - a["r"])).alias("y"))

        return F.aggregate(moves, start, move)

    totals, t = now, 1.0
    for _ in range(steps if sum(now) > 0 else 0):
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        history.append([(t - 1) / after, *[step * scale[i] * (totals[i] - target[i]) for i in range(k)]])
        got = combos.withColumn("y", state()["y"]).agg(*[F.sum(n * F.col("y") * p[i]).alias(f"t{i}") for i in range(k)]).first()
        before, totals, t = totals, [got[f"t{i}"] for i in range(k)], after
        if max(abs(x - y) for x, y in zip(before, totals)) <= tolerance * budget:
            break
    return combos.withColumn("rate", state()["r"])


def _plan(work: DataFrame, id_col: str, labels: DataFrame, domains, weights, anchor, margin, signals) -> DataFrame:
    """Posteriors and rate of each combination in ``work`` (narrow rows)."""
    known = labels.select(F.col("id").alias("label_id"), "domain").filter("label_id IS NOT NULL AND domain IS NOT NULL")
    labelled = work.select(F.col(f"r.{id_col}").alias("id"), "combo").join(known, F.col("id") == F.col("label_id"))
    combos = work.groupBy("combo").agg(F.sum("words").alias("tokens"))
    return fit_rates(posteriors(combos, labelled.select("combo", "domain"), domains, signals),
                     domains, weights, anchor, margin)


def mix(df: DataFrame, id_col: str, text_col: str, labels: DataFrame, domains: Sequence[str],
        weights: Sequence[float], anchor: str | None = None, margin: float = 0.0,
        signals: Signals | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``tokens``, ``p_<domain>``, ``rate``
    and ``copies``, the whole number of times to use it (the rate's fraction
    decided by a hash of the identifier and the text).

    ``labels`` has columns (id, domain); ``signals`` are learnt from them
    unless given."""
    signals = signals or learnt_signals(df, id_col, text_col, labels, domains, anchor)
    work = cut_lineage(with_combination(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))
                                        .withColumn("u", uniform("doc_id", "body")), "body", signals)
                       .select(F.struct("r.doc_id", "r.u").alias("r"), "words", "combo"), "mix")
    plan = _plan(work, "doc_id", labels, domains, weights, anchor, margin, signals).select("combo", "p", "rate")
    # at most signals.size rows of a few dozen bytes
    return work.join(F.broadcast(plan), "combo").select(
        "r.doc_id", F.col("words").alias("tokens"), *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(domains)],
        "rate", F.floor(F.col("rate") + F.col("r.u")).cast("long").alias("copies"))


def thin(df: DataFrame, id_col: str, text_col: str, labels: DataFrame, domains: Sequence[str],
         weights: Sequence[float], anchor: str | None = None, margin: float = 0.0,
         signals: Signals | None = None) -> DataFrame:
    """The rows of ``df`` kept by their rates: each with probability
    ``min(rate, 1)``, decided by a hash.  Texts are read, never shuffled."""
    signals = signals or learnt_signals(df, id_col, text_col, labels, domains, anchor)
    work = cut_lineage(with_combination(df.select(id_col, text_col), text_col, signals)
                       .select(F.struct(f"r.{id_col}").alias("r"), "words", "combo"), "mix")
    plan = _plan(work, id_col, labels, domains, weights, anchor, margin, signals).select("combo", "rate")
    rows = with_combination(df, text_col, signals).join(F.broadcast(plan), "combo")
    u = uniform(f"r.{id_col}", f"r.{text_col}")
    return rows.filter(u < F.col("rate")).select("r.*")


def uniform(id_col: str, text_col: str) -> Column:
    """A stable number in [0, 1) for each document."""
    h = F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")), F.lit("mix"))
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def label_domains(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, domain) of a label table with ``quality`` and ``toxic``."""
    domain = (F.when(F.col("quality") == 0, "low").when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean"))
    return labels.select(F.col(id_col).alias("id"), domain.alias("domain"))
