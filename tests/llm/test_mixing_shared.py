"""Words of a text are computed once for all domains, and signals are those of the plain patterns."""

import re

from lakemart.llm import mixing

TEXTS = ["", " ", "\n\t \x0b", "a", "a a", " a  a\ta\n", "aa a", "a aa", "idiot Idiots worthy worth", "## #", "$&x % **y",
         "one one one one", "stupidly|stupid stupid!!", "x x x", "#\n#", "worthless worthier worth-less idiot", None]


def test_words_are_split_once_for_all_domains(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    signals = mixing.with_words({"toxic": ["idiot", "worth*"], "low": ["stupi*", "x"], "other": []})
    out = mixing.with_combination(df, "text", signals)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(lower(") == 1              # once per domain before


def test_signals_equal_plain_patterns(spark):
    marks = {"toxic": ["idiot", "worth*"], "low": ["stupi*", "x"]}
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    signals = mixing.with_words(marks)
    got = {r.id: (r.words, r.combo) for r in mixing.with_combination(df, "text", signals).select("r.doc_id", "words", "combo")
           .withColumnRenamed("doc_id", "id").collect()}
    space = r"[ \t\n\x0b\f\r]"
    for i, t in enumerate(TEXTS):
        t = t or ""
        ws = [w for w in re.split(space, t) if w]
        per = max(len(ws), 1)
        distinct = set(re.split(r"[\W_]+", t.lower()))
        values = [len(re.findall(r"[#$%&*]{2,}", t)) / per, t.count("!!") / per, t.count("|") / per,
                  sum(a == b for a, b in zip(ws, ws[1:])) / per]
        for own in marks.values():
            starts = {w[:-1] for w in own if w.endswith("*")}
            values.append(len(distinct & set(own)) + len({w[:5] for w in distinct if len(w) > 5} & starts))
        code = 0
        for v, (_, _, edges) in zip(values, signals.parts):
            code = code * (len(edges) + 1) + sum(v > e for e in edges)
        assert got[i] == (len(ws), code), t
