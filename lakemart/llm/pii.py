"""Personal data in texts: patterns propose, checksums confirm, context scores.

Built-in SQL functions only.  For every kind a regular expression proposes
spans (leftmost, not overlapping); a validator confirms or drops each (address
parts, Luhn and mod-97 checksums, digit counts), and words near the span raise
its score.  An IBAN is as long as its country's are (``IBAN_LENGTHS``), so
that words and numbers after it are not taken for a part of it; codes of other
countries have no IBANs.  Kinds marked ``needs_context`` are reported only when their score
reaches ``ACCEPT``; base kinds are reported whenever they are valid.

Positions come from splitting the text by the same expression: gap lengths and
match lengths, summed in blocks, give starts and ends in code points, linear
in the text.  Context is cut by position, other spans included, from pieces of
the text of equal length, so that a span costs the same in any text.  The patterns use possessive repeats, so that one long run of
letters or digits is scanned once, not once per start; ``\\G`` and lookbehinds
keep the spans those of the plain patterns.

Defined results: a null text counts as empty and has no spans; identifiers may
be null or repeated; empty tables give no rows; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT = 40                    # code points before and after a span that may hold context words
ACCEPT = 0.6                    # least score of a kind that needs context
RAISE = 0.3                     # what a context word adds
BLOCK = 256                     # spans per block of the running sums
PIECE = 256                     # code points per piece of a text, from which context is cut; above CONTEXT


@dataclass(frozen=True)
class Kind:
    name: str
    guard: str                  # a text without this (regular expression) has no span
    pattern: str
    score: float
    words: str                  # context words (regular expression)
    base: bool = True
    needs_context: bool = False


# --- fixed values: characters of an IBAN by country, kinds in the order in which spans are listed
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD TG",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
_LOCAL = "[A-Za-z0-9._%+-]"
KINDS = [
    Kind("email", "@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9,
         r"e-?mail|contact|write|send"),
    Kind("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6,
         r"\bip\b|host|server|address|login"),
    Kind("card", r"[0-9]", r"[0-9](?:[ -]?[0-9])++", 0.7, r"card|visa|credit|payment|account"),
    Kind("phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]", 0.7, r"phone|call|tel|mobile|fax"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}", rf"(?<![A-Z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBAN})(?![A-Z0-9])", 0.8,
         r"iban|bank|account|konto|compte|cuenta", base=False),
    Kind("ssn", r"[0-9]-[0-9]{2}-[0-9]",
         r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", 0.4,
         r"ssn|social security", base=False, needs_context=True),
]
# ----------------------------------------------------------------------------------


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the Luhn check?"""
    n = F.length(digits)

    def add(acc, i):
        x = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = x * 2 - F.when(x > 4, 9).otherwise(0)
        return acc + F.when(i % 2 == 0, twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Does an IBAN without spaces leave 1 modulo 97?"""
    turned = F.concat(F.substring(iban, 5, 1000), F.substring(iban, 1, 4))

    def add(acc, c):
        letter = F.ascii(c) - F.lit(55)
        return F.when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + letter) % 97)

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), add) == 1


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}$")
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(m, " ", ""))
    return F.lit(True)


def running_sums(lengths: Column) -> Column:
    """Sums of the entries before each entry of an array<int>; two levels, so
    that the work stays near linear in the array's size."""
    def scan(values, start):
        return F.aggregate(values, F.struct(start.alias("s"), F.array().cast("array<int>").alias("out")),
                           lambda a, x: F.struct((a["s"] + x).alias("s"), F.concat(a["out"], F.array(a["s"])).alias("out")))["out"]

    n = F.size(lengths)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))
    sums = F.transform(blocks, lambda v: F.aggregate(v, F.lit(0), lambda a, x: a + x))
    return F.flatten(F.zip_with(blocks, scan(sums, F.lit(0)), scan))


def _between(start: Column, end: Column) -> Column:
    """Code points of the text from start to end, at most ``CONTEXT``."""
    first = F.floor(start / PIECE).cast("int")
    two = F.concat(F.coalesce(F.get("pieces", first), F.lit("")), F.coalesce(F.get("pieces", first + 1), F.lit("")))
    return F.substring(two, start - first * PIECE + 1, end - start)


def _spans(k: Kind):
    """Struct of the i-th match of kind ``k``, from its gaps and sums."""
    gaps, sums = F.col(f"g_{k.name}"), F.col(f"s_{k.name}")

    def span(match, i):
        start = F.get(sums, i) + F.length(F.get(gaps, i))
        end = start + F.length(match)
        around = F.concat(_between(F.greatest(start - CONTEXT, F.lit(0)), start), F.lit(" "), _between(end, end + CONTEXT))
        score = F.least(F.lit(k.score) + F.when(around.rlike(f"(?i){k.words}"), RAISE).otherwise(0.0), F.lit(1.0))
        return F.struct(F.lit(k.name).alias("kind"), start.alias("start"), end.alias("end"),
                        score.alias("score"), F.lit(k.base).alias("base"), _valid(k.name, match).alias("valid"))

    return span


def _reported(k: Kind):
    if k.needs_context:
        return lambda x: x["valid"] & (x["score"] >= ACCEPT)
    return lambda x: x["valid"]


def find(df: DataFrame, text: str, out: str = "spans") -> DataFrame:
    """Add ``out``: array of (kind, start, end, score, base) in the order of
    ``KINDS``, then of start; code points, end exclusive."""
    work = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("r"),
                     F.coalesce(F.col(text), F.lit("")).alias("t"))
    none = F.array().cast("array<string>")
    for k in KINDS:
        has = F.col("t").contains(k.guard) if k.guard == "@" else F.col("t").rlike(k.guard)
        work = work.withColumn(f"m_{k.name}", F.when(has, F.regexp_extract_all("t", F.lit(k.pattern), F.lit(0))).otherwise(none))
    for k in KINDS:
        work = work.withColumn(f"g_{k.name}", F.when(F.size(f"m_{k.name}") > 0, F.split("t", k.pattern, -1)))
    for k in KINDS:
        m, g = F.col(f"m_{k.name}"), F.col(f"g_{k.name}")
        steps = F.zip_with(F.slice(g, 1, F.size(m)), m, lambda a, b: F.length(a) + F.length(b))
        work = work.withColumn(f"s_{k.name}", F.when(F.size(m) > 0, running_sums(steps)))
    some = F.greatest(*[F.size(f"m_{k.name}") for k in KINDS]) > 0
    work = work.withColumn("pieces", F.when(some, F.regexp_extract_all("t", F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))))
    for k in KINDS:
        found = F.filter(F.transform(F.col(f"m_{k.name}"), _spans(k)), _reported(k))
        work = work.withColumn(f"f_{k.name}", F.when(F.size(f"m_{k.name}") > 0, found))
    parts = [F.col(f"f_{k.name}") for k in KINDS]
    spans = F.transform(F.flatten(F.filter(F.array(*parts), lambda x: x.isNotNull())),
                        lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                                           x["score"].alias("score"), x["base"].alias("base")))
    return work.select("r.*", spans.alias(out))


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"),
                                                                 x["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
