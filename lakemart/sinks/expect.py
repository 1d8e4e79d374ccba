"""Expectations: rules measured inside the write they guard.

Each rule is a Boolean column that holds for good rows; a NULL outcome is a
violation.  ``warn`` only counts, ``drop`` leaves the row out, ``fail`` stops the
write before anything is committed.  The counts are observed metrics of the write
itself, so there is no second pass over the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakemart.sinks.tables import publish

WARN, DROP, FAIL = "warn", "drop", "fail"


class ExpectationFailed(ValueError):
    """A row breaks a rule that must hold for all."""


def expect(df: DataFrame, rules: Mapping[str, tuple[str, Column]]) -> tuple[DataFrame, Observation]:
    """``df`` without the rows that a ``drop`` rule refuses, and the metrics
    that whatever writes it will observe: ``rows``, ``kept`` and ``bad_<rule>``."""
    wrong = [action for action, _ in rules.values() if action not in (WARN, DROP, FAIL)]
    if wrong:
        raise ValueError(f"no such action: {wrong[0]}")
    bad = {name: ~F.coalesce(rule, F.lit(False)) for name, (_, rule) in rules.items()}
    marked = df.withColumns({f"_bad_{name}": c for name, c in bad.items()})
    dropped = F.lit(False)
    for name, (action, _) in rules.items():
        if action == DROP:
            dropped = dropped | F.col(f"_bad_{name}")
    seen = Observation()
    counts = [F.count_if(F.col(f"_bad_{name}")).alias(f"bad_{name}") for name in rules]
    marked = marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(~dropped).alias("kept"), *counts)
    stop = F.lit(True)
    for name, (action, _) in rules.items():
        if action == FAIL:
            broken = F.raise_error(F.lit(f"expectation '{name}' failed")).cast("boolean")
            stop = F.when(F.col(f"_bad_{name}"), broken).otherwise(stop)
    return marked.filter(stop).filter(~dropped).select(*[F.col(f"`{c}`") for c in df.columns]), seen


def publish_expected(df: DataFrame, path: str, rules: Mapping[str, tuple[str, Column]], mode: str = "replace",
                     partition_by: Sequence[str] = ()) -> DataFrame:
    """:func:`~lakemart.sinks.tables.publish` under ``rules`` = {name:
    (action, column)}.  Returns one row per rule: ``rule``, ``action``, ``rows``
    seen, ``bad`` ones and rows ``kept`` by the write.  A ``fail`` rule that a
    row breaks raises :class:`ExpectationFailed`; the table stays as it was."""
    kept, seen = expect(df, rules)
    try:
        publish(kept, path, mode, partition_by)
    except Exception as e:
        if "USER_RAISED_EXCEPTION" in str(e) and "expectation '" in str(e):
            raise ExpectationFailed(str(e).split("expectation '", 1)[1].split("'", 1)[0]) from e
        raise
    got = seen.get
    return df.sparkSession.createDataFrame([(name, action, got["rows"], got[f"bad_{name}"], got["kept"])
                                            for name, (action, _) in rules.items()],
                                           "rule string, action string, rows long, bad long, kept long")
