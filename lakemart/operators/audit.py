"""Data-quality operators: rule violations, batch health, key checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: audit labels ------------------------------------------------
LABEL_DRIFT = "schema_drift"
LABEL_BAD = "bad_records"
LABEL_DUP = "duplicates"
LABEL_LATE = "late_data"
LABEL_HEALTHY = "healthy"
# --------------------------------------------------------------------------------


def violations_expr(rules: Mapping[str, Column]) -> Column:
    """Array of the names of violated rules, in rule order (NULL -> not
    violated)."""
    names = [F.when(F.coalesce(pred, F.lit(False)), F.lit(name)) for name, pred in rules.items()]
    return F.filter(F.array(*names), lambda x: x.isNotNull())


def rule_violations(df: DataFrame, rules: Mapping[str, Column], out: str = "violations",
                    only_bad: bool = True, as_string: bool = True) -> DataFrame:
    """Tag rows with the rules they break; by default keep only those rows
    (the quarantine set).  ``as_string`` joins the names with commas."""
    v = violations_expr(rules)
    tagged = df.withColumn(out, F.array_join(v, ",") if as_string else v)
    if only_bad:
        tagged = tagged.filter(F.size(v) > 0)
    return tagged


def late_rows(df: DataFrame, ts: str, batch_ts: Column, days: int) -> Column:
    """Predicate: the event is more than ``days`` days older than the batch."""
    return F.col(ts) < (batch_ts - F.make_interval(days=F.lit(days)))


def classify(drift: Column, bad: Column, dup: Column, late: Column) -> Column:
    """Comma list of the problems found, or ``healthy``."""
    tags = F.concat_ws(",",
                       F.when(drift.isNotNull() & (drift != F.lit("none")), F.lit(LABEL_DRIFT)),
                       F.when(bad > 0, F.lit(LABEL_BAD)),
                       F.when(dup > 0, F.lit(LABEL_DUP)),
                       F.when(late > 0, F.lit(LABEL_LATE)))
    return F.when(tags == F.lit(""), F.lit(LABEL_HEALTHY)).otherwise(tags)


def health_audit(df: DataFrame, source: str | Column, keys: Sequence[str],
                 bad_rules: Mapping[str, Column], late: Column | None = None,
                 drift: Column | None = None) -> DataFrame:
    """One row per source: rows, bad, duplicates, late, classification.

    Two-level aggregate: first per (source, key) -- rows, bad and late
    counts -- then per source, where duplicates = rows - distinct keys.
    Both levels combine map-side, so neither a hot source nor a hot key
    concentrates raw rows in one task, and no ``count(DISTINCT)`` is needed.
    """
    src = F.col(source) if isinstance(source, str) else source
    bad_any = F.size(violations_expr(bad_rules)) > 0
    per_key = (df.withColumn("_source", src)
                 .groupBy("_source", *keys)
                 .agg(F.count(F.lit(1)).alias("_n"),
                      F.count_if(bad_any).alias("_bad"),
                      F.count_if(F.coalesce(late, F.lit(False)) if late is not None else F.lit(False))
                       .alias("_late")))
    per_src = (per_key.groupBy("_source")
                      .agg(F.sum("_n").alias("rows_added"),
                           F.sum("_bad").alias("bad_records"),
                           F.sum(F.col("_n") - 1).alias("duplicates"),
                           F.sum("_late").alias("late_records")))
    d = drift if drift is not None else F.lit("none")
    return per_src.select(F.col("_source").alias("source"), "rows_added", "bad_records",
                          "duplicates", "late_records",
                          d.alias("drift_action"),
                          classify(d, F.col("bad_records"), F.col("duplicates"),
                                   F.col("late_records")).alias("classification"))


def check_primary_key(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values violating NOT NULL + UNIQUE: ``(cols..., rows, reason)``.

    A grouped count (partial aggregation) -- only violating keys survive."""
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("rows"))
    return (g.filter(any_null | (F.col("rows") > 1))
             .withColumn("reason", F.when(any_null, F.lit("null_key")).otherwise(F.lit("duplicate"))))


def check_foreign_key(fact: DataFrame, fk: str, dim: DataFrame, pk: str) -> DataFrame:
    """Fact rows whose non-NULL ``fk`` has no ``pk`` in the dimension."""
    return (fact.filter(F.col(fk).isNotNull())
                .join(dim.select(F.col(pk).alias(fk)), fk, "left_anti")
                .select(*fact.columns))
