"""Aggregations: periodic rollups, high-water marks, milestone pivots,
set union and key-share profiles.  All are hash aggregates with map-side
partial aggregation, so a hot key is pre-reduced before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.dates import truncate


def period_rollup(df: DataFrame, keys: Sequence[str], ts: str, unit: str,
                  aggs: Mapping[str, Column], period_col: str = "period_start") -> DataFrame:
    """``groupBy(keys, date_trunc(unit, ts)).agg(**aggs)``."""
    return (df.withColumn(period_col, truncate(unit, ts, df.schema[ts].dataType))
              .groupBy(*keys, period_col)
              .agg(*[v.alias(k) for k, v in aggs.items()]))


# --- fixed values: statuses that do not count as an active reading --------
INACTIVE_STATUSES = ("idle", "maintenance")
# ---------------------------------------------------------------------------


def hourly_rollup(df: DataFrame, key: str = "vehicle_id", ts: str = "reading_timestamp",
                  reading_id: str = "reading_id", speed: str = "speed_kmh",
                  odometer: str = "odometer_km", fuel: str = "fuel_pct",
                  engine: str = "engine_temp_c", cargo: str = "cargo_temp_c",
                  status: str = "vehicle_status", inactive: Sequence[str] = INACTIVE_STATUSES,
                  period_col: str = "period_start_timestamp") -> DataFrame:
    """Vehicle x hour telemetry rollup.

    ``active_readings`` counts readings whose status is not in ``inactive``
    (a NULL status counts as active); ``utilization_pct`` is its share of
    the readings, ``km_driven`` the odometer span within the hour.
    Averages are those of the raw values, rounded once at the end.
    """
    agg = period_rollup(df, [key], ts, "hour", {
        "readings_count": F.count(F.col(reading_id)),
        "avg_speed_kmh": F.round(F.avg(speed), 0),
        "max_speed_kmh": F.max(speed),
        "_min_odo": F.min(odometer),
        "_max_odo": F.max(odometer),
        "avg_fuel_pct": F.round(F.avg(fuel), 2),
        "avg_engine_temp_c": F.round(F.avg(engine), 0),
        "min_cargo_temp_c": F.min(cargo),
        "max_cargo_temp_c": F.max(cargo),
        "active_readings": F.count_if(~F.coalesce(F.col(status).isin(*inactive), F.lit(False))),
    }, period_col)
    return (agg.withColumn("km_driven", F.col("_max_odo") - F.col("_min_odo"))
               .withColumn("utilization_pct",
                           F.round(F.col("active_readings") / F.col("readings_count"), 2))
               .withColumn("period_date", F.to_date(F.col(period_col)))
               .drop("_min_odo", "_max_odo"))


def high_water(df: DataFrame, expr: Column | str, name: str = "high_water") -> DataFrame:
    """One-row frame with ``max(expr)`` (Parquet min/max stats can answer a
    plain column max without reading pages)."""
    e = F.col(expr) if isinstance(expr, str) else expr
    return df.agg(F.max(e).alias(name))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for each frame, one union."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def milestone_pivot(df: DataFrame, key: Sequence[str] | str, status_col: str, ts_col: str,
                    statuses: Sequence[str], carry_cols: Sequence[str] = (),
                    order: Sequence[str] | None = None, suffix: str = "_ts",
                    current_col: str = "current_status") -> DataFrame:
    """One row per key: for each status the ``ts_col`` of its last
    occurrence (``<status>_ts``), the latest non-NULL value of every carry
    column, and the latest status.

    Equivalent to ``last(c, ignorenulls)`` over the whole ordered
    partition followed by a per-key dedupe, but planned as one aggregate:
    ``max_by(c, order) FILTER (c IS NOT NULL)`` is partially aggregated on
    the map side, so no partition is sorted and a hot key is pre-reduced.
    ``order`` defaults to ``[ts_col]``; make it unique within a key for a
    deterministic result.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ordc = F.struct(*[F.col(c) for c in (list(order) if order else [ts_col])])
    aggs = []
    for s in statuses:
        hit = F.col(status_col) == F.lit(s)
        aggs.append(F.max_by(F.col(ts_col), F.when(hit & F.col(ts_col).isNotNull(), ordc))
                    .alias(f"{s}{suffix}"))
    for c in carry_cols:
        aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordc)).alias(c))
    if current_col:
        aggs.append(F.max_by(F.col(status_col), F.when(F.col(status_col).isNotNull(), ordc))
                    .alias(current_col))
    return df.groupBy(*keys).agg(*aggs)


def status_timestamps(df: DataFrame, status_col: str, ts_col: str, statuses: Sequence[str],
                      suffix: str = "_ts") -> DataFrame:
    """One column per status holding ``ts_col`` where the row has it."""
    return df.withColumns({f"{s}{suffix}": F.when(F.col(status_col) == F.lit(s), F.col(ts_col))
                           for s in statuses})


def union_distinct(df: DataFrame, cols: Sequence[str], out: str | None = None) -> DataFrame:
    """Set union of several columns of one frame, in one scan:
    ``explode(array(a, b, ...))`` then a distinct."""
    out = out or cols[0]
    return (df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias(out))
              .dropDuplicates())


def key_share(df: DataFrame, key: str, top: int, count_col: str = "rows",
              share_col: str = "share", digits: int = 4) -> DataFrame:
    """Top-``top`` keys by row count and their share of all rows.

    The total is a scalar subquery, so no cross join and nothing but the
    final ``top`` rows reaches the driver.
    """
    total = df.select(F.count(F.lit(1))).scalar()
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
    return (counts.orderBy(F.col(count_col).desc(), F.col(key).asc()).limit(top)
                  .withColumn(share_col, F.round(F.col(count_col) / total, digits)))
