"""Dimension, fact and silver-load builders composed from the operators.

Column names default to the freight mart's names and are parameters, so
the same builders serve any source with the same shape.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.dates import date_key
from lakemart.functions.keys import normalize_expr, surrogate_key
from lakemart.operators.cleanse import (enforce_schema, enrich_telemetry, live_rows,
                                        normalize_telemetry, require_keys, require_non_blank)
from lakemart.operators.dedupe import dedupe
from lakemart.session import cut_lineage
from lakemart.sinks.tables import publish, table_exists
from lakemart.operators.joins import as_of_join, bounded_broadcast, lookup_key, touched_history
from lakemart.operators.rollup import hourly_rollup, milestone_pivot, union_distinct
from lakemart.operators.scd import START, scd1_apply

# --- fixed values: static location lookup (city, realm_name, realm_code, region, language_region)
LOCATION_LOOKUP_ROWS = [
    ("Minas Tirith", "Gondor", "GO", "Gondor", "Westron"),
    ("Osgiliath", "Gondor", "GO", "Gondor", "Westron"),
    ("Pelargir", "Gondor", "GO", "Gondor", "Westron"),
    ("Dol Amroth", "Gondor", "GO", "Gondor", "Westron/Sindarin"),
    ("Edoras", "Rohan", "RO", "Rohan", "Rohirric"),
    ("Helm's Deep", "Rohan", "RO", "Rohan", "Rohirric"),
    ("Aldburg", "Rohan", "RO", "Rohan", "Rohirric"),
    ("Dunharrow", "Rohan", "RO", "Rohan", "Rohirric"),
    ("Isengard", "Isengard", "IS", "Rohan", "Westron"),
    ("Hobbiton", "The Shire", "SH", "Eriador", "Westron"),
    ("Bywater", "The Shire", "SH", "Eriador", "Westron"),
    ("Michel Delving", "The Shire", "SH", "Eriador", "Westron"),
    ("Tuckborough", "The Shire", "SH", "Eriador", "Westron"),
    ("Bree", "Bree-land", "BR", "Eriador", "Westron"),
    ("Combe", "Bree-land", "BR", "Eriador", "Westron"),
    ("Archet", "Bree-land", "BR", "Eriador", "Westron"),
    ("Rivendell", "Rivendell", "RV", "Eriador", "Sindarin"),
    ("Grey Havens", "Lindon", "LI", "Eriador", "Sindarin"),
    ("Fornost", "Arnor", "AR", "Eriador", "Westron"),
    ("Annúminas", "Arnor", "AR", "Eriador", "Westron"),
    ("Tharbad", "Enedwaith", "EN", "Enedwaith", "Westron"),
    ("Esgaroth", "Dale", "DA", "Rhovanion", "Westron"),
    ("Dale", "Dale", "DA", "Rhovanion", "Westron"),
    ("Erebor", "Erebor", "ER", "Rhovanion", "Khuzdul"),
    ("Caras Galadhon", "Lothlórien", "LO", "Rhovanion", "Sindarin"),
    ("Thranduil's Halls", "Woodland Realm", "WR", "Rhovanion", "Sindarin"),
]
# Order lifecycle statuses pivoted into milestone timestamps.
ORDER_STATUSES = ["picked_up", "created", "out_for_delivery", "delivered", "failed_delivery",
                  "in_transit", "returned", "confirmed"]
# Member that collects cities missing from the lookup.
UNKNOWN_CITY = "unknown"
# Delivery within this many days counts as on time.
ON_TIME_DAYS = 30
# -------------------------------------------------------------------------------------------

LOCATION_LOOKUP_SCHEMA = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("realm_name", T.StringType()),
    T.StructField("realm_code", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("language_region", T.StringType()),
])


def location_lookup(spark: SparkSession) -> DataFrame:
    """The static city lookup."""
    return spark.createDataFrame(LOCATION_LOOKUP_ROWS, LOCATION_LOOKUP_SCHEMA)


# ---------------------------------------------------------------- dimensions

def build_dim_scd2(silver: DataFrame, sk: str, key: str, start: str = START,
                   delete_flag: str = "_is_delete") -> DataFrame:
    """SCD2 dimension: live versions, ``sk = md5(key|start)`` first (G1)."""
    return surrogate_key(live_rows(silver, delete_flag), sk, [key, start])


def build_dim_scd1(silver: DataFrame, sk: str, key: str) -> DataFrame:
    """SCD1 dimension: ``sk = md5(key)`` first."""
    return surrogate_key(silver, sk, [key])


def build_dim_location(pairs: DataFrame, origin: str, destination: str, lookup: DataFrame,
                       lookup_city: str = "city", sk: str = "location_sk",
                       unknown: str = UNKNOWN_CITY) -> DataFrame:
    """Distinct cities of both roles, enriched from the lookup by
    normalised name; cities absent from the lookup collapse into one
    ``unknown`` member (G3).

    Pairs with a blank city in either role contribute neither city.  The
    lookup is broadcast behind a row-count bound; the city set is a
    distinct, so the join input is already small.
    """
    cities = union_distinct(require_non_blank(pairs.select(origin, destination), [origin, destination]),
                            [origin, destination], out="_city")
    lk_cols = [c for c in lookup.columns]
    lk = bounded_broadcast(lookup.withColumn("_nrm", normalize_expr(lookup_city)))
    j = (cities.withColumn("_nrm", normalize_expr("_city"))
               .join(lk, "_nrm", "left"))
    out = j.select(F.coalesce(F.col(lookup_city), F.lit(unknown)).alias(lookup_city),
                   *[F.col(c) for c in lk_cols if c != lookup_city]).dropDuplicates()
    return surrogate_key(out, sk, [lookup_city])


def calendar(df_bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Calendar rows (G4) for each day in ``[lo, hi]`` of a one-row frame:
    date_key, full_date, year, month, month_name, iso_week, day_of_week
    (1 = Sunday), is_weekend.  Row count = number of days, so the frame
    has a static size bound."""
    days = df_bounds.select(F.explode(F.sequence(F.to_date(F.col(lo)), F.to_date(F.col(hi))))
                            .alias("full_date"))
    d = F.col("full_date")
    return days.select(date_key(d).alias("date_key"), d,
                       F.year(d).alias("year"), F.month(d).alias("month"),
                       F.date_format(d, "MMMM").alias("month_name"),
                       F.weekofyear(d).alias("iso_week"),
                       F.dayofweek(d).alias("day_of_week"),
                       F.dayofweek(d).isin(1, 7).alias("is_weekend"))


def build_dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    b = spark.range(1).select(F.lit(start).cast("date").alias("lo"), F.lit(end).cast("date").alias("hi"))
    return calendar(b)


def calendar_for(df: DataFrame, *ts_cols: str) -> DataFrame:
    """Calendar spanning the dates of ``ts_cols`` in ``df`` (bounds by one
    aggregate; incremental runs start from the dimension's high-water)."""
    lo = F.least(*[F.min(c) for c in ts_cols]) if len(ts_cols) > 1 else F.min(ts_cols[0])
    hi = F.greatest(*[F.max(c) for c in ts_cols]) if len(ts_cols) > 1 else F.max(ts_cols[0])
    return calendar(df.agg(lo.alias("lo"), hi.alias("hi")))


def continue_dim_date(spark: SparkSession, path: str, span: DataFrame) -> None:
    """Append the calendar days of ``span`` (one row: ``lo``, ``hi``) after the
    dimension's last date; the first run writes them all.  Days before the
    first date that is stored are added too, so no fact is without a date."""
    if not table_exists(spark, path):
        publish(calendar(span.filter("lo IS NOT NULL AND hi IS NOT NULL")), path, "replace")
        return
    first, last = spark.read.parquet(path).agg(F.min("full_date"), F.max("full_date")).first()
    new = span.filter("lo IS NOT NULL AND hi IS NOT NULL").select(F.explode(F.array(
        F.struct(F.col("lo"), F.least(F.col("hi"), F.date_sub(F.lit(first), 1)).alias("hi")),
        F.struct(F.greatest(F.col("lo"), F.date_add(F.lit(last), 1)).alias("lo"), F.col("hi")))).alias("s")) \
        .select("s.lo", "s.hi").filter("lo <= hi")
    publish(calendar(cut_lineage(new, "days")), path, "append")


# ---------------------------------------------------------------- silver loads

# --- fixed values: column names and types of the vehicle table ----------------------
VEHICLE_SCHEMA = T.StructType([
    T.StructField("capacity_kg", T.IntegerType()),
    T.StructField("cold_chain_capable", T.BooleanType()),
    T.StructField("commissioned_date", T.DateType()),
    T.StructField("home_depot", T.StringType()),
    T.StructField("last_updated", T.TimestampType()),
    T.StructField("model", T.StringType()),
    T.StructField("plate_number", T.StringType()),
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("vehicle_type", T.StringType()),
])
# -----------------------------------------------------------------------------------


def silver_scd1(bronze: DataFrame, key: str, seq: str, schema: T.StructType,
                target: DataFrame | None = None, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Typed current-state table (G8): key filter, schema enforcement
    (cast *before* ordering, so the order is by value, not by text), latest
    row per key, sequence-guarded merge into ``target``."""
    typed = enforce_schema(require_keys(bronze, [key]), schema)
    return scd1_apply(target, typed, [key], seq, tiebreak=tiebreak)


def silver_events(bronze: DataFrame, key: str, ts: str, schema: T.StructType,
                  tiebreak: Sequence[str] = (), date_col: str | None = "event_date") -> DataFrame:
    """Typed event table (G9): earliest delivery per event id wins
    (NULL timestamps never win), plus the event date."""
    typed = enforce_schema(require_keys(bronze, [key]), schema)
    first = dedupe(typed, [key], ts, desc=False, tiebreak=tiebreak)
    return first.withColumn(date_col, F.to_date(F.col(ts))) if date_col else first


def silver_telemetry(bronze: DataFrame, key: str = "reading_id", ts: str = "reading_timestamp",
                     tiebreak: Sequence[str] = ()) -> DataFrame:
    """Telemetry (G10): earliest reading per id, cleansing, flags."""
    first = dedupe(require_keys(bronze, [key]), [key], ts, desc=False, tiebreak=tiebreak)
    return first.transform(normalize_telemetry, key).transform(enrich_telemetry)


# ---------------------------------------------------------------- facts

def build_fact_telemetry(silver: DataFrame, dim_vehicle: DataFrame, dim_date: DataFrame,
                         key: str = "vehicle_id", vehicle_sk: str = "vehicle_sk",
                         dim_rows: int | None = None, **rollup_cols) -> DataFrame:
    """Vehicle x hour fact (G7): the rollup first (one row per vehicle-hour,
    so the skewed raw readings are pre-aggregated before any join), then
    the vehicle and date lookups."""
    agg = hourly_rollup(silver, key=key, **rollup_cols)
    period = rollup_cols.get("period_col", "period_start_timestamp")
    f = lookup_key(agg, dim_vehicle, key, key, {vehicle_sk: vehicle_sk}, dim_rows=dim_rows)
    f = lookup_key(f, dim_date, "period_date", "full_date", {"date_key": "date_key"})
    rest = [c for c in agg.columns if c not in (key, period)]
    return f.select(key, period, vehicle_sk, "date_key", *rest)


def build_fact_event(silver: DataFrame, dim_vehicle: DataFrame, dim_date: DataFrame,
                     event_id: str = "event_id", key: str = "vehicle_id",
                     vehicle_sk: str = "vehicle_sk", date_col: str = "event_date",
                     dim_rows: int | None = None) -> DataFrame:
    """One row per event (G6) with the vehicle key and the date key."""
    f = lookup_key(silver, dim_vehicle, key, key, {vehicle_sk: vehicle_sk}, dim_rows=dim_rows)
    f = lookup_key(f, dim_date, date_col, "full_date", {"date_key": "date_key"})
    rest = [c for c in silver.columns if c != event_id]
    return f.select(event_id, vehicle_sk, "date_key", *rest)


def build_fact_order(history: DataFrame, key: str, status_col: str, time_col: str,
                     statuses: Sequence[str], carry_cols: Sequence[str],
                     customer_dim: DataFrame, customer_key: str, customer_sk: str,
                     asof_col: str, date_dim: DataFrame, date_roles: Mapping[str, Column | str],
                     order_date: str, delivery_date: Column | str,
                     header: DataFrame | None = None,
                     lookups: Sequence[tuple] = (),
                     touched: DataFrame | None = None, order: Sequence[str] | None = None,
                     dim_end: str | None = None, on_time_days: int = ON_TIME_DAYS,
                     unknown: Mapping[str, str] | None = None) -> DataFrame:
    """Order fulfilment fact (G5), one row per order.

    1. touched orders' full history (semi join) -- incremental runs;
    2. milestone pivot: last instant of each status, latest non-NULL carry
       columns and current status (one aggregate, no window); optionally
       joined onto a ``header`` frame with one row per order;
    3. as-of join to the SCD2 customer dimension at ``asof_col``;
    4. role-playing lookups -- ``lookups`` is a list of
       ``(dim, fact_col, dim_col, {new_name: dim_col})`` (e.g. origin and
       destination city) -- and one date lookup per ``date_roles`` entry;
       each dimension broadcast behind a size bound; ``unknown`` maps looked-up
       columns to the key of an unknown member for rows without a match
       (default: they stay NULL);
    5. ``delivery_days`` and ``is_on_time`` (false when undelivered).
    """
    h = history if touched is None else touched_history(history, touched, [key])
    f = milestone_pivot(h, key, status_col, time_col, statuses,
                        carry_cols=list(carry_cols), order=order)
    if header is not None:
        src = header if touched is None else touched_history(header, touched, [key])
        f = src.join(f, key, "left")
    f = as_of_join(f, customer_dim, [customer_key], asof_col, START, [customer_sk],
                   dim_end=dim_end)
    for dim, fact_col, dim_col, take in lookups:
        f = lookup_key(f, dim, fact_col, dim_col, take)
    for name, member in (unknown or {}).items():
        f = f.withColumn(name, F.coalesce(F.col(name), F.lit(member)))
    # one size check for the calendar, shared by every date role
    cal_rows = date_dim.count() if date_roles else 0
    for out, expr in date_roles.items():
        e = F.col(expr) if isinstance(expr, str) else expr
        f = lookup_key(f, date_dim, F.to_date(e), "full_date", {out: "date_key"}, dim_rows=cal_rows)
    dd = F.col(delivery_date) if isinstance(delivery_date, str) else delivery_date
    days = F.datediff(dd, F.col(order_date))
    return (f.withColumn("delivery_days", days)
             .withColumn("is_on_time", F.coalesce(days <= F.lit(on_time_days), F.lit(False))))
