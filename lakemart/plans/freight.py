"""The freight mart's jobs: bronze ingest, silver loads, gold dimensions and
facts, erasure -- each a function over Parquet tables under one root.

Layout: ``{root}/bronze/<feed>``, ``{root}/silver/<table>``,
``{root}/gold/<table>``, checkpoints under ``{root}/_checkpoints``.  Silver
and gold tables are hash-bucketed on their key; incremental runs rewrite
only the buckets a batch touches (:func:`lakemart.sinks.merge_into`).
Task order is the reference's: silver {vehicles, events, telemetry,
customers, orders} -> dims {customer, vehicle, location, date} -> facts
{order, shipment event, telemetry} -> erasure.
"""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.dates import truncate
from lakemart.functions.keys import surrogate_key
from lakemart.operators.cdc import snapshot_diff
from lakemart.operators.cleanse import enforce_schema, require_keys, stamp
from lakemart.operators.erase import erased_keys
from lakemart.operators.merge import delete_matching, upsert
from lakemart.operators.scd import scd1_apply, scd2_apply
from lakemart.plans import marts
from lakemart.session import cut_lineage
from lakemart.sinks.tables import load, merge_into, publish, table_exists, write_bucketed
from lakemart.sources.files import read_window
from lakemart.sources.schema import load_schema
from lakemart.streaming.ingest import apply_stream, ingest_on_arrival, read_arrived, stream_table

BUCKETS = None                  # follows each table's size (lakemart.sinks.buckets_for)
# Bronze feeds are partitioned by ingest date; windowed silver reads prune by it.
INGEST_DATE = "_ingest_date"

# --- source schemas (fixed values: column names and types of the feeds) -----
ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("customer_id", T.IntegerType()),
    T.StructField("product_code", T.StringType()), T.StructField("product_name", T.StringType()),
    T.StructField("quantity", T.IntegerType()), T.StructField("total_amount", T.DoubleType()),
    T.StructField("status", T.StringType()), T.StructField("payment_method", T.StringType()),
    T.StructField("order_date", T.TimestampType()), T.StructField("delivery_date", T.TimestampType()),
    T.StructField("origin_city", T.StringType()), T.StructField("destination_city", T.StringType()),
    T.StructField("_change_type", T.StringType()), T.StructField("_change_ts", T.TimestampType())])
EVENTS = T.StructType([
    T.StructField("event_id", T.StringType()), T.StructField("order_id", T.StringType()),
    T.StructField("vehicle_id", T.StringType()), T.StructField("event_type", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()), T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()), T.StructField("shipment_status", T.StringType()),
    T.StructField("temperature_celsius", T.DoubleType()), T.StructField("source_system", T.StringType())])
TELEMETRY = T.StructType([
    T.StructField("reading_id", T.StringType()), T.StructField("vehicle_id", T.StringType()),
    T.StructField("reading_timestamp", T.TimestampType()), T.StructField("speed_kmh", T.DoubleType()),
    T.StructField("fuel_pct", T.DoubleType()), T.StructField("engine_temp_c", T.DoubleType()),
    T.StructField("cargo_temp_c", T.DoubleType()), T.StructField("odometer_km", T.IntegerType()),
    T.StructField("vehicle_status", T.StringType())])
VEHICLES = marts.VEHICLE_SCHEMA
CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.IntegerType()), T.StructField("company_name", T.StringType()),
    T.StructField("contact_email", T.StringType()), T.StructField("address", T.StringType()),
    T.StructField("city", T.StringType()), T.StructField("postal_code", T.StringType()),
    T.StructField("tier", T.StringType()), T.StructField("industry", T.StringType()),
    T.StructField("signup_date", T.TimestampType()), T.StructField("last_updated", T.TimestampType())])
# Types of the silver tables where they differ from the feeds'.
CUSTOMER_TYPES = {"postal_code": T.IntegerType(), "signup_date": T.DateType()}
ORDER_TYPES = {"order_date": T.DateType(), "delivery_date": T.DateType()}
CUSTOMER_ATTRS = ["company_name", "contact_email", "address", "city", "postal_code", "tier", "industry",
                  "signup_date"]
ORDER_ATTRS = ["customer_id", "product_code", "product_name", "quantity", "total_amount", "status",
               "payment_method", "order_date", "delivery_date", "origin_city", "destination_city"]
FEEDS = {"orders": ORDERS, "shipment_events": EVENTS, "telemetry": TELEMETRY, "vehicles": VEHICLES}
# ------------------------------------------------------------------------------


def _p(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def _read(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.drop("_bucket") if "_bucket" in df.columns else df


def _bronze(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """A bronze feed; files written before a schema grew give NULL in the
    columns they lack."""
    store = _p(root, "_schemas", feed)
    path = _p(root, "bronze", feed)
    df = read_arrived(spark, path, store, INGEST_DATE) if load_schema(spark, store) else _read(spark, path)
    return df.drop("batch")


def silver_types(df: DataFrame, types: dict) -> DataFrame:
    """Cast the columns of ``types``; values that do not fit become NULL."""
    want = T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in df.schema.fields])
    return enforce_schema(df, want)


# ------------------------------------------------------------------ bronze

def ingest_feed(spark: SparkSession, root: str, landing: str, feed: str, schema: T.StructType,
                evolve: bool = False) -> str:
    """New JSON files of a landing folder -> append to ``bronze/<feed>``
    (typed columns, ``_rescued_data``, ``_corrupt_record``, ``_source_file``,
    ``_ingested_at``); exactly once through the stream checkpoint.  With
    ``evolve`` the feed's schema is stored and gains the fields that new files
    bring (returned as the drift action, e.g. for the health audit)."""
    actions = ingest_on_arrival(spark, landing, _p(root, "bronze", feed), _p(root, "_schemas", feed), schema,
                                _p(root, "_checkpoints", "bronze", feed), ingest_date_col=INGEST_DATE, grow=evolve)
    return "; ".join(actions) or "none"


def ingest_customer_snapshot(spark: SparkSession, root: str, snapshot: DataFrame, version: int) -> None:
    """Append the change rows turning the previous customer snapshot into
    ``snapshot`` to ``bronze/customers_changes`` and keep the snapshot."""
    snap_path = _p(root, "bronze", "customers_snapshot")
    feed = _p(root, "bronze", "customers_changes")
    # a version that an interrupted run has appended already is not appended again
    done = table_exists(spark, feed) and not _read(spark, feed).filter(F.col("_commit_version") >= version).isEmpty()
    snapshot = cut_lineage(snapshot, "snapshot")
    if not done:
        prev = _read(spark, snap_path) if table_exists(spark, snap_path) else \
            spark.createDataFrame([], snapshot.schema)
        changes = snapshot_diff(prev, snapshot, ["customer_id"], version) \
            .withColumn("_commit_timestamp", F.current_timestamp())
        publish(changes, feed, "append")
    publish(snapshot, snap_path, "replace")


# --- fixed values: per-feed bad-record rules, keys and lateness -------------------
def feed_rules(feed: str) -> dict:
    """Bad-record rules per feed (a row breaking any rule counts as bad)."""
    c = F.col
    return {
        "orders": {"missing_amount": c("total_amount").isNull(), "negative_amount": c("total_amount") < 0,
                   "blank_city": (F.trim(c("origin_city")) == "") | (F.trim(c("destination_city")) == "")},
        "shipment_events": {"null_vehicle": c("vehicle_id").isNull(),
                            "bad_temperature": c("temperature_celsius") == 999},
        "telemetry": {"bad_speed": c("speed_kmh") >= 300},
        "vehicles": {},
    }[feed]


FEED_KEYS = {"orders": ["order_id", "_change_ts"], "shipment_events": ["event_id"],
             "telemetry": ["reading_id"], "vehicles": ["vehicle_id", "last_updated"]}
FEED_EVENT_TIME = {"shipment_events": "event_timestamp", "telemetry": "reading_timestamp"}
LATE_DAYS = 3
# -----------------------------------------------------------------------------------


def audit_batch(spark: SparkSession, root: str, feed: str, batch_id: str, since, drift_action: str = "none",
                base: T.StructType | None = None) -> DataFrame:
    """Append one audit row for the bronze rows of ``feed`` ingested at or
    after ``since``: rows, bad records, duplicates, late records, drift
    action, active extra columns and the classification.  Returns it."""
    from lakemart.operators.audit import health_audit, late_rows
    bronze = _bronze(spark, root, feed).filter(
        F.col("_ingested_at") >= F.lit(since).cast("timestamp"))
    run_ts = bronze.select(F.max("_ingested_at")).scalar()
    late = None
    if feed in FEED_EVENT_TIME:
        # late = older than the batch's newest event by more than LATE_DAYS
        # (event time, so replays of old data are judged the same way)
        et = FEED_EVENT_TIME[feed]
        late = late_rows(bronze, et, bronze.select(F.max(et)).scalar(), LATE_DAYS)
    stored = load_schema(spark, _p(root, "_schemas", feed))
    base_names = set((base or FEEDS[feed]).fieldNames())
    extra = [f for f in (stored.fieldNames() if stored else []) if f not in base_names]
    row = (health_audit(bronze, F.lit(feed), FEED_KEYS[feed], feed_rules(feed), late,
                        drift=F.lit(drift_action))
           .select(F.lit(batch_id).alias("batch_id"), run_ts.alias("run_ts"), "source",
                   F.col("rows_added").cast("int").alias("rows_added"),
                   F.col("bad_records").cast("int").alias("bad_records"),
                   F.col("duplicates").cast("int").alias("duplicates"),
                   F.col("late_records").cast("int").alias("late_records"),
                   "drift_action", F.lit(",".join(extra)).alias("active_extra_columns"),
                   "classification"))
    out = cut_lineage(row, "audit-row")
    publish(out, _p(root, "audit"), "append")
    return out


# ------------------------------------------------------------------ silver

def silver_vehicles(spark: SparkSession, root: str, start, end) -> None:
    bronze = read_window(_bronze(spark, root, "vehicles"), "_ingested_at", start, end,
                         partition_col=INGEST_DATE)
    out = stamp(marts.silver_scd1(bronze, "vehicle_id", "last_updated", VEHICLES))
    path = _p(root, "silver", "vehicles")
    # sequence-guarded: an older vehicle record never overwrites a newer one
    load(spark, out, path, ["vehicle_id"], BUCKETS, initial=not table_exists(spark, path),
         how=lambda t, s, k: scd1_apply(t, s, k, "last_updated"))


def silver_shipment_events(spark: SparkSession, root: str, start, end) -> None:
    bronze = read_window(_bronze(spark, root, "shipment_events"), "_ingested_at", start, end,
                         partition_col=INGEST_DATE)
    out = stamp(marts.silver_events(bronze, "event_id", "event_timestamp", EVENTS,
                                    tiebreak=["source_system"]))
    path = _p(root, "silver", "shipment_events")
    # first delivery wins across batches too (a re-delivered id never replaces it)
    load(spark, out, path, ["event_id"], BUCKETS, initial=not table_exists(spark, path),
         how=lambda t, s, k: scd1_apply(t, s, k, "event_timestamp", desc=False))


def silver_telemetry(spark: SparkSession, root: str, start, end) -> None:
    bronze = read_window(_bronze(spark, root, "telemetry"), "_ingested_at", start, end,
                         partition_col=INGEST_DATE)
    out = stamp(marts.silver_telemetry(bronze))
    path = _p(root, "silver", "telemetry")
    load(spark, out, path, ["reading_id"], BUCKETS, initial=not table_exists(spark, path),
         how=lambda t, s, k: scd1_apply(t, s, k, "reading_timestamp", desc=False))


def _scd2_stream(spark: SparkSession, root: str, src: str, dst: str, keys, seq, attrs,
                 prefilter=None, **kw) -> None:
    """Stream a bronze change table into an SCD2 silver table with
    ``foreachBatch``; each micro-batch rebuilds the touched keys' timelines
    inside the buckets it touches (idempotent on replay)."""
    src_path, path = _p(root, "bronze", src), _p(root, "silver", dst)
    schema = spark.read.parquet(src_path).schema

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("_process_ts", F.current_timestamp())
        if not table_exists(spark, path):
            write_bucketed(scd2_apply(None, batch, keys, seq, attrs, **kw), path, keys, BUCKETS)
        else:
            merge_into(spark, path, batch, keys, BUCKETS,
                       how=lambda t, s, k: scd2_apply(t, s, k, seq, attrs, **kw))

    stream = stream_table(spark, src_path, schema).drop("batch")
    if prefilter is not None:
        stream = prefilter(stream)
    apply_stream(stream, apply, _p(root, "_checkpoints", "silver", dst))


def silver_customers(spark: SparkSession, root: str) -> None:
    _scd2_stream(spark, root, "customers_changes", "customers", ["customer_id"], "_commit_version",
                 CUSTOMER_ATTRS, prefilter=lambda df: silver_types(df, CUSTOMER_TYPES), start="last_updated", change_col="_change_type",
                 stamp_col="_insert_update_ts")


def silver_orders(spark: SparkSession, root: str) -> None:
    # rows without an order id never reach silver
    _scd2_stream(spark, root, "orders", "orders", ["order_id"], "_change_ts", ORDER_ATTRS,
                 prefilter=lambda df: silver_types(require_keys(df, ["order_id"]), ORDER_TYPES), tiebreak=["status"],
                 stamp_col="_insert_update_ts")


def silver_location_lookup(spark: SparkSession, root: str) -> None:
    publish(marts.location_lookup(spark), _p(root, "silver", "location_lookup"), "replace")


# ------------------------------------------------------------------ gold

def gold_dimensions(spark: SparkSession, root: str, start: str | None = None, end: str | None = None,
                    touched_since=None) -> None:
    """Customer and vehicle dimensions are upserted by surrogate key from
    the silver rows stamped since ``touched_since`` (all rows on the first
    run) -- an SCD2 rebuild re-stamps the versions whose interval changed,
    so closed versions are refreshed too.  The location dimension is small
    and rebuilt; the calendar continues from its last date."""
    s = lambda n: _read(spark, _p(root, "silver", n))

    def window(df: DataFrame, first: bool) -> DataFrame:
        if touched_since is None or first:
            return df
        return df.filter(F.col("_insert_update_ts") >= F.lit(touched_since).cast("timestamp"))

    for name, src, sk, key, build in (
            ("dim_customer", "customers", "customer_sk", "customer_id", marts.build_dim_scd2),
            ("dim_vehicle", "vehicles", "vehicle_sk", "vehicle_id", marts.build_dim_scd1)):
        path = _p(root, "gold", name)
        first = not table_exists(spark, path)
        rows = stamp(build(window(s(src), first).drop("_insert_update_ts"), sk, key))
        load(spark, rows, path, [sk], BUCKETS, initial=first)
    publish(stamp(marts.build_dim_location(s("orders"), "origin_city", "destination_city",
                                           s("location_lookup"))),
            _p(root, "gold", "dim_location"), "replace")
    extend_dim_date(spark, root, start, end)


def extend_dim_date(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> None:
    """Continue the date dimension from its high-water mark (``max(full_date)``)
    to ``end``, or to the last date the silver tables mention; the first run
    begins at ``start``, or at their first date."""
    path = _p(root, "gold", "dim_date")
    spans = []
    for name, cols in (("orders", ["order_date", "delivery_date", "start_at"]),
                       ("shipment_events", ["event_timestamp"]), ("telemetry", ["reading_timestamp"])):
        src = _p(root, "silver", name)
        if table_exists(spark, src):
            t = _read(spark, src)
            spans += [t.agg(F.min(F.to_date(c)).alias("lo"), F.max(F.to_date(c)).alias("hi")) for c in cols]
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    if spans:
        whole = spans[0]
        for x in spans[1:]:
            whole = whole.union(x)
        whole = whole.agg(F.coalesce(F.least(lo, F.min("lo")), F.min("lo"), lo).alias("lo"),
                          F.greatest(hi, F.max("hi")).alias("hi"))
    else:
        whole = spark.range(1).select(lo.alias("lo"), hi.alias("hi"))
    marts.continue_dim_date(spark, path, whole)


def gold_fact_order(spark: SparkSession, root: str, touched_since=None) -> None:
    """Order fulfilment fact; with ``touched_since`` only orders with a
    silver change at or after it are recomputed and merged."""
    g = lambda n: _read(spark, _p(root, "gold", n))
    hist = _read(spark, _p(root, "silver", "orders"))
    path = _p(root, "gold", "fact_order_fulfillment")
    first = not table_exists(spark, path)
    touched = None
    if touched_since is not None and not first:
        touched = hist.filter(F.col("_insert_update_ts") >= F.lit(touched_since).cast("timestamp"))
    carry = [c for c in ORDER_ATTRS if c != "status"] + ["start_at"]
    f = marts.build_fact_order(
        history=hist, key="order_id", status_col="status", time_col="start_at",
        statuses=marts.ORDER_STATUSES, carry_cols=carry, order=["start_at", "_change_ts"],
        customer_dim=g("dim_customer"), customer_key="customer_id", customer_sk="customer_sk",
        asof_col="start_at", date_dim=g("dim_date"),
        date_roles={"order_date_key": "order_date", "delivery_date_key": "delivered_ts"},
        order_date="order_date", delivery_date="delivery_date",
        lookups=[(g("dim_location"), "origin_city", "city", {"orig_location_sk": "location_sk"}),
                 (g("dim_location"), "destination_city", "city", {"dest_location_sk": "location_sk"})],
        touched=touched)
    out = f.select("order_id", "customer_sk", "orig_location_sk", "dest_location_sk", "order_date_key",
                   "delivery_date_key", "product_code", "product_name", "quantity", "total_amount",
                   "payment_method", F.col("current_status"), "created_ts", "confirmed_ts", "picked_up_ts",
                   "in_transit_ts", "out_for_delivery_ts", "delivered_ts", "failed_delivery_ts",
                   "returned_ts", "order_date", "delivery_date", "delivery_days", "is_on_time")
    load(spark, out, path, ["order_id"], BUCKETS, initial=first)


def gold_fact_shipment_event(spark: SparkSession, root: str, touched_since=None) -> None:
    """Shipment event fact; with ``touched_since`` only events stamped at or
    after it are read and merged (all on the first run)."""
    g = lambda n: _read(spark, _p(root, "gold", n))
    path = _p(root, "gold", "fact_shipment_event")
    first = not table_exists(spark, path)
    ev = _read(spark, _p(root, "silver", "shipment_events"))
    if touched_since is not None and not first:
        ev = ev.filter(F.col("_insert_update_ts") >= F.lit(touched_since).cast("timestamp"))
    out = marts.build_fact_event(ev.drop("_insert_update_ts"), g("dim_vehicle"), g("dim_date"))
    load(spark, out, path, ["event_id"], BUCKETS, initial=first)


def gold_fact_telemetry(spark: SparkSession, root: str, touched_since=None) -> None:
    """Vehicle x hour fact.  Incremental runs recompute every touched
    (vehicle, hour) from the *full* silver table, so a late reading never
    replaces an hour by a partial one."""
    g = lambda n: _read(spark, _p(root, "gold", n))
    silver = _read(spark, _p(root, "silver", "telemetry"))
    path = _p(root, "gold", "fact_vehicle_telemetry")
    first = not table_exists(spark, path)
    if touched_since is not None and not first:
        hours = (silver.filter(F.col("_insert_update_ts") >= F.lit(touched_since).cast("timestamp"))
                       .select(F.col("vehicle_id").alias("_v"),
                               truncate("hour", "reading_timestamp").alias("_h"))
                       .distinct())
        # hours of readings without a vehicle are refreshed too
        silver = silver.join(hours, F.col("vehicle_id").eqNullSafe(F.col("_v"))
                             & F.date_trunc("hour", F.col("reading_timestamp")).eqNullSafe(F.col("_h")),
                             "left_semi")
    out = marts.build_fact_telemetry(silver, g("dim_vehicle"), g("dim_date"))
    load(spark, out, path, ["vehicle_id", "period_start_timestamp"], BUCKETS, initial=first,
         how=partial(upsert, null_safe=True))


def gold_erase_customers(spark: SparkSession, root: str) -> int:
    """Remove deleted customers from the order fact and the customer
    dimension (every version; by surrogate key).  Without deletions nothing
    is read further or written; otherwise only the buckets that hold erased
    rows are rewritten.  Returns the number of buckets written."""
    silver = _read(spark, _p(root, "silver", "customers"))
    deleted = silver.filter(F.col("_is_delete")).select("customer_id").distinct()
    if deleted.isEmpty():
        return 0
    # every surrogate key ever issued for a customer (deleted versions are
    # already gone from the dimension, but facts may still carry their keys)
    issued = surrogate_key(silver.filter(F.col("start_at").isNotNull()), "customer_sk",
                           ["customer_id", "start_at"])
    keys = cut_lineage(erased_keys(issued, deleted, "customer_id", "customer_sk").distinct(), "erased")
    dim, fact = _p(root, "gold", "dim_customer"), _p(root, "gold", "fact_order_fulfillment")
    orders = _read(spark, fact).join(keys, "customer_sk", "left_semi").select("order_id")
    return (merge_into(spark, dim, _read(spark, dim).join(keys, "customer_sk", "left_semi").select("customer_sk"),
                       ["customer_sk"], how=delete_matching)
            + merge_into(spark, fact, orders, ["order_id"], how=delete_matching))


def run_all(spark: SparkSession, root: str, start: str, end: str, touched_since=None,
            calendar: tuple[str | None, str | None] = (None, None)) -> None:
    """Silver -> gold in the reference's task order (bronze is fed by the
    ingest functions)."""
    silver_vehicles(spark, root, start, end)
    silver_shipment_events(spark, root, start, end)
    silver_telemetry(spark, root, start, end)
    silver_customers(spark, root)
    silver_orders(spark, root)
    silver_location_lookup(spark, root)
    gold_dimensions(spark, root, *calendar, touched_since=touched_since)
    gold_fact_order(spark, root, touched_since)
    gold_fact_shipment_event(spark, root, touched_since)
    gold_fact_telemetry(spark, root, touched_since)
    gold_erase_customers(spark, root)


def today_window(days_back: int = 1, days_ahead: int = 1) -> tuple[str, str]:
    t = dt.date.today()
    return str(t - dt.timedelta(days=days_back)), str(t + dt.timedelta(days=days_ahead))



def main(argv=None) -> None:
    """Command line for scheduled runs (``spark-submit`` or ``python -m``):

    ``ingest --root R --feed orders --landing L [--evolve]`` (bronze);
    ``snapshot --root R --customers PATH --version N`` (customer changes);
    ``run --root R [--start D --end D] [--since TS]`` (silver and gold).
    The session comes from the platform; ``spark.checkpoint.dir`` must
    name shared storage."""
    import argparse

    from lakemart.session import configure

    ap = argparse.ArgumentParser(prog="lakemart.plans.freight")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("--root", required=True)
    a.add_argument("--feed", required=True, choices=sorted(FEEDS))
    a.add_argument("--landing", required=True)
    a.add_argument("--evolve", action="store_true")
    b = sub.add_parser("snapshot")
    b.add_argument("--root", required=True)
    b.add_argument("--customers", required=True)
    b.add_argument("--version", type=int, required=True)
    c = sub.add_parser("run")
    c.add_argument("--root", required=True)
    c.add_argument("--start")
    c.add_argument("--end")
    c.add_argument("--since")
    c.add_argument("--calendar", nargs=2, default=[None, None])
    args = ap.parse_args(argv)

    spark = configure(SparkSession.builder.getOrCreate())
    if args.cmd == "ingest":
        action = ingest_feed(spark, args.root, args.landing, args.feed, FEEDS[args.feed], evolve=args.evolve)
        print(f"{args.feed}: drift {action}")
    elif args.cmd == "snapshot":
        ingest_customer_snapshot(spark, args.root, spark.read.parquet(args.customers), args.version)
    else:
        d0, d1 = today_window()
        run_all(spark, args.root, args.start or d0, args.end or d1, touched_since=args.since,
                calendar=tuple(args.calendar))


if __name__ == "__main__":
    main()
