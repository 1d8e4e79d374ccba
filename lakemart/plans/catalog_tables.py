"""Queries over persisted tables, streams, freight jobs and sources, bound to
the driver tables, each with its DuckDB SQL (``SQL``)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.keys import surrogate_key
from lakemart.operators import audit, cdc, joins, merge, scd
from lakemart.plans import freight, marts
from lakemart.plans.catalog import (EVENT_SCHEMA_PROPS, ORDER_SCD_ATTRS, _customer_snapshots, _line_facts,
                                    order_changes, table, telemetry_bronze)
from lakemart.plans.oracle import _SNAP, _TELEMETRY_SILVER, _cal, _round
from lakemart.session import scratch_path
from lakemart.sinks.tables import load, merge_into, publish, table_exists, write_bucketed, write_json
from lakemart.sources.files import parse_json_rescued, read_change_feed, read_json_lines
from lakemart.sources.schema import evolve_stored_schema
from lakemart.streaming.ingest import (append_stream, first_deliveries, json_stream, merge_stream,
                                       rollup_stream, stream_table)

SQL: dict[str, str] = {}

# ----------------------------------------------------------------- streams


def _land_backwards(spark, ev, src, parts=4) -> None:
    """JSON drops of ``ev`` by days of the month, the last days first; each
    drop is written by as many tasks as its data has."""
    for i in range(parts):
        day = F.dayofmonth("ts")
        write_json(ev.filter((day > 31 - 8 * (i + 1)) & (day <= 31 - 8 * i)), f"{src}/drop={i}")


def q_stream_dedupe(spark, d):
    """Stream dedupe: four drops out of time order plus a drop of repeats in a
    second run on the same checkpoint; each event once."""
    ev = table(spark, d, "events")
    src, out, ck = (scratch_path(spark, "landing-dups"), scratch_path(spark, "bronze-dups"),
                    scratch_path(spark, "ckpt-dups"))

    def run():
        stream = spark.readStream.schema(EVENT_SCHEMA_PROPS).option("maxFilesPerTrigger", 1).json(f"{src}/*")
        first_deliveries(spark, stream, out, ["event_id"], "ts", ck)

    _land_backwards(spark, ev, src)
    run()
    write_json(ev.filter(F.col("event_type") == "purchase"), f"{src}/drop=9")
    run()
    return spark.read.parquet(out).select("event_id", "ts", "user_id", "event_type", "value", "props")


def q_stream_scd2(spark, d):
    """K2: SCD2 of orders applied with foreachBatch to a bucketed table, in
    merges that grow with the table; only the buckets they touch are rewritten."""
    ch = order_changes(spark, d)
    src, tgt, ck = (scratch_path(spark, "landing-orders"), scratch_path(spark, "scd2-orders"),
                    scratch_path(spark, "ckpt-scd2"))
    # three drops, arriving out of order
    for i, st in enumerate(["O", "F", "P"]):
        write_json(ch.filter(F.col("o_orderstatus") == st), f"{src}/drop={i}")

    def how(t, s, k):
        return scd.scd2_apply(t, s, k, "o_orderdate", ORDER_SCD_ATTRS, tiebreak=["o_orderkey"])

    def merge(changes):
        if table_exists(spark, tgt):
            merge_into(spark, tgt, changes, ["o_custkey"], how=how)
        else:
            write_bucketed(how(None, changes, ["o_custkey"]), tgt, ["o_custkey"])

    stream = spark.readStream.schema(ch.schema).option("maxFilesPerTrigger", 1).json(f"{src}/*")
    merge_stream(spark, stream, tgt, merge, ck)
    return spark.read.parquet(tgt).drop("_bucket")


def q_stream_rollup(spark, d):
    """Hourly rollup of the event feed as a stream: drops out of time order,
    the last of them in a second run on the same checkpoint."""
    ev = table(spark, d, "events")
    src, out, ck = (scratch_path(spark, "landing-roll"), scratch_path(spark, "roll"),
                    scratch_path(spark, "ckpt-roll"))
    late = F.col("event_type") == "error"

    def run():
        stream = spark.readStream.schema(EVENT_SCHEMA_PROPS).option("maxFilesPerTrigger", 2).json(f"{src}/*")
        rollup_stream(spark, stream, out, ["user_id"], "ts", "hour", {
            "events_count": F.count("event_id"),
            "max_value": F.max("value"),
            "min_value": F.min("value"),
            "value_sum": F.round(F.sum("value"), 4),
        }, ck)

    _land_backwards(spark, ev.filter(~late), src)
    run()
    write_json(ev.filter(late), f"{src}/drop=9")
    run()
    return spark.read.parquet(f"{out}/windows").select("user_id", "period_start", "events_count", "max_value",
                                                       "min_value", "value_sum")


def q_stream_table(spark, d):
    """Files of a table as a stream, two runs on one checkpoint; the second
    reads only what was appended (all other orders)."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    src, out, ck = (scratch_path(spark, n) for n in ("stream-src", "stream-out", "stream-ck"))
    finished = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    for part in (finished, ~finished):
        publish(o.filter(part), src, "append")
        append_stream(stream_table(spark, src, o.schema), out, ck)
    return spark.read.parquet(out)


SQL["q_stream_table"] = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"

# -------------------------------------------------------- persisted tables


def q_merge_upsert(spark, d):
    """M1 persisted: urgent orders repriced and low-priority ones re-keyed,
    merged into a bucketed table."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    path = scratch_path(spark, "merge-orders")
    write_bucketed(o, path, ["o_orderkey"], 32)
    changed = o.filter(F.col("o_orderpriority") == "1-URGENT").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    added = o.filter(F.col("o_orderpriority") == "5-LOW").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    merge_into(spark, path, changed.unionByName(added), ["o_orderkey"])
    return spark.read.parquet(path).drop("_bucket")


SQL["q_merge_upsert"] = """SELECT o_orderkey, o_custkey,
      CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_orderpriority
    FROM orders
    UNION ALL
    SELECT -o_orderkey - 1, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority = '5-LOW'"""


def q_merge_delete(spark, d):
    """M2 persisted: finished orders deleted from a table bucketed by status,
    which empties their bucket."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "merge-delete")
    write_bucketed(o, path, ["o_orderstatus"], 32)
    merge_into(spark, path, o.filter(F.col("o_orderstatus") == "F").select("o_orderstatus").distinct(),
               ["o_orderstatus"], how=merge.delete_matching)
    return spark.read.parquet(path).drop("_bucket")


SQL["q_merge_delete"] = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F'"


def q_delete_where(spark, d):
    """M3: orders of a set of priorities deleted by predicate; NULL keeps."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    o = o.withColumn("o_orderpriority", F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderpriority")))
    return merge.delete_where(o, F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))


SQL["q_delete_where"] = """SELECT o_orderkey, CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderpriority END AS o_orderpriority
    FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')"""


def q_replace_append(spark, d):
    """K3/K4: finished orders create a table, the table is replaced by its own
    rows with dearer ones marked, then all other orders are appended."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "replace-orders")
    finished = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    publish(o.filter(finished), path)
    publish(spark.read.parquet(path).withColumn("is_dear", F.col("o_totalprice") > 100_000), path)
    publish(o.filter(~finished).withColumn("is_dear", F.lit(None).cast("boolean")), path, "append")
    return spark.read.parquet(path)


SQL["q_replace_append"] = """SELECT o_orderkey, o_orderstatus, o_totalprice,
      CASE WHEN o_orderstatus = 'F' THEN o_totalprice > 100000 END AS is_dear FROM orders"""


def q_load_switch(spark, d):
    """K6: the first run loads all customers, the second merges one segment's change."""
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    path = scratch_path(spark, "load-customers")
    for rows in (c, c.filter(F.col("c_mktsegment") == "BUILDING").withColumn("c_acctbal", -F.col("c_acctbal"))):
        load(spark, rows, path, ["c_custkey"], None, initial=not table_exists(spark, path))
    return spark.read.parquet(path).drop("_bucket")


SQL["q_load_switch"] = """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN -c_acctbal ELSE c_acctbal END AS c_acctbal,
      c_mktsegment FROM customer"""


def q_as_of_ties(spark, d):
    """J2 with several versions of a key at one instant: the larger order key
    counts, in the broadcast plan (side a) and the timeline plan (side b)."""
    versions = table(spark, d, "orders").select(
        "o_custkey", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("start_at"), "o_orderkey", "o_orderpriority")
    facts = _line_facts(spark, d)
    sides = []
    for side, strategy in (("a", "broadcast"), ("b", "carry")):
        j = joins.as_of_join(facts, versions, ["o_custkey"], "l_shipdate", "start_at", take=["o_orderkey", "o_orderpriority"],
                             prefix="v_", strategy=strategy, dim_order=["o_orderkey"])
        sides.append(j.select("l_orderkey", "l_linenumber", "v_o_orderkey", "v_o_orderpriority", F.lit(side).alias("side")))
    return sides[0].unionByName(sides[1])


SQL["q_as_of_ties"] = """WITH v AS (
      SELECT o_custkey, date_trunc('month', o_orderdate) AS start_at, max(o_orderkey) AS o_orderkey,
             arg_max(o_orderpriority, o_orderkey) AS o_orderpriority
      FROM orders GROUP BY 1, 2),
    f AS (SELECT l_orderkey, l_linenumber, o_custkey, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    j AS (SELECT f.l_orderkey, f.l_linenumber, v.o_orderkey AS v_o_orderkey, v.o_orderpriority AS v_o_orderpriority
          FROM f ASOF LEFT JOIN v ON f.o_custkey = v.o_custkey AND f.l_shipdate >= v.start_at)
    SELECT *, 'a' AS side FROM j UNION ALL SELECT *, 'b' AS side FROM j"""


def q_dim_date_incremental(spark, d):
    """The calendar of finished orders, continued from its high-water
    mark by all order and ship dates."""
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    path = scratch_path(spark, "dim-date")
    dates = o.select(F.col("o_orderdate").alias("d")).unionByName(li.select(F.col("l_shipdate").alias("d")))
    for rows in (o.filter(F.col("o_orderstatus") == "F").select(F.col("o_orderdate").alias("d")), dates):
        marts.continue_dim_date(spark, path, rows.agg(F.to_date(F.min("d")).alias("lo"), F.to_date(F.max("d")).alias("hi")))
    return spark.read.parquet(path)


SQL["q_dim_date_incremental"] = f"""WITH {_cal("SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem")}
    SELECT * FROM cal"""

# -------------------------------------------------------- freight jobs


def q_silver_customers(spark, d):
    """Two customer snapshots -> change rows of four kinds -> SCD2
    silver with INT postal code and DATE sign-up, through the freight jobs."""
    root = scratch_path(spark, "freight-customers")
    c = table(spark, d, "customer")
    day = F.lit("2024-01-01 00:00:00").cast("timestamp")
    renamed = (F.col("c_acctbal") < 0) & (F.col("c_name") != F.upper("c_name"))

    def snap(rows, change):
        name = F.when(renamed, F.upper("c_name")).otherwise(F.col("c_name")) if change else F.col("c_name")
        at = F.when(renamed, day + F.expr("INTERVAL 5 HOURS")).otherwise(day) if change else day
        return rows.select(
            F.col("c_custkey").cast("int").alias("customer_id"), name.alias("company_name"),
            F.lit("m").alias("contact_email"), F.lit("a").alias("address"), F.lit("c").alias("city"),
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("postal_code"), F.col("c_mktsegment").alias("tier"),
            F.lit("i").alias("industry"), (day + F.make_dt_interval(F.col("c_nationkey").cast("int"))).alias("signup_date"),
            at.alias("last_updated"))

    freight.ingest_customer_snapshot(spark, root, snap(c.filter("c_mktsegment <> 'BUILDING'"), False), 1)
    freight.ingest_customer_snapshot(spark, root, snap(c.filter("c_mktsegment <> 'MACHINERY'"), True), 2)
    freight.silver_customers(spark, root)
    return spark.read.parquet(f"{root}/silver/customers").select(
        "customer_id", "company_name", "postal_code", "signup_date", "is_current", "_is_delete")


SQL["q_silver_customers"] = """WITH r AS (SELECT *, c_acctbal < 0 AND c_name <> upper(c_name) AS renamed FROM customer),
    v AS (
      SELECT c_custkey, c_name AS company_name, c_nationkey,
             c_mktsegment <> 'MACHINERY' AND NOT renamed AS is_current, c_mktsegment = 'MACHINERY' AS gone
      FROM r WHERE c_mktsegment <> 'BUILDING'
      UNION ALL
      SELECT c_custkey, CASE WHEN renamed THEN upper(c_name) ELSE c_name END, c_nationkey, true, false
      FROM r WHERE c_mktsegment = 'BUILDING' OR (renamed AND c_mktsegment <> 'MACHINERY'))
    SELECT CAST(c_custkey AS INTEGER) AS customer_id, company_name, CAST(c_nationkey AS INTEGER) AS postal_code,
           CAST(DATE '2024-01-01' + CAST(c_nationkey AS INTEGER) AS DATE) AS signup_date, is_current, gone AS _is_delete
    FROM v"""


def _order_feed(spark, d):
    """Orders as the freight order feed: finished orders change once more."""
    o = table(spark, d, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "O", "created") \
              .otherwise("picked_up")
    base = o.select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").cast("int").alias("customer_id"),
        F.lit("p").alias("product_code"), F.lit("n").alias("product_name"), F.lit(1).alias("quantity"),
        F.col("o_totalprice").alias("total_amount"), status.alias("status"), F.lit("card").alias("payment_method"),
        F.col("o_orderdate").cast("timestamp").alias("order_date"), F.lit(None).cast("timestamp").alias("delivery_date"),
        F.lit("A").alias("origin_city"), F.lit("B").alias("destination_city"), F.lit("insert").alias("_change_type"),
        F.col("o_orderdate").cast("timestamp").alias("_change_ts"))
    later = (base.filter(F.col("status") == "delivered")
             .withColumn("delivery_date", F.col("order_date") + F.expr("INTERVAL 3 DAYS"))
             .withColumn("_change_ts", F.col("_change_ts") + F.expr("INTERVAL 2 DAYS"))
             .withColumn("status", F.lit("returned")))
    return base.unionByName(later)


def q_silver_orders(spark, d):
    """G12/P6d/S1/S6b: the order feed landed as JSON, ingested, and applied to
    SCD2 silver with DATE columns, through the freight jobs."""
    root, land = scratch_path(spark, "freight-orders"), scratch_path(spark, "landing-freight")
    write_json(_order_feed(spark, d), land)
    freight.ingest_feed(spark, root, land, "orders", freight.FEEDS["orders"])
    freight.silver_orders(spark, root)
    return spark.read.parquet(f"{root}/silver/orders").select(
        "order_id", "status", "order_date", "delivery_date", F.col("start_at").cast("timestamp_ntz").alias("start_at"),
        F.col("end_at").cast("timestamp_ntz").alias("end_at"), "is_current")


SQL["q_silver_orders"] = """WITH v AS (
      SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
             CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'created' ELSE 'picked_up' END AS status,
             CAST(o_orderdate AS DATE) AS order_date, CAST(NULL AS DATE) AS delivery_date,
             CAST(o_orderdate AS TIMESTAMP) AS start_at FROM orders
      UNION ALL
      SELECT CAST(o_orderkey AS VARCHAR), 'returned', CAST(o_orderdate AS DATE),
             CAST(o_orderdate + INTERVAL 3 DAYS AS DATE), CAST(o_orderdate AS TIMESTAMP) + INTERVAL 2 DAYS
      FROM orders WHERE o_orderstatus = 'F')
    SELECT order_id, status, order_date, delivery_date, start_at,
           lead(start_at) OVER w - INTERVAL 1 MILLISECOND AS end_at, lead(start_at) OVER w IS NULL AS is_current
    FROM v WINDOW w AS (PARTITION BY order_id ORDER BY start_at)"""


def q_erase_job(spark, d):
    """The erasure job over persisted tables; customers in debt are
    deleted, and only buckets with rows of theirs are rewritten."""
    root = scratch_path(spark, "freight-erase")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"), at.alias("start_at"),
                                           (F.col("c_acctbal") < 0).alias("_is_delete"))
    write_bucketed(c, f"{root}/silver/customers", ["customer_id"], 32)
    write_bucketed(surrogate_key(c.drop("_is_delete"), "customer_sk", ["customer_id", "start_at"]),
                   f"{root}/gold/dim_customer", ["customer_sk"], 32)
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                                         at.alias("start_at"))
    write_bucketed(surrogate_key(o, "customer_sk", ["customer_id", "start_at"]).drop("customer_id", "start_at"),
                   f"{root}/gold/fact_order_fulfillment", ["order_id"], 32)
    freight.gold_erase_customers(spark, root)
    fact = spark.read.parquet(f"{root}/gold/fact_order_fulfillment").select(
        F.lit("fact").alias("kind"), "order_id", "customer_sk")
    return fact.unionByName(spark.read.parquet(f"{root}/gold/dim_customer").select(
        F.lit("dim").alias("kind"), F.col("customer_id").alias("order_id"), "customer_sk"))


SQL["q_erase_job"] = """WITH k AS (SELECT c_custkey, md5(concat_ws('|', CAST(c_custkey AS VARCHAR), '2024-01-01 00:00:00')) AS sk
      FROM customer WHERE NOT coalesce(c_acctbal < 0, false))
    SELECT 'fact' AS kind, o_orderkey AS order_id, sk AS customer_sk FROM orders JOIN k ON o_custkey = c_custkey
    UNION ALL
    SELECT 'dim', c_custkey, sk FROM k"""


def q_mart_silver_telemetry(spark, d):
    """G10 through ``marts.silver_telemetry``."""
    bronze = telemetry_bronze(spark, d).withColumn("reading_timestamp", F.col("reading_timestamp").cast("timestamp"))
    return marts.silver_telemetry(bronze).select(
        "reading_id", "vehicle_id", F.col("reading_timestamp").cast("timestamp_ntz").alias("reading_timestamp"),
        "speed_kmh", "fuel_pct", "engine_temp_c", "cargo_temp_c", "odometer_km", "vehicle_status",
        "is_cold_chain_cargo", "speed_limit_exceed", "engine_overheat")


SQL["q_mart_silver_telemetry"] = f"""SELECT reading_id, vehicle_id, reading_timestamp, speed_kmh, fuel_pct, engine_temp_c,
      cargo_temp_c, odometer_km, vehicle_status, is_cold_chain_cargo, speed_limit_exceed, engine_overheat
    FROM ({_TELEMETRY_SILVER})"""

# -------------------------------------------------------- sources and audits


def q_evolve_schema(spark, d):
    """A feed whose second landing has one more field; the stored schema
    gains it and rows of both landings are read with it."""
    ev = table(spark, d, "events")
    land, store, out, ck = (scratch_path(spark, n) for n in ("evolve-land", "evolve-schema", "evolve-bronze", "evolve-ck"))
    base = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    for i, rows in enumerate((ev.filter("event_type = 'click'").select("event_id", "value"),
                              ev.filter("event_type <> 'click'").select("event_id", "value", "user_id"))):
        write_json(rows, f"{land}/drop={i}")
        # only the new landing is inferred
        schema, action = evolve_stored_schema(spark, f"{land}/drop={i}", store, base)
        append_stream(json_stream(spark, f"{land}/*", schema), out, ck)
    return spark.read.option("mergeSchema", "true").parquet(out).select(
        "event_id", "value", "user_id", F.lit(action).alias("drift_action"))


SQL["q_evolve_schema"] = """SELECT event_id, value, CASE WHEN event_type <> 'click' THEN user_id END AS user_id,
      'added column ''user_id''' AS drift_action FROM events"""


def q_change_feed(spark, d):
    """Change rows from version 2 on, read back from a change-feed table."""
    path = scratch_path(spark, "change-feed")
    old, new = _customer_snapshots(spark, d)
    for v, (a, b) in enumerate(((old.limit(0), old), (old, new)), 1):
        publish(cdc.snapshot_diff(a, b, ["c_custkey"], v), path, "append")
    return read_change_feed(spark, path, 2).select("c_custkey", "c_name", "c_acctbal", "_change_type", "_commit_version")


SQL["q_change_feed"] = f"""WITH {_SNAP}
    SELECT c_custkey, c_name, c_acctbal, _change_type, CAST(2 AS BIGINT) AS _commit_version FROM chg"""


def q_json_scan(spark, d):
    """A batch scan of JSON lines, parsed with a given schema."""
    path = scratch_path(spark, "json-scan")
    write_json(table(spark, d, "part").select("p_partkey", "p_name", "p_size"), path)
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
                           T.StructField("p_size", T.IntegerType())])
    return parse_json_rescued(read_json_lines(spark, path), schema).select("p_partkey", "p_name", "p_size")


SQL["q_json_scan"] = "SELECT p_partkey, p_name, p_size FROM part"


def q_late_rows(spark, d):
    """Q4: events more than 20 days older than the newest one."""
    ev = table(spark, d, "events")
    return ev.filter(audit.late_rows(ev, "ts", ev.select(F.max("ts")).scalar(), 20)).select("event_id", "ts")


SQL["q_late_rows"] = "SELECT event_id, ts FROM events WHERE ts < (SELECT max(ts) FROM events) - INTERVAL 20 DAY"

SQL["q_stream_rollup"] = f"""SELECT user_id, date_trunc('hour', ts) AS period_start, count(event_id) AS events_count,
      max(value) AS max_value, min(value) AS min_value, {_round('sum(value)', 4)} AS value_sum
    FROM events GROUP BY user_id, date_trunc('hour', ts)"""

QUERIES = {name: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)}
