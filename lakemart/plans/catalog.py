"""Catalogue: every operator bound to the driver's tables.

Each entry is ``name -> fn(spark, sf_dir) -> DataFrame`` reading the given
Parquet tables (or frames Spark derives from them), so its work grows with
the data.  ``ORACLE_SQL`` holds an independent DuckDB statement over the
same tables for each entry that SQL can express; column names and types
match the Spark result.

Fixtures that need changes, copies, deletes or bad values are derived from
the tables by data-dependent rules (an event type, a priority, a
segment) -- never by sampling or capping the input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.dates import minus_millis, truncate
from lakemart.functions.keys import normalize_expr, surrogate_key_expr
from lakemart.operators import audit, cdc, cleanse, dedupe, erase, joins, merge, rollup, scd
from lakemart.plans import marts
from lakemart.session import configure, cut_lineage, scratch_path
from lakemart.sinks.tables import compact, write_json
from lakemart.sources.files import parse_json_rescued, read_window, rescued_keys, with_lineage
from lakemart.sources.schema import drift_state
from lakemart.streaming.ingest import append_stream, json_stream

Query = Callable[[SparkSession, str], DataFrame]

# --- fixed values: binding constants ------------------------------------------
EVENT_TYPES = ["signup", "error", "click", "view", "purchase"]
RETURN_FLAGS = ["A", "N", "R"]
REGION_CODES = [("AFRICA", "AF"), ("AMERICA", "AM"), ("ASIA", "AS"), ("EUROPE", "EU"),
                ("MIDDLE EAST", "ME")]
# --------------------------------------------------------------------------------


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


# ----------------------------------------------------------------- fixtures

def events_with_copies(spark, d) -> DataFrame:
    """Events plus a second, later delivery of every purchase event (1 s
    later, value + 1): at-least-once duplicates."""
    ev = table(spark, d, "events")
    copies = (ev.filter(F.col("event_type") == "purchase")
                .withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 SECOND"))
                .withColumn("value", F.col("value") + 1))
    return ev.unionByName(copies)


EV_COPIES_SQL = """ev AS (
  SELECT event_id, ts, user_id, event_type, value, props FROM events
  UNION ALL
  SELECT event_id, ts + INTERVAL 1 SECOND, user_id, event_type, value + 1, props
  FROM events WHERE event_type = 'purchase')"""


def sparse_events(spark, d) -> DataFrame:
    """Events whose value is missing on view events (sparse updates)."""
    ev = table(spark, d, "events")
    return ev.withColumn("value", F.when(F.col("event_type") != "view", F.col("value")))


def order_changes(spark, d) -> DataFrame:
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus",
                                            "o_totalprice", "o_orderpriority", "o_orderdate")


ORDER_SCD_ATTRS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def customer_scd2(spark, d) -> DataFrame:
    """SCD2 over orders keyed by customer, sequence = order date, applied
    in two batches that arrive out of order (status F first)."""
    ch = order_changes(spark, d)
    # each applied batch is materialised, as the persisted SCD2 table would be
    first = cut_lineage(scd.scd2_apply(None, ch.filter(F.col("o_orderstatus") == "F"), ["o_custkey"],
                                       "o_orderdate", ORDER_SCD_ATTRS, tiebreak=["o_orderkey"]))
    return cut_lineage(scd.scd2_apply(first, ch.filter(F.col("o_orderstatus") != "F"), ["o_custkey"],
                                      "o_orderdate", ORDER_SCD_ATTRS, tiebreak=["o_orderkey"]))


SCD2_SQL = """v0 AS (
  SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn
  FROM orders),
scd2 AS (
  SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate,
         o_orderdate AS start_at,
         lead(o_orderdate) OVER w - INTERVAL 1 MILLISECOND AS end_at,
         lead(o_orderdate) OVER w IS NULL AS is_current,
         false AS _is_delete,
         CAST(NULL AS TIMESTAMP) AS _delete_seq
  FROM v0 WHERE rn = 1
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate))"""


def event_changes(spark, d) -> DataFrame:
    """Change rows keyed by user: error events above 200 are deletes."""
    ev = table(spark, d, "events")
    kind = F.when((F.col("event_type") == "error") & (F.col("value") > 200), F.lit("delete")) \
            .otherwise(F.lit("upsert"))
    return ev.select("user_id", "event_id", "event_type", "value", "ts", kind.alias("_change_type"))


def events_scd2_deletes(spark, d) -> DataFrame:
    ch = event_changes(spark, d)
    late = F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")
    args = dict(keys=["user_id"], seq="ts", attrs=["event_id", "event_type", "value"],
                change_col="_change_type", tiebreak=["event_id"])
    t1 = cut_lineage(scd.scd2_apply(None, ch.filter(late), **args))      # later half first
    return cut_lineage(scd.scd2_apply(t1, ch.filter(~late), **args))


SCD2_DEL_SQL = """c AS (
  SELECT user_id, event_id, event_type, value, ts,
         CASE WHEN event_type = 'error' AND value > 200 THEN 'delete' ELSE 'upsert' END AS ct
  FROM events),
tomb AS (SELECT user_id, min(ts) AS ds FROM c WHERE ct = 'delete' GROUP BY user_id),
u0 AS (SELECT c.*, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn
       FROM c WHERE ct <> 'delete'),
v AS (SELECT u0.user_id, u0.event_id, u0.event_type, u0.value, u0.ts, tomb.ds
      FROM u0 LEFT JOIN tomb ON u0.user_id = tomb.user_id
      WHERE u0.rn = 1 AND (tomb.ds IS NULL OR u0.ts < tomb.ds)),
scd2d AS (
  SELECT user_id, event_id, event_type, value, ts, ts AS start_at,
         lead(ts) OVER w - INTERVAL 1 MILLISECOND AS end_at,
         (lead(ts) OVER w IS NULL AND ds IS NULL) AS is_current,
         ds IS NOT NULL AS _is_delete, ds AS _delete_seq
  FROM v WINDOW w AS (PARTITION BY user_id ORDER BY ts)
  UNION ALL
  SELECT user_id, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), ds,
         CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP), false, true, ds
  FROM tomb WHERE user_id NOT IN (SELECT user_id FROM v))"""


def dim_customer(spark, d, batches: bool = True) -> DataFrame:
    """The customer dimension.  ``batches=False`` builds it in one apply --
    the same rows, since the apply does not depend on how changes are
    batched (property-tested); queries that only consume the dimension
    use it."""
    if batches:
        hist = customer_scd2(spark, d)
    else:
        hist = cut_lineage(scd.scd2_apply(None, order_changes(spark, d), ["o_custkey"], "o_orderdate",
                                          ORDER_SCD_ATTRS, tiebreak=["o_orderkey"]))
    return marts.build_dim_scd2(hist, "customer_sk", "o_custkey")


def telemetry_bronze(spark, d, with_copies: bool = True) -> DataFrame:
    """Events shaped as vehicle telemetry readings (the skewed feed)."""
    ev = events_with_copies(spark, d) if with_copies else table(spark, d, "events")
    v = F.col("value")
    status = (F.when(F.col("event_type") == "view", "idle")
               .when(F.col("event_type") == "error", "maintenance")
               .when(F.col("event_type") == "click", "moving").otherwise("loading"))
    return ev.select(
        F.col("event_id").cast("string").alias("reading_id"),
        F.col("user_id").cast("string").alias("vehicle_id"),
        F.col("ts").alias("reading_timestamp"),
        v.alias("speed_kmh"),
        (v / 5).alias("fuel_pct"),
        (v / 2).alias("engine_temp_c"),
        F.when(F.col("event_type") == "purchase", v - 300).alias("cargo_temp_c"),
        F.floor(v * 10).cast("int").alias("odometer_km"),
        status.alias("vehicle_status"))


TELEMETRY_NTZ = T.StructType([f if f.name != "reading_timestamp"
                              else T.StructField("reading_timestamp", T.TimestampNTZType())
                              for f in cleanse.TELEMETRY_SCHEMA.fields])

TELEMETRY_SQL = """ev AS (
  SELECT event_id, ts, user_id, event_type, value, props FROM events
  UNION ALL
  SELECT event_id, ts + INTERVAL 1 SECOND, user_id, event_type, value + 1, props
  FROM events WHERE event_type = 'purchase'),
ev1 AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts ASC NULLS LAST) AS rn FROM ev),
raw AS (
  SELECT CAST(event_id AS VARCHAR) AS reading_id, CAST(user_id AS VARCHAR) AS vehicle_id,
         ts AS reading_timestamp, value AS speed_kmh, value / 5 AS fuel_pct, value / 2 AS engine_temp_c,
         CASE WHEN event_type = 'purchase' THEN value - 300 END AS cargo_temp_c,
         CAST(floor(value * 10) AS INTEGER) AS odometer_km,
         CASE event_type WHEN 'view' THEN 'idle' WHEN 'error' THEN 'maintenance'
                         WHEN 'click' THEN 'moving' ELSE 'loading' END AS vehicle_status
  FROM ev1 WHERE rn = 1),
silver AS (
  SELECT CASE WHEN cargo_temp_c < -273 OR cargo_temp_c > 100 THEN NULL ELSE cargo_temp_c END AS cargo_temp_c,
         CASE WHEN engine_temp_c < 0 OR engine_temp_c > 200 THEN NULL ELSE engine_temp_c END AS engine_temp_c,
         fuel_pct, odometer_km, reading_id, reading_timestamp,
         CASE WHEN speed_kmh < 0 OR speed_kmh > 180 THEN NULL ELSE speed_kmh END AS speed_kmh,
         vehicle_id, vehicle_status
  FROM raw WHERE reading_id IS NOT NULL)"""


def silver_telemetry(spark, d) -> DataFrame:
    first = dedupe.dedupe(telemetry_bronze(spark, d), ["reading_id"], "reading_timestamp", desc=False)
    return (first.transform(cleanse.normalize_telemetry, "reading_id", TELEMETRY_NTZ)
                 .transform(cleanse.enrich_telemetry))


def vehicle_dim(spark, d) -> DataFrame:
    cust = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("vehicle_id"),
                                               "c_name", "c_mktsegment")
    return marts.build_dim_scd1(cust, "vehicle_sk", "vehicle_id")


def orders_lines_calendar(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem").select(F.col("l_shipdate").alias("d"))
    od = table(spark, d, "orders").select(F.col("o_orderdate").alias("d"))
    return marts.calendar_for(li.unionByName(od), "d")


def _md5_key(*cols: str) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in cols) + "))"


def _nrm_sql(c: str) -> str:
    # written out, not taken from the code under test
    return (f"lower(regexp_replace(translate({c}, 'àâäéèêëïîôöûüçÀÂÄÉÈÊËÏÎÔÖÛÜÇ', 'aaaeeeeiioouucAAAEEEEIIOOUUC'), "
            f"'[^A-Za-z0-9 ]', '', 'g'))")


# ----------------------------------------------------------------- queries

def q_dedupe_latest(spark, d):
    """Latest order per customer (order date, ties by order key)."""
    return dedupe.dedupe(table(spark, d, "orders"), ["o_custkey"], "o_orderdate", desc=True,
                         tiebreak=["o_orderkey"])


def q_dedupe_earliest(spark, d):
    """Earliest delivery per event id over events plus late copies."""
    return dedupe.dedupe(events_with_copies(spark, d), ["event_id"], "ts", desc=False,
                         tiebreak=["value"])


def q_distinct_rows(spark, d):
    """D3: distinct (nation, segment) pairs of customers."""
    return dedupe.distinct_rows(table(spark, d, "customer"), ["c_nationkey", "c_mktsegment"])


def q_distinct_key(spark, d):
    """One customer per nation, deterministically the smallest key."""
    return dedupe.distinct_key(table(spark, d, "customer"), ["c_nationkey"], "c_custkey")


def q_latest_per_key(spark, d):
    """Latest event per user by (ts, event id)."""
    return dedupe.latest_per_key(table(spark, d, "events"), ["user_id"], ["ts", "event_id"])


def q_sample_n(spark, d):
    """Reproducible 100-order sample (hash order, distributed top-k)."""
    return dedupe.sample_n_md5(table(spark, d, "orders"), 100, "o_orderkey")


def q_read_window(spark, d):
    """Orders dated 1997-01-01..1997-12-31, bounds inclusive, pushed down."""
    return read_window(table(spark, d, "orders"), "o_orderdate", "1997-01-01", "1997-12-31")


def q_read_window_dedupe(spark, d):
    """Windowed read of events reduced to the latest per user."""
    return read_window(table(spark, d, "events"), "ts", "2024-01-10", "2024-01-20",
                       dedupe_keys=["user_id"], order_col="ts", desc=True, tiebreak=["event_id"])


def _doc_texts(spark, d):
    docs = table(spark, d, "documents")
    txt = (F.when(F.col("source") == "src0", F.lit(None).cast("string"))
            .when(F.col("source") == "src1", F.lit("")).otherwise(F.col("text")))
    return docs.select("doc_id", "lang", "source", txt.alias("text"))


DOC_SQL = """docs AS (
  SELECT doc_id, lang, source,
         CASE WHEN source = 'src0' THEN NULL WHEN source = 'src1' THEN '' ELSE text END AS text
  FROM documents)"""


def q_require_keys(spark, d):
    """Documents whose text is present (NULL texts fixture-derived by source)."""
    return (cleanse.require_keys(_doc_texts(spark, d), ["text"])
            .select("doc_id", "lang", "source", "text"))


def q_non_blank(spark, d):
    """Documents whose text is present and not empty."""
    return (cleanse.require_non_blank(_doc_texts(spark, d), ["text"])
            .select("doc_id", "lang", "source", "text"))


def q_live_rows(spark, d):
    """Live (not deleted) versions of the SCD2-with-deletes history."""
    return cleanse.live_rows(events_scd2_deletes(spark, d))


def q_deleted_rows(spark, d):
    """Versions flagged deleted in the SCD2-with-deletes history."""
    return cleanse.deleted_rows(events_scd2_deletes(spark, d))


def _customer_snapshots(spark, d):
    cust = table(spark, d, "customer")
    old = cust.filter(F.col("c_mktsegment") != "BUILDING")
    new = (cust.filter(F.col("c_mktsegment") != "AUTOMOBILE")
               .withColumn("c_acctbal", F.when(F.col("c_nationkey") < 5, F.col("c_acctbal") + 1)
                           .otherwise(F.col("c_acctbal"))))
    return old, new


def q_snapshot_diff(spark, d):
    """Change feed between two customer snapshots."""
    old, new = _customer_snapshots(spark, d)
    return cdc.snapshot_diff(old, new, ["c_custkey"], version=1)


def q_split_changes(spark, d):
    """P5: upserts of that change feed (pre-images and deletes removed)."""
    return cdc.upserts_only(q_snapshot_diff(spark, d))


def _raw_events(spark, d):
    ev = table(spark, d, "events")
    return ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") == "error", F.lit("not-a-time"))
         .otherwise(F.col("ts").cast("string")).alias("ts"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.when(F.col("event_type") == "view", F.lit("n/a"))
         .otherwise(F.col("value").cast("string")).alias("value"),
        F.col("props").alias("extra_props"))


EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType())])
EVENT_SCHEMA_PROPS = T.StructType(EVENT_SCHEMA.fields + [T.StructField("props", T.StringType())])


def q_enforce_schema(spark, d):
    """Stringly-typed events cast back with try_cast, closed column list."""
    return cleanse.enforce_schema(_raw_events(spark, d), EVENT_SCHEMA)


def q_null_out_of_range(spark, d):
    """Event values outside [1, 100] become NULL; rows kept."""
    ev = table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    return cleanse.null_out_of_range(ev, {"value": (1, 100)})


def q_add_flags(spark, d):
    """NULL-safe flag (value > 50) and event date on sparse events."""
    ev = sparse_events(spark, d)
    return (cleanse.add_flags(ev, {"is_high": F.col("value") > 50})
            .select("event_id", "is_high", F.to_date("ts").alias("event_date")))


def q_status_timestamps(spark, d):
    """P10: one timestamp column per event type."""
    ev = table(spark, d, "events").select("event_id", "event_type", "ts")
    return rollup.status_timestamps(ev, "event_type", "ts", EVENT_TYPES)


def q_normalize_str(spark, d):
    """Accent-folded, punctuation-free, lower-case conversation texts (whole texts)."""
    c = table(spark, d, "conversations")
    return c.select("conv_id", "turn", normalize_expr("text").alias("nrm_text"))


def q_surrogate_key(spark, d):
    """md5 surrogate key of (customer, order date) per order."""
    o = table(spark, d, "orders")
    return o.select(surrogate_key_expr(["o_custkey", "o_orderdate"]).alias("order_sk"), "o_orderkey")


def q_dim_date(spark, d):
    """Calendar over the order-date range with its attributes."""
    return marts.calendar_for(table(spark, d, "orders"), "o_orderdate")


def q_date_parts(spark, d):
    """Hour truncation, date, day difference, minus 1 ms on line items."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    j = li.join(o, "l_orderkey")
    return j.select("l_orderkey", "l_linenumber",
                    truncate("hour", "l_shipdate", T.TimestampNTZType()).alias("ship_hour"),
                    F.to_date("l_shipdate").alias("ship_date"),
                    F.datediff(F.col("l_shipdate"), F.col("o_orderdate")).alias("ship_days"),
                    minus_millis("l_shipdate").alias("ship_minus_ms"))


def _json_lines(spark, d, *extra: str):
    ev = table(spark, d, "events")
    raw = (F.when(F.col("event_type") == "click", F.replace(F.col("props"), F.lit("}"),
                                                            F.lit(', "src": "web"}')))
            .when(F.col("event_type") == "error", F.lit('{"k": "oops"}'))
            .when(F.col("event_type") == "signup", F.concat(F.lit("x"), F.col("props")))
            .otherwise(F.col("props")))
    return ev.select("event_id", *extra, raw.alias("value"))


JSON_SQL = """j AS (
  SELECT event_id,
         CASE WHEN event_type = 'click' THEN replace(props, '}', ', "src": "web"}')
              WHEN event_type = 'error' THEN '{"k": "oops"}'
              WHEN event_type = 'signup' THEN 'x' || props
              ELSE props END AS raw
  FROM events)"""


def q_parse_json_rescued(spark, d):
    """JSON lines parsed with rescued keys and corrupt-line flag."""
    parsed = parse_json_rescued(_json_lines(spark, d), T.StructType([T.StructField("k", T.IntegerType())]))
    return parsed.select("event_id", "k",
                         F.when(F.col("_rescued_data").isNotNull(), rescued_keys()).alias("rescued_keys"),
                         F.col("_corrupt_record").isNotNull().alias("is_corrupt"))


def quarantine_rules() -> dict:
    return {
        "value_over_400": F.col("value") > 400,
        "error_event": F.col("event_type") == "error",
        "night_time": F.hour("ts") < 6,
    }


def q_quarantine(spark, d):
    """Q5: events breaking quality rules, with the rule names."""
    ev = table(spark, d, "events")
    return audit.rule_violations(ev, quarantine_rules()).select("event_id", "violations")


def q_with_lineage(spark, d):
    """Source file name of every event row."""
    ev = with_lineage(table(spark, d, "events"), base_name=True, ingested_col=None)
    return ev.select("event_id", F.col("_source_file").alias("source_file"))


def q_lookup_table(spark, d):
    """Literal region-code lookup joined to nations."""
    codes = spark.createDataFrame(REGION_CODES, "r_name string, region_code string")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    nr = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select("n_nationkey", "n_name", "r_name")
    out = joins.lookup_key(nr, codes, "r_name", "r_name", {"region_code": "region_code"},
                           dim_rows=len(REGION_CODES))
    return out.select("n_nationkey", "n_name", "region_code")


def q_touched_history(spark, d):
    """Full order history of customers with an order since 2001-07-01."""
    o = table(spark, d, "orders")
    touched = o.filter(F.col("o_orderdate") >= F.lit("2001-07-01").cast("timestamp_ntz"))
    return joins.touched_history(o, touched, ["o_custkey"])


def _line_facts(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return li.join(o, "l_orderkey").select("l_orderkey", "l_linenumber", "o_custkey", "l_shipdate")


def q_as_of_join(spark, d):
    """Customer-priority version in effect at each line item's ship date."""
    versions = cut_lineage(scd.scd2_apply(None, order_changes(spark, d), ["o_custkey"], "o_orderdate",
                                          ORDER_SCD_ATTRS, tiebreak=["o_orderkey"]))
    return joins.as_of_join(_line_facts(spark, d), versions, ["o_custkey"], "l_shipdate", "start_at",
                            take=["o_orderpriority", "start_at"], prefix="v_")


def q_as_of_join_timeline(spark, d):
    """J2 through the timeline plan (union + hot-key-safe carry-forward),
    the plan used when the version table is too large to broadcast."""
    versions = cut_lineage(scd.scd2_apply(None, order_changes(spark, d), ["o_custkey"], "o_orderdate",
                                          ORDER_SCD_ATTRS, tiebreak=["o_orderkey"]))
    return joins.as_of_join(_line_facts(spark, d), versions, ["o_custkey"], "l_shipdate", "start_at",
                            take=["o_orderpriority", "start_at"], prefix="v_", strategy="carry")


def q_role_playing(spark, d):
    """Customer and supplier nation, ship and order date keys per line item."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    f = li.join(o, "l_orderkey")
    cust, supp, nation = (table(spark, d, "customer"), table(spark, d, "supplier"),
                          table(spark, d, "nation"))
    cal = orders_lines_calendar(spark, d)
    f = joins.lookup_key(f, cust, "o_custkey", "c_custkey", {"c_nationkey": "c_nationkey"})
    f = joins.lookup_key(f, supp, "l_suppkey", "s_suppkey", {"s_nationkey": "s_nationkey"})
    f = joins.lookup_key(f, nation, "c_nationkey", "n_nationkey", {"cust_nation": "n_name"})
    f = joins.lookup_key(f, nation, "s_nationkey", "n_nationkey", {"supp_nation": "n_name"})
    cal_rows = cal.count()          # one size check for both date roles (days, not data)
    f = joins.lookup_key(f, cal, F.to_date("l_shipdate"), "full_date", {"ship_date_key": "date_key"}, dim_rows=cal_rows)
    f = joins.lookup_key(f, cal, F.to_date("o_orderdate"), "full_date", {"order_date_key": "date_key"}, dim_rows=cal_rows)
    return f.select("l_orderkey", "l_linenumber", "cust_nation", "supp_nation", "ship_date_key",
                    "order_date_key")


def q_dim_lookup(spark, d):
    """Event to user surrogate key and date key."""
    ev = table(spark, d, "events")
    users = marts.build_dim_scd1(table(spark, d, "customer").select(F.col("c_custkey").alias("user_id")),
                                 "customer_sk", "user_id")
    cal = marts.calendar_for(ev, "ts")
    f = joins.lookup_key(ev, users, "user_id", "user_id", {"customer_sk": "customer_sk"})
    f = joins.lookup_key(f, cal, F.to_date("ts"), "full_date", {"date_key": "date_key"})
    return f.select("event_id", "customer_sk", "date_key")


def _mangled_nations(spark, d):
    n = table(spark, d, "nation")
    raw = (F.when(F.col("n_regionkey") == 4, F.replace(F.col("n_name"), F.lit("A"), F.lit("Ø")))
            .otherwise(F.translate(F.col("n_name"), "AIO", "ÂÏÖ")))
    return n.select(F.col("n_nationkey").alias("src_key"), raw.alias("raw_name"))


def q_normalized_lookup(spark, d):
    """Mangled nation names matched on their normalised form."""
    lookup = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    out = joins.normalized_lookup(_mangled_nations(spark, d), lookup, "raw_name", "n_name",
                                  take=["n_nationkey", "n_regionkey"])
    return out.select("src_key", "raw_name", "n_nationkey", "n_regionkey")


def _skewed_events(spark, d):
    ev = table(spark, d, "events")
    hot = F.col("event_type").isin("view", "click", "error")
    return ev.select("event_id", F.when(hot, F.pmod(F.col("user_id"), F.lit(5))).otherwise(F.col("user_id"))
                     .alias("user_id"))


def q_skew_join(spark, d):
    """Events skewed onto five users joined to users with selective salting."""
    users = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    # only keys with >= 1% of the fact rows are salted (at most 1000 keys)
    ev = _skewed_events(spark, d)
    hot_rows = max(1, ev.count() // 100)
    out = joins.salted_join(ev, users, "user_id", ["event_id"], buckets=8, hot_rows=hot_rows)
    return out.select("event_id", "user_id", "c_name", "c_mktsegment")


def q_hourly_rollup(spark, d):
    """A1-A3: per user and hour: counts, average of values with many decimals,
    extremes, active share."""
    ev = table(spark, d, "events")
    agg = rollup.period_rollup(ev, ["user_id"], "ts", "hour", {
        "events_count": F.count("event_id"),
        "avg_value": F.round(F.avg(F.col("value") / 7), 6),
        "max_value": F.max("value"),
        "min_value": F.min("value"),
        "active_events": F.count_if(~F.coalesce(F.col("event_type").isin("view", "click"), F.lit(False))),
    })
    return (agg.withColumn("utilization_pct", F.round(F.col("active_events") / F.col("events_count"), 2))
               .withColumn("period_date", F.to_date("period_start")))


def q_hourly_rollup_by_type(spark, d):
    """The same rollup keyed by event type: five keys, each a large share
    of the rows -- the partial aggregation absorbs the skew map-side."""
    ev = table(spark, d, "events")
    return rollup.period_rollup(ev, ["event_type"], "ts", "hour", {
        "events_count": F.count("event_id"),
        "users": F.count_distinct("user_id"),
        "value_sum": F.round(F.sum("value"), 4),
        "max_value": F.max("value"),
    })


def q_high_water(spark, d):
    """Latest order date and highest customer number."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    cust_max = c.select(F.max(F.substring("c_name", 10, 100).cast("int"))).scalar()
    return rollup.high_water(o, "o_orderdate", "hw_orderdate").withColumn("max_cust_num", cust_max)


ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def q_row_counts(spark, d):
    """Row count of every driver table."""
    return rollup.row_counts({t: table(spark, d, t) for t in ALL_TABLES})


def _orders_split(spark, d):
    o = table(spark, d, "orders")
    target = o.filter(F.col("o_orderstatus") == "F")
    source = (o.filter(F.col("o_orderpriority") == "1-URGENT")
               .withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return o, target, source


def q_upsert(spark, d):
    """M1: urgent orders (price changed) upserted into finished orders."""
    _, t, s = _orders_split(spark, d)
    return merge.upsert(t, s, ["o_orderkey"])


def q_delete_matching(spark, d):
    """M2/M3: orders minus the urgent ones."""
    o, _, s = _orders_split(spark, d)
    return merge.delete_matching(o, s, ["o_orderkey"])


def q_update_matching(spark, d):
    """M4: price update for open orders matched by high-priority ones."""
    o = table(spark, d, "orders")
    src = (o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
            .select("o_orderkey", (F.col("o_totalprice") + 100).alias("new_price")))
    return merge.update_matching(o, src, ["o_orderkey"], {"o_totalprice": F.col("s.new_price")},
                                 when=F.col("t.o_orderstatus") == "O")


def q_insert_missing(spark, d):
    """M5: urgent orders inserted where not yet present."""
    _, t, s = _orders_split(spark, d)
    return merge.insert_missing(t, s, ["o_orderkey"])


def q_scd1(spark, d):
    """Current event per user, later batch applied first (sequence guard)."""
    ev = table(spark, d, "events")
    cut = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    t = scd.scd1_apply(None, ev.filter(~cut), ["user_id"], "ts", tiebreak=["event_id"])
    return scd.scd1_apply(t, ev.filter(cut), ["user_id"], "ts", tiebreak=["event_id"])  # late batch


def q_scd2(spark, d):
    """SCD2 of orders per customer, two batches out of order."""
    return customer_scd2(spark, d)


def q_scd2_deletes(spark, d):
    """SCD2 of events per user with deletes, later half applied first."""
    return events_scd2_deletes(spark, d)


def q_fill_forward(spark, d):
    """Sparse event values completed by the latest earlier value per user."""
    ev = sparse_events(spark, d).select("event_id", "user_id", "ts", "event_type", "value")
    return cdc.fill_forward(ev, ["user_id"], ["ts", "event_id"], ["value"])


def q_milestone_pivot(spark, d):
    """Last time of each event type, latest value and status per user."""
    ev = table(spark, d, "events")
    return rollup.milestone_pivot(ev, "user_id", "event_type", "ts", EVENT_TYPES, carry_cols=["value"],
                                  order=["ts", "event_id"])


def q_union_distinct(spark, d):
    """Nation keys of customers and suppliers, as a set."""
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return c.union(s).dropDuplicates()


def q_dim_customer(spark, d):
    """G1: SCD2 customer dimension with md5(customer|start) keys."""
    return dim_customer(spark, d)


def silver_vehicles(spark, d):
    s = table(spark, d, "supplier")
    bronze = (s.select(*[F.col(c).cast("string").alias(c) for c in s.columns], F.lit("1").alias("version"))
               .unionByName(s.withColumn("s_acctbal", F.col("s_acctbal") - 1)
                             .select(*[F.col(c).cast("string").alias(c) for c in s.columns],
                                     F.lit("0").alias("version"))))
    schema = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
                           T.StructField("s_nationkey", T.IntegerType()),
                           T.StructField("s_acctbal", T.DoubleType()),
                           T.StructField("version", T.IntegerType())])
    return marts.silver_scd1(bronze, "s_suppkey", "version", schema)


def q_silver_vehicles(spark, d):
    """Typed current-state suppliers (as vehicles) from two deliveries."""
    return silver_vehicles(spark, d)


def q_dim_vehicle(spark, d):
    """SCD1 vehicle dimension with md5(key)."""
    return marts.build_dim_scd1(silver_vehicles(spark, d), "vehicle_sk", "s_suppkey")


def _city_pairs(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    n = table(spark, d, "nation")
    cn = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("origin_city"))
    sn = n.select(F.col("n_nationkey").alias("s_nationkey"),
                  F.when(F.col("n_regionkey") == 3, F.lit("")).otherwise(F.col("n_name"))
                   .alias("destination_city"))
    return (li.join(o, "l_orderkey").join(c, "o_custkey").join(s, "l_suppkey")
              .join(cn, "c_nationkey").join(sn, "s_nationkey")
              .select("origin_city", "destination_city"))


def _nation_city_lookup(spark, d):
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"]).filter(F.col("r_regionkey") < 3)
    return j.select(F.lower("n_name").alias("city"), F.col("r_name").alias("realm_name"),
                    F.substring("r_name", 1, 2).alias("realm_code"), F.col("r_name").alias("region"),
                    F.concat(F.lit("lang_"), F.col("r_regionkey").cast("string")).alias("language_region"))


def q_dim_location(spark, d):
    """City dimension from customer/supplier nations with lookup and unknown member."""
    return marts.build_dim_location(_city_pairs(spark, d), "origin_city", "destination_city",
                                    _nation_city_lookup(spark, d))


def q_fact_order(spark, d):
    """Order fact: line milestones, as-of customer key, nation, date keys, delivery days."""
    li = table(spark, d, "lineitem")
    header = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    cust = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return marts.build_fact_order(
        history=li.withColumnRenamed("l_orderkey", "o_orderkey"), key="o_orderkey",
        status_col="l_returnflag", time_col="l_shipdate", statuses=RETURN_FLAGS,
        carry_cols=["l_quantity", "l_extendedprice", "l_shipdate"],
        order=["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"],
        header=header, customer_dim=dim_customer(spark, d, batches=False), customer_key="o_custkey",
        customer_sk="customer_sk", asof_col="o_orderdate",
        lookups=[(cust, "o_custkey", "o_custkey", {"cust_nation_key": "c_nationkey"})],
        date_dim=orders_lines_calendar(spark, d),
        date_roles={"order_date_key": "o_orderdate", "delivery_date_key": "l_shipdate"},
        order_date="o_orderdate", delivery_date="l_shipdate",
    ).select("o_orderkey", "customer_sk", "cust_nation_key", "order_date_key", "delivery_date_key",
             "o_totalprice", "A_ts", "N_ts", "R_ts", "current_status", "l_quantity", "l_extendedprice",
             F.col("l_shipdate").alias("last_ship_ts"), "delivery_days", "is_on_time")


def silver_events(spark, d):
    return marts.silver_events(events_with_copies(spark, d), "event_id", "ts",
                               EVENT_SCHEMA_PROPS, tiebreak=["value"])


def q_silver_events(spark, d):
    """Typed events, first delivery per id, event date."""
    return silver_events(spark, d)


def q_fact_event(spark, d):
    """Event fact with user and date keys."""
    ev = silver_events(spark, d)
    users = marts.build_dim_scd1(table(spark, d, "customer").select(F.col("c_custkey").alias("user_id")),
                                 "customer_sk", "user_id")
    # calendar bounds from the raw feed (a superset of the silver dates):
    # one scan + aggregate instead of repeating the dedupe
    cal = marts.calendar_for(events_with_copies(spark, d), "ts")
    return marts.build_fact_event(ev, users, cal, key="user_id", vehicle_sk="customer_sk")


def q_silver_telemetry(spark, d):
    """Events as telemetry readings, deduplicated, cleansed, flagged."""
    return silver_telemetry(spark, d)


def q_fact_telemetry(spark, d):
    """Vehicle x hour telemetry fact with vehicle and date keys (flagship)."""
    silver = silver_telemetry(spark, d)
    cal = marts.calendar_for(telemetry_bronze(spark, d), "reading_timestamp")
    return marts.build_fact_telemetry(silver, vehicle_dim(spark, d), cal)


def q_erase(spark, d):
    """Order fact after erasing customers with a negative balance."""
    o = table(spark, d, "orders")
    fact = o.select("o_orderkey", "o_custkey",
                    surrogate_key_expr(["o_custkey", "o_orderdate"]).alias("customer_sk"))
    entities = table(spark, d, "customer").filter(F.col("c_acctbal") < 0) \
        .select(F.col("c_custkey").alias("o_custkey"))
    _, facts = erase.erase(entities, dim_customer(spark, d, batches=False), {"fact": fact}, "o_custkey", "customer_sk",
                           fact_natural_key={"fact": "o_custkey"})
    return facts["fact"]


def q_erase_dim(spark, d):
    """Customer dimension after the same erasure."""
    entities = table(spark, d, "customer").filter(F.col("c_acctbal") < 0) \
        .select(F.col("c_custkey").alias("o_custkey"))
    dim, _ = erase.erase(entities, dim_customer(spark, d, batches=False), {}, "o_custkey", "customer_sk")
    return dim.select("customer_sk", "o_custkey", "start_at")


def q_check_pk(spark, d):
    """Q6: (order, line number) keys violating NOT NULL + UNIQUE."""
    return audit.check_primary_key(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_check_fk_orphans(spark, d):
    """Q7: orphans after shifting low-priority orders' customer keys."""
    o = table(spark, d, "orders")
    shifted = o.withColumn("o_custkey", F.when(F.col("o_orderpriority") == "5-LOW",
                                               F.col("o_custkey") + 1000).otherwise(F.col("o_custkey")))
    return audit.check_foreign_key(shifted, "o_custkey", table(spark, d, "customer"), "c_custkey") \
        .select("o_orderkey", "o_custkey")


def q_health_audit(spark, d):
    """Q1/Q4: health row per event type: rows, bad, duplicates, late, label."""
    ev = events_with_copies(spark, d)
    batch_ts = ev.select(F.max("ts")).scalar()
    late = F.col("ts") < batch_ts - F.expr("INTERVAL 20 DAYS")
    return audit.health_audit(ev, "event_type", ["event_id"], {"value_over_400": F.col("value") > 400},
                              late=late)


def q_key_share(spark, d):
    """Q8: the five users with most events and their share."""
    return rollup.key_share(table(spark, d, "events"), "user_id", 5)


def q_compact(spark, d):
    """Q10: line items rewritten into few files; rows unchanged."""
    dst = scratch_path(spark, "compact-lineitem")
    compact(spark, f"{d.rstrip('/')}/lineitem.parquet", dst, rows_per_file=250_000)
    return spark.read.parquet(dst)


def q_stream_ingest(spark, d):
    """Events landed as JSON files, ingested by an availableNow stream."""
    src, out, ck = (scratch_path(spark, "landing-events"), scratch_path(spark, "bronze-events"),
                    scratch_path(spark, "ckpt-events"))
    write_json(table(spark, d, "events"), src)
    append_stream(json_stream(spark, src, EVENT_SCHEMA_PROPS), out, ck)
    return spark.read.parquet(out).select("event_id", "ts", "user_id", "event_type", "value", "props",
                                          "_rescued_data")


def q_drift_state(spark, d):
    """Audit rows derived from the feed: per (source = event type, batch =
    day) the comma list of JSON keys that had to be rescued; the drift
    state is the latest row per source."""
    lines = _json_lines(spark, d, "event_type", "ts")       # one scan, no self-join
    parsed = parse_json_rescued(lines, T.StructType([T.StructField("k", T.IntegerType())]))
    keys = parsed.select("event_type", F.to_date("ts").alias("batch"),
                         F.explode_outer(F.split(rescued_keys(), ",")).alias("key"))
    audit = (keys.groupBy(F.col("event_type").alias("source"), "batch")
                 .agg(F.array_join(F.array_sort(F.collect_set("key")), ",").alias("active_extra_columns"))
                 .withColumn("run_ts", F.col("batch").cast("timestamp"))
                 .withColumn("batch_id", F.date_format("batch", "yyyyMMdd")))
    st = drift_state(audit)
    return st.select("source", F.array_join("extra_columns", ",").alias("extra_columns"))


QUERIES: dict[str, Query] = {name: fn for name, fn in sorted(globals().items())
                             if name.startswith("q_") and callable(fn)}
