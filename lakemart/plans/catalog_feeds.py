"""Queries over feeds: schemas that grow on arrival, rescued values, malformed
lines, the mart's feeds and statistics, bound to the driver tables, each with
its DuckDB SQL (``SQL``)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators import asof, cdc, episodes
from lakemart.operators.heavy import heavy_keys
from lakemart.plans import freight
from lakemart.plans.catalog import SCD2_SQL, _customer_snapshots, _json_lines, _line_facts, customer_scd2, table
from lakemart.plans.oracle import ORACLE_SQL, _round
from lakemart.session import cut_lineage, scratch_path
from lakemart.sinks import expect as expectations
from lakemart.sinks import pack
from lakemart.sinks.tables import analyze, column_statistics, write_json
from lakemart.sources.files import empty_like, parse_json_rescued, quarantine_split, read_json_lines
from lakemart.streaming.ingest import ingest_on_arrival, read_arrived
from lakemart.streaming.state import earliest_state, rollup_state

SQL: dict[str, str] = {}


def q_schema_on_arrival(spark, d):
    """Three landings over two runs on one checkpoint; the second brings a
    struct, the third a field within it and a column.  Each run infers the
    schema of its new files only, and rows of all landings are read with the
    grown schema."""
    ev = table(spark, d, "events")
    land, store, out, ck = (scratch_path(spark, n) for n in ("arrive-land", "arrive-schema", "arrive", "arrive-ck"))
    base = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    user, kind = F.col("user_id").alias("id"), F.col("event_type").alias("kind")
    drops = [[(ev.filter(F.col("event_type").isin("click", "view")).select("event_id", "value")),
              (ev.filter(F.col("event_type").isin("purchase", "signup"))
                 .select("event_id", "value", F.struct(user).alias("user")))],
             [(ev.filter(~F.col("event_type").isin("click", "view", "purchase", "signup"))
                 .select("event_id", "value", F.struct(user, kind).alias("user"), F.lit(True).alias("flag")))]]
    actions = []
    for run, parts in enumerate(drops):
        for i, rows in enumerate(parts):
            write_json(rows, f"{land}/drop={run}{i}")
        actions += ingest_on_arrival(spark, f"{land}/*", out, store, base, ck)
    return read_arrived(spark, out, store).select(
        "event_id", "value", F.col("user.id").alias("user_id"), F.col("user.kind").alias("user_kind"), "flag",
        F.col("_rescued_data").isNull().alias("all_known"), F.lit("; ".join(actions)).alias("drift_actions"))


SQL["q_schema_on_arrival"] = """SELECT event_id, value, CASE WHEN event_type NOT IN ('click', 'view') THEN user_id END AS user_id,
      CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'signup') THEN event_type END AS user_kind,
      CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'signup') THEN true END AS flag, true AS all_known,
      'added column ''user'', ''user.id''; added column ''user.kind'', ''flag''' AS drift_actions
    FROM events"""


def q_rescue_nested(spark, d):
    """S3 below structs and arrays: per event type another value does not fit
    or is unknown; its path and value are rescued, all else is typed."""
    ev = table(spark, d, "events")
    kind, number = F.col("event_type"), F.regexp_extract("props", "[0-9]+", 0)
    lat = F.when(kind == "error", F.lit('"north"')).otherwise(F.col("value").cast("string"))
    geo = F.concat(F.lit('{"lat":'), lat, F.lit(',"tag":"'), kind, F.lit('"'),
                   F.when(kind == "click", F.concat(F.lit(',"lon":'), F.col("user_id").cast("string"))).otherwise(F.lit("")), F.lit("}"))
    second = F.when(kind == "signup", F.lit('"bad"')).otherwise(F.col("user_id").cast("string"))
    items = F.when(kind == "purchase", F.lit('"none"')).otherwise(
        F.concat(F.lit('[{"k":'), number, F.lit('},{"k":'), second, F.lit("}]")))
    lines = ev.select(F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"geo":'), geo,
                               F.lit(',"items":'), items, F.lit("}")).alias("value"))
    schema = T.DataType.fromDDL("event_id bigint, geo struct<lat:double,tag:string>, items array<struct<k:bigint>>")
    parsed = parse_json_rescued(lines, schema)
    return parsed.select("event_id", F.col("geo.lat").alias("lat"), F.col("geo.tag").alias("tag"),
                         F.get("items", F.lit(0))["k"].alias("k0"), F.get("items", F.lit(1))["k"].alias("k1"),
                         F.col("_rescued_data").alias("rescued"))


SQL["q_rescue_nested"] = """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS lat, event_type AS tag,
      CASE WHEN event_type <> 'purchase' THEN CAST(regexp_extract(props, '[0-9]+') AS BIGINT) END AS k0,
      CASE WHEN event_type NOT IN ('purchase', 'signup') THEN user_id END AS k1,
      CASE event_type WHEN 'error' THEN '{"geo.lat":"north"}' WHEN 'click' THEN '{"geo.lon":"' || user_id || '"}'
        WHEN 'signup' THEN '{"items[1].k":"bad"}' WHEN 'purchase' THEN '{"items":"none"}' END AS rescued
    FROM events"""


def q_quarantine_split(spark, d):
    """Lines that are no JSON object go to quarantine whole, the others
    are parsed; blank lines are skipped."""
    path = scratch_path(spark, "mangled")
    lines = _json_lines(spark, d, "event_type")
    blank = lines.filter(F.col("event_type") == "view").select(F.lit("  ").alias("value"))
    lines.select("value").unionAll(blank).write.text(path)
    good, bad = quarantine_split(parse_json_rescued(read_json_lines(spark, path),
                                                    T.StructType([T.StructField("k", T.IntegerType())])))
    return (good.groupBy("k", F.col("_corrupt_record").alias("line")).agg(F.count(F.lit(1)).alias("rows"))
                .unionByName(bad.groupBy("k", F.col("_corrupt_record").alias("line")).agg(F.count(F.lit(1)).alias("rows"))))


SQL["q_quarantine_split"] = """SELECT CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(regexp_extract(props, '[0-9]+') AS INTEGER) END AS k,
      CASE WHEN event_type = 'signup' THEN 'x' || props END AS line, count(*) AS rows
    FROM events GROUP BY 1, 2"""


def q_empty_like(spark, d):
    """An empty table like ``orders`` with two more typed columns, which
    the orders are then appended to."""
    o = table(spark, d, "orders")
    extra = T.StructType([T.StructField("closed_on", T.DateType()), T.StructField("score", T.DoubleType())])
    target = empty_like(o, extra, drop=["o_orderdate", "o_orderpriority"])
    return target.unionByName(o.drop("o_orderdate", "o_orderpriority"), allowMissingColumns=True)


SQL["q_empty_like"] = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(NULL AS DATE) AS closed_on,
      CAST(NULL AS DOUBLE) AS score FROM orders"""


def _ingested(spark, feed, rows):
    """Bronze rows of ``feed`` after its job has ingested ``rows`` in two runs."""
    root, land = scratch_path(spark, f"feed-{feed}"), scratch_path(spark, f"land-{feed}")
    half = F.pmod(F.xxhash64(*rows.columns), F.lit(2))
    for i in range(2):
        write_json(rows.filter(half == i), f"{land}/drop={i}")
        freight.ingest_feed(spark, root, f"{land}/*", feed, freight.FEEDS[feed])
    return freight._bronze(spark, root, feed)


def q_feed_shipment_events(spark, d):
    """The shipment event feed; clicks bring a temperature as text and an
    unknown field, which are rescued."""
    ev, kind = table(spark, d, "events"), F.col("event_type")
    rows = ev.select(F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("event_id"),
                     F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("vehicle_id"), "event_type",
                     F.col("ts").alias("event_timestamp"), F.col("value").alias("latitude"),
                     F.when(kind == "click", F.lit("warm")).alias("temperature_celsius"),
                     F.when(kind == "click", F.lit("q")).alias("gate"))
    return _ingested(spark, "shipment_events", rows).select("event_id", "vehicle_id", "event_type", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
                         "latitude", "temperature_celsius", F.col("_rescued_data").alias("rescued"))


SQL["q_feed_shipment_events"] = """SELECT 'E' || event_id AS event_id, 'V' || user_id AS vehicle_id, event_type, ts AS event_timestamp,
      value AS latitude, CAST(NULL AS DOUBLE) AS temperature_celsius,
      CASE WHEN event_type = 'click' THEN '{"temperature_celsius":"warm","gate":"q"}' END AS rescued FROM events"""


def q_feed_telemetry(spark, d):
    """The telemetry feed."""
    rows = table(spark, d, "events").select(
        F.concat(F.lit("R"), F.col("event_id").cast("string")).alias("reading_id"),
        F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("vehicle_id"),
        F.col("ts").alias("reading_timestamp"), F.col("value").alias("speed_kmh"),
        F.col("user_id").cast("int").alias("odometer_km"), F.col("event_type").alias("vehicle_status"))
    got = _ingested(spark, "telemetry", rows)
    return got.select("reading_id", "vehicle_id", F.col("reading_timestamp").cast("timestamp_ntz").alias("reading_timestamp"),
                      "speed_kmh", "odometer_km", "vehicle_status", F.col("fuel_pct").isNull().alias("no_fuel"))


SQL["q_feed_telemetry"] = """SELECT 'R' || event_id AS reading_id, CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS vehicle_id,
      ts AS reading_timestamp, value AS speed_kmh, CAST(user_id AS INTEGER) AS odometer_km, event_type AS vehicle_status,
      true AS no_fuel FROM events"""


def q_feed_vehicles(spark, d):
    """S1d: the vehicle feed."""
    rows = table(spark, d, "supplier").select(
        F.concat(F.lit("V"), F.col("s_suppkey").cast("string")).alias("vehicle_id"), F.col("s_name").alias("model"))
    return _ingested(spark, "vehicles", rows).select("vehicle_id", "model", F.col("_corrupt_record").isNull().alias("is_good"))


SQL["q_feed_vehicles"] = "SELECT 'V' || s_suppkey AS vehicle_id, s_name AS model, true AS is_good FROM supplier"


def q_analyze(spark, d):
    """Q9: statistics of a table and its columns, computed and read back."""
    name, path = f"analyzed_{scratch_path(spark, 'a')[-32:]}", scratch_path(spark, "analyzed")
    table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag").write.option("path", path).saveAsTable(name)
    analyze(spark, name, ["l_orderkey", "l_quantity"])
    out = column_statistics(spark, name, ["l_orderkey", "l_quantity"])
    spark.sql(f"DROP TABLE {name}")
    return out.select("column", "rows", "nulls", F.col("least").cast("double").alias("least"), F.col("most").cast("double").alias("most"))


SQL["q_analyze"] = """SELECT 'l_orderkey' AS "column", count(*) AS rows, count(*) FILTER (l_orderkey IS NULL) AS nulls,
      min(l_orderkey)::DOUBLE AS least, max(l_orderkey)::DOUBLE AS most FROM lineitem
    UNION ALL SELECT 'l_quantity', count(*), count(*) FILTER (l_quantity IS NULL), min(l_quantity)::DOUBLE, max(l_quantity)::DOUBLE FROM lineitem"""

def _late_feed(spark, d):
    """Events without some users and times, landed against the order of time;
    purchases come again in a second landing."""
    ev = table(spark, d, "events")
    kind = F.col("event_type")
    ev = ev.select("event_id", F.when(kind != "signup", F.col("ts")).alias("ts"),
                   F.when(kind != "error", F.col("user_id")).alias("user_id"), "event_type", "value")
    late = F.coalesce(F.dayofmonth("ts") <= 10, F.lit(False))
    return ev, [[ev.filter(~late), ev.filter(late & (kind != "click"))],
                [ev.filter(late & (kind == "click")), ev.filter(kind == "purchase")]]


def _land_and_run(spark, name, schema, landings, run):
    """Two runs on one checkpoint; every drop of JSON files is a micro-batch."""
    src, ck = scratch_path(spark, f"{name}-land"), scratch_path(spark, f"{name}-ck")
    for i, drops in enumerate(landings):
        for j, rows in enumerate(drops):
            write_json(rows, f"{src}/drop={i}{j}")
        run(spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).json(f"{src}/*"), ck)


def q_state_rollup(spark, d):
    """2.12: hourly windows from keyed state over two runs, with late and
    repeated rows, and rows without user or time."""
    ev, landings = _late_feed(spark, d)
    out = scratch_path(spark, "state-rollup")
    aggs = {"n": F.count(F.lit(1)), "least": F.min("value"), "most": F.max("value"), "total": F.round(F.sum("value"), 4)}
    _land_and_run(spark, "state-rollup", ev.schema, landings,
                  lambda s, ck: rollup_state(spark, s, out, ["user_id"], "ts", "hour", aggs, ck))
    return spark.read.parquet(out).drop("_bucket")


_LATE = """late AS (SELECT event_id, CASE WHEN event_type <> 'signup' THEN ts END AS ts,
      CASE WHEN event_type <> 'error' THEN user_id END AS user_id, event_type, value FROM events)"""

SQL["q_state_rollup"] = f"""WITH {_LATE}
    SELECT user_id, date_trunc('hour', ts) AS period_start, count(*) AS n, min(value) AS least, max(value) AS most,
      {_round('sum(value)', 4)} AS total
    FROM (SELECT * FROM late UNION ALL SELECT * FROM late WHERE event_type = 'purchase') GROUP BY 1, 2"""


def q_state_dedupe(spark, d):
    """2.12: each event once from keyed state over two runs; corrected repeats
    come later, and all events without identifier count as one."""
    ev, landings = _late_feed(spark, d)
    ev = ev.withColumn("event_id", F.when(F.col("user_id").isNull() & (F.col("value") < 20), None).otherwise(F.col("event_id")))
    again = ev.withColumn("value", F.col("value") + 1).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 SECOND"))
    kind, late = F.col("event_type"), F.coalesce(F.dayofmonth("ts") <= 10, F.lit(False))
    landings = [[ev.filter(~late), again.filter(kind != "view")], [ev.filter(late), again.filter(kind == "purchase")]]
    out = scratch_path(spark, "state-dedupe")
    _land_and_run(spark, "state-dedupe", ev.schema, landings,
                  lambda s, ck: earliest_state(spark, s, out, ["event_id"], "ts", ck))
    return spark.read.parquet(out).select("event_id", "ts", "user_id", "event_type", "value")


SQL["q_state_dedupe"] = f"""WITH {_LATE},
    named AS (SELECT * REPLACE (CASE WHEN user_id IS NOT NULL OR value >= 20 THEN event_id END AS event_id) FROM late),
    every AS (SELECT * FROM named UNION ALL SELECT * REPLACE (value + 1 AS value, ts + INTERVAL 1 SECOND AS ts) FROM named)
    SELECT event_id, ts, user_id, event_type, value FROM every
    QUALIFY row_number() OVER (PARTITION BY event_id
      ORDER BY ts NULLS LAST, user_id NULLS FIRST, event_type NULLS FIRST, value NULLS FIRST) = 1"""

def q_fill_forward_burst(spark, d):
    """Values filled forward where one key has two fifths of the rows,
    half of them within one hour, and a fifth has no key; timelines are split
    at 500 rows."""
    ev = table(spark, d, "events")
    kind, at = F.col("event_type"), F.unix_micros(F.col("ts").cast("timestamp"))
    rows = ev.select(F.when(kind.isin("click", "view"), 0).when(kind != "error", F.col("user_id")).alias("k"),
                     F.when(kind == "click", at % 3_600_000_000).otherwise(at).alias("t"), "event_id",
                     F.when(F.col("value") < 20, F.col("value")).alias("filled"))
    return cdc.fill_forward(rows, ["k"], ["t", "event_id"], ["filled"], rows_per_bucket=500)


SQL["q_fill_forward_burst"] = """WITH r AS (
      SELECT CASE WHEN event_type IN ('click', 'view') THEN 0 WHEN event_type <> 'error' THEN user_id END AS k,
        CASE WHEN event_type = 'click' THEN epoch_us(ts) % 3600000000 ELSE epoch_us(ts) END AS t, event_id,
        CASE WHEN value < 20 THEN value END AS v FROM events)
    SELECT k, t, event_id, last_value(v IGNORE NULLS) OVER (PARTITION BY k ORDER BY t, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM r"""


def q_heavy_keys(spark, d):
    """All customers with more than one in 1,400 orders, from a sketch
    and an exact count of its candidates; orders of low priority count as without customer."""
    o = table(spark, d, "orders")
    key = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("o_custkey")
    n = o.count()
    return heavy_keys(o.select(key), ["o_custkey"], n // 1400 + 1, n)


SQL["q_heavy_keys"] = """SELECT o_custkey, count(*) AS n
    FROM (SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS o_custkey FROM orders) GROUP BY 1
    HAVING count(*) >= (SELECT count(*) FROM orders) // 1400 + 1"""

def q_scd2_reopen(spark, d):
    """C3 with L8: customers whose pending orders delete them and later orders
    bring them back, in three batches out of order (finished orders last)."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    ch = o.withColumn("_change_type", F.when(F.col("o_orderstatus") == "P", "delete").otherwise("update_postimage"))
    out, status = None, F.coalesce(F.col("o_orderstatus"), F.lit("-"))
    for part in (status == "P", ~status.isin("P", "F"), status == "F"):
        out = cut_lineage(episodes.reopen_apply(out, ch.filter(part), ["o_custkey"], "o_orderdate",
                                                ["o_orderkey", "o_totalprice", "o_orderpriority"], "_change_type"), "reopen")
    return out.drop("o_orderdate")


SQL["q_scd2_reopen"] = """WITH ev AS (
      SELECT o_custkey, o_orderdate AS t, coalesce(o_orderstatus = 'P', false) AS gone, o_orderkey, o_totalprice, o_orderpriority
      FROM orders WHERE o_orderdate IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate
        ORDER BY coalesce(o_orderstatus = 'P', false) DESC, o_orderkey DESC) = 1),
    seen AS (
      SELECT *, lag(gone) OVER w AS before, lead(t) OVER w AS next, lead(gone) OVER w AS next_gone
      FROM ev WINDOW w AS (PARTITION BY o_custkey ORDER BY t)),
    island AS (
      SELECT *, max(CASE WHEN NOT gone AND coalesce(before, true) THEN t END)
        OVER (PARTITION BY o_custkey ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS opened FROM seen)
    SELECT o_custkey, CASE WHEN NOT gone THEN o_orderkey END AS o_orderkey, CASE WHEN NOT gone THEN o_totalprice END AS o_totalprice,
      CASE WHEN NOT gone THEN o_orderpriority END AS o_orderpriority, t AS start_at,
      CASE WHEN NOT gone THEN next - INTERVAL 1 MILLISECOND END AS end_at, NOT gone AND next IS NULL AS is_current,
      gone AS _is_delete, CASE WHEN NOT gone THEN opened END AS episode_start,
      CASE WHEN NOT gone THEN CASE WHEN next_gone THEN 'delete' WHEN next IS NOT NULL THEN 'update' END END AS ended_by
    FROM island"""


def q_snapshot_diff_tree(spark, d):
    """C1 by digest tree: the change feed between two customer snapshots."""
    old, new = _customer_snapshots(spark, d)
    return cdc.snapshot_diff_tree(old, new, ["c_custkey"], version=1)


SQL["q_snapshot_diff_tree"] = ORACLE_SQL["q_snapshot_diff"]


def q_expectations(spark, d):
    """2.15: events written under three rules; counts of the write itself,
    and what it kept."""
    ev, path = table(spark, d, "events"), scratch_path(spark, "expected")
    rules = {"small_value": (expectations.WARN, F.col("value") <= 100),
             "known_kind": (expectations.DROP, F.col("event_type").isin("click", "view", "purchase")),
             "has_id": (expectations.FAIL, F.col("event_id").isNotNull())}
    got = expectations.publish_expected(ev, path, rules)
    written = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("written"), F.round(F.sum("value"), 3).alias("value_sum"))
    return got.crossJoin(F.broadcast(written))          # one row


SQL["q_expectations"] = f"""WITH rules AS (
      SELECT 'small_value' AS rule, 'warn' AS action, count(*) FILTER (NOT coalesce(value <= 100, false)) AS bad FROM events
      UNION ALL SELECT 'known_kind', 'drop', count(*) FILTER (NOT coalesce(event_type IN ('click', 'view', 'purchase'), false)) FROM events
      UNION ALL SELECT 'has_id', 'fail', count(*) FILTER (event_id IS NULL) FROM events)
    SELECT rule, action, (SELECT count(*) FROM events) AS rows, bad, kept, kept AS written, value_sum FROM rules,
      (SELECT count(*) AS kept, {_round('sum(value)', 3)} AS value_sum FROM events WHERE event_type IN ('click', 'view', 'purchase'))"""

def q_as_of_merge(spark, d):
    """J2 as a merge of sorted streams: the customer version valid at each
    shipment, timelines cut every 5,000 facts."""
    facts = _line_facts(spark, d)
    dim = customer_scd2(spark, d).filter(~F.col("_is_delete"))
    out = asof.as_of_merge(facts, dim, ["o_custkey"], "l_shipdate", "start_at", ["o_orderkey", "o_totalprice"],
                           prefix="v_", rows_per_part=5_000)
    return out.select("l_orderkey", "l_linenumber", "o_custkey", "l_shipdate", "v_o_orderkey", "v_o_totalprice")


SQL["q_as_of_merge"] = f"""WITH {SCD2_SQL},
    f AS (SELECT l_orderkey, l_linenumber, o_custkey, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT f.l_orderkey, f.l_linenumber, f.o_custkey, f.l_shipdate, v.o_orderkey AS v_o_orderkey, v.o_totalprice AS v_o_totalprice
    FROM f ASOF LEFT JOIN scd2 v ON f.o_custkey = v.o_custkey AND f.l_shipdate >= v.start_at"""

def q_pack(spark, d):
    """Q10: orders in one large and 24 small files; the small ones are packed
    in an order by date and price, the large one is not touched."""
    o, path = table(spark, d, "orders"), scratch_path(spark, "pack")
    finished = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    o.filter(finished).coalesce(1).write.parquet(path)
    large = pack.list_files(spark, path).first()
    o.filter(~finished).repartition(24, "o_orderkey").write.mode("append").parquet(path)
    replaced = pack.pack(spark, path, large.length, cluster_by=["o_orderdate", "o_totalprice"])
    files = pack.list_files(spark, path)
    untouched = files.filter((F.col("path") == large.path) & (F.col("length") == large.length)).count()
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit(replaced).cast("long").alias("replaced"),
                                           F.lit(untouched).cast("long").alias("untouched"))


SQL["q_pack"] = """SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(24 AS BIGINT) AS replaced, CAST(1 AS BIGINT) AS untouched
    FROM orders"""

QUERIES = {name: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)}
