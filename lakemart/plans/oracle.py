"""Independent DuckDB SQL for the catalogue entries (the correctness gate).

Each statement reads the same Parquet tables (pre-registered views) and
produces the same column names and types as the Spark query.
"""

from __future__ import annotations

from lakemart.plans.catalog import (DOC_SQL, EV_COPIES_SQL, JSON_SQL, SCD2_DEL_SQL, SCD2_SQL,
                                    TELEMETRY_SQL, _md5_key, _nrm_sql)

_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_CUST_COLS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
_EVENT_COLS = "event_id, ts, user_id, event_type, value, props"
_SCD2_COLS = ("o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate, "
              "start_at, end_at, is_current, _is_delete, _delete_seq")
_SCD2D_COLS = "user_id, event_id, event_type, value, ts, start_at, end_at, is_current, _is_delete, _delete_seq"

_CAL_SQL = """cal AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
         CAST(year(full_date) AS INTEGER) AS year, CAST(month(full_date) AS INTEGER) AS month,
         strftime(full_date, '%B') AS month_name, CAST(weekofyear(full_date) AS INTEGER) AS iso_week,
         CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week,
         dayofweek(full_date) IN (0, 6) AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS full_date
        FROM (SELECT CAST(min(d) AS DATE) AS lo, CAST(max(d) AS DATE) AS hi FROM ({src}))))"""


def _cal(src: str) -> str:
    return _CAL_SQL.format(src=src)


_TELEMETRY_SILVER = f"""WITH {TELEMETRY_SQL}
SELECT *, cargo_temp_c IS NOT NULL AS is_cold_chain_cargo,
       coalesce(speed_kmh > 120, false) AS speed_limit_exceed,
       coalesce(engine_temp_c > 110, false) AS engine_overheat,
       CAST(reading_timestamp AS DATE) AS reading_date
FROM silver"""

def _round(expr: str, d: int) -> str:
    """Half-up rounding of the value's decimal form (Spark's ``round`` on
    doubles); DuckDB's double ``round`` works on the binary value instead."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {d}) AS DOUBLE)"


_SNAP = f"""o AS (SELECT {_CUST_COLS} FROM customer WHERE c_mktsegment <> 'BUILDING'),
n AS (SELECT c_custkey, c_name, c_nationkey,
             CASE WHEN c_nationkey < 5 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment
      FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'),
chg AS (
  SELECT n.*, 'insert' AS _change_type FROM n WHERE c_custkey NOT IN (SELECT c_custkey FROM o)
  UNION ALL
  SELECT o.*, 'delete' FROM o WHERE c_custkey NOT IN (SELECT c_custkey FROM n)
  UNION ALL
  SELECT o.*, 'update_preimage' FROM o JOIN n USING (c_custkey)
  WHERE (o.c_name, o.c_nationkey, o.c_acctbal, o.c_mktsegment)
        IS DISTINCT FROM (n.c_name, n.c_nationkey, n.c_acctbal, n.c_mktsegment)
  UNION ALL
  SELECT n.*, 'update_postimage' FROM o JOIN n USING (c_custkey)
  WHERE (o.c_name, o.c_nationkey, o.c_acctbal, o.c_mktsegment)
        IS DISTINCT FROM (n.c_name, n.c_nationkey, n.c_acctbal, n.c_mktsegment))"""

_DIM_CUSTOMER = f"""WITH {SCD2_SQL}
SELECT {_md5_key('o_custkey', 'start_at')} AS customer_sk, {_SCD2_COLS}
FROM scd2 WHERE NOT coalesce(_is_delete, false)"""

_SILVER_VEHICLES = """SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 1 AS version FROM supplier"""

_FACT_ORDER = f"""WITH {SCD2_SQL},
dimc AS (SELECT {_md5_key('o_custkey', 'start_at')} AS customer_sk, o_custkey, start_at,
                lead(start_at) OVER (PARTITION BY o_custkey ORDER BY start_at) AS next_start
         FROM scd2),
li AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC,
                  l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
       FROM lineitem),
piv AS (SELECT l_orderkey,
               max(l_shipdate) FILTER (WHERE l_returnflag = 'A') AS A_ts,
               max(l_shipdate) FILTER (WHERE l_returnflag = 'N') AS N_ts,
               max(l_shipdate) FILTER (WHERE l_returnflag = 'R') AS R_ts,
               max(CASE WHEN rn = 1 THEN l_returnflag END) AS current_status,
               max(CASE WHEN rn = 1 THEN l_quantity END) AS l_quantity,
               max(CASE WHEN rn = 1 THEN l_extendedprice END) AS l_extendedprice,
               max(l_shipdate) AS l_shipdate
        FROM li GROUP BY l_orderkey),
{_cal("SELECT l_shipdate AS d FROM lineitem UNION ALL SELECT o_orderdate FROM orders")}
SELECT o.o_orderkey, dc.customer_sk, c.c_nationkey AS cust_nation_key,
       od.date_key AS order_date_key, dd.date_key AS delivery_date_key, o.o_totalprice,
       p.A_ts, p.N_ts, p.R_ts, p.current_status, p.l_quantity, p.l_extendedprice,
       p.l_shipdate AS last_ship_ts,
       CAST(date_diff('day', o.o_orderdate, p.l_shipdate) AS INTEGER) AS delivery_days,
       coalesce(date_diff('day', o.o_orderdate, p.l_shipdate) <= 30, false) AS is_on_time
FROM orders o
LEFT JOIN piv p ON o.o_orderkey = p.l_orderkey
LEFT JOIN dimc dc ON o.o_custkey = dc.o_custkey AND dc.start_at <= o.o_orderdate
                 AND (dc.next_start IS NULL OR o.o_orderdate < dc.next_start)
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN cal od ON CAST(o.o_orderdate AS DATE) = od.full_date
LEFT JOIN cal dd ON CAST(p.l_shipdate AS DATE) = dd.full_date"""

_DIM_LOCATION = f"""WITH p AS (
  SELECT cn.n_name AS origin_city,
         CASE WHEN sn.n_regionkey = 3 THEN '' ELSE sn.n_name END AS destination_city
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey JOIN nation sn ON s.s_nationkey = sn.n_nationkey),
pn AS (SELECT * FROM p WHERE origin_city IS NOT NULL AND origin_city <> ''
                         AND destination_city IS NOT NULL AND destination_city <> ''),
cities AS (SELECT origin_city AS city FROM pn UNION SELECT destination_city FROM pn),
lk AS (SELECT lower(n.n_name) AS city, r.r_name AS realm_name, substring(r.r_name, 1, 2) AS realm_code,
              r.r_name AS region, 'lang_' || CAST(r.r_regionkey AS VARCHAR) AS language_region
       FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_regionkey < 3),
dl AS (SELECT DISTINCT coalesce(lk.city, 'unknown') AS city, lk.realm_name, lk.realm_code, lk.region,
              lk.language_region
       FROM cities LEFT JOIN lk ON {_nrm_sql('cities.city')} = {_nrm_sql('lk.city')})
SELECT md5(city) AS location_sk, city, realm_name, realm_code, region, language_region FROM dl"""

ORACLE_SQL: dict[str, str] = {
    "q_dedupe_latest": f"""SELECT {_ORDER_COLS} FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders) WHERE rn = 1""",

    "q_dedupe_earliest": f"""WITH {EV_COPIES_SQL}
        SELECT {_EVENT_COLS} FROM (
          SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts ASC NULLS LAST, value ASC NULLS LAST) AS rn
          FROM ev) WHERE rn = 1""",

    "q_distinct_rows": "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer",

    "q_distinct_key": f"""SELECT {_CUST_COLS} FROM (
        SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn FROM customer)
        WHERE rn = 1""",

    "q_latest_per_key": f"""SELECT {_EVENT_COLS} FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1""",

    "q_sample_n": f"SELECT {_ORDER_COLS} FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100",

    "q_read_window": f"""SELECT {_ORDER_COLS} FROM orders
        WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'""",

    "q_read_window_dedupe": f"""SELECT {_EVENT_COLS} FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
        WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20') WHERE rn = 1""",

    "q_require_keys": f"""WITH {DOC_SQL}
        SELECT doc_id, lang, source, text FROM docs
        WHERE text IS NOT NULL""",

    "q_non_blank": f"""WITH {DOC_SQL}
        SELECT doc_id, lang, source, text FROM docs
        WHERE text IS NOT NULL AND text <> ''""",

    "q_live_rows": f"WITH {SCD2_DEL_SQL} SELECT {_SCD2D_COLS} FROM scd2d WHERE NOT coalesce(_is_delete, false)",

    "q_deleted_rows": f"WITH {SCD2_DEL_SQL} SELECT {_SCD2D_COLS} FROM scd2d WHERE coalesce(_is_delete, false)",

    "q_snapshot_diff": f"""WITH {_SNAP}
        SELECT {_CUST_COLS}, _change_type, CAST(1 AS BIGINT) AS _commit_version FROM chg""",

    "q_split_changes": f"""WITH {_SNAP}
        SELECT {_CUST_COLS}, _change_type, CAST(1 AS BIGINT) AS _commit_version FROM chg
        WHERE _change_type NOT IN ('update_preimage', 'delete')""",

    "q_enforce_schema": """SELECT CAST(event_id AS BIGINT) AS event_id,
        CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS ts,
        user_id, event_type, CASE WHEN event_type = 'view' THEN NULL ELSE value END AS value
        FROM events""",

    "q_null_out_of_range": """SELECT event_id, user_id, ts,
        CASE WHEN value < 1 OR value > 100 THEN NULL ELSE value END AS value FROM events""",

    "q_add_flags": """SELECT event_id, coalesce(CASE WHEN event_type <> 'view' THEN value END > 50, false) AS is_high,
        CAST(ts AS DATE) AS event_date FROM events""",

    "q_status_timestamps": """SELECT event_id, event_type, ts,
        CASE WHEN event_type = 'signup' THEN ts END AS signup_ts,
        CASE WHEN event_type = 'error' THEN ts END AS error_ts,
        CASE WHEN event_type = 'click' THEN ts END AS click_ts,
        CASE WHEN event_type = 'view' THEN ts END AS view_ts,
        CASE WHEN event_type = 'purchase' THEN ts END AS purchase_ts FROM events""",

    "q_normalize_str": f"SELECT conv_id, turn, {_nrm_sql('text')} AS nrm_text FROM conversations",

    "q_surrogate_key": f"SELECT {_md5_key('o_custkey', 'o_orderdate')} AS order_sk, o_orderkey FROM orders",

    "q_dim_date": f"WITH {_cal('SELECT o_orderdate AS d FROM orders')} SELECT * FROM cal",

    "q_date_parts": """SELECT l.l_orderkey, l.l_linenumber, date_trunc('hour', l.l_shipdate) AS ship_hour,
        CAST(l.l_shipdate AS DATE) AS ship_date,
        CAST(date_diff('day', o.o_orderdate, l.l_shipdate) AS INTEGER) AS ship_days,
        l.l_shipdate - INTERVAL 1 MILLISECOND AS ship_minus_ms
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",

    "q_parse_json_rescued": f"""WITH {JSON_SQL}
        SELECT event_id,
          CASE WHEN json_valid(raw) THEN TRY_CAST(json_extract_string(raw, '$.k') AS INTEGER) END AS k,
          CASE WHEN json_valid(raw) THEN NULLIF(array_to_string(list_sort(list_filter(json_keys(raw),
               lambda x: x <> 'k' OR (TRY_CAST(json_extract_string(raw, '$.k') AS INTEGER) IS NULL
                                      AND json_extract_string(raw, '$.k') IS NOT NULL))), ','), '') END
            AS rescued_keys,
          NOT json_valid(raw) AS is_corrupt
        FROM j""",

    "q_quarantine": """SELECT event_id, concat_ws(',',
          CASE WHEN value > 400 THEN 'value_over_400' END,
          CASE WHEN event_type = 'error' THEN 'error_event' END,
          CASE WHEN hour(ts) < 6 THEN 'night_time' END) AS violations
        FROM events WHERE value > 400 OR event_type = 'error' OR hour(ts) < 6""",

    "q_with_lineage": "SELECT event_id, 'events.parquet' AS source_file FROM events",

    "q_lookup_table": """SELECT n.n_nationkey, n.n_name, c.region_code
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
        LEFT JOIN (VALUES ('AFRICA', 'AF'), ('AMERICA', 'AM'), ('ASIA', 'AS'), ('EUROPE', 'EU'),
                          ('MIDDLE EAST', 'ME')) c(r_name, region_code) ON r.r_name = c.r_name""",

    "q_touched_history": f"""SELECT {_ORDER_COLS} FROM orders WHERE o_custkey IN
        (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01')""",

    "q_as_of_join": """WITH v0 AS (
          SELECT o_custkey, o_orderdate AS start_at, o_orderpriority,
                 row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn
          FROM orders),
        v AS (SELECT o_custkey, start_at, o_orderpriority,
                     lead(start_at) OVER (PARTITION BY o_custkey ORDER BY start_at) AS next_start
              FROM v0 WHERE rn = 1),
        f AS (SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, l.l_shipdate
              FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
        SELECT f.l_orderkey, f.l_linenumber, f.o_custkey, f.l_shipdate,
               v.o_orderpriority AS v_o_orderpriority, v.start_at AS v_start_at
        FROM f LEFT JOIN v ON f.o_custkey = v.o_custkey AND v.start_at <= f.l_shipdate
                           AND (v.next_start IS NULL OR f.l_shipdate < v.next_start)""",

    "q_as_of_join_timeline": """WITH v0 AS (
          SELECT o_custkey, o_orderdate AS start_at, o_orderpriority,
                 row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn
          FROM orders),
        v AS (SELECT o_custkey, start_at, o_orderpriority,
                     lead(start_at) OVER (PARTITION BY o_custkey ORDER BY start_at) AS next_start
              FROM v0 WHERE rn = 1),
        f AS (SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, l.l_shipdate
              FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
        SELECT f.l_orderkey, f.l_linenumber, f.o_custkey, f.l_shipdate,
               v.o_orderpriority AS v_o_orderpriority, v.start_at AS v_start_at
        FROM f LEFT JOIN v ON f.o_custkey = v.o_custkey AND v.start_at <= f.l_shipdate
                           AND (v.next_start IS NULL OR f.l_shipdate < v.next_start)""",

    "q_role_playing": f"""WITH {_cal("SELECT l_shipdate AS d FROM lineitem UNION ALL SELECT o_orderdate FROM orders")}
        SELECT l.l_orderkey, l.l_linenumber, cn.n_name AS cust_nation, sn.n_name AS supp_nation,
               sd.date_key AS ship_date_key, od.date_key AS order_date_key
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        LEFT JOIN customer c ON o.o_custkey = c.c_custkey
        LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
        LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
        LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
        LEFT JOIN cal sd ON CAST(l.l_shipdate AS DATE) = sd.full_date
        LEFT JOIN cal od ON CAST(o.o_orderdate AS DATE) = od.full_date""",

    "q_dim_lookup": f"""WITH {_cal("SELECT ts AS d FROM events")}
        SELECT e.event_id, md5(CAST(c.c_custkey AS VARCHAR)) AS customer_sk, cal.date_key
        FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
        LEFT JOIN cal ON CAST(e.ts AS DATE) = cal.full_date""",

    "q_normalized_lookup": f"""WITH m AS (
          SELECT n_nationkey AS src_key,
                 CASE WHEN n_regionkey = 4 THEN replace(n_name, 'A', 'Ø')
                      ELSE translate(n_name, 'AIO', 'ÂÏÖ') END AS raw_name
          FROM nation)
        SELECT m.src_key, m.raw_name, l.n_nationkey, l.n_regionkey
        FROM m LEFT JOIN nation l ON {_nrm_sql('m.raw_name')} = {_nrm_sql('l.n_name')}""",

    "q_skew_join": """SELECT e.event_id, e.user_id, c.c_name, c.c_mktsegment
        FROM (SELECT event_id, CASE WHEN event_type IN ('view', 'click', 'error') THEN user_id % 5
                                    ELSE user_id END AS user_id FROM events) e
        LEFT JOIN customer c ON e.user_id = c.c_custkey""",

    "q_hourly_rollup": f"""SELECT user_id, date_trunc('hour', ts) AS period_start,
          count(event_id) AS events_count, {_round('avg(value / 7)', 6)} AS avg_value,
          max(value) AS max_value, min(value) AS min_value,
          count(*) FILTER (WHERE NOT coalesce(event_type IN ('view', 'click'), false)) AS active_events,
          {_round("CAST(count(*) FILTER (WHERE NOT coalesce(event_type IN ('view', 'click'), false)) AS DOUBLE) / count(event_id)", 2)} AS utilization_pct,
          CAST(date_trunc('hour', ts) AS DATE) AS period_date
        FROM events GROUP BY user_id, date_trunc('hour', ts)""",

    "q_hourly_rollup_by_type": f"""SELECT event_type, date_trunc('hour', ts) AS period_start,
          count(event_id) AS events_count, count(DISTINCT user_id) AS users,
          {_round('sum(value)', 4)} AS value_sum, max(value) AS max_value
        FROM events GROUP BY event_type, date_trunc('hour', ts)""",

    "q_high_water": """SELECT (SELECT max(o_orderdate) FROM orders) AS hw_orderdate,
        (SELECT max(CAST(substring(c_name, 10, 100) AS INTEGER)) FROM customer) AS max_cust_num""",

    "q_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                  "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]),

    "q_upsert": f"""SELECT {_ORDER_COLS} FROM orders WHERE o_orderstatus = 'F'
          AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
        UNION ALL
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority
        FROM orders WHERE o_orderpriority = '1-URGENT'""",

    "q_delete_matching": f"""SELECT {_ORDER_COLS} FROM orders
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",

    "q_update_matching": """SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus,
          CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderstatus = 'O' THEN s.new_price ELSE t.o_totalprice END
            AS o_totalprice,
          t.o_orderdate, t.o_orderpriority
        FROM orders t LEFT JOIN (SELECT o_orderkey, o_totalprice + 100 AS new_price FROM orders
                                 WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) s
          ON t.o_orderkey = s.o_orderkey""",

    "q_insert_missing": f"""SELECT {_ORDER_COLS} FROM orders WHERE o_orderstatus = 'F'
        UNION ALL
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority
        FROM orders WHERE o_orderpriority = '1-URGENT'
          AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",

    "q_scd1": f"""SELECT {_EVENT_COLS} FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1""",

    "q_scd2": f"WITH {SCD2_SQL} SELECT {_SCD2_COLS} FROM scd2",

    "q_scd2_deletes": f"WITH {SCD2_DEL_SQL} SELECT {_SCD2D_COLS} FROM scd2d",

    "q_fill_forward": """SELECT event_id, user_id, ts, event_type,
        last_value(CASE WHEN event_type <> 'view' THEN value END IGNORE NULLS) OVER (
          PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
        FROM events""",

    "q_milestone_pivot": """SELECT user_id,
        max(ts) FILTER (WHERE event_type = 'signup') AS signup_ts,
        max(ts) FILTER (WHERE event_type = 'error') AS error_ts,
        max(ts) FILTER (WHERE event_type = 'click') AS click_ts,
        max(ts) FILTER (WHERE event_type = 'view') AS view_ts,
        max(ts) FILTER (WHERE event_type = 'purchase') AS purchase_ts,
        arg_max(value, {'t': ts, 'e': event_id}) FILTER (WHERE value IS NOT NULL) AS value,
        arg_max(event_type, {'t': ts, 'e': event_id}) FILTER (WHERE event_type IS NOT NULL) AS current_status
        FROM events GROUP BY user_id""",

    "q_union_distinct": "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier",

    "q_dim_customer": _DIM_CUSTOMER,

    "q_silver_vehicles": _SILVER_VEHICLES,

    "q_dim_vehicle": f"""SELECT md5(CAST(s_suppkey AS VARCHAR)) AS vehicle_sk, * FROM ({_SILVER_VEHICLES})""",

    "q_dim_location": _DIM_LOCATION,

    "q_fact_order": _FACT_ORDER,

    "q_silver_events": f"""WITH {EV_COPIES_SQL}
        SELECT {_EVENT_COLS}, CAST(ts AS DATE) AS event_date FROM (
          SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts ASC NULLS LAST, value ASC NULLS LAST) AS rn
          FROM ev) WHERE rn = 1""",

    "q_fact_event": f"""WITH {EV_COPIES_SQL},
        s AS (SELECT {_EVENT_COLS}, CAST(ts AS DATE) AS event_date FROM (
          SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts ASC NULLS LAST, value ASC NULLS LAST) AS rn
          FROM ev) WHERE rn = 1),
        {_cal("SELECT ts AS d FROM s")}
        SELECT s.event_id, md5(CAST(c.c_custkey AS VARCHAR)) AS customer_sk, cal.date_key,
               s.ts, s.user_id, s.event_type, s.value, s.props, s.event_date
        FROM s LEFT JOIN customer c ON s.user_id = c.c_custkey
        LEFT JOIN cal ON s.event_date = cal.full_date""",

    "q_silver_telemetry": _TELEMETRY_SILVER,

    "q_fact_telemetry": f"""WITH {TELEMETRY_SQL},
        agg AS (
          SELECT vehicle_id, date_trunc('hour', reading_timestamp) AS period_start_timestamp,
                 count(reading_id) AS readings_count,
                 {_round('avg(speed_kmh)', 0)} AS avg_speed_kmh,
                 max(speed_kmh) AS max_speed_kmh,
                 {_round('avg(fuel_pct)', 2)} AS avg_fuel_pct,
                 {_round('avg(engine_temp_c)', 0)} AS avg_engine_temp_c,
                 min(cargo_temp_c) AS min_cargo_temp_c, max(cargo_temp_c) AS max_cargo_temp_c,
                 count(*) FILTER (WHERE NOT coalesce(vehicle_status IN ('idle', 'maintenance'), false))
                   AS active_readings,
                 max(odometer_km) - min(odometer_km) AS km_driven
          FROM silver GROUP BY vehicle_id, date_trunc('hour', reading_timestamp)),
        {_cal("SELECT reading_timestamp AS d FROM silver")}
        SELECT a.vehicle_id, a.period_start_timestamp, md5(CAST(c.c_custkey AS VARCHAR)) AS vehicle_sk,
               cal.date_key, a.readings_count, a.avg_speed_kmh, a.max_speed_kmh, a.avg_fuel_pct,
               a.avg_engine_temp_c, a.min_cargo_temp_c, a.max_cargo_temp_c, a.active_readings,
               a.km_driven,
               {_round("CAST(a.active_readings AS DOUBLE) / a.readings_count", 2)} AS utilization_pct,
               CAST(a.period_start_timestamp AS DATE) AS period_date
        FROM agg a LEFT JOIN customer c ON a.vehicle_id = CAST(c.c_custkey AS VARCHAR)
        LEFT JOIN cal ON CAST(a.period_start_timestamp AS DATE) = cal.full_date""",

    "q_erase": f"""SELECT o_orderkey, o_custkey, {_md5_key('o_custkey', 'o_orderdate')} AS customer_sk
        FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",

    "q_erase_dim": f"""WITH {SCD2_SQL}
        SELECT {_md5_key('o_custkey', 'start_at')} AS customer_sk, o_custkey, start_at FROM scd2
        WHERE NOT coalesce(_is_delete, false)
          AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",

    "q_check_pk": """SELECT l_orderkey, l_linenumber, count(*) AS rows,
          CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'null_key' ELSE 'duplicate' END AS reason
        FROM lineitem GROUP BY l_orderkey, l_linenumber
        HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",

    "q_check_fk_orphans": """SELECT o_orderkey, o_custkey FROM (
          SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN o_custkey + 1000 ELSE o_custkey END AS o_custkey
          FROM orders)
        WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)""",

    "q_health_audit": f"""WITH {EV_COPIES_SQL},
        b AS (SELECT max(ts) AS bt FROM ev)
        SELECT event_type AS source, CAST(count(*) AS BIGINT) AS rows_added,
          CAST(count(*) FILTER (WHERE value > 400) AS BIGINT) AS bad_records,
          CAST(count(*) - count(DISTINCT event_id) AS BIGINT) AS duplicates,
          CAST(count(*) FILTER (WHERE ts < (SELECT bt FROM b) - INTERVAL 20 DAYS) AS BIGINT) AS late_records,
          'none' AS drift_action,
          CASE WHEN concat_ws(',',
                 CASE WHEN count(*) FILTER (WHERE value > 400) > 0 THEN 'bad_records' END,
                 CASE WHEN count(*) - count(DISTINCT event_id) > 0 THEN 'duplicates' END,
                 CASE WHEN count(*) FILTER (WHERE ts < (SELECT bt FROM b) - INTERVAL 20 DAYS) > 0
                      THEN 'late_data' END) = '' THEN 'healthy'
               ELSE concat_ws(',',
                 CASE WHEN count(*) FILTER (WHERE value > 400) > 0 THEN 'bad_records' END,
                 CASE WHEN count(*) - count(DISTINCT event_id) > 0 THEN 'duplicates' END,
                 CASE WHEN count(*) FILTER (WHERE ts < (SELECT bt FROM b) - INTERVAL 20 DAYS) > 0
                      THEN 'late_data' END) END AS classification
        FROM ev GROUP BY event_type""",

    "q_key_share": f"""SELECT user_id, count(*) AS rows,
          {_round("CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM events)", 4)} AS share
        FROM events GROUP BY user_id ORDER BY rows DESC, user_id ASC LIMIT 5""",

    "q_compact": "SELECT * FROM lineitem",

    "q_stream_ingest": f"SELECT {_EVENT_COLS}, CAST(NULL AS VARCHAR) AS _rescued_data FROM events",

    "q_stream_dedupe": f"SELECT {_EVENT_COLS} FROM events",

    "q_stream_scd2": f"WITH {SCD2_SQL} SELECT {_SCD2_COLS} FROM scd2",

    "q_drift_state": f"""WITH {JSON_SQL},
        p AS (SELECT e.event_type AS source, CAST(e.ts AS DATE) AS batch,
                     CASE WHEN json_valid(j.raw) THEN list_filter(json_keys(j.raw),
                       lambda x: x <> 'k' OR (TRY_CAST(json_extract_string(j.raw, '$.k') AS INTEGER) IS NULL
                                              AND json_extract_string(j.raw, '$.k') IS NOT NULL)) END AS ks
              FROM j JOIN events e ON j.event_id = e.event_id),
        a AS (SELECT source, batch,
                     array_to_string(list_sort(list_distinct(flatten(list(coalesce(ks, []))))), ',') AS cols
              FROM p GROUP BY source, batch),
        l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY batch DESC) AS rn FROM a)
        SELECT source, cols AS extra_columns FROM l WHERE rn = 1""",
}
