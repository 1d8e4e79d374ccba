"""End to end: the freight mart's jobs over two incremental landing batches."""

import json
import os
import time

from pyspark.sql import functions as F

from lakemart.plans import freight
from lakemart.session import scratch_path


def _write(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        for r in rows:
            fh.write(json.dumps(r) + "\n")


def _order(oid, status, ts, cust=1, orig="Minas Tirith", dest="Edoras", delivery=None):
    return {"order_id": oid, "customer_id": cust, "product_code": "P1", "product_name": "Lembas",
            "quantity": 2, "total_amount": 10.5, "status": status, "payment_method": "card",
            "origin_city": orig, "destination_city": dest, "order_date": "2024-03-01T08:00:00",
            "delivery_date": delivery, "_change_type": "UPDATE", "_change_ts": ts}


def _reading(rid, veh, ts, speed, odo, status="moving"):
    return {"reading_id": rid, "vehicle_id": veh, "reading_timestamp": ts, "speed_kmh": speed,
            "fuel_pct": 50.0, "engine_temp_c": 90.0, "cargo_temp_c": None, "odometer_km": odo,
            "vehicle_status": status}


def _vehicle(vid, model, updated):
    return {"vehicle_id": vid, "plate_number": f"PL-{vid}", "model": model, "vehicle_type": "truck",
            "home_depot": "Bree", "capacity_kg": 1000, "cold_chain_capable": True,
            "commissioned_date": "2020-01-01T00:00:00", "last_updated": updated}


def _customers(spark, rows):
    return spark.createDataFrame(rows, freight.CUSTOMERS)


def test_freight_jobs_two_batches(spark, tmp_path):
    import datetime as dt
    root = scratch_path(spark, "freight")
    land = str(tmp_path / "landing")
    start, end = freight.today_window()
    d = dt.datetime

    # ---- batch 1
    _write(f"{land}/orders", "b1.json", [
        _order("ORD-1", "created", "2024-03-01T08:00:00"),
        _order("ORD-1", "confirmed", "2024-03-01T09:00:00"),
        _order("ORD-2", "created", "2024-03-02T08:00:00", cust=2, orig="Nowhere", dest=""),   # L16
        _order("ORD-3", "created", "2024-03-02T08:00:00", cust=3, orig="Gondolin"),
        _order(None, "created", "2024-03-02T08:00:00")])
    _write(f"{land}/shipment_events", "b1.json", [
        {"event_id": "E1", "order_id": "ORD-1", "vehicle_id": "V1", "event_type": "gps_ping",
         "event_timestamp": "2024-03-01T10:00:00", "latitude": 1.0, "longitude": 2.0,
         "source_system": "a"},
        {"event_id": "E1", "order_id": "ORD-1", "vehicle_id": "V1", "event_type": "gps_ping",
         "event_timestamp": "2024-03-01T10:05:00", "latitude": 1.0, "longitude": 2.0,
         "source_system": "b"},
        {"event_id": "E2", "order_id": "ORD-2", "vehicle_id": None, "event_type": "temperature_alert",
         "event_timestamp": "2024-03-02T10:00:00", "temperature_celsius": 999.0, "source_system": "a"}])
    _write(f"{land}/telemetry", "b1.json", [
        _reading("R1", "V1", "2024-03-01T10:05:00", 50.0, 100),
        _reading("R2", "V1", "2024-03-01T10:40:00", 900.0, 130),      # bad speed -> NULL
        _reading("R3", "V2", "2024-03-01T11:00:00", 10.0, 5, "idle")])
    _write(f"{land}/vehicles", "b1.json", [_vehicle("V1", "Oliphaunt", "2024-01-01T00:00:00"),
                                           _vehicle("V2", "Mule", "2024-01-01T00:00:00")])
    t_ingest1 = time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime(time.time() - 1))
    for feed, schema in (("orders", freight.ORDERS), ("shipment_events", freight.EVENTS),
                         ("telemetry", freight.TELEMETRY), ("vehicles", freight.VEHICLES)):
        freight.ingest_feed(spark, root, f"{land}/{feed}", feed, schema)
    a1 = freight.audit_batch(spark, root, "shipment_events", "b1", t_ingest1).first()
    assert (a1.rows_added, a1.duplicates, a1.bad_records) == (3, 1, 1)
    assert a1.classification == "bad_records,duplicates"
    freight.ingest_customer_snapshot(spark, root, _customers(spark, [
        (1, "Prancing Pony", "a@x", "1 Road", "Bree", "1", "premium", "inn", d(2020, 1, 1), d(2024, 2, 1)),
        (2, "Bag End", "b@x", "2 Hill", "Hobbiton", "2", "standard", "home", d(2020, 1, 1), d(2024, 2, 1)),
        (3, "Green Dragon", "c@x", "3 Lane", "Bywater", "3", "standard", "inn", d(2020, 1, 1), d(2024, 2, 1)),
    ]), version=1)
    freight.run_all(spark, root, start, end)
    mark = time.time()
    time.sleep(1.1)

    # ---- batch 2
    _write(f"{land}/orders", "b2.json", [
        dict(_order("ORD-1", "delivered", "2024-03-03T09:00:00", delivery="2024-03-03T09:00:00"),
             source_batch="B2"),                                                  # drifted column
        _order("ORD-1", "picked_up", "2024-03-02T09:00:00")])                    # late change
    _write(f"{land}/telemetry", "b2.json", [_reading("R4", "V1", "2024-03-01T10:50:00", 70.0, 140)])  # late
    _write(f"{land}/shipment_events", "b2.json", [   # E1 delivered again, later
        {"event_id": "E1", "order_id": "ORD-1", "vehicle_id": "V1", "event_type": "gps_ping",
         "event_timestamp": "2024-03-01T11:00:00", "latitude": 1.0, "longitude": 2.0, "source_system": "c"}])
    _write(f"{land}/vehicles", "b2.json", [_vehicle("V1", "Mumak", "2024-02-01T00:00:00"),
                                           _vehicle("V2", "Old", "2023-01-01T00:00:00")])   # stale V2
    t_ingest2 = time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime(time.time() - 1))
    drift = freight.ingest_feed(spark, root, f"{land}/orders", "orders", freight.ORDERS, evolve=True)
    assert drift == "added column 'source_batch'"
    for feed, schema in (("telemetry", freight.TELEMETRY),
                         ("vehicles", freight.VEHICLES), ("shipment_events", freight.EVENTS)):
        freight.ingest_feed(spark, root, f"{land}/{feed}", feed, schema)
    a2 = freight.audit_batch(spark, root, "orders", "b2", t_ingest2, drift).first()
    assert a2.classification == "schema_drift" and a2.active_extra_columns == "source_batch"
    from lakemart.sources.schema import drift_state
    st = {r.source: r.extra_columns for r in drift_state(spark.read.parquet(f"{root}/audit")).collect()}
    assert st == {"orders": ["source_batch"], "shipment_events": []}
    freight.ingest_customer_snapshot(spark, root, _customers(spark, [
        (1, "Prancing Pony Inn", "a@x", "1 Road", "Bree", "1", "premium", "inn", d(2020, 1, 1),
         d(2024, 3, 2)),
        (3, "Green Dragon", "c@x", "3 Lane", "Bywater", "3", "standard", "inn", d(2020, 1, 1), d(2024, 2, 1)),
    ]), version=2)                                                               # customer 2 deleted
    since = time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime(mark))
    freight.run_all(spark, root, start, end, touched_since=since)

    rd = lambda *p: freight._read(spark, "/".join([root, *p]))

    # silver orders: one current version per order, history in order, no NULL key
    so = rd("silver", "orders")
    assert so.filter(F.col("order_id").isNull()).count() == 0
    cur = {r.order_id: r.status for r in so.filter("is_current").collect()}
    assert cur == {"ORD-1": "delivered", "ORD-2": "created", "ORD-3": "created"}
    hist = [r.status for r in so.filter("order_id = 'ORD-1'").orderBy("start_at").collect()]
    assert hist == ["created", "confirmed", "picked_up", "delivered"]

    # silver vehicles: newer record wins, stale one ignored
    sv = {r.vehicle_id: r.model for r in rd("silver", "vehicles").collect()}
    assert sv == {"V1": "Mumak", "V2": "Mule"}

    # silver events: earliest delivery of a duplicated id; temp 999 passes through
    se = {r.event_id: r.source_system for r in rd("silver", "shipment_events").collect()}
    assert se == {"E1": "a", "E2": "a"}

    # silver customers: update versioned, deleted customer flagged, not current
    sc = rd("silver", "customers")
    assert sc.filter("customer_id = 1").count() == 2
    assert sc.filter("customer_id = 2 AND is_current").count() == 0
    assert sc.filter("customer_id = 2").first()._is_delete

    # gold: location dim has the unknown member, fact joins exact city (NULL if unmatched)
    dl = {r.city for r in rd("gold", "dim_location").collect()}
    assert dl == {"unknown", "Minas Tirith", "Edoras"}    # Nowhere: blank partner city (L16)
    fo = {r.order_id: r for r in rd("gold", "fact_order_fulfillment").collect()}
    assert set(fo) == {"ORD-1", "ORD-3"}                  # ORD-2 erased with customer 2
    assert fo["ORD-3"].orig_location_sk is None and fo["ORD-3"].dest_location_sk is not None  # L15
    assert not fo["ORD-3"].is_on_time                     # undelivered (L19)
    o1 = fo["ORD-1"]
    assert o1.current_status == "delivered" and o1.delivered_ts is not None
    assert o1.picked_up_ts is not None and o1.confirmed_ts is not None
    assert o1.orig_location_sk is not None and o1.customer_sk is not None
    assert o1.delivery_days == 2 and o1.is_on_time

    # erasure: no residue of customer 2 anywhere in gold
    assert rd("gold", "dim_customer").filter("customer_id = 2").count() == 0
    # incremental dims: customer 1's old version was closed by the upsert
    c1 = sorted((r.company_name, r.is_current) for r in rd("gold", "dim_customer")
                .filter("customer_id = 1").collect())
    assert c1 == [("Prancing Pony", False), ("Prancing Pony Inn", True)]
    assert {r.vehicle_id: r.model for r in rd("gold", "dim_vehicle").collect()} == {"V1": "Mumak", "V2": "Mule"}

    # telemetry: the late reading re-aggregates the whole hour from silver
    ft = {(r.vehicle_id, r.period_start_timestamp.hour): r for r in rd("gold", "fact_vehicle_telemetry").collect()}
    h = ft[("V1", 10)]
    assert h.readings_count == 3 and h.max_speed_kmh == 70.0 and h.km_driven == 40
    assert ft[("V2", 11)].active_readings == 0 and ft[("V2", 11)].vehicle_sk is not None

    # shipment fact keeps one row per event with keys
    fe = {r.event_id: r for r in rd("gold", "fact_shipment_event").collect()}
    assert fe["E1"].vehicle_sk is not None and fe["E2"].vehicle_sk is None
    assert fe["E1"].date_key == 20240301
