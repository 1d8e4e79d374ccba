from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.cleanse import (TELEMETRY_RANGES, add_flags, enforce_schema, enrich_telemetry, live_rows,
                                        deleted_rows, normalize_telemetry, require_non_blank)
from tests.conftest import rows

RAW = "reading_id string, vehicle_id string, reading_timestamp string, speed_kmh string, " \
      "engine_temp_c string, cargo_temp_c string, fuel_pct string, odometer_km string, vehicle_status string"


def test_telemetry_bounds(spark):
    """Each range keeps its ends and turns what lies beyond into NULL; the
    other columns of the row stay."""
    fields = [f.split()[0] for f in RAW.split(", ")]
    base = {"reading_id": "x", "vehicle_id": "v", "reading_timestamp": "2024-05-05 05:05:05", "speed_kmh": "10",
            "engine_temp_c": "20", "cargo_temp_c": "3", "fuel_pct": "40", "odometer_km": "5", "vehicle_status": "moving"}
    cases = []
    for col, (lo, hi) in TELEMETRY_RANGES.items():
        for value, inside in ((lo, True), (hi, True), (lo - 1, False), (hi + 1, False), (None, False)):
            cases.append((col, value, inside))
    data = [tuple({**base, "reading_id": str(i), col: None if v is None else str(v)}[f] for f in fields)
            for i, (col, v, _) in enumerate(cases)]
    data.append(tuple({**base, "reading_id": None}[f] for f in fields))
    got = {r.reading_id: r for r in normalize_telemetry(spark.createDataFrame(data, RAW)).collect()}
    assert set(got) == {str(i) for i in range(len(cases))}
    for i, (col, v, inside) in enumerate(cases):
        row = got[str(i)]
        assert row[col] == (float(v) if inside else None)
        for other in set(TELEMETRY_RANGES) - {col}:
            assert row[other] == float(base[other])


def test_enrich_flags_null_safe(spark):
    df = spark.createDataFrame(
        [(120.0, 110.0, None), (121.0, 111.0, 3.0), (None, None, None)],
        "speed_kmh double, engine_temp_c double, cargo_temp_c double") \
        .withColumn("reading_timestamp", F.lit("2024-03-04 05:06:07").cast("timestamp"))
    out = enrich_telemetry(df).collect()
    assert [(r.speed_limit_exceed, r.engine_overheat, r.is_cold_chain_cargo) for r in out] == [
        (False, False, False), (True, True, True), (False, False, False)]
    assert str(out[0].reading_date) == "2024-03-04"


def test_enforce_schema_try_cast_and_pack(spark):
    df = spark.createDataFrame([("1", "x", "extra")], "a string, b string, c string")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
                           T.StructField("d", T.DateType())])
    out = enforce_schema(df, schema, extra="pack").first()
    assert (out.a, out.b, out.d) == (1, None, None)
    assert out._extra == '{"c":"extra"}'


def test_require_non_blank_and_delete_filters(spark):
    df = spark.createDataFrame([("a", True), ("", False), (None, None)], "c string, _is_delete boolean")
    assert rows(require_non_blank(df, ["c"]), "c") == [("a",)]
    assert rows(live_rows(df), "c") == [("",), (None,)]
    assert rows(deleted_rows(df), "c") == [("a",)]


def test_add_flags_null_to_false(spark):
    df = spark.createDataFrame([(None,), (3,)], "v int")
    assert rows(add_flags(df, {"big": F.col("v") > 1}), "big") == [(False,), (True,)]
