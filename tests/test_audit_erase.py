import datetime as dt

from pyspark.sql import functions as F

from lakemart.operators.audit import (check_foreign_key, check_primary_key, health_audit,
                                      late_rows, rule_violations)
from lakemart.operators.erase import erase, residue
from tests.conftest import rows


def test_rule_violations_and_quarantine(spark):
    df = spark.createDataFrame([(1, -5.0, ""), (2, None, "x"), (3, 1.0, "y")], "id int, amount double, city string")
    rules = {"missing_amount": F.col("amount").isNull(), "negative_amount": F.col("amount") < 0,
             "blank_city": F.col("city") == ""}
    assert rows(rule_violations(df, rules), "id", "violations") == [
        (1, "negative_amount,blank_city"), (2, "missing_amount")]


def test_health_audit_labels(spark):
    t = dt.datetime(2024, 1, 31)
    df = spark.createDataFrame([("a", 1, 5.0, t), ("a", 1, 5.0, t), ("a", 2, 999.0, t - dt.timedelta(days=10)),
                                ("b", 3, 1.0, t)], "src string, id int, temp double, ts timestamp")
    late = late_rows(df, "ts", F.lit(t), 3)
    out = {r.source: r for r in health_audit(df, "src", ["id"], {"temp_999": F.col("temp") == 999}, late)
           .collect()}
    a = out["a"]
    assert (a.rows_added, a.bad_records, a.duplicates, a.late_records) == (3, 1, 1, 1)
    assert a.classification == "bad_records,duplicates,late_data"
    assert out["b"].classification == "healthy"
    drift = health_audit(df, "src", ["id"], {}, drift=F.lit("added column 'x'")).collect()
    assert all(r.classification.startswith("schema_drift") for r in drift)


def test_primary_and_foreign_key_checks(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None), (3, 1)], "a int, b int")
    assert rows(check_primary_key(df, ["a", "b"])) == [(1, 1, 2, "duplicate"), (2, None, 1, "null_key")]
    dim = spark.createDataFrame([(1,), (2,)], "pk int")
    fact = spark.createDataFrame([(10, 1), (11, 5), (12, None)], "id int, fk int")
    assert rows(check_foreign_key(fact, "fk", dim, "pk")) == [(11, 5)]


def test_erase_leaves_zero_residue(spark):
    dim = spark.createDataFrame([("s1", 1), ("s2", 1), ("s3", 2)], "sk string, cust int")
    fact = spark.createDataFrame([(100, "s1", 1), (101, "s2", 1), (102, None, 1), (103, "s3", 2)],
                                 "oid int, sk string, cust int")
    ent = spark.createDataFrame([(1,)], "cust int")
    d2, facts = erase(ent, dim, {"f": fact}, "cust", "sk", fact_natural_key={"f": "cust"})
    assert rows(d2, "sk") == [("s3",)]
    # ledger L26: a fact row with a NULL surrogate key goes by natural key
    assert rows(facts["f"], "oid") == [(103,)]
    res = residue(ent, {"dim": d2, "f": facts["f"]}, {"dim": "cust", "f": "cust"}, "cust")
    assert [r.remaining_rows for r in res.collect()] == [0, 0]
    # without the natural key the NULL-sk row would survive
    _, only_sk = erase(ent, dim, {"f": fact}, "cust", "sk")
    assert rows(only_sk["f"], "oid") == [(102,), (103,)]


def test_erasure_job_touches_only_buckets_with_erased_rows(spark):
    from lakemart.functions.keys import surrogate_key
    from lakemart.plans import freight
    from lakemart.session import scratch_path
    from lakemart.sinks.tables import write_bucketed
    root = scratch_path(spark, "t-erase-job")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    c = spark.range(40).select(F.col("id").cast("int").alias("customer_id"), at.alias("start_at"), F.lit(False).alias("_is_delete"))
    sk = surrogate_key(c.drop("_is_delete"), "customer_sk", ["customer_id", "start_at"])
    write_bucketed(c, f"{root}/silver/customers", ["customer_id"], 16)
    write_bucketed(sk, f"{root}/gold/dim_customer", ["customer_sk"], 16)
    write_bucketed(sk.select((F.col("customer_id") * 10).alias("order_id"), "customer_sk"),
                   f"{root}/gold/fact_order_fulfillment", ["order_id"], 16)
    assert freight.gold_erase_customers(spark, root) == 0                 # nobody is deleted
    write_bucketed(c.withColumn("_is_delete", F.col("customer_id") == 7), f"{root}/silver/customers", ["customer_id"], 16)
    assert freight.gold_erase_customers(spark, root) == 2                 # one bucket of each table
    assert spark.read.parquet(f"{root}/gold/dim_customer").count() == 39
    left = spark.read.parquet(f"{root}/gold/fact_order_fulfillment")
    assert left.count() == 39 and left.filter("order_id = 70").isEmpty()
    assert freight.gold_erase_customers(spark, root) == 0
