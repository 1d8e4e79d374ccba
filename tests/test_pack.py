from pyspark.sql import functions as F

from lakemart.session import scratch_path
from lakemart.sinks import pack
from tests.conftest import rows


def layout(spark, path):
    return {tuple(r.path.rsplit("/", 2)[1:]): r.length for r in pack.list_files(spark, path).collect()}


def table(spark, name):
    path = scratch_path(spark, name)
    df = spark.range(40_000).select("id", (F.col("id") % 97).alias("a"), F.sha2(F.col("id").cast("string"), 256).alias("t"),
                                    F.when(F.col("id") % 2 == 0, "x y").otherwise("z").alias("p"))
    df.filter("id < 30000").coalesce(1).write.partitionBy("p").parquet(path)
    df.filter("id >= 30000").repartition(12).write.mode("append").partitionBy("p").parquet(path)
    return path, df


def test_small_files_are_packed_and_large_ones_untouched(spark):
    path, df = table(spark, "pack")
    before = layout(spark, path)
    large = {n: x for n, x in before.items() if x > 400_000}
    assert len(large) == 2 and len(before) == 26
    assert pack.pack(spark, path, target_bytes=200_000, small=0.9) == 24
    after = layout(spark, path)
    assert {n: after.get(n) for n in large} == large
    new = [x for n, x in after.items() if n not in large]
    assert 2 <= len(new) <= 6 and all(size < 400_000 for size in new)
    assert rows(spark.read.parquet(path).select("id", "a", "t", "p")) == rows(df)
    assert pack.pack(spark, path, target_bytes=200_000, small=0.1) == 0
    assert layout(spark, path) == after


def test_clustered_files_hold_boxes(spark):
    path = scratch_path(spark, "pack-z")
    df = spark.range(20_000).select("id", (F.col("id") * 7919 % 20_000).alias("b"), F.lit("x").alias("t"))
    df.repartition(10).write.parquet(path)
    assert pack.pack(spark, path, target_bytes=1 << 30, cluster_by=["id", "b"]) == 10
    assert rows(spark.read.parquet(path)) == rows(df)
    got = [tuple(r) for r in spark.read.parquet(path).select("id", "b").collect()]      # one file, in its order
    quarter = got[:5_000]
    assert max(i for i, _ in quarter) < 12_000 and max(b for _, b in quarter) < 12_000


def test_stopped_packing_goes_on(spark, monkeypatch):
    path, df = table(spark, "pack-stop")
    real = pack.finish_packing
    calls = []
    monkeypatch.setattr(pack, "finish_packing", lambda *a: real(*a) if not calls.append(1) and len(calls) == 1 else None)
    pack.pack(spark, path, target_bytes=200_000, small=0.9)
    monkeypatch.undo()
    assert len(layout(spark, path)) == 26               # written beside the table only
    fs, make = pack._fs(spark, path)
    name = spark.read.parquet(f"{path}.pack/names").first()                             # one file was moved, then it stopped
    moved = fs.globStatus(make(f"{path}.pack/rows/_to={name._to}/*.parquet"))[0].getPath()
    fs.rename(moved, make(f"{name.folder}/packed-{name._to}-{moved.getName()}"))
    pack.finish_packing(spark, path)
    assert rows(spark.read.parquet(path).select("id", "a", "t", "p")) == rows(df) and len(layout(spark, path)) < 10
    assert not fs.exists(make(f"{path}.pack"))
