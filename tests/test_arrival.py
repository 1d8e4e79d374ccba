import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.session import scratch_path
from lakemart.sources.files import parse_json_rescued
from lakemart.sources.schema import evolve_schema, field_paths, load_schema, store_schema
from lakemart.sources.variant import infer_lines
from lakemart.streaming import ingest as ingest_module
from lakemart.streaming.ingest import ingest_on_arrival, read_arrived


def lines(spark, *values):
    return spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v),) for v in values], "value string")


def land(folder, name, *values):
    os.makedirs(folder, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(v) + "\n" for v in values))


def test_infer_lines_merges_shapes(spark):
    got = infer_lines(lines(spark, {"a": 1, "g": {"x": 1.5}, "l": [{"n": 1}], "e": {}, "z": None, "O`BJECT<": 1},
                            {"a": 2, "g": {"y": "s"}, "l": [{"m": True}], "t": "u"}, {"a": 3.5}, {"t": 4}, "no json", "[1]", "7"))
    kinds = {f.name: f.dataType.simpleString() for f in got.fields}
    assert kinds == {"a": "double", "g": "struct<x:double,y:string>", "l": "array<struct<m:boolean,n:bigint>>",
                     "e": "string", "z": "string", "t": "string", "O`BJECT<": "bigint"}
    assert infer_lines(lines(spark, "no json", "[]")).fields == []
    assert infer_lines(lines(spark, {}).limit(0)).fields == []


def test_evolve_nested_keeps_known_types():
    known = T.DataType.fromDDL("a int, g struct<x:float>, l array<struct<n:int>>")
    came = T.DataType.fromDDL("b string, g struct<x:string,y:int>, l array<struct<n:string,m:int>>, a string")
    assert evolve_schema(known, came, nested=True).simpleString() == \
        "struct<a:int,g:struct<x:float,y:int>,l:array<struct<n:int,m:int>>,b:string>"
    assert evolve_schema(known, came).simpleString() == "struct<a:int,g:struct<x:float>,l:array<struct<n:int>>,b:string>"
    assert field_paths(known) == ["a", "g", "g.x", "l", "l.n"]


def test_stored_schemas_are_versions(spark):
    path = scratch_path(spark, "versions")
    assert load_schema(spark, path) is None
    for ddl in ("a int", "a int, b string", "a int, b string, c double"):
        store_schema(spark, T.DataType.fromDDL(ddl), path)
        assert load_schema(spark, path) == T.DataType.fromDDL(ddl)
    assert spark.read.json(path).count() == 3


def test_second_run_opens_only_new_files(spark, tmp_path, monkeypatch):
    src, root = tmp_path / "land", scratch_path(spark, "arrive")
    args = (f"{root}/bronze", f"{root}/_schema", T.DataType.fromDDL("id bigint, v double"), f"{root}/_ck")
    opened = []
    real = ingest_module.infer_lines

    def watched(batch):
        opened.append(sorted(r[0].rsplit("/", 1)[-1] for r in batch.select("_source_file").distinct().collect()))
        return real(batch)

    monkeypatch.setattr(ingest_module, "infer_lines", watched)
    land(src, "a.json", {"id": 1, "v": 0.5}, {"id": 2, "v": "x"})
    land(src, "b.json", {"id": 3, "g": {"n": 1}})
    assert ingest_on_arrival(spark, str(src), *args) == ["added column 'g', 'g.n'"]
    assert opened == [["a.json", "b.json"]] * 2         # the restart gets the same micro-batch
    opened.clear()
    (src / "a.json").unlink()                           # read once, never asked for again
    land(src, "c.json", {"id": 4, "g": {"n": 2, "m": [1]}, "k": True})
    assert ingest_on_arrival(spark, str(src), *args) == ["added column 'g.m', 'k'"]
    assert opened == [["c.json"]] * 2
    assert ingest_on_arrival(spark, str(src), *args) == []
    got = read_arrived(spark, *args[:2]).select("id", "v", "g", "k", "_rescued_data").collect()
    assert sorted((r.id, r.v, r.g and tuple(r.g), r.k, r._rescued_data) for r in got) == [
        (1, 0.5, None, None, None), (2, None, None, None, '{"v":"x"}'), (3, None, (1, None), None, None),
        (4, None, (2, [1]), True, None)]


def test_stopped_batch_is_written_once(spark, tmp_path, monkeypatch):
    src, root = tmp_path / "land", scratch_path(spark, "arrive-stop")
    args = (f"{root}/bronze", f"{root}/_schema", T.DataType.fromDDL("id bigint"), f"{root}/_ck")
    land(src, "a.json", *({"id": i} for i in range(5)))
    real = ingest_module.parse_json_rescued
    calls = []

    def failing(*a):
        calls.append(1)
        out = real(*a)
        return out.withColumn("id", F.raise_error(F.lit("stop")).cast("bigint")) if len(calls) == 1 else out

    monkeypatch.setattr(ingest_module, "parse_json_rescued", failing)
    try:
        ingest_on_arrival(spark, str(src), *args)
        raise AssertionError("should have stopped")
    except ingest_module.StreamingQueryException:
        pass
    ingest_on_arrival(spark, str(src), *args)
    ingest_on_arrival(spark, str(src), *args)
    assert sorted(r.id for r in read_arrived(spark, *args[:2]).collect()) == list(range(5))


def test_without_growth_unknown_fields_are_rescued(spark, tmp_path):
    src, root = tmp_path / "land", scratch_path(spark, "arrive-fixed")
    land(src, "a.json", {"id": 1, "new": 5})
    ingest_on_arrival(spark, str(src), f"{root}/b", f"{root}/_schema", T.DataType.fromDDL("id bigint"), f"{root}/_ck", grow=False)
    assert load_schema(spark, f"{root}/_schema") is None
    got = spark.read.parquet(f"{root}/b").first()
    assert (got.id, got._rescued_data) == (1, '{"new":"5"}')


def test_rescue_below_structs_and_arrays(spark):
    schema = T.DataType.fromDDL("a bigint, g struct<lat:double>, l array<struct<n:bigint>>, m map<string,int>, s array<int>, "
                                "d struct<u:array<struct<v:struct<w:bigint>>>>")
    given = [({"g": {"lat": "north", "lon": 2}}, {"g.lat": "north", "g.lon": "2"}),
             ({"a": 1, "g": {"lat": 2}, "l": [], "m": {}, "s": None, "d": {"u": [None, {"v": None}]}}, None),
             ({"l": [{"n": 1, "z": {"q": [1]}}, {"n": "bad"}, None]}, {"l[0].z": '{"q":[1]}', "l[1].n": "bad"}),
             ({"l": {"n": 1}, "g": [3]}, {"l": '{"n":1}', "g": "[3]"}),
             ({"m": {"k": 1, "j": "no"}, "s": [1, "b"]}, {"m": '{"j":"no","k":1}', "s": '[1,"b"]'}),
             ({"d": {"u": [{"v": {"w": "x"}}, {"v": {"w": 3, "new": None}}], "k": 5}},
              {"d.u[0].v.w": "x", "d.u[1].v.new": None, "d.k": "5"}),
             ({"x.y": 1, "g": {"b[0]": 2}}, {"`x.y`": "1", "g.`b[0]`": "2"})]
    df = lines(spark, *[v for v, _ in given])
    got = parse_json_rescued(df.withColumn("at", F.monotonically_increasing_id()), schema).orderBy("at").collect()
    for r, (value, want) in zip(got, given):
        assert (json.loads(r._rescued_data) if r._rescued_data else None) == want, value
        assert r._corrupt_record is None
    odd = parse_json_rescued(lines(spark, "{", "[1]", '{"a":1,"a":2,"q":3}', '{"a":null}'), schema).collect()
    assert [r._corrupt_record for r in odd] == ["{", "[1]", None, None]
    assert json.loads(odd[2]._rescued_data)["q"] == "3" and odd[3]._rescued_data is None


def test_nothing_is_lost_below_structs(spark):
    """Every scalar of random values is either in the typed columns or rescued."""
    import random
    r = random.Random(4)
    schema = T.DataType.fromDDL("a bigint, g struct<x:double,h:struct<y:bigint>>, l array<struct<n:bigint,s:string>>")

    def value(depth=0):
        pick = r.random()
        if pick < 0.25:
            return r.randrange(1000, 9999)
        if pick < 0.45:
            return f"t{r.randrange(1000, 9999)}"
        if pick < 0.7 or depth > 3:
            return {k: value(depth + 1) for k in r.sample(["a", "g", "x", "h", "y", "l", "n", "s"], r.randrange(4))}
        return [value(depth + 1) for _ in range(r.randrange(3))]

    rows = [{k: value() for k in r.sample(["a", "g", "l", "zz"], r.randrange(1, 4))} for _ in range(300)]

    def scalars(v):
        if isinstance(v, dict):
            return [s for x in v.values() for s in scalars(x)]
        if isinstance(v, list):
            return [s for x in v for s in scalars(x)]
        return [str(v)]

    df = lines(spark, *rows).withColumn("at", F.monotonically_increasing_id())
    got = parse_json_rescued(df, schema).select("at", F.to_json(F.struct("a", "g", "l")).alias("j"), "_rescued_data")
    for row, given in zip(got.orderBy("at").collect(), rows):
        kept = row.j + (row._rescued_data or "")
        assert all(s in kept for s in scalars(given)), (given, kept)
