import datetime as dt
import itertools

from pyspark.sql import functions as F

from lakemart.operators.scd import scd1_apply, scd2_apply
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)
CH = "k int, seq timestamp, a string"


def ts(h):
    return T0 + dt.timedelta(hours=h)


def apply_batches(spark, batches, **kw):
    target = None
    schema = kw.pop("schema", CH)
    for b in batches:
        df = spark.createDataFrame(b, schema) if isinstance(b, list) else b
        target = scd2_apply(target, df, ["k"], "seq", ["a"], **kw)
        target = spark.createDataFrame(target.collect(), target.schema)   # materialise
    return target


def canon(df):
    return rows(df, "k", "seq", "a", "start_at", "end_at", "is_current", "_is_delete")


CHANGES = [(1, ts(0), "v0"), (1, ts(1), "v1"), (1, ts(2), "v2"), (2, ts(0), "w0"), (2, ts(5), "w5")]


def test_in_order_basic_intervals(spark):
    out = apply_batches(spark, [CHANGES])
    got = {(r.k, r.a): (r.end_at, r.is_current) for r in out.collect()}
    assert got[(1, "v0")] == (ts(1) - dt.timedelta(milliseconds=1), False)
    assert got[(1, "v2")] == (None, True)
    assert got[(2, "w5")] == (None, True)


def test_batch_split_order_and_replay_invariance(spark):
    one = canon(apply_batches(spark, [CHANGES]))
    for perm in itertools.permutations([CHANGES[:2], CHANGES[2:4], CHANGES[4:]]):
        assert canon(apply_batches(spark, list(perm))) == one
    # replay of a batch changes nothing
    assert canon(apply_batches(spark, [CHANGES, CHANGES[1:3]])) == one


def test_late_change_keeps_single_current(spark):
    # ledger L5: an older change arriving later is slotted into history
    out = apply_batches(spark, [[(1, ts(5), "new")], [(1, ts(1), "old")]])
    cur = [r.a for r in out.collect() if r.is_current]
    assert cur == ["new"]
    old = [r for r in out.collect() if r.a == "old"][0]
    assert old.end_at == ts(5) - dt.timedelta(milliseconds=1)


def test_equal_sequence_tie(spark):
    # ledger L6: two changes with the same sequence collapse into one version
    out = apply_batches(spark, [[(1, ts(1), "x"), (1, ts(1), "y"), (1, ts(2), "z")]])
    got = rows(out, "a", "start_at", "end_at")
    assert len(got) == 2
    assert all(e is None or e >= s for _, s, e in got)


DEL = "k int, seq timestamp, a string, op string"


def test_deletes_mark_history_and_block_later_versions(spark):
    # ledger L7/L8/L9: versions before the delete are flagged, none is
    # current, versions at/after the delete are dropped, whatever the order
    ch = [(1, ts(0), "a", "upsert"), (1, ts(1), "b", "upsert"), (1, ts(2), None, "delete"),
          (1, ts(3), "c", "upsert"), (2, ts(0), "x", "upsert")]
    kw = dict(change_col="op", schema=DEL)
    one = canon(apply_batches(spark, [ch], **dict(kw)))
    got = {(k, a): (cur, dele) for k, _, a, _, _, cur, dele in one}
    assert got[(1, "a")] == (False, True) and got[(1, "b")] == (False, True)
    assert (1, "c") not in got
    assert got[(2, "x")] == (True, False)
    for perm in itertools.permutations([ch[:2], ch[2:3], ch[3:]]):
        assert canon(apply_batches(spark, list(perm), **dict(kw))) == one


def test_delete_before_any_version_leaves_tombstone(spark):
    ch1 = [(1, ts(2), None, "delete")]
    ch2 = [(1, ts(0), "a", "upsert"), (1, ts(3), "late", "upsert")]
    out = apply_batches(spark, [ch1, ch2], change_col="op", schema=DEL)
    live = [r for r in out.collect() if not r._is_delete]
    assert live == []
    assert sorted(r.a for r in out.collect() if r.a) == ["a"]


def test_preimages_ignored_and_start_column(spark):
    ch = spark.createDataFrame(
        [(1, 1, ts(0), "a", "insert"), (1, 2, ts(1), "a", "update_preimage"), (1, 2, ts(1), "b", "update_postimage")],
        "k int, ver long, upd timestamp, a string, _change_type string")
    out = scd2_apply(None, ch, ["k"], "ver", ["a"], start="upd", change_col="_change_type")
    got = rows(out, "ver", "a", "start_at", "is_current")
    assert got == [(1, "a", ts(0), False), (2, "b", ts(1), True)]


def test_scd1_guard_and_plain(spark):
    s = "k int, seq int, v string"
    newer = spark.createDataFrame([(1, 5, "new")], s)
    older = spark.createDataFrame([(1, 2, "old"), (2, 1, "x")], s)
    t = scd1_apply(None, newer, ["k"], "seq")
    assert rows(scd1_apply(t, older, ["k"], "seq")) == [(1, 5, "new"), (2, 1, "x")]
    assert rows(scd1_apply(t, older, ["k"], "seq", guard_sequence=False)) == [(1, 2, "old"), (2, 1, "x")]


def test_multi_column_keys(spark):
    ch = spark.createDataFrame([("a", 1, ts(0), "x"), ("a", 1, ts(2), "y"), ("a", 2, ts(1), "z"),
                                ("b", 1, ts(0), "w")], "k1 string, k2 int, seq timestamp, a string")
    one = scd2_apply(None, ch, ["k1", "k2"], "seq", ["a"])
    two = scd2_apply(spark.createDataFrame(scd2_apply(None, ch.filter("a = 'y'"), ["k1", "k2"], "seq",
                                                      ["a"]).collect(),
                                           one.schema),
                     ch.filter("a <> 'y'"), ["k1", "k2"], "seq", ["a"])
    cols = ["k1", "k2", "a", "start_at", "end_at", "is_current"]
    assert rows(one, *cols) == rows(two, *cols)
    cur = sorted((r.k1, r.k2, r.a) for r in one.collect() if r.is_current)
    assert cur == [("a", 1, "y"), ("a", 2, "z"), ("b", 1, "w")]


def test_scd1_earliest_first_delivery_wins(spark):
    s = "k int, seq int, v string"
    first = scd1_apply(None, spark.createDataFrame([(1, 5, "first")], s), ["k"], "seq", desc=False)
    later = spark.createDataFrame([(1, 7, "redelivered"), (1, 5, "same-time")], s)
    assert rows(scd1_apply(first, later, ["k"], "seq", desc=False), "v") == [("first",)]
    earlier = spark.createDataFrame([(1, 3, "earlier")], s)
    assert rows(scd1_apply(first, earlier, ["k"], "seq", desc=False), "v") == [("earlier",)]


def test_close_deleted_ends_the_last_version(spark):
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 5)]
    ch = spark.createDataFrame([(1, t[0], "a", "insert"), (1, t[1], "b", "insert"), (1, t[2], None, "delete"),
                                (2, t[0], "c", "insert")], "k int, s timestamp, v string, c string")
    for close, end in ((False, None), (True, t[2] - dt.timedelta(milliseconds=1))):
        out = scd2_apply(None, ch, ["k"], "s", ["v"], change_col="c", close_deleted=close)
        got = {(r.k, r.v): (r.end_at, r.is_current) for r in out.collect()}
        assert got == {(1, "a"): (t[1] - dt.timedelta(milliseconds=1), False), (1, "b"): (end, False), (2, "c"): (None, True)}
