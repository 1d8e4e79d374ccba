from lakemart.operators.cdc import fill_forward, snapshot_diff, split_changes
from tests.conftest import rows

S = "k int, a string, b int"


def test_snapshot_diff_emits_four_change_types(spark):
    old = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (3, "z", None)], S)
    new = spark.createDataFrame([(1, "x", 1), (2, "Y", 2), (3, "z", None), (4, "w", 4)], S)
    got = rows(snapshot_diff(old, new, ["k"], version=7), "k", "a", "_change_type", "_commit_version")
    assert got == [(2, "Y", "update_postimage", 7), (2, "y", "update_preimage", 7), (4, "w", "insert", 7)]
    gone = spark.createDataFrame([(1, "x", 1)], S)
    got = rows(snapshot_diff(old, gone, ["k"], 8), "k", "_change_type")
    assert got == [(2, "delete"), (3, "delete")]


def test_snapshot_diff_null_safe(spark):
    old = spark.createDataFrame([(1, "x", None)], S)
    new = spark.createDataFrame([(1, "x", None)], S)
    assert snapshot_diff(old, new, ["k"], 1).count() == 0


def test_split_changes(spark):
    ch = spark.createDataFrame([(1, "insert"), (2, "update_preimage"), (2, "update_postimage"), (3, "delete")],
                               "k int, _change_type string")
    ups, dels = split_changes(ch)
    assert rows(ups, "k") == [(1,), (2,)]
    assert rows(dels, "k") == [(3,)]


def test_fill_forward_sparse_updates(spark):
    # ledger L23 / C6: sparse updates become full post-images; L20: an older
    # value is carried when the newest is NULL
    df = spark.createDataFrame([(1, 1, "a", 10), (1, 2, None, 20), (1, 3, "c", None), (2, 1, None, 5)],
                               "k int, seq int, a string, b int")
    got = rows(fill_forward(df, ["k"], ["seq"], ["a", "b"]), "k", "seq", "a", "b")
    assert got == [(1, 1, "a", 10), (1, 2, "a", 20), (1, 3, "c", 20), (2, 1, None, 5)]
