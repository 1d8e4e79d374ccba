import itertools
import random

import pytest
from pyspark.sql import functions as F

from lakemart.operators.episodes import live_intervals, reopen_apply
from lakemart.session import cut_lineage
from tests.conftest import rows

KIND = "k int, t timestamp, v string, _change_type string"


def at(i):
    return None if i is None else f"2024-01-{i:02d} 00:00:00"


def frame(spark, events):
    return spark.createDataFrame([(k, at(t), v, c) for k, t, v, c in events], KIND.replace("timestamp", "string")) \
                .withColumn("t", F.col("t").cast("timestamp"))


def apply(spark, target, events):
    return reopen_apply(target, frame(spark, events), ["k"], "t", ["v"], "_change_type")


def plain(events):
    """Rows from a walk over each key's events in order."""
    chosen = {}
    for k, t, v, c in events:
        if c == "update_preimage" or t is None:
            continue
        new = (c == "delete", v if c != "delete" else None)
        if (k, t) not in chosen or (new[0], new[1] is not None, new[1] or "") > (chosen[k, t][0], chosen[k, t][1] is not None, chosen[k, t][1] or ""):
            chosen[k, t] = new
    out = []
    for k in {k for k, _ in chosen}:
        line = sorted((t, *e) for (q, t), e in chosen.items() if q == k)
        opened = None
        for i, (t, gone, v) in enumerate(line):
            nxt = line[i + 1] if i + 1 < len(line) else None
            if gone:
                opened = None
                out.append((k, t, None, None, False, True, None, None))
                continue
            opened = opened or t
            out.append((k, t, v, nxt and nxt[0], nxt is None, False, opened, nxt and ("delete" if nxt[1] else "update")))
    return sorted(out, key=str)


def found(df):
    day = lambda x: x and (x.day if x.hour == 0 else x.day + 1)
    return sorted(((r.k, day(r.start_at), r.v, day(r.end_at), r.is_current, r._is_delete, day(r.episode_start), r.ended_by)
                   for r in df.collect()), key=str)


CHANGES = [(1, 1, "a", "insert"), (1, 3, None, "delete"), (1, 5, "b", "update_postimage"), (1, 6, "c", "update_postimage"),
           (1, 8, None, "delete"), (1, 8, "x", "insert"), (2, 2, None, "delete"), (2, 4, "z", "insert"), (1, 2, "p", "update_preimage"),
           (None, 3, "n", "insert"), (None, 4, None, "delete"), (3, 7, "q", "insert"), (3, None, "lost", "insert")]


def test_every_batch_order_gives_the_same(spark):
    want = plain(CHANGES)
    parts = [CHANGES[:3], CHANGES[3:6] + CHANGES[:1], CHANGES[6:]]
    for order in itertools.permutations(range(3)):
        out = None
        for i in order:
            out = cut_lineage(apply(spark, out, parts[i]), "t")
        assert found(out) == want, order
    assert found(apply(spark, out, CHANGES)) == want    # a replay changes nothing
    assert rows(live_intervals(out, ["k"]).select("k", F.dayofmonth("episode_start"), "versions")) == rows(
        spark.createDataFrame([(1, 1, 1), (1, 5, 2), (2, 4, 1), (3, 7, 1), (None, 3, 1)], "k int, d int, n int"))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_events_in_random_batches(spark, seed):
    r = random.Random(seed)
    events = [(r.choice([1, 2, None]), r.randrange(1, 28), r.choice("abc"), r.choice(["delete", "insert", "insert", "update_preimage"]))
              for _ in range(60)]
    want, out = plain(events), None
    r.shuffle(events)
    for i in range(0, 60, 20):
        out = cut_lineage(apply(spark, out, events[i:i + 20]), "t")
    assert found(out) == want


def test_late_delete_cuts_and_late_upsert_reopens(spark):
    out = apply(spark, None, [(1, 1, "a", "insert"), (1, 9, "b", "insert")])
    out = apply(spark, cut_lineage(out, "t"), [(1, 5, None, "delete")])
    assert found(out) == plain([(1, 1, "a", "insert"), (1, 9, "b", "insert"), (1, 5, None, "delete")])
    assert {r[6] for r in found(out)} == {1, 9, None}


def test_hot_keys_are_split(spark, monkeypatch):
    from lakemart.operators import episodes
    r = random.Random(7)
    events = [(r.choice([1, 1, 1, None]), r.randrange(1, 28), "v", r.choice(["delete", "insert"])) for _ in range(80)]
    real = episodes.order_splits
    made = []
    monkeypatch.setattr(episodes, "order_splits", lambda *a: made.append(real(*a, rows=5)) or made[-1])
    assert found(apply(spark, None, events)) == plain(events) and made[0] is not None
