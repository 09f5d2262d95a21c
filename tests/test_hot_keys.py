"""Sessions and as-of lookups where one visitor or item has most of the rows, in ranges that cut sessions and groups."""

import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import checks
from clickloom.operators import metadata as m
from clickloom.operators import sessions as s

MIN = 60_000
RAW = "event_id long, timestamp long, visitorid long, event string, itemid long, transactionid long"


@pytest.fixture()
def small_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def brute(rows):
    """event_id to (session_id, group_id, the columns of STATE)."""
    rows = sorted(rows, key=lambda r: (r[2], r[1], r[0]))
    sessions = []
    for r in rows:
        last = sessions[-1][-1] if sessions else None
        if last is None or last[2] != r[2] or r[1] - last[1] > 30 * MIN:
            sessions.append([])
        sessions[-1].append(r)
    out, groups = {}, 0
    for n, ses in enumerate(sessions, 1):
        times = sorted({r[1] for r in ses})
        for order, r in enumerate(ses):
            g = times.index(r[1])
            seen = [x for x in ses[: order + 1]]
            counts = [sum(x[3] == b for x in seen) for b in s.BEHAVIOURS]
            latest = [max((x[1] for x in seen if x[3] == b), default=None) for b in s.BEHAVIOURS]
            out[r[0]] = (n, groups + g + 1, order, times[0], times[-1], g + 1, times[g - 1] if g else None, times[g + 1] if g + 1 < len(times) else None, *counts, *latest)
        groups += len(times)
    return out


@pytest.mark.parametrize("kind", ["random", "one long session", "one long group", "hot visitor"])
def test_sessions_in_ranges(spark, small_ranges, kind):
    rng = random.Random(kind)
    one = lambda i, t, v: (i, t, v, rng.choice(s.BEHAVIOURS), rng.randrange(9), 1)
    if kind == "random":
        rows = [one(i, rng.randrange(40) * 20 * MIN, rng.randrange(12)) for i in range(400)]
    elif kind == "one long session":
        rows = [one(i, i // 2 * MIN, 5) for i in range(400)] + [one(1000 + i, i * MIN, rng.randrange(12)) for i in range(40)]
    elif kind == "one long group":
        rows = [one(i, 7 * MIN, 5) for i in range(300)] + [one(1000 + i, i * MIN, 5) for i in range(20)] + [one(2000 + i, 50 * MIN, 5) for i in range(60)]
    else:
        rows = [one(i, rng.randrange(2000) * MIN, 3 if i % 3 else rng.randrange(12)) for i in range(500)]
    rows = [(i, t, v, "view" if kind == "one long group" and i < 300 else e, item, x) for i, t, v, e, item, x in rows]
    got = s.sessionize(spark.createDataFrame(rows, RAW).repartition(5), 30)
    names = ["session_id", "group_id", *(x.split()[0] for x in s.STATE)]
    assert {r.event_id: tuple(r[n] for n in names) for r in got.collect()} == brute(rows)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.2 * len(rows), "no task holds the visitor"


def test_sessions_of_no_events(spark):
    got = s.sessionize(spark.createDataFrame([], RAW))
    assert got.collect() == [] and s.timestamp_groups(s.temporal_split(got, s.cutoffs(got))).collect() == []


def test_asof_with_a_hot_item(spark, small_ranges):
    """Half of the requests and of the updates are of one item; null items and times find nothing known of them."""
    rng = random.Random(1)
    item = lambda: 7 if rng.random() < 0.5 else rng.randrange(40)
    props = {(item(), rng.choice(["available", "categoryid"]), rng.randrange(3000)): rng.randrange(2) for _ in range(600)}
    asked = [(k, item(), rng.randrange(3000)) for k in range(1500)] + [(9000, None, 5), (9001, 7, None), (9002, 999, 5)]
    known = {i: min(t for j, _, t in props if j == i) for i in {j for j, _, _ in props}}
    p = spark.createDataFrame([(*k, v) for k, v in props.items()], "itemid long, property string, timestamp long, value long")
    items = spark.createDataFrame(list(known.items()), "itemid long, known_at long")
    tree = m.category_tree(spark.createDataFrame([(1, None)], "categoryid long, parentid long"))
    found = m.asof_metadata(spark.createDataFrame(asked, "k long, itemid long, t long"), p, items, tree)
    got = {r.k: r for r in found.collect()}
    assert len(got) == len(asked)
    for k, i, t in asked[:-3]:
        for name, value, at in (("available", "available", "available_time"), ("categoryid", None, "category_time")):
            best = max(((u, v) for (j, q, u), v in props.items() if j == i and q == name and u <= t), default=(None, None))
            assert getattr(got[k], at) == best[0] and (value is None or getattr(got[k], value) == best[1])
        assert got[k].known_at == known.get(i)
    assert [got[k].available for k in (9000, 9001, 9002)] == [None] * 3 and not any(got[k].candidate for k in (9000, 9001, 9002))
    report = {r.check: r.violations for r in checks.metadata(found, p, items, "t").collect()}
    assert set(report.values()) == {0}
    spread = m.last_known(spark.createDataFrame(asked, "k long, itemid long, t long"), p.select("itemid", F.col("timestamp").alias("t"), "value"), "value")
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.35 * sum(sizes)
