"""Sampling without rejection: places, items in place among many ranges and blocks, and that samples are uniform."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from clickloom.operators import negatives


@pytest.fixture()
def small_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def places(rows):
    batch = pa.RecordBatch.from_pydict({k: [r[i] for r in rows] for i, k in enumerate(("query_id", "t", "n", "c"))})
    return [tuple(r.values()) for b in negatives._positions(iter([batch]), 7) for r in b.to_pylist()]


def test_places_are_distinct_and_uniform():
    got = places([(q, 0, 9, 4) for q in range(5000)])
    by = {}
    for q, _, d, pos, filled in got:
        by.setdefault(q, []).append(pos)
        assert 0 <= pos < 9 and not filled
    assert all(len(set(p)) == 4 for p in by.values())
    # chi-square of places, and of unordered pairs of the first two; 8 and 35 degrees of freedom, 0.999 quantiles
    one = Counter(p for x in by.values() for p in x)
    assert sum((one[i] - 20000 / 9) ** 2 / (20000 / 9) for i in range(9)) < 26.1
    two = Counter(frozenset(x[:2]) for x in by.values())
    assert len(two) == 36 and sum((c - 5000 / 36) ** 2 / (5000 / 36) for c in two.values()) < 66.6
    assert sorted(p[3] for p in places([(1, 0, 5, 5)])) == list(range(5)) and all(p[4] for p in places([(1, 0, 5, 5)]))


@pytest.mark.parametrize("hot", [False, True])
def test_items_in_place(spark, small_ranges, hot):
    """700 ranks in three blocks, changes and draws over twelve ranges; hot: one rank has a third of the changes, one time a third of the draws."""
    rng = random.Random(3)
    log, state = [], {}
    for t in range(0, 3000):
        rank = 5 if hot and rng.random() < 0.34 else rng.randrange(700)
        state[rank] = not state.get(rank, False)
        log.append((t // 3 * 3 if not hot else t, rank, state[rank]))
    log = list({(t, r): (t, r, on) for t, r, on in log}.values())
    alive, clean = {}, []
    for t, r, on in log:  # in turn on and off
        if alive.get(r, False) != on:
            alive[r] = on
            clean.append((t, r, on))

    def eligible(at):
        now = {}
        for t, r, on in clean:
            if t <= at:
                now[r] = on
        return sorted(r for r, on in now.items() if on)

    draws, want = [], {}
    for q in range(400):
        t = 1500 if hot and q % 3 == 0 else rng.randrange(10, 3100)
        able = eligible(t)
        for d in range(3):
            pos = rng.randrange(len(able))
            draws.append((q, d, t, pos, False))
            want[q, d] = able[pos]
    got = negatives.select_eligible(spark.createDataFrame(clean, "t long, rank long, on boolean"), spark.createDataFrame(draws, "query_id long, d long, t long, pos long, filled boolean"), 700)
    assert {(r.query_id, r.d): r["rank"] for r in got.collect()} == want


def test_samples_are_uniform_over_the_pool(spark, small_ranges):
    """Of 14 items two come later, one is unavailable and one is a target: ten are equally likely."""
    ranks = spark.createDataFrame([(i, 0 if i < 12 else 10**6, i) for i in range(14)], "itemid long, known_at long, rank long")
    props = spark.createDataFrame([(3, "available", 5, 0), (4, "available", 5, 0), (4, "available", 9, 1)], "itemid long, property string, timestamp long, value long")
    queries = spark.createDataFrame([(q, 10 + q, "train") for q in range(3000)], "query_id long, query_time long, split string")
    targets = spark.createDataFrame([(q, 7) for q in range(3000)], "query_id long, itemid long")
    got = negatives.negatives(queries, targets, ranks, props, k=3).collect()
    counts = Counter(r.itemid for r in got)
    assert len(got) == 9000 and set(counts) == {0, 1, 2, 4, 5, 6, 8, 9, 10, 11}
    assert sum((c - 900) ** 2 / 900 for c in counts.values()) < 27.9  # 9 degrees of freedom, 0.999
