"""Lists of the most popular candidates at each query's time against trying every item; metrics of one list a query."""

import math
import random

import pytest

from clickloom.operators import metadata, ranking


@pytest.fixture()
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize(("share", "times"), [(0.5, 1000), (0.95, 1000), (0.5, 12)])
def test_popular_candidates(spark, many_ranges, share, times):
    """Mostly available, mostly not, and many changes at one time (which ranges then cut)."""
    rng = random.Random(7)
    items = [(i, rng.randrange(times)) for i in range(80)]
    props = [(i, "available", t, int(rng.random() > share)) for i, k in items for t in {rng.randrange(k, times + 1) for _ in range(6)}] + [(0, "categoryid", 0, 5)]
    train = [(rng.randrange(80),) for _ in range(300)]
    queries = [(q, rng.randrange(-2, times + 5)) for q in range(300)]
    changes = metadata.eligibility_changes(spark.createDataFrame(items, "itemid long, known_at long"), spark.createDataFrame(props, "itemid long, property string, timestamp long, value long"))
    ranks = ranking.popularity_ranks(spark.createDataFrame(train, "itemid long"))
    lists = ranking.candidate_lists(ranks, changes, 4)
    got = {(r.query_id, r["rank"]): r.itemid for r in ranking.popular_candidates(spark.createDataFrame(queries, "query_id long, query_time long"), lists).collect()}
    counts = {}
    for (i,) in train:
        counts[i] = counts.get(i, 0) + 1
    known, last = dict(items), {}
    for i, p, t, v in props:
        if p == "available":
            last.setdefault(i, []).append((t, v))
    order, want = sorted(counts, key=lambda i: (-counts[i], i)), {}
    for q, t in queries:
        able = [i for i in order if known[i] <= t and max(((u, v) for u, v in last.get(i, []) if u <= t), default=(0, 1))[1] == 1]
        want |= {(q, n): i for n, i in enumerate(able[:4], 1)}
    assert got == want and len(want) > 100


def test_no_changes_and_no_items(spark):
    ranks = spark.createDataFrame([], "itemid long, rank long")
    changes = spark.createDataFrame([], "itemid long, t long, on boolean")
    lists = ranking.candidate_lists(ranks, changes)
    assert lists.collect() == [] and ranking.popular_candidates(spark.createDataFrame([(1, 2)], "query_id long, query_time long"), lists).collect() == []


def test_metrics_by_query(spark):
    """A target outside the list and a query without one stay in the denominator."""
    ranked = spark.createDataFrame([(1, 7, 1), (1, 8, 2), (2, 7, 1), (2, 9, 2)], "query_id long, itemid long, rank int")
    targets = spark.createDataFrame([(1, 8, "t"), (1, 99, "t"), (2, 7, "t"), (3, 7, "t")], "query_id long, itemid long, split string")
    (r,) = ranking.metrics_by_query(ranked, targets, (2,)).collect()
    assert (r.queries, r.recall, r.hit_rate, r.mrr) == (3, 0.5, 0.666667, 0.5)
    assert r.ndcg == round((1 / math.log2(3) / (1 + 1 / math.log2(3)) + 1) / 3, 6)


def test_metrics_by_list(spark):
    """Lists given once for many queries measure as lists written out for each; the popular list of a time likewise."""
    ranked = spark.createDataFrame([(1, 7, 1), (1, 8, 2), (2, 7, 1), (2, 9, 2)], "list_id long, itemid long, rank int")
    of = spark.createDataFrame([(q, 1 + q % 2) for q in range(10)], "query_id long, list_id long")
    targets = spark.createDataFrame([(q, i, "t") for q in range(12) for i in (7 + q % 3, 99)], "query_id long, itemid long, split string")
    each = of.join(ranked, "list_id").drop("list_id")
    got = ranking.metrics_by_list(ranked, of, targets, (1, 2)).collect()
    assert sorted(got) == sorted(ranking.metrics_by_query(each, targets, (1, 2)).collect()) and got[0].queries == 12
    lists = spark.createDataFrame([(5, 0, 1, 7), (5, 1, 0, None), (9, 1, 1, 8)], "t long, part int, place int, itemid long")
    asked = spark.createDataFrame([(1, 4), (2, 5), (3, 8), (4, 9), (5, 20)], "query_id long, query_time long")
    assert {(r.query_id, tuple(r.list_id)) for r in ranking.lists_at(asked, lists).collect()} == {(2, (5, 1)), (3, (5, 1)), (4, (9, 1)), (5, (9, 1))}
