"""Fixtures of the reference's behaviour: cleaning, sessions, splits, samples, metadata."""

import random

import numpy as np
import pytest

from clickloom.functions.index import dense_index, reliable
from clickloom.functions.quantile import exact_quantiles
from clickloom.operators import metadata as m
from clickloom.operators import sessions as s
from clickloom.sources.star import require_columns

RAW = "event_id long, timestamp long, visitorid long, event string, itemid long, transactionid long"
MIN = 60_000


def test_exact_repeats_go_and_the_first_stays(spark):
    rows = [(0, 1000, 1, "view", 10, None), (1, 1000, 1, "view", 10, None), (2, 1000, 1, "addtocart", 10, None), (3, 2000, 1, "transaction", 10, 5), (4, 2000, 1, "view", 10, None)]
    got = s.clean_events(spark.createDataFrame(rows, RAW))
    assert sorted(r.event_id for r in got.collect()) == [0, 2, 3, 4]


def test_bad_inputs_are_refused(spark):
    with pytest.raises(ValueError, match="Missing event columns"):
        require_columns(spark.createDataFrame([(1,)], "timestamp long"))
    with pytest.raises(ValueError, match="No valid events"):
        s.reject_bad_events(s.clean_events(spark.createDataFrame([(0, 1, 1, "invalid", 1, None)], RAW)))
    with pytest.raises(ValueError, match="require transactionid"):
        s.reject_bad_events(s.clean_events(spark.createDataFrame([(0, 1, 1, "transaction", 1, None)], RAW)))


def test_a_gap_of_just_the_limit_stays_in_the_session(spark):
    rows = [(i, t * MIN, 1, "view", i, None) for i, t in enumerate((0, 30, 61))]
    got = s.sessionize(spark.createDataFrame(rows, RAW))
    assert [r.session_id for r in got.orderBy("event_id").collect()] == [1, 1, 2]


def test_a_cutoff_through_a_session_drops_it(spark):
    rows = [(i, i * 1000, 1 + i // 3, "view", i, None) for i in range(9)]
    ses = s.sessionize(spark.createDataFrame(rows, RAW))
    ends = s.cutoffs(ses, 0.5, 0.8)
    assert tuple(ends.first()) == (4000, 6400, 8000)
    ev = s.temporal_split(ses, ends)
    assert {(r.visitorid, r.split) for r in ev.collect()} == {(1, "train"), (2, "boundary_drop"), (3, "boundary_drop")}
    groups = s.timestamp_groups(ev)
    assert {r.visitorid for r in s.queries_of(groups).collect()} == {1}
    assert s.queries_of(groups).count() + s.excluded_steps(groups).count() == groups.count()


def test_targets_are_the_items_of_the_next_group(spark):
    rows = [(0, 0, 1, "view", 10, None), (1, 0, 1, "addtocart", 10, None), (2, MIN, 1, "view", 11, None), (3, MIN, 1, "addtocart", 12, None), (4, MIN, 1, "transaction", 11, 1), (5, 2 * MIN, 1, "view", 10, None)]
    ses = s.sessionize(spark.createDataFrame(rows, RAW))
    ev = s.temporal_split(ses, s.cutoffs(ses, 1.0, 1.0))
    groups = s.timestamp_groups(ev)
    got = {(r.query_id, r.itemid, r.target_events) for r in s.next_targets(ev).collect()}
    assert got == {(1, 11, 2), (1, 12, 1), (2, 10, 1)}
    f = s.queries_of(groups).where("query_id = 2").first()
    assert (f.view_count, f.addtocart_count, f.transaction_count, f.prefix_events, f.view_recency) == (2, 2, 1, 5, 0)
    assert s.queries_of(groups).where("query_id = 1").first().transaction_recency is None


def test_asof_metadata_and_candidates(spark):
    day = 86_400_000
    props = spark.createDataFrame([(10, "available", day, 1), (10, "available", 5 * day, 0), (10, "categoryid", day, 999)], "itemid long, property string, timestamp long, value long")
    tree = m.category_tree(spark.createDataFrame([(1, None)], "categoryid long, parentid long"))
    items = spark.createDataFrame([(10, day), (11, day), (12, 10 * day)], "itemid long, known_at long")
    asked = spark.createDataFrame([(0, 10, 2 * day), (1, 10, 6 * day), (2, 11, 2 * day), (3, 12, 2 * day)], "k int, itemid long, t long")
    got = {r.k: r for r in m.asof_metadata(asked, props, items, tree).collect()}
    assert [got[i].candidate for i in range(4)] == [True, False, True, False]
    assert (got[0].available, got[0].category_invalid, got[0].category_id) == (1, True, -1)


@pytest.mark.parametrize("rows", [[(1, 2), (2, 1)], [(1, 99)]])
def test_bad_trees_are_refused(spark, rows):
    with pytest.raises(ValueError):
        m.category_tree(spark.createDataFrame(rows, "categoryid long, parentid long"))


def test_dense_index_is_the_rank(spark):
    ids = spark.range(0, 1000, 7).selectExpr("id * 13 % 1000 as k")
    got = sorted((r.k, r.i) for r in dense_index(ids, "k", 2, "i").collect())
    assert got == [(k, n) for n, k in enumerate(sorted({x * 13 % 1000 for x in range(0, 1000, 7)}), 2)]


def test_deep_trees_are_whole_in_few_rounds(spark, monkeypatch):
    """Depth 4,095 in a chain takes twelve rounds; a bush beside it is whole, too."""
    rounds = []
    monkeypatch.setattr(m, "reliable", lambda df: rounds.append(1) or reliable(df))
    rows = [(i, i - 1 if i else None) for i in range(4096)] + [(5000 + i, 5000 if i else None) for i in range(50)] + [(6000 + i, 5000 + i) for i in range(50)]
    got = {r.categoryid: (r.root_id, r.depth, r.steps, r.tail) for r in m.category_tree(spark.createDataFrame(rows, "categoryid long, parentid long")).selectExpr("*", "size(split(path, '/')) as steps", "right(path, 9) as tail").collect()}
    assert len(rounds) <= 14 and len(got) == len(rows)
    assert all(got[i][:3] == (0, i, i + 1) for i in range(4096)) and got[4095][3] == "4094/4095" and got[6007] == (5000, 2, 3, "5007/6007")


@pytest.mark.parametrize("rows", [[(0, None), (1, 2), (2, 3), (3, 1)], [(0, 0)], [(1, None), (1, None)], [(None, None)]])
def test_cycles_beside_a_tree_repeats_and_nulls_are_refused(spark, rows):
    with pytest.raises(ValueError):
        m.category_tree(spark.createDataFrame(rows, "categoryid long, parentid long"))


def test_ids_are_made_for_a_source_without(spark):
    rows = [(5, 1, "view", 2, None), (5, 1, "view", 2, None), (1, 9, "transaction", 2, 7), (5, 1, "view", 1, None), (5, 1, "bad", 1, None)]
    got = s.clean_events(spark.createDataFrame(rows, RAW.split(", ", 1)[1]))
    assert sorted((r.event_id, r.timestamp, r.itemid) for r in got.collect()) == [(0, 1, 2), (1, 5, 1), (2, 5, 2)]
    assert s.sessionize(got).count() == 3


@pytest.mark.parametrize("seed", range(4))
def test_quantiles_are_exact(spark, seed):
    rng = random.Random(seed)
    v = [rng.choice([rng.randint(-50, 50), rng.randint(-(10**12), 10**12)]) for _ in range(rng.randint(1, 400))]
    df = spark.createDataFrame([(x,) for x in [*v, None]], "x long")
    at = (0.0, 0.1, 0.5, 0.8, 0.99, 1.0)
    want = [pytest.approx(float(x)) for x in np.quantile(np.array(v, float), at)]
    assert exact_quantiles(df, "x", at) == want and exact_quantiles(df, "x", at, width=7 * 10**9) == want
    assert exact_quantiles(df.where("false"), "x", at) == [None] * 6


PROPS = "timestamp long, itemid long, property string, value string"


def test_properties_are_cast_and_checked(spark):
    rows = [(1, 2, "available", "1"), (1, 2, "available", "1"), (1, 2, "categoryid", "7.0"), (1, 2, "790", "n1.2"), (None, 2, "available", "1"), (1, 2, "available", None)]
    make = lambda *more: m.clean_properties(spark.createDataFrame([*rows, *more], PROPS))
    assert sorted(tuple(r) for r in make().collect()) == [(2, "available", 1, 1), (2, "categoryid", 1, 7)]
    for bad, message in (((3, 2, "categoryid", "x1"), "whole"), ((3, 2, "available", "2"), "neither"), ((1, 2, "available", "0"), "conflicting")):
        with pytest.raises(ValueError, match=message):
            make(bad)


def test_the_future_changes_no_features_and_order_in_a_group_nothing(spark):
    rng = random.Random(3)
    rows = [(i, rng.randint(0, 12) * 20 * MIN, rng.randint(1, 3), rng.choice(s.BEHAVIOURS), rng.randint(1, 4), 1) for i in range(60)]
    columns = ["visitorid", "query_time", "prefix_events", "history_last_time", *(f"{b}_{x}" for b in s.BEHAVIOURS for x in ("count", "last_time", "recency"))]

    def features(rows, until):
        ses = s.sessionize(s.clean_events(spark.createDataFrame(rows, RAW)))
        g = s.timestamp_groups(s.temporal_split(ses, s.cutoffs(ses, 1.0, 1.0)))
        return sorted(map(tuple, g.where(f"query_time <= {until}").select(*columns).collect()), key=str)

    whole = features(rows, 100 * MIN)
    assert whole == features([r for r in rows if r[1] <= 100 * MIN], 100 * MIN)
    assert whole == features([(1000 - r[0], *r[1:]) for r in rows], 100 * MIN)


def test_one_visitor_and_item_with_half_of_the_events(spark):
    rows = [(i, i * 1000, 1 if i % 2 else i, "view", 7 if i % 2 else i, None) for i in range(4000)]
    ses = s.sessionize(s.clean_events(spark.createDataFrame(rows, RAW)))
    ev = s.temporal_split(ses, s.cutoffs(ses, 1.0, 1.0))
    got = s.next_targets(ev)
    assert got.count() == 1999 and got.select("itemid").distinct().count() == 1
    assert s.queries_of(s.timestamp_groups(ev)).agg({"prefix_events": "max"}).first()[0] == 1999
