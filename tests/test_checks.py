"""Each data check counts nothing on a sound build and counts the rows of a table broken for it."""

import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import checks, negatives
from clickloom.operators import metadata as m
from clickloom.operators import sessions as s

MIN = 60_000


@pytest.fixture(scope="module")
def built(spark):
    rng = random.Random(9)
    rows = [(i, rng.randint(0, 300) * 5 * MIN, rng.randint(1, 8), rng.choice(s.BEHAVIOURS), rng.randint(1, 12), 5) for i in range(400)]
    ses = s.sessionize(s.clean_events(spark.createDataFrame(rows, "event_id long, timestamp long, visitorid long, event string, itemid long, transactionid long")), 60)
    t = {"ends": s.cutoffs(ses)}
    t["events"] = s.temporal_split(ses, t["ends"]).cache()
    t["groups"] = s.timestamp_groups(t["events"]).cache()
    t["queries"], t["targets"] = s.queries_of(t["groups"]).cache(), s.next_targets(t["events"]).cache()
    t["train"] = t["events"].where("split = 'train'")
    t["users"], t["items"] = m.mapping(t["train"], "visitorid").cache(), m.mapping(t["train"], "itemid").cache()
    t["pairs"] = m.interactions(t["train"], t["users"], t["items"], t["ends"].first().train_end).cache()
    t["props"] = spark.createDataFrame([(i, p, 1000 * MIN * k, (i + k) % 2) for i in range(1, 9) for k in (0, 1) for p in ("available", "categoryid")], "itemid long, property string, timestamp long, value long")
    t["catalog"] = m.catalog(t["events"], t["props"]).cache()
    t["tree"] = m.category_tree(spark.createDataFrame([(1, None)], "categoryid long, parentid long"))
    t["meta"] = m.asof_metadata(t["targets"], t["props"], t["catalog"], t["tree"], "query_time").cache()
    t["negatives"] = negatives.negatives(t["queries"], t["targets"], negatives.train_ranks(t["catalog"], t["train"]), t["props"], k=3).cache()
    t["negative_meta"] = m.asof_metadata(t["negatives"].drop("filled"), t["props"], t["catalog"], t["tree"], "query_time").cache()
    return t


RUN = {
    "events": lambda t: checks.events(t["events"]),
    "queries": lambda t: checks.queries(t["queries"], t["targets"], t["ends"]),
    "targets": lambda t: checks.targets(t["targets"], t["queries"], t["groups"]),
    "next_group": lambda t: checks.next_group(t["events"], t["queries"]),
    "target_sets": lambda t: checks.target_sets(t["events"], t["queries"], t["targets"]),
    "features": lambda t: checks.features(t["queries"].drop("split", "target_time"), t["events"]),
    "prefixes": lambda t: checks.prefixes(t["events"], t["queries"]),
    "mappings": lambda t: checks.mappings(t["train"], t["users"], t["items"]),
    "interactions": lambda t: checks.interactions(t["pairs"], t["train"]),
    "properties": lambda t: checks.properties(t["props"]),
    "metadata": lambda t: checks.metadata(t["meta"], t["props"], t["catalog"]),
    "negatives": lambda t: checks.negatives(t["negatives"], t["queries"], t["targets"], t["items"], t["negative_meta"]),
}
set_ = lambda c, e: lambda df: df.withColumn(c, F.expr(e))
#: report, table, change, checks that must fire
BROKEN = [
    ("events", "events", lambda df: df.union(df.limit(1).withColumn("split", F.lit("other"))), {"duplicate_events", "session_in_splits"}),
    ("queries", "queries", lambda df: df.union(df.limit(1)), {"duplicate_query", "duplicate_session_time"}),
    ("queries", "queries", set_("target_time", "query_time"), {"target_not_later"}),
    ("queries", "queries", set_("target_time", "target_time + 1000000000"), {"target_after_split_end"}),
    ("queries", "queries", set_("split", "'boundary_drop'"), {"boundary_query"}),
    ("queries", "targets", lambda df: df.where("query_id % 2 = 0"), {"query_without_targets"}),
    ("targets", "targets", lambda df: df.union(df), {"duplicate_pair", "count_mismatch"}),
    ("targets", "targets", set_("target_time", "target_time + 1"), {"other_target_time"}),
    ("targets", "queries", lambda df: df.where("query_id % 2 = 0"), {"target_without_query"}),
    ("next_group", "queries", set_("target_time", "target_time + 1"), {"wrong_next_time"}),
    ("next_group", "queries", lambda df: df.where("query_id % 2 = 0"), {"step_without_query"}),
    ("next_group", "events", lambda df: df.where("event = 'view'"), {"query_without_step"}),
    ("target_sets", "targets", set_("itemid", "itemid + 1"), {"missing_target", "unexpected_target"}),
    ("features", "queries", set_("history_last_time", "query_time + 1"), {"history_in_future"}),
    ("features", "queries", set_("view_last_time", "query_time + 1"), {"history_in_future"}),
    ("features", "queries", set_("view_recency", "-1D"), {"recency_in_future"}),
    ("features", "queries", set_("query_time", "query_time + 1"), {"query_without_features", "features_without_query"}),
    ("features", "queries", set_("target_count", "1"), {"label_columns"}),
    ("prefixes", "queries", set_("prefix_events", "prefix_events + 1"), {"prefix_events"}),
    ("prefixes", "queries", set_("view_recency", "view_recency + 1"), {"view_recency"}),
    ("mappings", "users", set_("visitorid_idx", "visitorid_idx + 1"), {"visitorid_index_not_dense"}),
    ("mappings", "items", set_("itemid", "itemid + 1"), {"itemid_unmapped", "itemid_not_in_train"}),
    ("interactions", "pairs", lambda df: df.union(df), {"duplicate_interaction", "view_total_differs"}),
    ("properties", "props", lambda df: df.union(df.limit(1)), {"duplicate_property"}),
    ("metadata", "meta", set_("available_time", "query_time + 1"), {"availability_from_future", "other_availability"}),
    ("metadata", "meta", set_("category_time", "query_time + 1"), {"category_from_future", "other_category"}),
    ("metadata", "meta", set_("candidate", "not candidate"), {"other_candidate"}),
    ("negatives", "negatives", lambda df: df.union(df), {"duplicate_negative"}),
    ("negatives", "negatives", set_("itemid", "itemid + 1000"), {"not_in_vocabulary"}),
    ("negatives", "negatives", set_("query_id", "query_id + 100000"), {"not_a_train_query"}),
    ("negatives", "targets", lambda df: df.sparkSession.table("negatives_as_targets"), {"negative_is_target"}),
    ("negatives", "negative_meta", set_("candidate", "false"), {"not_eligible"}),
]


def fired(df):
    return {r["check"] for r in df.collect() if r.violations}


@pytest.mark.parametrize("name", RUN)
def test_nothing_fires_on_a_sound_build(built, name):
    assert fired(RUN[name](built)) == set()


@pytest.mark.parametrize(("name", "table", "change", "must"), BROKEN)
def test_broken_tables_fire(built, name, table, change, must):
    built["negatives"].createOrReplaceTempView("negatives_as_targets")
    assert must <= fired(RUN[name](built | {table: change(built[table])}))
