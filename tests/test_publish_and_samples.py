"""Publishing, negative samples, checks and ranking on small tables."""

import pytest

from clickloom.operators import checks, negatives, ranking
from clickloom.operators import metadata as m
from clickloom.sources import files

DAY = 86_400_000
QUERIES = "query_id long, query_time long, split string"


def test_publish_is_read_again_and_tampering_shows(spark, tmp_path):
    a, b = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k long, v string"), spark.range(3)
    path = str(tmp_path / "set")
    with pytest.raises(FileNotFoundError):
        files.require_complete(spark, path)
    files.publish({"a": a, "b": b}, path, config={"gap": 30})
    assert {r.name: (r.stored_rows, r.same) for r in files.verify_manifest(spark, path, {"gap": 30}).collect()} == {"a": (3, True), "b": (3, True)}
    with pytest.raises(ValueError, match="configuration"):
        files.verify_manifest(spark, path, {"gap": 31})
    with pytest.raises(FileExistsError):
        files.publish({"a": a}, path)
    spark.createDataFrame([(1, None), (1, "None"), (2, "x")], a.schema).write.mode("overwrite").parquet(f"{path}/a")
    assert {r.name: r.same for r in files.verify_manifest(spark, path).collect()} == {"a": False, "b": True}
    spark.range(3).write.mode("overwrite").parquet(f"{path}/a")
    with pytest.raises(ValueError, match="another schema"):
        files.require_complete(spark, path)


def test_failed_checks_leave_no_dataset(spark, tmp_path):
    path = str(tmp_path / "set")
    with pytest.raises(ValueError, match="repeated_id"):
        files.publish({"a": spark.createDataFrame([(1,), (1,)], "id long")}, path, lambda t: checks.report(repeated_id=checks.repeated(t["a"], "id")))
    with pytest.raises(FileNotFoundError):
        files.require_complete(spark, path)


def test_csv_is_typed_and_strict(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("timestamp,visitorid,event,itemid,transactionid\n5,1,view,2,\n6,1,transaction,2,9\n")
    bad.write_text("timestamp,visitorid,event,itemid,transactionid\nsoon,1,view,2,\n")
    assert [tuple(r) for r in files.read_events(spark, str(good)).orderBy("timestamp").collect()] == [(5, 1, "view", 2, None), (6, 1, "transaction", 2, 9)]
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        files.read_events(spark, str(bad)).collect()
    for i in (1, 2):
        (tmp_path / f"p{i}.csv").write_text("timestamp,itemid,property,value\n" + f"1,{i},available,1\n" * i)
    rows = files.read_properties(spark, [str(tmp_path / f"p{i}.csv") for i in (1, 2)])
    assert sorted((r.source[-6:], r.row_count) for r in files.property_files(rows).collect()) == [("p1.csv", 1), ("p2.csv", 2)]


def test_negatives_are_known_eligible_and_no_targets(spark):
    train = spark.createDataFrame([(i,) for i in range(10)], "itemid long")
    items = spark.createDataFrame([(i, i * DAY) for i in range(12)], "itemid long, known_at long")
    props = spark.createDataFrame([(1, "available", DAY, 0), (2, "available", DAY, 1)], "itemid long, property string, timestamp long, value long")
    q = spark.createDataFrame([(1, 4 * DAY, "train"), (2, 20 * DAY, "train"), (3, 20 * DAY, "test"), (4, -1, "train")], QUERIES)
    t = spark.createDataFrame([(1, 3), (2, 0)], "query_id long, itemid long")
    ranks = negatives.train_ranks(items, train)
    assert {r.query_id: r.limit for r in negatives.known_item_limit(q, ranks).collect()} == {1: 5, 2: 10, 4: 0}
    make = lambda **o: sorted((r.query_id, r.itemid) for r in negatives.negatives(q, t, ranks, props, **o).collect())
    got = make(k=5)
    assert [i for k, i in got if k == 1] == [0, 2, 4]  # all that exist: 1 is unavailable, 3 a target
    assert len({i for k, i in got if k == 2}) == 5 and not {i for k, i in got if k == 2} & {0, 1, 10, 11}
    assert {k for k, _ in got} == {1, 2} and got == make(k=5)
    none = negatives.negatives(q, t, ranks, props, k=0)
    assert none.count() == 0 and none.columns == ["query_id", "itemid", "query_time", "filled"]
    found = negatives.negatives(q, t, ranks, props, k=5)
    assert tuple(negatives.shortfall(q, found).first()) == (3, 2, 7)


def test_checks_count_violations(spark):
    ev = [(1, 1, 1, "view", 5, None, 1, "train"), (1, 1, 1, "view", 5, None, 1, "test"), (2, 2, None, "transaction", 5, None, 2, "train")]
    got = checks.events(spark.createDataFrame(ev, "event_id long, timestamp long, visitorid long, event string, itemid long, transactionid long, session_id long, split string"))
    assert {r["check"]: r.violations for r in got.collect()} == {"duplicate_events": 1, "null_required": 1, "transaction_without_id": 1, "invalid_event": 0, "session_in_splits": 1}


def test_popularity_and_metrics(spark):
    top = ranking.popularity(spark.createDataFrame([(i,) for i in (7, 7, 8, 9, 9)], "itemid long"), 2)
    assert [tuple(r) for r in top.orderBy("rank").collect()] == [(7, 2, 1), (9, 2, 2)]
    t = spark.createDataFrame([("test", 1, 9), ("test", 1, 50), ("test", 2, 50)], "split string, query_id long, itemid long")
    r = ranking.metrics(top, t, (10,)).first()
    assert (r.queries, r.recall, r.hit_rate, r.mrr, r.ndcg) == (2, 0.25, 0.5, 0.25, 0.193426)


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        q = files.write_bucketed(spark.range(100).selectExpr("id as query_id", "id * 2 as t"), str(tmp_path), "queries", "query_id", 4)
        files.write_bucketed(spark.range(300).selectExpr("id div 3 as query_id", "id as itemid"), str(tmp_path), "targets", "query_id", 4)
        spark.sql(f"DROP TABLE {files._registered(str(tmp_path), 'targets')}")  # as another session finds it
        g = files.open_bucketed(spark, str(tmp_path), "targets", spark.createDataFrame([], "query_id long, itemid long").schema, "query_id", 4)
        both = q.join(g, "query_id").groupBy("query_id", "t").count()
        assert "Exchange" not in both._jdf.queryExecution().toString() and "SortMergeJoin" in both._jdf.queryExecution().toString()
        assert both.where("count = 3").count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
