"""Popularity baselines, over all items or the candidates of a query's time, and ranking metrics."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.index import reliable, running_base
from clickloom.functions.joins import join_split
from clickloom.functions.segments import ranged, scan


def popularity(train: DataFrame, k: int = 20) -> DataFrame:
    """itemid, events, rank (from 1) of the ``k`` train items with most events; the smaller id first among equals."""
    top = train.groupBy("itemid").agg(F.count("*").alias("events")).orderBy(F.desc("events"), "itemid").limit(k)
    rows = F.array_sort(F.collect_list(F.struct((-F.col("events")).alias("o"), "itemid", "events")))  # k rows
    return top.agg(rows.alias("r")).select(F.posexplode("r").alias("p", "x")).select("x.itemid", "x.events", (F.col("p") + 1).alias("rank"))


def metrics(ranked: DataFrame, targets: DataFrame, cuts: tuple[int, ...] = (10, 20)) -> DataFrame:
    """split, cutoff, queries, recall, hit_rate, mrr, ndcg of one list (itemid, rank) given to every query.

    Relevance is binary, the discount log2(rank + 1); targets that no list holds stay in the denominator. The
    list must have at most a few thousand rows, for it is broadcast.
    """
    return _metrics(targets.select("split", "query_id", "itemid").join(F.broadcast(ranked.select("itemid", "rank")), "itemid", "left"), cuts)


def metrics_by_query(ranked: DataFrame, targets: DataFrame, cuts: tuple[int, ...] = (10, 20)) -> DataFrame:
    """As ``metrics``, of one list (query_id, itemid, rank) for each query; queries without a list, and targets that are no candidates, count as missed."""
    return _metrics(targets.select("split", "query_id", "itemid").join(ranked.select("query_id", "itemid", "rank"), ["query_id", "itemid"], "left"), cuts)


def metrics_by_list(ranked: DataFrame, of: DataFrame, targets: DataFrame, cuts: tuple[int, ...] = (10, 20)) -> DataFrame:
    """As ``metrics_by_query``, where many queries have one list: ``of`` has query_id and list_id, ``ranked`` list_id, itemid and rank.

    Only targets are looked up, so the lists are not written out for each query. A (list, target) of very many queries
    is split by the engine's skew handling.
    """
    at = targets.select("split", "query_id", "itemid").join(of.select("query_id", "list_id"), "query_id", "left")
    return _metrics(at.join(ranked.select("list_id", "itemid", "rank"), ["list_id", "itemid"], "left"), cuts)


def _metrics(hit: DataFrame, cuts: tuple[int, ...]) -> DataFrame:
    rows = hit.withColumn("cutoff", F.explode(F.array(*map(F.lit, cuts)))).withColumn("at", F.when(F.col("rank") <= F.col("cutoff"), F.col("rank")))
    q = rows.groupBy("split", "cutoff", "query_id").agg(F.count("*").alias("n"), F.count("at").alias("h"), F.min("at").alias("first"), F.sum(1 / F.log2(F.col("at") + 1)).alias("dcg"))
    best = F.aggregate(F.sequence(F.lit(1), F.least("n", "cutoff")), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + F.lit(1.0)))
    per = q.select("split", "cutoff", (F.col("h") / F.col("n")).alias("recall"), (F.col("h") > 0).cast("int").alias("hit_rate"), F.coalesce(1 / F.col("first"), F.lit(0.0)).alias("mrr"), (F.coalesce("dcg", F.lit(0.0)) / best).alias("ndcg"))
    return per.groupBy("split", "cutoff").agg(F.count("*").alias("queries"), *(F.round(F.avg(c), 6).alias(c) for c in ("recall", "hit_rate", "mrr", "ndcg")))


def popularity_ranks(train: DataFrame) -> DataFrame:
    """itemid, rank (from 0) of all train items: most events first, the smaller id among equals; numbered by ranges."""
    counts = train.groupBy("itemid").agg(F.count("*").alias("n")).select(F.struct((-F.col("n")).alias("o"), "itemid").alias("_k"), F.lit(1).alias("_one"))
    return running_base(counts, "_k", "_one").select("_k.itemid", F.col("base").alias("rank"))


def candidate_lists(ranks: DataFrame, changes: DataFrame, k: int = 20) -> DataFrame:
    """t, part, place (from 1), itemid: the ``k`` first items by ``rank`` that are candidates from t on, whenever these change.

    A list without items is one row of place 0. Of equal t, the list of the largest part holds.

    Changes are swept in time order in ranges. A range of c changes needs at its start the k + c first candidates
    only: nothing behind them can come to the first k in it. They are looked up in blocks of ranks, as many as it
    takes, so neither the catalog nor the query times are enumerated.
    """
    log = reliable(changes.join(ranks, "itemid").select("t", "rank", "itemid", "on"))
    rows = ranged(log, "t", "rank").drop("_place")
    n = ranks.count()
    starts = rows.groupBy("_range").agg(F.min(F.struct("t", "rank")).alias("s"), (F.count("*") + k).alias("need"))
    open_ = reliable(starts.select("_range", "s", "need", F.lit(0).cast("long").alias("lo"), F.least(2 * F.col("need"), F.lit(n)).alias("hi")))
    found = None
    while not open_.isEmpty():
        asked = open_.select("_range", "s", F.explode(F.expr("sequence(lo, hi - 1)")).alias("rank")).join(ranks, "rank")
        # what came before the first row of the range: at its time, the smaller ranks only
        asked = asked.select("rank", "itemid", F.when(F.col("rank") < F.col("s.rank"), F.col("s.t")).otherwise(F.col("s.t") - 1).alias("t"), F.lit(1).alias("_kind"), F.col("_range").alias("_asked"))
        both = asked.unionByName(log.select("rank", "t", F.lit(0).alias("_kind"), "on"), allowMissingColumns=True)
        state = scan(both, ("rank",), ("t", "_kind"), lasts={"_on": F.col("on")}).where("_kind = 1 and _on")
        state = reliable(state.select(F.col("_asked").alias("_range"), "rank", "itemid"))
        found = state if found is None else reliable(found.union(state))
        have = found.groupBy("_range").agg(F.count("*").alias("have"))
        more = open_.join(have, "_range", "left").where((F.coalesce("have", F.lit(0)) < F.col("need")) & (F.col("hi") < n))
        open_ = reliable(more.select("_range", "s", "need", F.col("hi").alias("lo"), F.least(2 * F.col("hi"), F.lit(n)).alias("hi")))
    if found is None:
        return log.sparkSession.createDataFrame([], "t long, part int, place int, itemid long")
    null = F.lit(None)
    first = found.select("_range", F.lit(0).alias("kind"), null.cast("long").alias("t"), "rank", "itemid", F.lit(True).alias("on"))
    both = first.union(rows.select("_range", F.lit(1), "t", "rank", "itemid", "on"))
    return both.repartition("_range").sortWithinPartitions("_range", "kind", "t", "rank").mapInArrow(partial(_sweep, k=k), "t long, part int, place int, itemid long")


def _sweep(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The lists of each range, whose first candidates come before its changes."""
    part, live, item, top, at = None, [], {}, [], None
    out: list[tuple] = []

    def settle() -> None:
        """After the last change of one time."""
        nonlocal top
        if at is not None and live[:k] != top:
            top = live[:k]
            out.extend((at, part, i, item[r]) for i, r in enumerate(top, 1))
            if not top:
                out.append((at, part, 0, None))

    for b in batches:
        for r, kind, t, rank, itemid, on in zip(*(c.to_pylist() for c in b.columns)):
            if r != part:
                settle()
                part, live, item, top, at = r, [], {}, [], None
            if kind and t != at:
                if at is None:
                    top = live[:k]
                else:
                    settle()
                at = t
            i = bisect_left(live, rank)
            here = i < len(live) and live[i] == rank
            if on and not here:
                insort(live, rank)
                item[rank] = itemid
            elif not on and here:
                del live[i]
        if out:
            yield _lists(out)
            out = []
    settle()
    if out:
        yield _lists(out)


def _lists(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.int64()))], names=["t", "part", "place", "itemid"])


def lists_at(queries: DataFrame, lists: DataFrame) -> DataFrame:
    """query_id, list_id: for each query (query_id, query_time) the (t, part) of the list of ``candidate_lists`` that holds at its time."""
    marks = lists.select("t", "part", F.lit(0).alias("_kind"), F.struct("t", "part").alias("v")).distinct()
    asked = queries.select("query_id", F.col("query_time").alias("t"), F.lit(1).alias("_kind"))
    both = asked.unionByName(marks, allowMissingColumns=True)
    return scan(both, (), ("t", "_kind", "part"), lasts={"_list": F.col("v")}).where("_kind = 1 and _list is not null").select("query_id", F.col("_list").alias("list_id"))


def popular_candidates(queries: DataFrame, lists: DataFrame) -> DataFrame:
    """query_id, itemid, rank: for each query (query_id, query_time) the list that holds at its time."""
    lists = reliable(lists.withColumn("v", F.struct("t", "part")))
    at = reliable(lists_at(queries, lists))
    often = at.groupBy("list_id").agg(F.count("*").alias("_n"))
    rows = lists.where("place > 0").join(often, F.col("v") == F.col("list_id")).select("list_id", "place", "itemid", "_n")
    return join_split(at, rows, "list_id", "_n", at.count()).select("query_id", "itemid", F.col("place").alias("rank"))
