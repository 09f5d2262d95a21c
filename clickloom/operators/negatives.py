"""Reproducible negative samples for train queries, from the items known and eligible at the query's time."""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import partial
from itertools import accumulate
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clickloom.functions.index import reliable, running_base
from clickloom.functions.segments import ranged, scan
from clickloom.operators.metadata import eligibility_changes


def train_ranks(items: DataFrame, train: DataFrame) -> DataFrame:
    """itemid, known_at, rank: train items numbered from 0 in order of (known_at, itemid), by ranges, not in one task."""
    known = items.join(train.select("itemid").distinct(), "itemid", "left_semi").select("itemid", "known_at")
    ones = known.select(F.struct("known_at", "itemid").alias("_k"), F.lit(1).alias("_one"))
    return running_base(ones, "_k", "_one").select("_k.itemid", "_k.known_at", F.col("base").alias("rank"))


def known_item_limit(queries: DataFrame, ranks: DataFrame) -> DataFrame:
    """query_id, query_time, limit of each train query: how many train items are known by its time.

    Running counts over the distinct times of items and queries together, then one equi-join by time.
    """
    q = queries.where("split = 'train'").select("query_id", "query_time")
    times = ranks.select(F.col("known_at").alias("_t"), F.lit(1).alias("_n")).union(q.select("query_time", F.lit(0)))
    counts = times.groupBy("_t").agg(F.sum("_n").alias("_n"))
    upto = running_base(counts, "_t", "_n").join(counts, "_t").select(F.col("_t").alias("query_time"), (F.col("base") + F.col("_n")).alias("limit"))
    return q.join(upto, "query_time").select("query_id", "query_time", "limit")


def negatives(queries: DataFrame, targets: DataFrame, ranks: DataFrame, props: DataFrame, k: int = 5, seed: int = 7) -> DataFrame:
    """query_id, itemid, query_time, filled: up to ``k`` distinct items for each train query.

    The pool of a query is every train item known at its time and not last seen as unavailable, without its targets.
    With m targets, k + m places of the eligible items in order of rank are drawn without replacement (hash draws, see
    ``_positions``); those that are targets go and the first k of the rest stay, which is a uniform sample of the pool
    without a rejected draw. A smaller pool is taken whole (``filled``: the draw took every eligible item); never a later
    item. ``k`` = 0 gives an empty table of the same columns.
    """
    out = "query_id long, itemid long, query_time long, filled boolean"
    if k == 0:
        return queries.sparkSession.createDataFrame([], out)
    changes = eligibility_changes(ranks.select("itemid", "known_at"), props).join(ranks.select("itemid", "rank"), "itemid")
    changes = reliable(changes.select("t", "rank", "on"))
    asked = queries.where("split = 'train'").select("query_id", F.col("query_time").alias("t"), F.lit(1).alias("_kind"))
    both = asked.unionByName(changes.select("t", F.lit(0).alias("_kind"), F.when(F.col("on"), 1).otherwise(-1).alias("_by")), allowMissingColumns=True)
    sized = scan(both, (), ("t", "_kind"), sums={"n": F.col("_by")}).where("_kind = 1 and n > 0").select("query_id", "t", "n")
    own = targets.groupBy("query_id").agg(F.count("*").alias("m"))
    sized = sized.join(own, "query_id", "left").select("query_id", "t", "n", F.least("n", F.coalesce("m", F.lit(0)) + k).alias("c"))
    draws = sized.mapInArrow(partial(_positions, seed=seed), "query_id long, t long, d long, pos long, filled boolean")
    found = select_eligible(changes, draws, ranks.count()).join(ranks.select("rank", "itemid"), "rank")
    rest = found.join(targets.select("query_id", "itemid"), ["query_id", "itemid"], "left_anti")
    place = F.row_number().over(W.partitionBy("query_id").orderBy("d"))
    return rest.withColumn("_i", place).where(F.col("_i") <= k).select("query_id", "itemid", F.col("t").alias("query_time"), "filled")


def _positions(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """c distinct places below n of each query, in the order of drawing.

    Draw d is a hash of seed, query and d modulo n - d; it counts the places not drawn before.
    """
    names = ["query_id", "t", "d", "pos", "filled"]
    types = [pa.int64()] * 4 + [pa.bool_()]
    for b in batches:
        rows = []
        for q, t, n, c in zip(*(x.to_pylist() for x in b.columns)):
            taken: list[int] = []
            for d in range(c):
                r = int(hashlib.md5(f"{seed}:{q}:{d}".encode()).hexdigest()[:15], 16) % (n - d)
                lo, hi = 0, len(taken)  # how many of the taken places stand before the r-th free one
                while lo < hi:
                    mid = (lo + hi) // 2
                    lo, hi = (mid + 1, hi) if taken[mid] - mid <= r else (lo, mid)
                taken.insert(lo, r + lo)
                rows.append((q, t, d, r + lo, c == n))
        yield _table(rows, names, types)


def select_eligible(changes: DataFrame, draws: DataFrame, n: int) -> DataFrame:
    """query_id, d, t, filled, rank: the item in place ``pos`` (from 0) of those eligible at t, in order of rank.

    ``changes``: t, rank (below ``n``), on, in turn on and off for each rank; ``draws``: query_id, d, t, pos, filled.
    Changes and draws go in ranges of time. In each, one sweep over counts of blocks of ranks finds a draw's block
    (what is counted at the start of a range are sums over the ranges before), and a sweep over each block finds
    the rank. A task has the blocks' counts or the ranks of one block, and the rows of one range.
    """
    size = max(256, isqrt(n))
    log = changes.select("t", F.lit(0).alias("kind"), F.col("rank").alias("id"), F.lit(0).cast("long").alias("d"), F.when(F.col("on"), 1).otherwise(-1).cast("long").alias("x"), F.lit(False).alias("filled"))
    both = log.union(draws.select("t", F.lit(1), F.col("query_id"), "d", "pos", "filled"))
    rows = ranged(both, "t", "kind", "id", "d").drop("_place").withColumnRenamed("_range", "part")
    parts = (rows.agg(F.max("part")).first()[0] or 0) + 1
    log = rows.where("kind = 0").withColumn("block", F.expr(f"id div {size}L"))
    net = log.groupBy("part", "block").agg(F.sum("x").alias("x"))
    every = net.select("block").distinct().select("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    upto = W.partitionBy("block").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    start = every.join(net, ["block", "part"], "left").select("part", "block", F.sum("x").over(upto).alias("x")).where("x > 0")
    zero = F.lit(0).cast("long")
    top = start.select("part", F.lit(0).alias("step"), zero.alias("t"), F.lit(0).alias("kind"), F.col("block").alias("id"), zero.alias("d"), "x", F.lit(False).alias("filled"))
    top = top.union(log.select("part", F.lit(1), "t", "kind", "block", "d", "x", "filled")).union(rows.where("kind = 1").select("part", F.lit(1), "t", "kind", "id", "d", "x", "filled"))
    asked = top.repartition("part").sortWithinPartitions("part", "step", "t", "kind").mapInArrow(_blocks, "part int, t long, id long, d long, x long, filled boolean, block long")
    # the ranks that are eligible when a range begins: from the range after the change that let them in to that of the one that put them out
    turns = scan(log.select("id", "t", "x", "part"), ("id",), ("t",), before={"since": F.col("part")})
    closed = turns.where("x < 0 and part > since").select("id", F.explode(F.expr("sequence(since + 1, part)")).alias("part"))
    last = log.groupBy("id").agg(F.max_by(F.struct("x", "part"), "t").alias("z")).where("z.x > 0").where(F.col("z.part") < parts - 1)
    live = closed.union(last.select("id", F.explode(F.sequence(F.col("z.part") + 1, F.lit(parts - 1)))))
    cell = live.select("part", F.expr(f"id div {size}L").alias("block"), F.lit(0).alias("step"), zero.alias("t"), F.lit(0).alias("kind"), "id", zero.alias("d"), F.lit(1).cast("long").alias("x"), F.lit(False).alias("filled"))
    cell = cell.union(log.select("part", "block", F.lit(1), "t", "kind", "id", "d", "x", "filled")).union(asked.select("part", "block", F.lit(1), "t", F.lit(1), "id", "d", "x", "filled"))
    return cell.repartition("part", "block").sortWithinPartitions("part", "block", "step", "t", "kind").mapInArrow(_ranks, "query_id long, d long, t long, filled boolean, rank long")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The block of ranks that holds each draw, and its place in it."""
    now, counts, order, sums = None, {}, None, None
    for b in batches:
        out = []
        for part, step, t, kind, id_, d, x, filled in zip(*(c.to_pylist() for c in b.columns)):
            if part != now:
                now, counts, order = part, {}, None
            if kind == 0:
                counts[id_] = counts.get(id_, 0) + x
                order = None
                continue
            if order is None:
                order = sorted(counts)
                sums = list(accumulate(counts[i] for i in order))
            i = bisect_right(sums, x)
            out.append((part, t, id_, d, x - (sums[i - 1] if i else 0), filled, order[i]))
        yield _table(out, ["part", "t", "id", "d", "x", "filled", "block"], [pa.int32(), *[pa.int64()] * 4, pa.bool_(), pa.int64()])


def _ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rank of each draw in the sorted eligible ranks of its block."""
    now, live = None, []
    for b in batches:
        out = []
        for part, block, _, t, kind, id_, d, x, filled in zip(*(c.to_pylist() for c in b.columns)):
            if (part, block) != now:
                now, live = (part, block), []
            if kind:
                out.append((id_, d, t, filled, live[x]))
            elif x > 0:
                insort(live, id_)
            else:
                del live[bisect_left(live, id_)]
        yield _table(out, ["query_id", "d", "t", "filled", "rank"], [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()])


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(names), types)], names=names)


def shortfall(queries: DataFrame, found: DataFrame, k: int = 5) -> DataFrame:
    """One row: train_queries, short_queries (with fewer than ``k`` negatives), missing (samples in all)."""
    have = found.groupBy("query_id").agg(F.count("*").alias("n"))
    q = queries.where("split = 'train'").select("query_id").join(have, "query_id", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    return q.agg(F.count("*").alias("train_queries"), F.count_if(F.col("n") < k).alias("short_queries"), F.coalesce(F.sum(F.lit(k) - F.col("n")), F.lit(0)).cast("long").alias("missing"))
