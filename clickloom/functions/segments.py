"""Ordered scans over a whole table in even ranges, so that one key may span many tasks.

A window by key sends all rows of a key to one task. Here rows are dealt by ranges of (key, order), which cut a
long key where its range is full; what a range must know of the ones before it is a single row, that of its
first key. Those rows, one for each partition, are all that ever meets in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clickloom.functions.index import reliable

#: monotonically_increasing_id: the partition above this bit, the place in the partition below it.
PLACE_BITS = 33


def ranged(df: DataFrame, *order: str) -> DataFrame:
    """``df`` in ranges of ``order``, each sorted, with _range (its number) and _place (of a row in it, from 0).

    Nulls come first. The rows are kept by a reliable checkpoint, so that every later look sees the same ranges.
    """
    kept = reliable(df.repartitionByRange(*order).sortWithinPartitions(*order))
    at = F.monotonically_increasing_id()
    return kept.withColumns({"_range": F.shiftright(at, PLACE_BITS).cast("int"), "_place": at.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))})


def scan(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None, before: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with running values in ``order`` within each key, which may span any number of tasks (no keys: the whole table).

    ``sums``: name to a value added up to each row, itself included (nulls count 0). ``lasts``: name to a value whose
    last one that is not null is taken, itself included. ``before``: as ``lasts``, from the rows before. Also adds
    _range. Rows equal in keys and order come in any order, so give one that settles all that matters.
    """
    sums, lasts, before = sums or {}, lasts or {}, before or {}
    values = {f"_v_{n}": c for n, c in (sums | lasts | before).items()}
    rows = ranged(df.withColumns(values), *keys, *order)
    inside = W.partitionBy("_range", *keys).orderBy("_place")
    upto, prior = inside.rowsBetween(W.unboundedPreceding, 0), inside.rowsBetween(W.unboundedPreceding, -1)
    found = rows.withColumns({f"_i_{n}": F.coalesce(F.sum(f"_v_{n}").over(upto), F.lit(0)) for n in sums} | {f"_i_{n}": F.last(f"_v_{n}", True).over(upto) for n in lasts} | {f"_i_{n}": F.last(f"_v_{n}", True).over(prior) for n in before})
    if rows.rdd.getNumPartitions() < 2:  # nothing comes from another range
        names = {n: F.col(f"_i_{n}") for n in sums | lasts | before}
        return found.select(*(F.col(f"`{c}`") for c in df.columns if c not in names), "_range", *(c.alias(n) for n, c in names.items()))
    # one row for each range: its first and last key, and what the last key has come to in it
    key = F.struct(*(F.col(k) for k in keys)) if keys else F.struct(F.lit(0).alias("_all"))
    ends = rows.groupBy("_range").agg(F.min_by(key, "_place").alias("_seg_first"), F.max_by(key, "_place").alias("_seg_last"))
    latest = {n: F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.col("_place"))).alias(n) for n in lasts | before}
    tail = rows.join(F.broadcast(ends), "_range").where(key.eqNullSafe(F.col("_seg_last"))).groupBy("_range", F.col("_seg_last").alias("_seg_key")).agg(*(F.coalesce(F.sum(f"_v_{n}"), F.lit(0)).alias(n) for n in sums), *latest.values())
    asked = ends.select("_range", F.col("_seg_first").alias("_seg_key"), F.lit(0).alias("_seg_kind"))
    both = tail.withColumn("_seg_kind", F.lit(1)).unionByName(asked, allowMissingColumns=True)
    earlier = W.partitionBy("_seg_key").orderBy("_range", "_seg_kind").rowsBetween(W.unboundedPreceding, -1)
    carried = both.select("_range", "_seg_key", "_seg_kind", *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_c_{n}") for n in sums), *(F.last(n, True).over(earlier).alias(f"_c_{n}") for n in lasts | before))
    carried = carried.where("_seg_kind = 0").drop("_seg_kind")
    found = found.join(F.broadcast(carried), "_range")
    same = key.eqNullSafe(F.col("_seg_key"))
    out = {n: F.col(f"_i_{n}") + F.when(same, F.col(f"_c_{n}")).otherwise(F.lit(0)) for n in sums} | {n: F.coalesce(f"_i_{n}", F.when(same, F.col(f"_c_{n}"))) for n in lasts | before}
    return found.select(*(F.col(f"`{c}`") for c in df.columns if c not in out), "_range", *(c.alias(n) for n, c in out.items()))
