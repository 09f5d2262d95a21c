"""Exact quantiles of an integer column without holding its distinct values in one place."""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def exact_quantiles(df: DataFrame, column: str, at: tuple[float, ...], width: int | None = None, buckets: int = 4096) -> list[float | None]:
    """Linearly interpolated quantiles ``at`` (0 to 1) of a long column, nulls left out; None for no values.

    A histogram of ranges of ``width`` (default: what makes at most ``buckets`` of them) tells which range holds
    each order statistic; only the rows of those ranges are ordered, by their counted values, so at most about
    ``width`` rows meet in one place.
    """
    values = df.select(F.col(column).cast("long").alias("v")).where("v is not null")
    if width is None:
        lo, hi = values.agg(F.min("v"), F.max("v")).first()
        width = 1 if lo is None else (hi - lo) // buckets + 1
    values = values.withColumn("b", F.expr(f"v div {width}L"))
    histogram = sorted(values.groupBy("b").agg(F.count("*")).collect())  # one row for each range
    n = sum(k for _, k in histogram)
    if not n:
        return [None] * len(at)
    ranks = sorted({r for q in at for r in (floor(q * (n - 1)), ceil(q * (n - 1)))})
    before, wanted = 0, {}
    for b, k in histogram:
        if found := [r - before for r in ranks if before <= r < before + k]:
            wanted[b] = (before, found)
        before += k
    counted = values.where(F.col("b").isin(*wanted)).groupBy("b", "v").agg(F.count("*").alias("k"))
    upto = F.sum("k").over(W.partitionBy("b").orderBy("v").rowsBetween(W.unboundedPreceding, 0))
    inside = F.map_from_arrays(F.array(*map(F.lit, wanted)), F.array(*(F.array(*(F.lit(r).cast("long") for r in found)) for _, found in wanted.values())))
    holds = F.explode(F.filter(F.element_at(inside, F.col("b")), lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("k"))))
    rows = counted.withColumn("upto", upto).select("b", "v", holds.alias("r")).collect()  # one row for each rank
    value = {wanted[b][0] + r: v for b, v, r in rows}
    return [value[floor(p)] + (p - floor(p)) * (value[ceil(p)] - value[floor(p)]) for p in (q * (n - 1) for q in at)]
