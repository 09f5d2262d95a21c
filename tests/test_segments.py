"""Running values over ranges against a walk over all rows, with keys that span many ranges."""

import random

import pytest
from pyspark.sql import functions as F

from clickloom.functions.segments import scan


@pytest.mark.parametrize("hot", [False, True])
def test_scan(spark, hot):
    rng = random.Random(2)
    rows = [((None if rng.random() < 0.1 else 1 if hot and rng.random() < 0.8 else rng.randrange(30)), i, rng.choice([None, 1, 2, 3])) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, t int, v int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = scan(df, ("k",), ("t",), sums={"s": F.col("v")}, lasts={"l": F.col("v")}, before={"b": F.col("v")})
        got, ranges = {r.t: (r.s, r.l, r.b) for r in out.collect()}, out.groupBy("k").agg(F.count_distinct("_range").alias("n")).agg(F.max("n")).first()[0]
        flat = {r.t: r.s for r in scan(df, (), ("t",), sums={"s": F.col("v")}).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    state, total = {}, 0
    for k, t, v in rows:
        s, last = state.get(k, (0, None))
        state[k] = now = (s + (v or 0), last if v is None else v)
        total += v or 0
        assert got[t] == (now[0], now[1], last) and flat[t] == total
    assert len(got) == len(rows) and (not hot or ranges >= 3)


def test_scan_of_no_rows(spark):
    assert scan(spark.createDataFrame([], "k int, t int"), ("k",), ("t",), sums={"s": F.col("t")}).collect() == []
