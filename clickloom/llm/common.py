"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.index import reliable, shared_dir
from clickloom.functions.joins import join_split

__all__ = ["checkpointed", "columns_of", "components", "join_split", "let", "map_columns", "shared_dir", "table", "unused", "written"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: bytes.translate table that lower-cases A-Z and leaves every other byte alone.
LOWER_TABLE = bytes.maketrans(UPPER.encode(), LOWER.encode())


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of one input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    return reliable(df)


def columns_of(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever their names."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def unused(df: DataFrame, name: str) -> str:
    """``name``, with further underscores if ``df`` has it already (in either case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, and the size that Spark plans with is the real one.

    (A checkpoint keeps the estimate of its plan, which joins multiply from round to round.)
    """
    path = shared_dir(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once for each row, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def map_columns(df: DataFrame, step: Callable[[list], dict], schema: str) -> DataFrame:
    """Apply ``step`` (lists, one for each column of ``df``, to a dict of lists) to Arrow batches."""
    arrow = pa.schema(list(_arrow_fields(df.sparkSession, schema)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = step(*(c.to_pylist() for c in b.columns))
            yield pa.RecordBatch.from_pydict({f.name: out[f.name] for f in arrow}, schema=arrow)

    return df.mapInArrow(run, schema)


def _arrow_fields(spark: SparkSession, schema: str) -> Iterator[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    yield from to_arrow_schema(_parse_datatype_string(schema))


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """Connected components of undirected ``edges`` (src, dst): node, component_id (its smallest node).

    Alternates large-star and small-star steps, each a partial aggregation and a join (which adaptive
    execution may split where a node has very many neighbours), until nothing changes; a reliable checkpoint
    cuts the lineage after each round. Null ends and self links are dropped; no edges give no rows.
    """
    links = checkpointed(
        edges.where("src <> dst").select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).distinct()
    )
    state = _state(links)
    for _ in range(rounds):
        if state[0] == 0:
            break
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        # large star: every larger neighbour of a points at the smallest of a and its neighbours
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        # small star: a and its smaller neighbours point at the smallest of them
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = checkpointed(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        now = _state(links)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    out = links.groupBy("a").agg(F.min("b").alias("component_id"))
    roots = out.select(F.col("component_id").alias("a"), "component_id").distinct()
    return out.union(roots).select(F.col("a").alias("node"), "component_id")


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]
