"""CSV sources, Parquet tables, and publishing: tables first, checks next, the manifest last."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickloom.sources.star import require_columns

EVENTS = "timestamp long, visitorid long, event string, itemid long, transactionid long"
PROPERTIES = "timestamp long, itemid long, property string, value string"
TREE = "categoryid long, parentid long"
MANIFEST = "dataset_info"


def _csv(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Typed rows; a malformed row or other header is an error, not a null."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("enforceSchema", False).csv(paths)


def read_events(spark: SparkSession, path: str | list[str], schema: str = EVENTS) -> DataFrame:
    return require_columns(_csv(spark, path, schema))


def read_properties(spark: SparkSession, paths: list[str], keep: tuple[str, ...] | None = None) -> DataFrame:
    """All files as one table with the file's name; ``keep`` limits the properties (a filter on the scan)."""
    rows = _csv(spark, paths, PROPERTIES).withColumn("source", F.input_file_name())
    return rows.where(F.col("property").isin(*keep)) if keep else rows


def property_files(rows: DataFrame) -> DataFrame:
    """source, row_count, items, properties of each file read."""
    return rows.groupBy("source").agg(F.count("*").alias("row_count"), F.count_distinct("itemid").alias("items"), F.count_distinct("property").alias("properties"))


def read_category_tree(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, TREE)


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: row_count, fingerprint. The sum of a 60-bit md5 part of each row: free of order and files, repeats count.

    A row is the text of its columns in order of name; null is told from every text.
    """
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-"))
    row = F.conv(F.substring(F.md5(F.concat_ws("|", *map(part, sorted(df.columns)))), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.select(row.alias("h")).agg(F.count("*").alias("row_count"), F.coalesce(F.sum("h"), F.lit(0)).cast("string").alias("fingerprint"))


def manifest(tables: Mapping[str, DataFrame]) -> DataFrame:
    """name, schema (JSON), row_count, fingerprint of each table."""
    rows = [fingerprint(df).select(F.lit(n).alias("name"), F.lit(json.dumps(sorted(df.dtypes))).alias("schema"), "row_count", "fingerprint") for n, df in tables.items()]
    return reduce(DataFrame.union, rows)


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Write each table as Parquet and return it as read back."""
    out = {}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        out[name] = df.sparkSession.read.parquet(f"{folder}/{name}")
    return out


def write_splits(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table in one folder for each split, so that readers of one split read only its files."""
    df.write.mode("overwrite").partitionBy("split").parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def write_bucketed(df: DataFrame, folder: str, name: str, key: str, buckets: int) -> DataFrame:
    """Write a table in ``buckets`` files by a hash of ``key``, each sorted by it, and return it as ``open_bucketed`` reads it.

    Tables of the same buckets are joined and grouped by ``key`` as they lie, without a shuffle.
    """
    df.repartition(buckets, key).sortWithinPartitions(key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", f"{folder}/{name}").saveAsTable(_registered(folder, name))
    return open_bucketed(df.sparkSession, folder, name, df.schema, key, buckets)


def open_bucketed(spark: SparkSession, folder: str, name: str, schema: StructType, key: str, buckets: int) -> DataFrame:
    """A table of ``write_bucketed``, also in a session other than the one that wrote it."""
    table = _registered(folder, name)
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{folder}/{name}'")
    return spark.table(table)


def _registered(folder: str, name: str) -> str:
    """Name in the catalog; the folder's hash keeps datasets apart."""
    return f"{name}_{hashlib.md5(folder.encode()).hexdigest()[:12]}"


def publish(tables: Mapping[str, DataFrame], folder: str, check=None, config: Mapping | None = None) -> DataFrame:
    """Write ``tables`` to a new ``folder``, audit them, and last the manifest that marks the dataset complete.

    ``check`` takes the tables as read back and returns rows (check, violations); any violation is an error, and
    the folder then stays without manifest, so readers refuse it. A folder with a manifest is never overwritten.
    """
    spark = next(iter(tables.values())).sparkSession
    if _exists(spark, f"{folder}/{MANIFEST}"):
        raise FileExistsError(f"{folder} is published already")
    stored = write_tables(tables, folder)
    if check is not None and (bad := check(stored).where("violations > 0").limit(20).collect()):
        raise ValueError(f"checks failed: {[(r['check'], r['violations']) for r in bad]}")
    manifest(stored).withColumn("config", F.lit(json.dumps(config or {}, sort_keys=True))).coalesce(1).write.parquet(f"{folder}/{MANIFEST}")
    return spark.read.parquet(f"{folder}/{MANIFEST}")


def _exists(spark: SparkSession, folder: str) -> bool:
    """Whether a committed Parquet table is there; files of an unfinished write are not visible to readers."""
    try:
        return bool(spark.read.parquet(folder).columns)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def require_complete(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of a published dataset; an error if it is missing, half written or of other schemas."""
    if not _exists(spark, f"{folder}/{MANIFEST}"):
        raise FileNotFoundError(f"{folder} is not a complete dataset")
    out = {}
    for row in spark.read.parquet(f"{folder}/{MANIFEST}").select("name", "schema").collect():  # one row for each table
        if not _exists(spark, f"{folder}/{row.name}"):
            raise FileNotFoundError(f"table {row.name} of {folder} is not complete")
        out[row.name] = spark.read.parquet(f"{folder}/{row.name}")
        if json.dumps(sorted(out[row.name].dtypes)) != row.schema:
            raise ValueError(f"table {row.name} of {folder} has another schema")
    return out


def verify_manifest(spark: SparkSession, folder: str, config: Mapping | None = None) -> DataFrame:
    """name, stored_rows, found_rows, same: the tables counted again against the manifest.

    With ``config``, a dataset made with another one is an error.
    """
    tables = require_complete(spark, folder)
    stored = spark.read.parquet(f"{folder}/{MANIFEST}")
    if config is not None and stored.where(F.col("config") != json.dumps(config, sort_keys=True)).count():
        raise ValueError(f"{folder} was made with another configuration")
    found = manifest(tables).select("name", F.col("row_count").alias("found_rows"), F.col("fingerprint").alias("_f"))
    both = stored.join(found, "name", "full")
    return both.select("name", F.col("row_count").alias("stored_rows"), "found_rows", (F.col("fingerprint").eqNullSafe(F.col("_f")) & F.col("row_count").eqNullSafe(F.col("found_rows"))).alias("same"))
