"""Layer tables as Parquet folders `<root>/<layer>/<name>`."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DEFAULT_LAYER = "main"


def table_path(root: str, layer: str | None, name: str) -> str:
    """The layer's name is taken as it is; a table without one belongs to the default layer."""
    return f"{root.rstrip('/')}/{layer or DEFAULT_LAYER}/{name}"


def write_table(
    df: DataFrame,
    root: str,
    layer: str | None,
    name: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Replace the table with the frame's rows and return the stored table.

    `sort_by` orders the rows inside each file, without a shuffle, so that filters on those columns
    skip row groups.
    """
    path = table_path(root, layer, name)
    rows = df.sortWithinPartitions(*sort_by) if sort_by else df
    writer = rows.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, root: str, layer: str | None, name: str) -> DataFrame:
    return spark.read.parquet(table_path(root, layer, name))


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as that knows it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists in whatever file system its scheme names."""
    files, hadoop_path = file_system(spark, path)
    return files.exists(hadoop_path)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes in all files under the path, from the file system's own count."""
    files, hadoop_path = file_system(spark, path)
    return files.getContentSummary(hadoop_path).getLength()


def matching_names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the files and folders that match the pattern."""
    files, hadoop_pattern = file_system(spark, pattern)
    return [status.getPath().getName() for status in files.globStatus(hadoop_pattern) or []]


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The stored table, or an empty frame of the schema if nothing was stored yet."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


# Repeated keys are broadcast up to this many; beyond it all rows are grouped by key.
REPEATED_KEYS = 100_000


def _least_rows(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the least by the other columns. The rows of a key are merged before they are shuffled."""
    others = [name for name in df.columns if name != key]
    merged = df.groupBy(key).agg(F.min(F.struct(*others)).alias("row"))
    return merged.select(
        *[F.col(name) if name == key else F.col(f"row.{name}") for name in df.columns]
    )


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key: of several, the least by the other columns. Rows without a key drop out.

    Keys that stand more than once are found on the keys alone (an action that reads no other column) and
    broadcast, so that only their rows are grouped; all other rows stay where they are. The frame is read
    again for that, so it should be one that is stored, or cheap to make.
    """
    rows = df.where(F.col(key).isNotNull())
    counts = rows.groupBy(F.col(key).alias("__repeated")).agg(F.count(F.lit(1)).alias("__rows"))
    repeated = counts.where("__rows > 1").select("__repeated")
    n = repeated.limit(REPEATED_KEYS + 1).count()
    if not n:
        return rows
    if n > REPEATED_KEYS:
        return _least_rows(rows, key)
    marked = rows.join(F.broadcast(repeated), F.col(key) == F.col("__repeated"), "left")
    single = marked.where("__repeated is null").select(*df.columns)
    return single.unionByName(_least_rows(marked.where("__repeated is not null").select(*df.columns), key))


def register_layer(spark: SparkSession, root: str, layer: str, names: list[str]) -> None:
    """Make stored tables known to SQL as `<layer>.<name>`."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    for name in names:
        path = table_path(root, layer, name)
        spark.sql(f"DROP TABLE IF EXISTS `{layer}`.`{name}`")
        spark.sql(f"CREATE TABLE `{layer}`.`{name}` USING parquet LOCATION '{path}'")


def load_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
