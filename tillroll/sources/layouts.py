"""Stored layouts of large tables: by month, so that a filter on months lists and reads those alone, and in buckets of a
key, so that tables bucketed alike are joined and grouped by it without a shuffle."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tillroll.sources.tables import table_path

# The partition column that `write_by_month` adds: `yyyy-MM`, or missing where the date is.
MONTH = "order_month"


def month_of(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def write_by_month(
    df: DataFrame, root: str, layer: str, name: str, date_col: str, files_per_month: int = 1
) -> DataFrame:
    """Replace the table by the frame's rows, in one folder per month and at most `files_per_month` files in each,
    sorted by date. Rows of a large month are dealt over its files by a hash of all their columns."""
    path = table_path(root, layer, name)
    dealt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_month))
    rows = df.withColumn(MONTH, month_of(F.col(date_col)))
    rows = rows.repartition(MONTH, dealt).sortWithinPartitions(MONTH, date_col)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(MONTH).parquet(path)
    return read_by_month(df.sparkSession, root, layer, name, df.schema)


def read_by_month(
    spark: SparkSession, root: str, layer: str, name: str, schema: StructType,
    first: str | None = None, last: str | None = None,
) -> DataFrame:
    """The stored table with its month; with bounds (`yyyy-MM`, both included) other months' folders are not read."""
    listed = StructType([*schema.fields]).add(MONTH, StringType())
    rows = spark.read.schema(listed).parquet(table_path(root, layer, name))
    if first is not None:
        rows = rows.where(F.col(MONTH) >= first)
    return rows if last is None else rows.where(F.col(MONTH) <= last)


def _catalog_name(path: str) -> str:
    return f"bucketed_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def write_bucketed(df: DataFrame, root: str, layer: str, name: str, by: str, buckets: int) -> DataFrame:
    """Replace the table by the frame's rows, in `buckets` files by a hash of `by`, each sorted by it."""
    path, spark = table_path(root, layer, name), df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_catalog_name(path)}")  # its entry alone; the data lie outside the warehouse
    (
        df.repartition(buckets, by)
        .write.mode("overwrite").format("parquet").option("path", path)
        .bucketBy(buckets, by).sortBy(by).saveAsTable(_catalog_name(path))
    )
    return spark.table(_catalog_name(path))


def read_bucketed(
    spark: SparkSession, root: str, layer: str, name: str, schema: StructType, by: str, buckets: int
) -> DataFrame:
    """The stored table, in a session that may not have written it. Key and number are those it was written with."""
    path = table_path(root, layer, name)
    if not spark.catalog.tableExists(_catalog_name(path)):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        place = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {_catalog_name(path)} ({columns}) USING parquet "
            f"CLUSTERED BY (`{by}`) SORTED BY (`{by}`) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
    return spark.table(_catalog_name(path))
