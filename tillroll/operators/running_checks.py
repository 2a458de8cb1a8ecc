"""Checks over tables that grow by landings, from stored counts of their keys.

Every tested column's values are counted once per landing, (entry, value, rows, known), and merged into a stored
table of counts that is cut into buckets by a hash of the value. A landing reads itself and the buckets that its
values fall into, writes those anew, and keeps per bucket what the verdicts need; so a report is a sum over as
many small rows as there are buckets and entries. Versions are committed as in `sources.commits`: two landings at
once are merged one after the other, and a reader sees all of a landing or nothing.

The report equals that of `checks.run_checks` over all landed rows together.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.checks import Check, as_value, is_number
from tillroll.sources.commits import Version, commit, read_version
from tillroll.sources.tables import matching_names

# Buckets of a new store. A bucket holds the counts of one in so many values, and is rewritten as a whole.
BUCKETS = 64
COUNTS = "entry string, number bigint, text string, rows bigint, known boolean"
TOTALS = "bucket int, entry string, not_null bigint, unique bigint, relationships bigint"


def _entry(table: str, column: str) -> str:
    return f"{table}.{column}"


def _values(df: DataFrame, columns: Mapping[str, str], rows: int) -> DataFrame:
    """(entry, number, text, rows) of the given columns (entry -> column), in one pass over the table."""
    parts = []
    for entry, column in columns.items():
        value, number = as_value(df, column), is_number(df, column)
        parts.append(
            f"named_struct('entry', '{entry}', 'number', {value if number else 'cast(null as bigint)'}, "
            f"'text', {'cast(null as string)' if number else value}, 'rows', {rows}L)"
        )
    return df.selectExpr(f"inline(array({', '.join(parts)}))")


def landed_counts(tables: Mapping[str, DataFrame], suite: Sequence[Check]) -> DataFrame:
    """Counts of one landing. Parent keys stand under the child's entry, as rows that count nothing."""
    parts = []
    for table, df in tables.items():
        own = {_entry(c.table, c.column): c.column for c in suite if c.table == table}
        parents = {_entry(c.table, c.column): c.parent_key for c in suite if c.parent == table}
        parts += [_values(df, columns, rows) for columns, rows in ((own, 1), (parents, 0)) if columns]
    return _merged(reduce(DataFrame.union, parts).withColumn("known", F.col("rows") == 0))


def _merged(counts: DataFrame) -> DataFrame:
    return counts.groupBy("entry", "number", "text").agg(
        F.sum("rows").alias("rows"), F.bool_or("known").alias("known")
    )


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("entry", "number", "text"), F.lit(buckets)).cast("int").alias("bucket")


def _write_buckets(counts: DataFrame, buckets: int, path: str) -> None:
    counts.withColumn("bucket", _bucket(buckets)).repartition("bucket").write.partitionBy("bucket").parquet(path)


def _totals(counts: DataFrame, buckets: int) -> DataFrame:
    missing = "number is null and text is null"
    return counts.groupBy(_bucket(buckets), "entry").agg(
        F.expr(f"sum(if({missing}, rows, 0L))").alias("not_null"),
        F.expr(f"count_if(not ({missing}) and rows > 1)").alias("unique"),
        F.expr(f"sum(if(not ({missing}) and not known, rows, 0L))").alias("relationships"),
    )


def add_landing(
    spark: SparkSession, root: str, tables: Mapping[str, DataFrame], suite: Sequence[Check], buckets: int = BUCKETS
) -> Version:
    """Merge one landing of (some of) the suite's tables into the store under `root`.

    `buckets` is taken when the store is new. The landing is counted once, into a folder of its own that is cut into
    buckets. Buckets that the store does not hold are taken from there as they are; the others are merged with the stored
    ones. A landing that another one overtakes is merged again with the buckets that the other has written.
    """
    base = read_version(spark, root)
    buckets = base.note.get("n_buckets", buckets)
    landed = f"data-{uuid.uuid4().hex}"
    _write_buckets(landed_counts(tables, suite), buckets, f"{root}/{landed}")
    names = matching_names(spark, f"{root}/{landed}/bucket=*")  # at most all buckets
    touched = sorted(int(name.removeprefix("bucket=")) for name in names)
    while True:
        if base.number and base.note["n_buckets"] != buckets:
            raise ValueError(f"the store has {base.note['n_buckets']} buckets, not {buckets}")
        held = base.note.get("buckets", {})
        now = held | {str(b): f"{landed}/bucket={b}" for b in touched}
        if again := [b for b in touched if str(b) in held]:
            both = [f"{root}/{place}" for b in again for place in (held[str(b)], f"{landed}/bucket={b}")]
            name = f"data-{uuid.uuid4().hex}"
            _write_buckets(_merged(spark.read.schema(COUNTS).parquet(*both)), buckets, f"{root}/{name}")
            now |= {str(b): f"{name}/bucket={b}" for b in again}
        listed = [f"{root}/{now[str(b)]}" for b in touched]
        fresh = _totals(spark.read.schema(COUNTS).parquet(*listed) if listed else spark.createDataFrame([], COUNTS), buckets)
        if base.number:
            kept = spark.read.schema(TOTALS).parquet(f"{root}/{base.note['totals']}")
            fresh = fresh.unionByName(kept.where(~F.col("bucket").isin(touched)))
        totals = f"data-{uuid.uuid4().hex}"
        fresh.coalesce(1).write.parquet(f"{root}/{totals}")
        folders = sorted({path.split("/")[0] for path in now.values()} | {totals})
        made = commit(spark, root, base, folders, {"n_buckets": buckets, "buckets": now, "totals": totals})
        if made:
            return made
        base = read_version(spark, root)


def report(spark: SparkSession, root: str, suite: Sequence[Check], version: Version | None = None) -> DataFrame:
    """(test, table, column, failures) over all landings of a version, the newest by default."""
    version = version or read_version(spark, root)
    listed = spark.createDataFrame(
        [(c.test, c.table, c.column, _entry(c.table, c.column)) for c in suite],
        "test string, table string, column string, entry string",
    )
    if version.number:
        totals = spark.read.schema(TOTALS).parquet(f"{root}/{version.note['totals']}")
    else:
        totals = spark.createDataFrame([], TOTALS)
    sums = totals.groupBy("entry").agg(*[F.sum(c).alias(c) for c in ("not_null", "unique", "relationships")])
    return listed.join(sums, "entry", "left").selectExpr(
        "test", "table", "column",
        "coalesce(case test when 'not_null' then not_null when 'unique' then unique else relationships end, 0) as failures",
    )
