"""Data-quality tests: not_null, unique and relationships, one by one or as a suite.

The suite counts every tested column's values once, in long form (table, column, value, rows), and
reads all verdicts off those counts. Values are counted before they are shuffled, so neither a value
that fills a third of a table nor a column full of NULLs ends up as one large group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType


@dataclass(frozen=True)
class Check:
    """One test. `parent` and `parent_key` belong to relationships only."""

    test: str
    table: str
    column: str
    parent: str | None = None
    parent_key: str | None = None


def _key_checks(table: str, key: str) -> list[Check]:
    return [Check("unique", table, key), Check("not_null", table, key)]


STAGING_CHECKS: list[Check] = [
    *_key_checks("stg_customers", "customer_id"),
    *_key_checks("stg_products", "product_id"),
    *_key_checks("stg_orders", "order_id"),
    *_key_checks("stg_order_items", "order_item_id"),
    *_key_checks("stg_reviews", "review_id"),
]
GOLD_CHECKS: list[Check] = [
    *_key_checks("dim_customer", "customer_id"),
    *_key_checks("dim_product", "product_id"),
    *_key_checks("dim_date", "date_day"),
    *_key_checks("fct_transactions", "order_item_id"),
    Check("not_null", "fct_transactions", "customer_id"),
    Check("relationships", "fct_transactions", "customer_id", "dim_customer", "customer_id"),
    Check("not_null", "fct_transactions", "product_id"),
    Check("relationships", "fct_transactions", "product_id", "dim_product", "product_id"),
    *_key_checks("mart_customer_performance", "customer_id"),
]
SUITE = STAGING_CHECKS + GOLD_CHECKS


class ChecksFailed(RuntimeError):
    """At least one data-quality test found failing rows."""


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows whose column is missing."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, key: str) -> DataFrame:
    """Values that occur more than once, with their number of rows; NULLs do not count."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    return counts.where(F.col("rows") > 1)


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose key has no parent; a missing key is not a failure here."""
    keys = parent.select(F.col(pk).alias(fk))
    return child.where(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


def is_number(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (IntegralType, DateType))


def as_value(df: DataFrame, column: str) -> str:
    """SQL for the column as text or, for whole numbers and dates, as a number (groups faster)."""
    if isinstance(df.schema[column].dataType, DateType):
        return f"cast(unix_date(`{column}`) as bigint)"
    return f"cast(`{column}` as {'bigint' if is_number(df, column) else 'string'})"


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


def _long_form(df: DataFrame, entries: Mapping[int, str], rows: int) -> DataFrame:
    """(entry, value, rows) of the given columns, in one pass over the table."""
    if len(entries) == 1:
        ((entry, column),) = entries.items()
        return df.selectExpr(f"{entry} as entry", f"{as_value(df, column)} as value", f"{rows}L as rows")
    pairs = [
        f"named_struct('entry', {entry}, 'value', {as_value(df, column)})"
        for entry, column in entries.items()
    ]
    return df.selectExpr(f"inline(array({', '.join(pairs)}))").selectExpr("*", f"{rows}L as rows")


def _count_values(
    tables: Mapping[str, DataFrame], suite: Sequence[Check], columns: Sequence[tuple[str, str]]
) -> DataFrame:
    """(entry, value, rows, known): rows per value of each column, entry being its position.

    `known` is true for values that have a parent where relationships asks for one. Parent keys are
    grouped together with the child's values, as rows that count nothing, which takes no join.
    """
    entry_of = {column: entry for entry, column in enumerate(columns)}
    values = [
        _long_form(tables[table], {entry_of[table, c]: c for t, c in columns if t == table}, rows=1)
        for table in dict.fromkeys(table for table, _ in columns)
    ]
    parents = [
        _long_form(tables[c.parent], {entry_of[c.table, c.column]: c.parent_key}, rows=0)
        for c in suite
        if c.test == "relationships"
    ]
    return (
        _union(values + parents)
        .groupBy("entry", "value")
        .agg(F.sum("rows").alias("rows"), F.expr("min(rows) = 0 as known"))
    )


def _verdicts(counts: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    def name_of(part: int) -> str:
        names = ", ".join(f"'{column[part]}'" for column in columns)
        return f"get(array({names}), entry)"

    return (
        counts.groupBy("entry")
        .agg(
            F.expr("sum(if(value is null, rows, 0)) as not_null"),
            F.expr("count_if(value is not null and rows > 1) as unique"),
            F.expr("sum(if(value is not null and not known, rows, 0)) as relationships"),
        )
        .selectExpr(
            f"{name_of(0)} as table",
            f"{name_of(1)} as column",
            "not_null",
            "unique",
            "relationships",
        )
    )


def run_checks(tables: Mapping[str, DataFrame], suite: Sequence[Check] = tuple(SUITE)) -> DataFrame:
    """Report (test, table, column, failures) with one row per check of the suite.

    Failures are rows for not_null and relationships, and repeated values for unique. Number and
    text columns are counted apart, each against parents of its own kind.
    """
    spark = next(iter(tables.values())).sparkSession
    columns = list(dict.fromkeys((c.table, c.column) for c in suite))
    numbers = [(table, c) for table, c in columns if is_number(tables[table], c)]
    texts = [column for column in columns if column not in numbers]
    verdicts = []
    for group in filter(None, (numbers, texts)):
        inside = [c for c in suite if (c.table, c.column) in group]
        verdicts.append(_verdicts(_count_values(tables, inside, group), group))
    # The suite is a short list in code; a table without rows has no verdict and no failure.
    listed = spark.createDataFrame(
        [(c.test, c.table, c.column) for c in suite], "test string, table string, column string"
    )
    return listed.join(_union(verdicts), ["table", "column"], "left").selectExpr(
        "test",
        "table",
        "column",
        "coalesce(case test when 'not_null' then not_null when 'unique' then unique"
        " else relationships end, 0) as failures",
    )


def require_passed(report: DataFrame) -> None:
    """Raise if the report holds failures. Reads the report: one row per check."""
    failed = report.where(F.col("failures") > 0).orderBy("table", "column", "test").collect()
    if failed:
        lines = [f"{r['test']}({r['table']}.{r['column']}): {r['failures']}" for r in failed]
        raise ChecksFailed("; ".join(lines))
