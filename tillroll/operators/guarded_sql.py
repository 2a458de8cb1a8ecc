"""SQL text written by a model: cleaning, verdicts over a whole query log, and one guarded run."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.text import (
    FORBIDDEN_KEYWORDS,
    starts_with_select,
    whole_word,
    without_fences,
)


class QueryRefused(ValueError):
    """The SQL text did not pass the guard."""


def clean_sql(df: DataFrame, column: str) -> DataFrame:
    """The column without markdown fences and outer white space."""
    return df.withColumn(column, without_fences(F.col(column)))


def guard_sql(df: DataFrame, column: str) -> DataFrame:
    """Add the verdict on each text: `allowed`, and `reason` where it is refused."""
    lowered = F.lower(column)
    reason = (
        F.when(~F.coalesce(starts_with_select(lowered), F.lit(False)), "not a select")
        .when(whole_word(lowered, FORBIDDEN_KEYWORDS), "forbidden keyword")
    )
    return df.withColumns({"reason": reason, "allowed": reason.isNull()})


def readonly_session(spark: SparkSession, gold_paths: Mapping[str, str | Sequence[str]]) -> SparkSession:
    """A session with the given tables, each of one or several paths, as views, without the caller's own
    temporary views.

    The views read committed Parquet. They are known by name and as `gold.<name>`; nothing else can be
    read through `run_readonly_sql`.
    """
    session = spark.newSession()
    for name, path in gold_paths.items():
        session.read.parquet(*([path] if isinstance(path, str) else path)).createOrReplaceTempView(name)
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    return session


# What a reading plan may be made of. Scripts, commands, table functions and all other sources are not.
READING_NODES = frozenset({
    "Aggregate", "CTERelationDef", "CTERelationRef", "Deduplicate", "Distinct", "Except", "Expand", "Filter",
    "Generate", "GlobalLimit", "Intersect", "Join", "LateralJoin", "LocalLimit", "LocalRelation", "Offset",
    "OneRowRelation", "Pivot", "Project", "ResolvedHint", "Sample", "Sort", "SubqueryAlias", "Union", "Unpivot",
    "Window", "WithCTE",
})

# Expressions that run code from outside Spark's own functions, whatever name the text calls them by.
FOREIGN_CODE = ("Reflect", "UDF", "UDAF", "Invoke", "UserDefined")


def _refusal(plan, views: frozenset[str]) -> str | None:
    """Why an analysed plan may not run, or None. Only the registered temporary views are read."""
    kind = plan.getClass().getSimpleName()
    if kind == "View":
        desc = plan.desc().identifier()
        if plan.isTempView() and desc.table().lower() in views:
            return None
        return f"reads {desc.table()}"
    if kind not in READING_NODES:
        return f"holds {kind}"
    expressions = [plan.expressions().apply(i) for i in range(plan.expressions().size())]
    while expressions:
        own = expressions.pop()
        name = own.getClass().getSimpleName()
        if any(part in name for part in FOREIGN_CODE):
            return f"calls {name}"
        children = own.children()
        expressions += [children.apply(i) for i in range(children.size())]
    for below in (plan.children(), plan.subqueries()):
        for i in range(below.size()):
            if reason := _refusal(below.apply(i), views):
                return reason
    return None


def _without_layer(sql: str, names: frozenset[str]) -> str:
    """`gold.<name>` of the known names, back-quoted or not, as the bare name; literals, comments and other
    back-quoted names stay as they are."""
    listed = "|".join(sorted(map(re.escape, names))) or "(?!)"
    known = rf"(?<![\w.`])(?:gold|`gold`)\s*\.\s*(?:({listed})\b|`({listed})`)"
    other = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|--[^\n]*|/\*.*?\*/|`(?:[^`]|``)*`"""
    return re.sub(
        f"{known}|({other})", lambda m: m[1] or m[2] or m[3], sql, flags=re.IGNORECASE | re.DOTALL
    )


def run_readonly_sql(session: SparkSession, sql: str) -> DataFrame:
    """Run one guarded SELECT in a session of `readonly_session`; refuse anything else.

    The verdict on the one text is read back (an action on one row). The text is then parsed, so that a
    command never starts, and analysed; the plan may hold listed nodes over the session's own views only.
    """
    text = session.createDataFrame([(sql,)], "sql string")
    verdict = guard_sql(clean_sql(text, "sql"), "sql").first()
    if not verdict["allowed"]:
        raise QueryRefused(f"{verdict['reason']}: {sql[:80]}")
    views = frozenset(t.name.lower() for t in session.catalog.listTables() if t.isTemporary)
    plain = _without_layer(verdict["sql"], views)
    parsed = session._jsparkSession.sessionState().sqlParser().parsePlan(plain)
    if "Command" in parsed.getClass().getSimpleName() or "Statement" in parsed.getClass().getSimpleName():
        raise QueryRefused(f"not a select: {sql[:80]}")
    found = session.sql(plain)
    if reason := _refusal(found._jdf.queryExecution().analyzed(), views):
        raise QueryRefused(f"{reason}: {sql[:80]}")
    return found


def describe_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its column list, read off the schemas."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, ", ".join(df.columns)) for name, df in tables.items()]
    return spark.createDataFrame(rows, "table_name string, columns string")
