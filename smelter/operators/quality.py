"""Data-quality checks as DataFrames with one row per check.

Conditions are SQL text, so a table's whole report is one aggregate and one
``inline`` over its single row of counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECK = "check_name, check_kind, checked, violations, unknown"


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _check(kind: str, name: str, violations: str, unknown: str = "0") -> str:
    return (
        f"struct({_quoted(name)}, {_quoted(kind)}, checked, "
        f"CAST({violations} AS BIGINT), CAST({unknown} AS BIGINT))"
    )


def _report(table: str, counts: DataFrame, checks: list[str]) -> DataFrame:
    """One row of counts -> one row per check."""
    return counts.selectExpr(f"inline(array({', '.join(checks)})) AS ({CHECK})").selectExpr(
        f"{_quoted(table)} AS table_name",
        "*",
        "round(try_divide(100.0D * violations, checked), 2) AS violation_pct",
        "violations = 0 AND checked > 0 AS passed",
    )


def _is_missing(field: T.StructField) -> str:
    name = f"`{field.name}`"
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return f"{name} IS NULL OR isnan({name})"
    return f"{name} IS NULL"


def column_checks(
    df: DataFrame, table: str, keys: Sequence[str] = (), rules: Mapping[str, str] | None = None
) -> DataFrame:
    """Row count, NULL key parts, NULL or NaN share of every column, and rule violations.

    All counts come from one aggregate that reduces to a row per task. A rule
    whose condition is NULL is counted under ``unknown``, not as a violation.
    """
    return column_report(df.selectExpr(*column_counts(df.schema, rules)), table, df.schema, keys, rules)


def column_counts(schema: T.StructType, rules: Mapping[str, str] | None = None, weight: str = "1") -> list[str]:
    """The aggregates behind ``column_checks``; with a signed ``weight`` per row, what to add to earlier ones."""

    def total(condition: str = "TRUE") -> str:
        return f"coalesce(sum(CASE WHEN {condition} THEN {weight} END), 0)" if weight != "1" else f"count_if({condition})"

    counts = [f"{total()} AS checked"]
    counts += [f"{total(_is_missing(f))} AS `null_{f.name}`" for f in schema.fields]
    for i, condition in enumerate(dict(rules or {}).values()):
        counts += [f"{total(f'NOT ({condition})')} AS bad_{i}", f"{total(f'({condition}) IS NULL')} AS unsure_{i}"]
    return counts


def column_report(
    counts: DataFrame, table: str, schema: T.StructType, keys: Sequence[str] = (), rules: Mapping[str, str] | None = None
) -> DataFrame:
    """One row of ``column_counts`` as a report."""
    checks = [_check("rows", "has rows", "0")]
    checks += [_check("null_key", k, f"`null_{k}`") for k in keys]
    checks += [_check("null_profile", f.name, f"`null_{f.name}`") for f in schema.fields]
    checks += [_check("rule", name, f"bad_{i}", f"unsure_{i}") for i, name in enumerate(dict(rules or {}))]
    return _report(table, counts, checks)


def total_report(table: str, kind: str, name: str, counts: DataFrame) -> DataFrame:
    """One row (checked, violations, unknown) as the report of one check."""
    return _report(table, counts, [_check(kind, name, "violations", "unknown")])


def duplicate_check(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key; NULL key parts compare as equal.

    Kept apart from the other counts so that only the keys are shuffled.
    """
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    counts = groups.selectExpr(
        "coalesce(sum(n), 0) AS checked", "coalesce(sum(n - 1), 0) AS extra"
    )
    return _report(table, counts, [_check("duplicate", ", ".join(keys), "extra")])


def orphan_check(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Rows whose foreign key has no parent; NULL refers to nothing and is ``unknown``.

    Both sides are reduced to one row per key before they meet.
    """
    referred = child.groupBy(F.col(column).alias("_key")).agg(F.count("*").alias("n"))
    present = parent.select(F.col(parent_column).alias("_key")).distinct()
    present = present.withColumn("_found", F.lit(True))
    counts = referred.join(present, "_key", "left").selectExpr(
        "coalesce(sum(n), 0) AS checked",
        "coalesce(sum(n) FILTER (WHERE _found IS NULL AND _key IS NOT NULL), 0) AS orphans",
        "coalesce(sum(n) FILTER (WHERE _key IS NULL), 0) AS unsure",
    )
    return _report(table, counts, [_check("orphan", column, "orphans", "unsure")])


def validate(
    df: DataFrame, table: str, keys: Sequence[str] = (), rules: Mapping[str, str] | None = None
) -> DataFrame:
    """Every check of one table that needs no other table."""
    report = column_checks(df, table, keys, rules)
    return report.unionByName(duplicate_check(df, table, keys)) if keys else report


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows, to look at."""
    return df.limit(n)
