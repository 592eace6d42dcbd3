"""Checks that give the violating rows; an empty result means the constraint holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill import schemas


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(*keys, n)`` of keys that occur more than once; keys with a NULL are exempt."""
    present = df.dropna(subset=list(keys))
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in a required column, and the names of those columns."""
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]), lambda c: c.isNotNull())
    return df.withColumn("missing", missing).filter(F.size("missing") > 0)


def foreign_key_violations(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows that point at no parent; NULL points nowhere and is allowed."""
    parents = parent.select(F.col(parent_key).alias(column))
    return child.filter(F.col(column).isNotNull()).join(parents, column, "left_anti").select(*child.columns)


def enum_violations(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose value is set but none of the allowed ones."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(allowed)))


def violation_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table, constraint, violations)`` for all declared keys and required columns of the given tables."""
    parts = []
    for name, df in tables.items():
        checks = [(f"unique({', '.join(k)})", unique_violations(df, k)) for k in schemas.UNIQUE_KEYS.get(name, [])]
        if name in schemas.REQUIRED_COLUMNS:
            checks.append(("not null", null_violations(df, schemas.REQUIRED_COLUMNS[name])))
        if name == "file_summaries":
            checks.append(("kind", enum_violations(df, "kind", schemas.SUMMARY_KINDS)))
        for label, rows in checks:
            parts.append(rows.agg(F.count(F.lit(1)).alias("violations")).select(
                F.lit(name).alias("table"), F.lit(label).alias("constraint"), "violations"
            ))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
