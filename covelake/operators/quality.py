"""Data-quality tests: each returns the violations; ``run`` counts them with a severity."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unique(df: DataFrame, *keys: Column | str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return df.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def value_between(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    cond = F.lit(False)
    if low is not None:
        cond = cond | (F.col(column) < low)
    if high is not None:
        cond = cond | (F.col(column) > high)
    return df.where(cond)


def scd2_anomalies(dim: DataFrame, key: str) -> DataFrame:
    """(key, anomaly): empty or reversed intervals, gaps or overlaps, not exactly one current row."""
    w = Window.partitionBy(key).orderBy("valid_from")
    nxt = dim.withColumn("_next", F.lead("valid_from").over(w))
    reversed_ = nxt.where("valid_to <= valid_from").select(key, F.lit("reversed").alias("anomaly"))
    broken = nxt.where("_next is not null and _next <> valid_to").select(key, F.lit("gap or overlap").alias("anomaly"))
    current = dim.groupBy(key).agg(F.sum(F.col("is_current").cast("int")).alias("n")).where("n <> 1").select(key, F.lit("current rows").alias("anomaly"))
    return reversed_.unionAll(broken).unionAll(current)


def stale_versions(source: DataFrame, target: DataFrame, key: str, updated: str) -> DataFrame:
    """Source rows newer than what the target holds of their key."""
    t = target.select(F.col(key).alias("_k"), F.col(updated).alias("_t"))
    return source.join(t, (F.col(key) == F.col("_k")) & (F.col(updated) > F.col("_t"))).drop("_k", "_t")


def conserved(a: DataFrame, b: DataFrame, column: str, tolerance: float = 0.01) -> DataFrame:
    """One row (left_sum, right_sum) if the sums differ by more than the tolerance."""
    x = a.agg(F.coalesce(F.sum(column), F.lit(0)).cast("double").alias("left_sum"))
    y = b.agg(F.coalesce(F.sum(column), F.lit(0)).cast("double").alias("right_sum"))
    return x.crossJoin(y).where(F.abs(F.col("left_sum") - F.col("right_sum")) > tolerance)  # one row each


def not_once(whole: DataFrame, key: str, *parts: DataFrame) -> DataFrame:
    """Keys of ``whole`` that do not stand in exactly one row of the parts together."""
    seen = parts[0].select(key)
    for p in parts[1:]:
        seen = seen.unionAll(p.select(key))
    n = seen.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return whole.select(key).join(n, [key], "left").select(key, F.coalesce("n", F.lit(0)).cast("bigint").alias("n")).where("n <> 1")


@dataclass(frozen=True)
class Check:
    name: str
    violations: DataFrame
    severity: str = "error"


def run(checks: Sequence[Check]) -> list[tuple[str, str, int]]:
    """(name, 'pass' | 'warn' | 'error', violations) a check."""
    out = []
    for c in checks:
        n = c.violations.count()
        out.append((c.name, "pass" if n == 0 else c.severity, n))
    return out
