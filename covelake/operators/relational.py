"""Operators on keyed tables: dedup, routing, lookups, keyed defaults, top-n, name-wise unions, guarded broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A side larger than this (by the optimizer's estimate) is not broadcast on request but joined by shuffle.
BROADCAST_LIMIT = 64 << 20


def small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``df`` with a broadcast hint if its estimated size is under ``limit``, else as it is."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= limit else df


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row a key: the first in ``order`` (a total order). Spark prunes each partition to its first row before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def running(df: DataFrame, keys: Sequence[str], order: Sequence[Column]):
    """Window of rows from the start of the key to the current row (never RANGE: ties must not merge)."""
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def route(df: DataFrame, groups: dict[str, Column]) -> dict[str, DataFrame]:
    """A DataFrame a group, and ``default`` for rows that satisfy none; a null condition is not satisfied."""
    out = {name: df.where(F.coalesce(cond, F.lit(False))) for name, cond in groups.items()}
    none = reduce(lambda a, b: a & b, [~F.coalesce(c, F.lit(False)) for c in groups.values()])
    return out | {"default": df.where(none)}


def lookup(df: DataFrame, table: DataFrame, on: Sequence[str], mode: str = "continue") -> DataFrame:
    """Lookup modes: continue (keep unmatched), drop, reject (only unmatched), fail (raise on the first unmatched row)."""
    if mode == "continue":
        return df.join(small(table), list(on), "left")
    if mode == "drop":
        return df.join(small(table), list(on), "inner")
    if mode == "reject":
        return df.join(small(table), list(on), "left_anti")
    if mode == "fail":
        marked = df.join(small(table.withColumn("_hit", F.lit(1))), list(on), "left")
        return marked.withColumn("_hit", F.when(F.col("_hit").isNull(), F.raise_error(F.lit("lookup without a match"))).otherwise(F.col("_hit"))).where("_hit = 1").drop("_hit")
    raise ValueError(mode)


def left_default(df: DataFrame, right: DataFrame, on: Sequence[str], measures: Sequence[str], default=0) -> DataFrame:
    """Left join in which measures are ``default`` only for unmatched rows: a matched null stays null."""
    marked = right.withColumn("_hit", F.lit(True))
    joined = df.join(marked, list(on), "left")
    return joined.withColumns({m: F.when(F.col("_hit").isNull(), F.lit(default)).otherwise(F.col(m)) for m in measures}).drop("_hit")


def top_n(df: DataFrame, group: Sequence[str], by: Sequence[Column], n: int) -> DataFrame:
    """Rows of rank <= n within a group; ties share a rank."""
    return df.withColumn("rank", F.rank().over(Window.partitionBy(*group).orderBy(*by)).cast("bigint")).where(F.col("rank") <= n)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def inline_table(spark, values: Sequence, column: str) -> DataFrame:
    """A one-column parameter table."""
    return spark.createDataFrame([(v,) for v in values], [column])


def days(spark, first: str, end: str, column: str = "day") -> DataFrame:
    """Every day from ``first`` up to, not including, ``end``."""
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(first)), F.date_sub(F.to_date(F.lit(end)), 1))).alias(column))
