"""History: slowly changing dimensions, point-in-time and interval joins, incremental merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covelake.operators.relational import dedup_latest

START, OPEN_END = "1900-01-01", "9999-12-31"


def scd2(versions: DataFrame, key: str, updated: str) -> DataFrame:
    """All versions of a key as half-open intervals [valid_from, valid_to): version_no, is_current; the first is back-dated."""
    w = Window.partitionBy(key).orderBy(updated)
    n = F.row_number().over(w)
    nxt = F.lead(updated).over(w)
    return versions.withColumns(
        {
            "version_no": n.cast("bigint"),
            "valid_from": F.when(n == 1, F.to_date(F.lit(START))).otherwise(F.col(updated)),
            "valid_to": F.coalesce(nxt, F.to_date(F.lit(OPEN_END))),
            "is_current": nxt.isNull(),
        }
    )


def scd2_merge(history: DataFrame, current: DataFrame, key: str, updated: str) -> DataFrame:
    """One snapshot run: a newer version closes the open row of its key at its own time and opens a row; equal or older ones change nothing.

    ``history``: the columns of ``current``, valid_from, valid_to. Deletions aren't tracked.
    """
    end = F.to_date(F.lit(OPEN_END))
    open_rows = history.where(F.col("valid_to") == end)
    seen = open_rows.select(key, F.col(updated).alias("_seen"))
    fresh = current.join(seen, key, "left").where(F.col("_seen").isNull() | (F.col(updated) > F.col("_seen"))).drop("_seen")
    closing = fresh.select(key, F.col(updated).alias("_close"))
    kept = history.join(closing, key, "left").withColumn("valid_to", F.when((F.col("valid_to") == end) & F.col("_close").isNotNull(), F.col("_close")).otherwise(F.col("valid_to"))).drop("_close")
    return kept.unionByName(fresh.withColumn("valid_from", F.col(updated)).withColumn("valid_to", end))


def point_in_time(facts: DataFrame, dim: DataFrame, key: str, at: str) -> DataFrame:
    """Left join with the version valid at ``at``: key equality is the hash key, the interval a residual condition."""
    d = dim.withColumnRenamed(key, "_key")
    cond = (facts[key] == F.col("_key")) & (facts[at] >= F.col("valid_from")) & (facts[at] < F.col("valid_to"))
    return facts.join(d, cond, "left").drop("_key")


def overlap_by_year(intervals: DataFrame, start: str, end: str, years: Sequence[int]) -> DataFrame:
    """Rows times the years they overlap, with ``year``, ``first_day``, ``last_day`` (inclusive overlap).

    The years of a row come from its own bounds, so this is a projection (no join, no shuffle).
    """
    lo, hi = F.greatest(F.year(start), F.lit(min(years))), F.least(F.year(end), F.lit(max(years)))
    rows = intervals.where(lo <= hi).withColumn("year", F.explode(F.sequence(lo, hi))).where(F.col("year").isin(*years))
    first, last = F.make_date(F.col("year"), F.lit(1), F.lit(1)), F.make_date(F.col("year"), F.lit(12), F.lit(31))
    return rows.withColumn("first_day", F.greatest(F.col(start), first)).withColumn("last_day", F.least(F.col(end), last))


def above_high_water(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Source rows newer than the target's newest; all of them while the target is empty."""
    mark = target.agg(F.max(column)).first()[0]
    return source if mark is None else source.where(F.col(column) > F.lit(mark))


def merge_latest(target: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Upsert in which existing rows of touched keys compete again, so that a stale version never wins."""
    touched = new.select(*keys).distinct()
    candidates = target.join(touched, list(keys), "left_semi").unionByName(new, allowMissingColumns=True)
    return target.join(touched, list(keys), "left_anti").unionByName(dedup_latest(candidates, keys, order), allowMissingColumns=True)
