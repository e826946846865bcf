"""Semantic metrics: simple sums and ratios of sums at any grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total(column: str, places: int = 2) -> Column:
    """A money sum, exact in decimal, as a rounded double."""
    return F.round(F.sum(F.col(column).cast("decimal(38,4)")).cast("double"), places)


def ratio_of_sums(numerator: str, denominator: str, places: int = 6) -> Column:
    """Aggregate first, then divide; null over a zero sum."""
    num = F.sum(F.col(numerator).cast("decimal(38,4)")).cast("double")
    den = F.sum(F.col(denominator).cast("decimal(38,4)")).cast("double")
    return F.round(num / F.nullif(den, F.lit(0.0)), places)


def at_grain(df: DataFrame, grain: Sequence[str], **metrics: Column) -> DataFrame:
    return df.groupBy(*grain).agg(*[m.alias(k) for k, m in metrics.items()])
