"""Row-level reconciliation of two tables with tolerances: one full outer join, one aggregation."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


@dataclass
class ColumnResult:
    name: str
    mismatches: int
    left_sum: float | None = None
    right_sum: float | None = None


@dataclass
class Result:
    status: str
    left_rows: int = 0
    right_rows: int = 0
    missing: int = 0
    extra: int = 0
    columns: list[ColumnResult] = field(default_factory=list)
    samples: list[dict] = field(default_factory=list)
    error: str = ""


def paired(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on the keys' text: structs ``l`` and ``r``, null where a side has no row. A row with a null key has no partner: it counts as missing or extra, but stays a row."""
    a = left.select(F.struct(*left.columns).alias("l"), *[F.col(k).cast("string").alias(f"_k{i}") for i, k in enumerate(keys)])
    b = right.select(F.struct(*right.columns).alias("r"), *[F.col(k).cast("string").alias(f"_k{i}") for i, k in enumerate(keys)])
    return a.join(b, [f"_k{i}" for i in range(len(keys))], "full_outer")


def differs(left: DataFrame, column: str, tolerance: float):
    """Condition on ``paired`` rows: numbers differ beyond the tolerance or in being null; all else in text."""
    a, b = F.col(f"l.{column}"), F.col(f"r.{column}")
    if isinstance(left.schema[column].dataType, NumericType):
        return F.coalesce((a.isNull() != b.isNull()) | (F.abs(a.cast("double") - b.cast("double")) > tolerance), F.lit(False))
    return ~a.cast("string").eqNullSafe(b.cast("string"))


def summary(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], tolerance: float = 0.01, tolerances: dict[str, float] | None = None) -> DataFrame:
    """One row: left_rows, right_rows, missing, extra, and diff_<column>, left_<column>, right_<column> (sums of numbers)."""
    tol = tolerances or {}
    both = F.col("l").isNotNull() & F.col("r").isNotNull()
    one = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    aggs = [one(F.col("l").isNotNull()).alias("left_rows"), one(F.col("r").isNotNull()).alias("right_rows"), one(F.col("r").isNull()).alias("missing"), one(F.col("l").isNull()).alias("extra")]
    for c in columns:
        aggs.append(one(both & differs(left, c, tol.get(c, tolerance))).alias(f"diff_{c}"))
        if isinstance(left.schema[c].dataType, NumericType):
            for side, s in (("left", "l"), ("right", "r")):
                aggs.append(F.round(F.sum(F.col(f"{s}.{c}").cast("decimal(38,4)")).cast("double"), 2).alias(f"{side}_{c}"))
    return paired(left, right, keys).agg(*aggs)


def samples(left: DataFrame, right: DataFrame, keys: Sequence[str], column: str, tolerance: float, n: int = 5) -> DataFrame:
    """The first ``n`` differing rows of a column in key order, keys and both values as text."""
    pairs = paired(left, right, keys).where(F.col("l").isNotNull() & F.col("r").isNotNull() & differs(left, column, tolerance))
    return pairs.select(*[F.col(f"l.{k}").alias(k) for k in keys], F.col(f"l.{column}").cast("string").alias("left_value"), F.col(f"r.{column}").cast("string").alias("right_value")).orderBy(*keys, "left_value", "right_value").limit(n)


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], tolerance: float = 0.01, tolerances: dict[str, float] | None = None, sample_size: int = 5) -> Result:
    lacking = [c for c in (*keys, *columns) if c not in left.columns or c not in right.columns]
    if lacking:
        return Result("error", error="missing columns: " + ", ".join(dict.fromkeys(lacking)))
    row = summary(left, right, keys, columns, tolerance, tolerances).first().asDict()
    out = Result("pass", row["left_rows"] or 0, row["right_rows"] or 0, row["missing"] or 0, row["extra"] or 0)
    for c in columns:
        out.columns.append(ColumnResult(c, row[f"diff_{c}"] or 0, row.get(f"left_{c}"), row.get(f"right_{c}")))
        if out.columns[-1].mismatches and len(out.samples) < 3 * sample_size:
            got = samples(left, right, keys, c, (tolerances or {}).get(c, tolerance), sample_size)
            out.samples += [{"column": c, **r.asDict()} for r in got.collect()]  # at most sample_size rows
    if out.missing or out.extra or out.left_rows != out.right_rows or any(c.mismatches for c in out.columns):
        out.status = "fail"
    return out


@dataclass(frozen=True)
class Spec:
    """One dataset to reconcile: keys, columns (all common ones, if none are named) and tolerances."""

    name: str
    keys: tuple[str, ...]
    columns: tuple[str, ...] = ()
    tolerance: float = 0.01
    tolerances: tuple[tuple[str, float], ...] = ()


def reconcile_all(specs: Sequence[Spec], left: Callable[[str], DataFrame], right: Callable[[str], DataFrame], sample_size: int = 5) -> dict[str, Result]:
    """A result for each spec; a table that can't be read, and keys that aren't unique, are errors of that spec alone."""
    out = {}
    for spec in specs:
        try:
            a, b = left(spec.name), right(spec.name)
            columns = spec.columns or tuple(c for c in a.columns if c in b.columns and c not in spec.keys)
            twice = [side for side, df in (("left", a), ("right", b)) if set(spec.keys) <= set(df.columns) and not df.groupBy(*spec.keys).count().where("count > 1").isEmpty()]
            out[spec.name] = Result("error", error=f"keys repeat on the {' and '.join(twice)}") if twice else reconcile(a, b, spec.keys, columns, spec.tolerance, dict(spec.tolerances), sample_size)
        except (LookupError, OSError, AnalysisException) as e:
            out[spec.name] = Result("error", error=str(e).splitlines()[0][:200])
    return out


def report_json(results: dict[str, Result]) -> str:
    return json.dumps({name: asdict(r) for name, r in results.items()}, ensure_ascii=False, sort_keys=True, default=str)


def report_markdown(results: dict[str, Result]) -> str:
    """A table of datasets, and one of columns for each that differs."""
    lines = ["| dataset | status | left | right | missing | extra | differing columns |", "|-|-|-|-|-|-|-|"]
    for name, r in results.items():
        wrong = ", ".join(f"{c.name} ({c.mismatches})" for c in r.columns if c.mismatches)
        lines.append(f"| {name} | {r.status} | {r.left_rows} | {r.right_rows} | {r.missing} | {r.extra} | {r.error or wrong} |")
    return "\n".join(lines)
