"""A registry of metrics over models: sums, and ratios of sums, at any grain of a model's dimensions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from covelake.operators import metrics
from covelake.plans import domain as D


@dataclass(frozen=True)
class Metric:
    """A sum of a model's measure, or, with ``over``, the ratio of two sums; ``text`` says what it is."""

    model: str
    measure: str
    over: str | None = None
    text: str = ""


@dataclass
class Registry:
    models: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = field(default_factory=dict)
    metrics: dict[str, Metric] = field(default_factory=dict)

    def ask(self, spark: SparkSession, d: str, names: Sequence[str], grain: Sequence[str] = ()) -> DataFrame:
        """The metrics at a grain: each model is aggregated once, and models meet by the grain (null-safe, all groups of either)."""
        unknown = [n for n in names if n not in self.metrics]
        if unknown:
            raise LookupError(f"no metric {', '.join(unknown)}")
        out = None
        for model in dict.fromkeys(self.metrics[n].model for n in names):
            build, dimensions = self.models[model]
            if lacking := [g for g in grain if g not in dimensions]:
                raise LookupError(f"{model} has no dimension {', '.join(lacking)}")
            wanted = {n: self.metrics[n] for n in names if self.metrics[n].model == model}
            part = metrics.at_grain(build(spark, d), grain, **{n: metrics.ratio_of_sums(m.measure, m.over) if m.over else metrics.total(m.measure) for n, m in wanted.items()})
            if out is None:
                out = part
            elif not grain:
                out = out.crossJoin(part)  # one row each
            else:
                other = part.select(*[part[g].alias(f"_{g}") for g in grain], *wanted)
                same = [out[g].eqNullSafe(other[f"_{g}"]) for g in grain]
                joined = out.join(other, same, "full_outer")
                out = joined.selectExpr(*[f"coalesce(`{g}`, `_{g}`) AS `{g}`" for g in grain], *[f"`{c}`" for c in [*out.columns[len(grain) :], *wanted]])
        return out.select(*grain, *names)


REGISTRY = Registry(
    {"loss_ratio": (D.loss_ratio, ("product", "year")), "monthly_premiums": (D.monthly_premiums, ("month", "product", "segment"))},
    {
        "total_paid": Metric("loss_ratio", "paid"),
        "earned_premium": Metric("loss_ratio", "earned"),
        "loss_ratio": Metric("loss_ratio", "paid", "earned", "ratio of sums: what is paid over what is earned, not a mean of ratios"),
        "policies": Metric("monthly_premiums", "n_policies"),
        "written_premium": Metric("monthly_premiums", "premiums"),
        "mean_premium": Metric("monthly_premiums", "premiums", "n_policies", "weighted: written premium over policies, not a mean of means"),
    },
)
