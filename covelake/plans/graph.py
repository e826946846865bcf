"""A graph of models: name, dependencies, builder, checks. Runs in topological order; waves for parallel migration."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame

from covelake.operators.quality import Check, run
from covelake.sources.storage import Lake


@dataclass
class Model:
    name: str
    build: Callable[[dict[str, DataFrame]], DataFrame]
    needs: Sequence[str] = ()
    stored: bool = True
    checks: Callable[[DataFrame], list[Check]] | None = None


@dataclass
class Graph:
    models: dict[str, Model] = field(default_factory=dict)

    def add(self, model: Model) -> None:
        self.models[model.name] = model

    def order(self) -> list[str]:
        return [n for n in TopologicalSorter({m.name: [d for d in m.needs if d in self.models] for m in self.models.values()}).static_order()]

    def waves(self) -> list[list[str]]:
        """Models by layer: each needs only earlier layers."""
        sorter = TopologicalSorter({m.name: [d for d in m.needs if d in self.models] for m in self.models.values()})
        sorter.prepare()
        out = []
        while sorter.is_active():
            ready = sorted(sorter.get_ready())
            out.append(ready)
            sorter.done(*ready)
        return out

    def run(self, lake: Lake, sources: dict[str, DataFrame]) -> list[tuple[str, str, int]]:
        """Builds and stores all models; an error in a check stops the run before anything depends on the model."""
        have, report = dict(sources), []
        for name in self.order():
            m = self.models[name]
            df = m.build({n: have[n] for n in m.needs})
            have[name] = lake.overwrite(name, df) if m.stored else df
            if m.checks:
                got = run(m.checks(have[name]))
                report += [(f"{name}.{c}", status, n) for c, status, n in got]
                if any(s == "error" for _, s, _ in got):
                    raise RuntimeError(f"{name}: {[x for x in got if x[1] == 'error']}")
        return report
