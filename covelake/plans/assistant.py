"""Tools for a language-model client: the catalog, guarded queries, a tool loop with a budget, and conversion checked by reconciliation.

A client is anything with ``reply(messages, tools) -> Reply``; none is built in. Errors of tools go back to the client as text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from covelake.operators import reconcile
from covelake.plans import guard


@dataclass
class Catalog:
    """Tables and views of a session of its own, with descriptions; queries see nothing else."""

    session: SparkSession
    about: dict[str, str] = field(default_factory=dict)

    @classmethod
    def over(cls, spark: SparkSession, paths: dict[str, str], about: dict[str, str] | None = None) -> Catalog:
        """Parquet folders by name."""
        own = spark.newSession()
        for name, path in paths.items():
            own.read.parquet(path).createOrReplaceTempView(name)
        return cls(own, {name: (about or {}).get(name, "") for name in paths})

    def columns(self) -> DataFrame:
        """(table, position, column, type, description): the catalog as a table."""
        rows = [(t, i, f.name, f.dataType.simpleString(), self.about[t]) for t in sorted(self.about) for i, f in enumerate(self.session.table(t).schema.fields)]
        return self.session.createDataFrame(rows, "`table` string, position int, `column` string, type string, description string")

    def list_tables(self) -> str:
        return json.dumps([{"table": t, "about": self.about[t]} for t in sorted(self.about)], ensure_ascii=False)

    def describe(self, table: str) -> str:
        if table not in self.about:
            raise LookupError(f"no table {table}")
        return json.dumps({"table": table, "about": self.about[table], "columns": {f.name: f.dataType.simpleString() for f in self.session.table(table).schema.fields}}, ensure_ascii=False)

    def run_sql(self, sql: str, rows: int = 200) -> str:
        """The guarded query's first rows as JSON."""
        got = guard.run(self.session, sql, set(self.about), rows)
        return json.dumps({"columns": got.columns, "rows": [[None if v is None else str(v) for v in r] for r in got.collect()]}, ensure_ascii=False)

    def tools(self) -> dict[str, Callable[..., str]]:
        return {"list_tables": self.list_tables, "describe": self.describe, "run_sql": self.run_sql}


@dataclass
class Reply:
    """What a client answers: text, or calls (name, arguments); and the tokens it took."""

    text: str = ""
    calls: Sequence[tuple[str, dict]] = ()
    tokens_in: int = 0
    tokens_out: int = 0


@dataclass
class Outcome:
    status: str
    answer: str
    turns: int
    cost: float
    messages: list[dict]


def cost(reply: Reply, price: tuple[float, float]) -> float:
    """``price``: of a million tokens in and out."""
    return (reply.tokens_in * price[0] + reply.tokens_out * price[1]) / 1e6


def converse(client, question: str, tools: dict[str, Callable[..., str]], ends: str | None = None, turns: int = 10, budget: float = 0.5, price: tuple[float, float] = (0.0, 0.0)) -> Outcome:
    """Turns until the client answers without a call, calls the tool ``ends`` with success, or turns or budget are used up.

    A tool's error, or an unknown tool, is its result, so that the client can mend its call.
    """
    messages, spent = [{"role": "user", "content": question}], 0.0
    for turn in range(1, turns + 1):
        reply = client.reply(messages, list(tools))
        spent += cost(reply, price)
        messages.append({"role": "assistant", "content": reply.text, "calls": list(reply.calls)})
        if not reply.calls:
            return Outcome("answered", reply.text, turn, spent, messages)
        for name, arguments in reply.calls:
            try:
                if name not in tools:
                    raise LookupError(f"no tool {name}")
                result, failed = tools[name](**arguments), False
            except Exception as e:  # whatever it is, the client is told
                result, failed = f"{type(e).__name__}: {str(e).splitlines()[0][:300] if str(e) else ''}", True
            messages.append({"role": "tool", "name": name, "content": result, "failed": failed})
            if name == ends and not failed:
                return Outcome("done", result, turn, spent, messages)
        if spent > budget:
            return Outcome("over budget", "", turn, spent, messages)
    return Outcome("out of turns", "", turns, spent, messages)


def convert(client, source: str, catalog: Catalog, legacy: DataFrame, keys: Sequence[str], columns: Sequence[str], tolerance: float = 0.01, **limits) -> tuple[Outcome, str | None]:
    """A legacy program's SQL from the client, accepted once its result reconciles with ``legacy`` (of the catalog's session).

    ``submit`` fails, with what differs, until it does; the candidate is checked by the guard and run read-only.
    """
    accepted: list[str] = []

    def submit(sql: str) -> str:
        guard.check(catalog.session, sql, set(catalog.about))
        got = reconcile.reconcile(legacy, catalog.session.sql(sql.strip().rstrip(";")), keys, columns, tolerance)
        if got.status != "pass":
            wrong = {c.name: c.mismatches for c in got.columns if c.mismatches}
            raise ValueError(f"{got.status}: {got.error or f'rows {got.left_rows} and {got.right_rows}, missing {got.missing}, extra {got.extra}, differing {wrong}, for example {got.samples[:3]}'}")
        accepted.append(sql)
        return "reconciled"

    outcome = converse(client, source, {**catalog.tools(), "submit": submit}, ends="submit", **{"turns": 16, **limits})
    return outcome, accepted[-1] if accepted else None
