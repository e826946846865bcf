"""Layer tables on parquet: each write in a folder of its own, committed by Spark's marker, which is written last.

A folder ``v<time>`` is the whole table, a folder ``a<time>`` rows appended to the version before it. Readers take the newest
whole version with what was appended since, so they never see a half-written table, and a table can be rewritten from
itself. An append may carry a tag; a later append with the same tag replaces it, so that a replayed batch replaces its own
work. Appends cost what they bring; ``compact`` makes one version of them.
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covelake.operators.history import merge_latest


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), p

    def _folders(self, name: str) -> list[str]:
        """Committed folders, oldest first: those whose marker exists."""
        fs, p = self._fs(f"{self.root}/{name}")
        if not fs.exists(p):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(p) if fs.exists(self._fs(f"{self.root}/{name}/{s.getPath().getName()}/_SUCCESS")[1])]
        return sorted(found, key=lambda f: f[1:21])

    def versions(self, name: str) -> list[str]:
        """Committed whole versions, oldest first."""
        return [f for f in self._folders(name) if f[0] == "v"]

    def current(self, name: str) -> list[str]:
        """The folders that make the table: the newest version, and of later appends the last of each tag."""
        found, out = self._folders(name), {}
        for f in found:
            if f[0] == "v":
                out = {f: f}
            else:
                out[f[22:] or f] = f
        return sorted(out.values(), key=lambda f: f[1:21])

    def exists(self, name: str) -> bool:
        return bool(self._folders(name))

    def read(self, name: str) -> DataFrame:
        found = self.current(name)
        if not found:
            raise LookupError(f"no table {name}")
        paths = [f"{self.root}/{name}/{f}" for f in found]
        return self.spark.read.option("mergeSchema", len(paths) > 1).parquet(*paths)

    def append(self, name: str, df: DataFrame, tag: str = "") -> DataFrame:
        """Rows by column name, in a folder of their own; columns that either side lacks are null there (a new column widens the table)."""
        df.write.parquet(f"{self.root}/{name}/a{time.time_ns():020d}" + (f"-{tag}" if tag else ""))
        return self.read(name)

    def drop(self, name: str) -> None:
        """The table with all its versions, if there is one."""
        fs, p = self._fs(f"{self.root}/{name}")
        fs.delete(p, True)

    def overwrite(self, name: str, df: DataFrame, keep: int = 2) -> DataFrame:
        """A new version (committed by Spark's own marker); what is older than the last ``keep`` versions goes."""
        df.write.parquet(f"{self.root}/{name}/v{time.time_ns():020d}")
        kept = self.versions(name)[-keep:]
        for old in self._folders(name):
            if old[1:21] < kept[0][1:21]:
                fs, p = self._fs(f"{self.root}/{name}/{old}")
                fs.delete(p, True)
        return self.read(name)

    def upsert(self, name: str, new: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
        """Keyed upsert in which existing rows of touched keys compete with the new ones."""
        from covelake.operators.relational import dedup_latest

        return self.overwrite(name, merge_latest(self.read(name), new, keys, order) if self.exists(name) else dedup_latest(new, keys, order))

    def compact(self, name: str, file_bytes: int = 256 << 20) -> DataFrame:
        """The table as one version in files of about ``file_bytes``; a table that has no more files than that stays as it is."""
        parts = []
        for f in self.current(name):
            fs, p = self._fs(f"{self.root}/{name}/{f}")
            parts += [s.getLen() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-")]
        files = max(1, math.ceil(sum(parts) / file_bytes))
        return self.overwrite(name, self.read(name).repartition(files)) if len(parts) > files else self.read(name)

    def vacuum(self, name: str, hours: float = 168.0, now: float | None = None) -> list[str]:
        """Drops what is older than ``hours`` and no part of the table, unfinished writes included; returns what went."""
        now_in = set(self.current(name))
        if not now_in:
            return []
        before = ((time.time() if now is None else now) - hours * 3600) * 1e9
        fs, p = self._fs(f"{self.root}/{name}")
        old = sorted(v for s in fs.listStatus(p) if (v := s.getPath().getName()) not in now_in and v[:1] in "va" and v[1:21].isdigit() and int(v[1:21]) < before)
        for v in old:
            fs.delete(self._fs(f"{self.root}/{name}/{v}")[1], True)
        return old

    def analyse(self, name: str) -> DataFrame:
        """(column, n_rows, n_null, n_distinct) of the newest version, in one pass; distinct values are estimated."""
        df = self.read(name)
        stats = [F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.col(f"`{c}`").isNull().cast("long")), F.lit(0)).alias("n_null"), F.approx_count_distinct(F.col(f"`{c}`")).alias("n_distinct")) for c in df.columns]
        return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))
