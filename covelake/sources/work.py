"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders made for sessions without a checkpoint folder, by application.
_own: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; without one, a session whose executors all run on this machine gets a fresh folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="covelake-")
    return _own[app]


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, for plans that would compute it several times."""
    path = f"{folder(df.sparkSession)}/covelake/work-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
