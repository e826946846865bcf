"""The event job: JSON-lines files, one a micro-batch, to refreshed windows and alerts raised once.

State is in layer tables. Kept events, alerts and figures (with the watermark) are appended under the batch's number, so
a replayed batch replaces its own work and no batch rewrites those before it; windows are the newest version. A batch's figures
are written last: a batch that failed has none, and what it left is replaced when it runs again. Events are deduplicated against all kept events; the watermark is the
newest kept event less the delay and never falls; an event strictly before the watermark left by earlier batches is late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covelake.sources.storage import Lake
from covelake.streaming import windows as W

SCHEMA = "event_id string, event_type string, claim_id string, policy_id string, province string, kind string, value double, ts timestamp"


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One file a micro-batch, in order; a malformed line fails its batch."""
    return spark.readStream.schema(SCHEMA).option("mode", "FAILFAST").option("maxFilesPerTrigger", 1).option("latestFirst", False).json(folder)


def process(lake: Lake, threshold: int, number: int, batch: DataFrame) -> dict:
    """One micro-batch; returns its figures."""
    spark = lake.spark
    tag = f"batch-{number}"
    before_this = lambda name: lake.read(name).where(F.col("batch") < number) if lake.exists(name) else None
    past, kept_before, before = before_this("stream/metrics"), before_this("stream/events"), before_this("stream/alerts")
    mark = past.agg(F.max("watermark")).first()[0] if past is not None else None
    n_read = batch.count()
    fresh = W.first_by_id(batch)
    if kept_before is not None:
        fresh = fresh.join(kept_before.select("event_id"), "event_id", "left_anti")
    n_fresh = fresh.count()
    kept = (fresh if mark is None else fresh.where(F.col("ts") >= F.lit(mark))).withColumn("batch", F.lit(number))
    events = lake.append("stream/events", kept, tag).where(F.col("batch") <= number)
    new = events.where(F.col("batch") == number)
    n_kept, newest = new.agg(F.count(F.lit(1)), F.max("ts") - F.expr(f"interval {W.DELAY}")).first()
    touched = W.touched(new)
    n_windows = touched.count()
    win = W.by_window(events) if not lake.exists("stream/windows") else W.refresh(lake.read("stream/windows"), events, new)
    win = lake.overwrite("stream/windows", win)
    found = W.alerts(win.join(touched, ["window_start", "province"], "left_semi"), threshold)
    raised = (found if before is None else W.new_alerts(found, before)).withColumn("batch", F.lit(number))
    alerts = lake.append("stream/alerts", raised, tag)
    marks = [m for m in (mark, newest) if m is not None]
    out = {"batch": number, "read": n_read, "duplicates": n_read - n_fresh, "late": n_fresh - n_kept, "kept": n_kept, "watermark": max(marks) if marks else None, "windows": n_windows, "alerts": alerts.where(F.col("batch") == number).count()}
    row = spark.createDataFrame([tuple(out.values())], "batch int, read long, duplicates long, late long, kept long, watermark timestamp, windows long, alerts long")
    lake.append("stream/metrics", row, tag)
    return out


def reset(lake: Lake, checkpoint: str) -> None:
    """Forgets all state and progress; the next run starts with the first file."""
    for name in ("events", "windows", "alerts", "metrics"):
        lake.drop(f"stream/{name}")
    fs, p = lake._fs(checkpoint)
    fs.delete(p, True)


def run_available(lake: Lake, folder: str, checkpoint: str, threshold: int = 40) -> None:
    """Processes the files that are there and stops; a further run starts after them."""
    query = read(lake.spark, folder).writeStream.foreachBatch(lambda df, n: process(lake, threshold, n, df.persist()) and df.unpersist()).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query.start().awaitTermination()


def closed_windows(events: DataFrame) -> DataFrame:
    """The append-mode form: watermark, dedup within it, and windows once they are closed."""
    kept = events.withWatermark("ts", W.DELAY).dropDuplicatesWithinWatermark(["event_id"])
    one = lambda kind: F.count_if(F.col("event_type") == kind)
    return kept.groupBy(F.window("ts", W.WIDTH), "province").agg(one(W.DECLARED).alias("n_declared"), one(W.PAID).alias("n_paid")).select(F.col("window.start").alias("window_start"), "province", "n_declared", "n_paid")
