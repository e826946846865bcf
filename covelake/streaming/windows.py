"""Window operators on events (event_id, ts, event_type, province, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WIDTH, DELAY = "15 minutes", "30 minutes"
DECLARED, PAID = "purchase", "click"


def sample_stream(spark, d) -> DataFrame:
    """The events table with repeated (a minute later) and late (45 minutes early) copies, as a test stream."""
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type", (F.col("user_id") % 9).alias("province"), "value")
    again = e.where("event_id % 30 = 0").withColumn("ts", F.col("ts") + F.expr("interval 1 minute"))
    late = e.where("event_id % 25 = 0").withColumns({"event_id": -F.col("event_id"), "ts": F.col("ts") - F.expr("interval 45 minutes")})
    return e.unionByName(again).unionByName(late)


def first_by_id(rows: DataFrame) -> DataFrame:
    """The earliest row of each event; of rows at the same time the least by its other columns."""
    rest = [c for c in rows.columns if c not in ("event_id", "ts")]
    first = F.min(F.struct("ts", *rest)).alias("first")
    return rows.groupBy("event_id").agg(first).select("event_id", "first.*").select(rows.columns)


def late(rows: DataFrame) -> DataFrame:
    """Marks events older than the watermark left by the retained events that arrived before them (arrival: absolute id).

    The watermark is the newest event so far less the delay. An event that isn't retained is older than that, so it can't
    be the newest: the maximum over all events is that over the retained ones.
    Arrival is cut into ranges of about equal size, one a shuffle partition: the maximum of each range, the running maximum
    over the ranges, and a scan within each range. Only one row a range meets in one task.
    """
    arrival, seen = F.abs("event_id"), F.col("ts")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.select(arrival.alias("at")).approxQuantile("at", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []
    part = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= arrival)) if cuts else F.lit(0)
    rows = rows.withColumn("_part", F.when(arrival.isNull(), 0).otherwise(part))
    tops = rows.groupBy("_part").agg(F.max(seen).alias("_top"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("_part", F.max("_top").over(before).alias("_before"))
    within = Window.partitionBy("_part").orderBy(arrival, F.desc("event_id")).rowsBetween(Window.unboundedPreceding, -1)
    mark = F.greatest(F.max(seen).over(within), "_before") - F.expr(f"interval {DELAY}")
    judged = rows.join(F.broadcast(tops), "_part").withColumn("late", F.coalesce(F.col("ts") < mark, F.lit(False)))
    return judged.drop("_part", "_before")


def _start():
    return F.window("ts", WIDTH)["start"]


def touched(rows: DataFrame) -> DataFrame:
    return rows.select(_start().alias("window_start"), "province").distinct()


def by_window(rows: DataFrame) -> DataFrame:
    """Counts and amounts a window and province."""
    one = lambda kind: F.count_if(F.col("event_type") == kind)
    amount = F.sum(F.when(F.col("event_type") == DECLARED, F.round("value", 4).cast("decimal(18,4)")))
    return rows.groupBy(_start().alias("window_start"), "province").agg(one(DECLARED).alias("n_declared"), one(PAID).alias("n_paid"), F.round(F.coalesce(amount, F.lit(0)).cast("double"), 2).alias("declared"))


def refresh(windows: DataFrame, events: DataFrame, new: DataFrame) -> DataFrame:
    """Windows that ``new`` touches are computed anew over all ``events`` in them; the others stay."""
    keys = touched(new)
    span = keys.agg(F.min("window_start"), F.max("window_start")).first()  # one row: files of other times aren't read
    if span[0] is not None:
        events = events.where((F.col("ts") >= F.lit(span[0])) & (F.col("ts") < F.lit(span[1]) + F.expr(f"interval {WIDTH}")))
    again = by_window(events.withColumn("window_start", _start()).join(keys, ["window_start", "province"], "left_semi").drop("window_start"))
    return windows.join(keys, ["window_start", "province"], "left_anti").unionByName(again)


def alerts(windows: DataFrame, threshold: int) -> DataFrame:
    return windows.where(F.col("n_declared") >= threshold).select("window_start", "province", "n_declared", F.lit(threshold).alias("threshold"))


def new_alerts(found: DataFrame, before: DataFrame) -> DataFrame:
    """Alerts for windows that have none yet."""
    return found.join(before.select("window_start", "province"), ["window_start", "province"], "left_anti")
