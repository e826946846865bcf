"""Seeded synthetic extracts and event batches, with the anomalies that the models must survive.

Rows are functions of their number and a seed, computed on the executors, so a table of any size has the same rows on any
cluster. ``extracts`` yields two batches of CSV extracts as landed (all text); the second updates the first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covelake.sources.landing import write_csv

DAYS = {1: dt.date(2026, 5, 31), 2: dt.date(2026, 6, 30)}
PROVINCES, SEGMENTS, PRODUCTS = ("QC", "ON", "NB", "NS", "AB", "BC"), ("PERSON", "FIRM"), ("CAR", "HOME", "LIFE")
STALE_TOWN = "Old Town"


def _draw(seed: int, what: str, n: int, key: str = "id") -> Column:
    """A number below ``n``, the same for the same row, seed and purpose."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed), F.lit(what)), F.lit(n))


def _pick(seed: int, what: str, values: tuple, key: str = "id") -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (_draw(seed, what, len(values), key) + 1).cast("int"))


def _name(kind: str, width: int, key: str | Column = "id") -> Column:
    return F.concat(F.lit(f"{kind}-"), F.lpad((F.col(key) if isinstance(key, str) else key).cast("string"), width, "0"))


def _money(seed: int, what: str, low: int, high: int) -> Column:
    return F.format_string("%.2f", (_draw(seed, what, (high - low) * 100) / 100 + low).cast("double"))


def clients(spark: SparkSession, seed: int, n: int, first: int = 0) -> DataFrame:
    """Names in any case, padded province codes, a missing birth date in 66, a blank town in 40."""
    raw = F.concat_ws(" ", _pick(seed, "first", ("anne-marie", "JEAN", "Élodie", "o'neil")), _name("c", 1))
    cased = F.when(_draw(seed, "case", 3) == 0, F.upper(raw)).when(_draw(seed, "case", 3) == 1, F.lower(raw)).otherwise(F.concat(F.lit("  "), raw, F.lit(" ")))
    return spark.range(first, first + n).select(
        "id", _name("CL", 6).alias("client_id"), cased.alias("name"), F.when(_draw(seed, "birth", 66) != 0, F.date_add(F.lit(dt.date(1940, 1, 1)), _draw(seed, "age", 24_000).cast("int")).cast("string")).alias("birth"),
        F.concat(_pick(seed, "province", PROVINCES), F.when(_draw(seed, "pad", 9) == 0, " ").otherwise("")).alias("province"), F.when(_draw(seed, "blank", 40) == 0, "").otherwise(_name("Town", 2, _draw(seed, "town", 60))).alias("town"),
        _pick(seed, "segment", SEGMENTS).alias("segment"), F.lit(str(DAYS[1])).alias("updated"),
    )


def policies(spark: SparkSession, seed: int, n: int, n_clients: int) -> DataFrame:
    start = F.date_add(F.lit(dt.date(2022, 6, 1)), _draw(seed, "start", 1400).cast("int"))
    return spark.range(n).select(
        "id", _name("PO", 7).alias("policy_id"), _name("CL", 6, _draw(seed, "owner", n_clients)).alias("client_id"), _pick(seed, "product", PRODUCTS).alias("product"), start.cast("string").alias("start_date"),
        F.date_add(start, 364).cast("string").alias("end_date"), _money(seed, "premium", 300, 4000).alias("premium"), F.when(start < F.lit(dt.date(2025, 5, 31)), "EXPIRED").otherwise("ACTIVE").alias("status"), F.lit(str(DAYS[1])).alias("updated"),
    )


def claims(spark: SparkSession, seed: int, n: int, n_policies: int, first: int = 0, orphans: int = 12) -> DataFrame:
    """A twentieth belong to few repeat offenders; the first ``orphans`` name policies that don't exist; open ones have no paid amount."""
    day = F.date_add(F.lit(dt.date(2023, 1, 1)), _draw(seed, "day", 1240).cast("int"))
    owner = F.when(F.col("id") < orphans, n_policies + F.col("id")).when(_draw(seed, "again", 20) == 0, _draw(seed, "few", max(1, n_policies // 200))).otherwise(_draw(seed, "policy", n_policies))
    status = _pick(seed, "status", ("OPEN", "CLOSED", "CLOSED", "CLOSED", "REFUSED"))
    claimed = _draw(seed, "claimed", 3_000_000) / 100 + 100
    return spark.range(first, first + n).select(
        "id", _name("SI", 7).alias("claim_id"), _name("PO", 7, owner).alias("policy_id"), day.cast("string").alias("claim_date"), F.date_add(day, _draw(seed, "delay", 90).cast("int")).cast("string").alias("report_date"),
        F.format_string("%.2f", claimed.cast("double")).alias("claimed"), F.when(status == "CLOSED", F.format_string("%.2f", (claimed * (50 + _draw(seed, "rate", 51)) / 100).cast("double"))).alias("paid"), status.alias("status"), F.lit(str(DAYS[1])).alias("updated"),
    )


def extracts(spark: SparkSession, seed: int = 42, n_clients: int = 6000) -> dict[int, dict[str, DataFrame]]:
    """Both batches. The second holds new clients and claims, moves and settlements, stale versions that must not win, and exact duplicates."""
    n_policies, n_claims, day = n_clients * 11 // 6, n_clients, F.lit(str(DAYS[2]))
    one = {"clients": clients(spark, seed, n_clients), "policies": policies(spark, seed, n_policies, n_clients), "claims": claims(spark, seed, n_claims, n_policies)}
    c, p, k = one["clients"], one["policies"], one["claims"]
    moved = c.where(_draw(seed, "moves", 40) == 0).withColumns({"town": F.lit("New Town"), "updated": day})
    stale = c.where(_draw(seed, "stale", n_clients // 5 or 1) == 0).withColumns({"town": F.lit(STALE_TOWN), "updated": F.lit(str(DAYS[1] - dt.timedelta(days=30)))})
    fresh = clients(spark, seed, max(1, n_clients // 300), n_clients).withColumn("updated", day)
    ended = p.where((F.col("status") == "ACTIVE") & (_draw(seed, "ended", 100) == 0)).withColumns({"status": F.lit("CANCELLED"), "updated": day})
    paid = k.where((F.col("status") == "OPEN") & (_draw(seed, "settled", 2) == 0)).withColumns({"paid": F.col("claimed"), "status": F.lit("CLOSED"), "updated": day})
    more = claims(spark, seed, n_clients // 15, n_policies, n_claims, orphans=0).withColumn("updated", day)
    twice = paid.where(_draw(seed, "twice", 10) == 0)
    two = {"clients": moved.unionByName(stale).unionByName(fresh), "policies": ended, "claims": paid.unionByName(more).unionByName(twice)}
    return {b: {name: df.drop("id") for name, df in tables.items()} for b, tables in ((1, one), (2, two))}


def write_extracts(spark: SparkSession, folder: str, seed: int = 42, n_clients: int = 6000) -> None:
    """CSV folders ``<folder>/<table>/batch_<n>`` of both batches."""
    for batch, tables in extracts(spark, seed, n_clients).items():
        for name, df in tables.items():
            write_csv(df, f"{folder}/{name}/batch_{batch}")


def events(spark: SparkSession, number: int, seed: int = 7, size: int = 60, storm: int = 40) -> DataFrame:
    """Events of a micro-batch of 15 minutes: about 1 of 30 twice, 1 of 25 late by 15, 45 or 90 minutes; the fourth batch has a storm of claims."""
    s = seed * 1000 + number
    n = size + (storm if number == 4 else 0)
    declared = (F.col("id") >= size) | (_draw(s, "kind", 10) < 7)
    late = F.when(_draw(s, "late", 25) == 0, _pick(s, "minutes", (15, 45, 90)) * 60).otherwise(0)
    at = F.lit(dt.datetime(2026, 7, 1, 8, 0)).cast("timestamp_ntz").cast("timestamp").cast("long") + (number - 1) * 900 + _draw(s, "second", 900) - late
    rows = spark.range(n).select(
        "id", _name(f"EV-{number:03d}", 4).alias("event_id"), F.when(declared, "DECLARED").otherwise("PAID").alias("event_type"), _name(f"SI-{number:03d}", 4).alias("claim_id"), _name("PO", 7, _draw(s, "policy", 11_000)).alias("policy_id"),
        F.when(F.col("id") >= size, "QC").otherwise(_pick(s, "province", PROVINCES)).alias("province"), _pick(s, "cause", ("COLLISION", "THEFT", "WATER", "GLASS")).alias("kind"), (_draw(s, "value", 1_500_000) / 100 + 300).cast("double").alias("value"), at.cast("timestamp").alias("ts"),
    )
    return rows.unionByName(rows.where(_draw(s, "again", 30) == 0)).drop("id")


def write_events(spark: SparkSession, folder: str, number: int, **how) -> None:
    """One JSON-lines file of a batch, in ``<folder>/batch=<number>``."""
    events(spark, number, **how).coalesce(1).write.mode("overwrite").json(f"{folder}/batch={number}")
