"""The insurance domain over the star-schema tables: clients, policies, claims, and the business models built on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from covelake.functions import semantics as S
from covelake.operators import history, relational


@dataclass(frozen=True)
class Params:
    """The single source of the models' constants."""

    date_ref: str = "2001-06-30"
    ratio_years: tuple[int, ...] = (1996, 1997, 1998)
    large_claim: float = 50000.0


P = Params()
DEDUCTIBLE = {"1-URGENT": 500, "2-HIGH": 1000}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def clients(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    key = F.col("c_custkey")
    birth = F.when(key % 61 != 0, F.make_date((1945 + key % 60).cast("int"), (1 + key % 12).cast("int"), (1 + key % 28).cast("int")))
    place = table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"), F.col("r_name").alias("region"))  # 25 rows by definition
    return c.join(F.broadcast(place), "c_nationkey", "left").select(key.alias("client_id"), F.col("c_name").alias("name"), birth.alias("birth"), F.col("c_mktsegment").alias("segment"), "nation", "region")


def policies(spark, d) -> DataFrame:
    start = F.to_date("o_orderdate")
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("policy_id"), F.col("o_custkey").alias("client_id"), F.col("o_orderpriority").alias("product"), start.alias("start_date"), F.date_add(start, 364).alias("end_date"), F.col("o_totalprice").cast("decimal(12,2)").alias("premium"), F.col("o_orderstatus").alias("status")
    )


def claim_versions(spark, d) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return table(spark, d, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("claim_id"), F.col("l_orderkey").alias("policy_id"), F.to_date("l_shipdate").alias("claim_date"),
        F.date_add(F.to_date("l_shipdate"), F.col("l_quantity").cast("int")).alias("report_date"), F.col("l_returnflag").alias("kind"), price.alias("claimed"),
        F.when(F.col("l_linestatus") != "O", (price * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(16,4)")).alias("paid"),
        F.when(F.col("l_linestatus") != "O", "CLOSED").otherwise("OPEN").alias("status"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"),
    )


def claims(spark, d) -> DataFrame:
    """The latest version of each claim."""
    order = [F.desc("claim_date"), F.desc("p"), F.desc("s"), F.desc("claimed")]
    return relational.dedup_latest(claim_versions(spark, d), ["claim_id"], order).drop("p", "s")


def client_versions(spark, d) -> DataFrame:
    """One version of a client for each day with policies: status and product of that day's greatest policy."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("client_id"), F.to_date("o_orderdate").alias("updated"), "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("product"))
    return o.groupBy("client_id", "updated").agg(F.max(F.struct("o_orderkey", "status", "product")).alias("m")).select("client_id", "updated", "m.status", "m.product")


def enriched(spark, d) -> DataFrame:
    """Claims with their policy and current client; claims without a policy drop out."""
    c = clients(spark, d).select("client_id", "segment", "region")
    p = policies(spark, d).select("policy_id", "client_id", "product", "start_date", "premium")
    return (
        claims(spark, d).join(p, "policy_id").join(c, "client_id", "left")
        .withColumn("band", F.when(F.col("claimed") < 10000, "SMALL").when(F.col("claimed") < 50000, "MEDIUM").otherwise("LARGE"))
        .withColumn("pay_rate", F.round(S.safe_div(F.col("paid").cast("double"), F.col("claimed").cast("double")), 6))
        .withColumn("claim_year", F.year("claim_date").cast("bigint"))
    )


def earned(spark, d, params: Params = P) -> DataFrame:
    """Premium earned pro rata of days by product and year (always over 365, bounds inclusive)."""
    rows = history.overlap_by_year(policies(spark, d), "start_date", "end_date", params.ratio_years)
    days = F.datediff("last_day", "first_day") + 1
    # in ten-thousandths, so that the sum is exact whatever its order
    part = F.round(F.col("premium").cast("double") * days / 365.0, 4).cast("decimal(18,4)")
    return rows.groupBy("product", F.col("year").cast("bigint").alias("year")).agg(F.sum(part).alias("earned"), F.count(F.lit(1)).alias("n_policies"))


def loss_ratio(spark, d, params: Params = P) -> DataFrame:
    e = earned(spark, d, params)
    c = enriched(spark, d).where(F.col("claim_year").isin(*params.ratio_years)).groupBy("product", F.col("claim_year").alias("year")).agg(F.count(F.lit(1)).alias("n_claims"), F.sum("claimed").alias("claimed"), F.sum("paid").alias("paid"))
    both = relational.left_default(e, c, ["product", "year"], ["n_claims", "claimed", "paid"])
    dbl = lambda x: F.round(F.col(x).cast("double"), 2)
    return both.select("product", "year", dbl("earned").alias("earned"), F.col("n_claims").cast("bigint").alias("n_claims"), dbl("claimed").alias("claimed"), dbl("paid").alias("paid"), F.round(S.safe_div(F.col("paid").cast("double"), F.col("earned").cast("double")), 6).alias("ratio"))


def fraud_indicators(spark, d, of: DataFrame | None = None) -> DataFrame:
    """Running counts, sums and gaps of each client's claims, flags and score; ``of``: enriched claims, if they are at hand."""
    e = (enriched(spark, d) if of is None else of).withColumn("delay", S.days_between(F.col("claim_date"), F.col("report_date"))).withColumn("since_start", S.days_between(F.col("start_date"), F.col("claim_date")))
    order = [F.asc_nulls_last("claim_date"), F.asc("claim_id")]
    run = relational.running(e, ["client_id"], order)
    gap = F.datediff("claim_date", F.lag("claim_date").over(Window.partitionBy("client_id").orderBy(*order))).cast("bigint")
    e = e.withColumns({"n_so_far": F.row_number().over(Window.partitionBy("client_id").orderBy(*order)).cast("bigint"), "claimed_so_far": F.sum("claimed").over(run).cast("double"), "gap_days": gap})
    flag = lambda c: F.when(c, 1).otherwise(0).cast("bigint")
    e = e.withColumns({"flag_gap": flag(F.col("gap_days") <= 30), "flag_new": flag(F.col("since_start") <= 30), "flag_delay": flag(F.col("delay") > 45)})
    return e.select("claim_id", "client_id", "n_so_far", "claimed_so_far", "gap_days", "flag_gap", "flag_new", "flag_delay", (40 * F.col("flag_gap") + 35 * F.col("flag_new") + 25 * F.col("flag_delay")).cast("bigint").alias("score"))


def settled(spark, d) -> DataFrame:
    """Closed claims with deductible, net amount (not below zero) and share of the premium."""
    e = enriched(spark, d).where(F.col("status") == "CLOSED")
    ded = S.decode(F.col("product"), 0, **DEDUCTIBLE).cast("decimal(12,2)")
    net = F.greatest(F.col("paid") - ded, F.lit(0).cast("decimal(12,2)"))
    return e.select("claim_id", "product", S.year_month(F.col("claim_date")).alias("month"), F.col("paid").cast("double").alias("paid"), ded.cast("double").alias("deductible"), net.cast("double").alias("net"), F.round(S.safe_div(net.cast("double"), F.col("premium").cast("double")), 6).alias("premium_ratio"))


def routed(spark, d, params: Params = P, of: DataFrame | None = None) -> dict[str, DataFrame]:
    """Settled claims by route; ``of``: settled claims, if they are at hand."""
    return relational.route(settled(spark, d) if of is None else of, {"large": F.col("net") >= params.large_claim})


def monthly_premiums(spark, d) -> DataFrame:
    p = policies(spark, d).where(F.col("status") != "P")
    seg = clients(spark, d).where("client_id % 17 <> 0").select("client_id", "segment")  # some clients have no segment: the lookup continues
    j = relational.lookup(p, seg, ["client_id"]).withColumn("segment", F.coalesce("segment", F.lit("UNKNOWN"))).withColumn("month", S.year_month(F.col("start_date")))
    return j.groupBy("month", "product", "segment").agg(F.count(F.lit(1)).alias("n_policies"), F.sum("premium").cast("double").alias("premiums"), F.round(F.sum("premium").cast("double") / F.count(F.lit(1)), 6).alias("mean_premium"))
