"""The query catalogue: every operator on the star-schema tables, each with its DuckDB equivalent."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covelake.functions import semantics as S
from covelake.operators import history, metrics, quality, reconcile, relational
from covelake.operators import ml as model
from covelake.plans import domain as D
from covelake.plans import guard, semantic
from covelake.sources.work import written
from covelake.streaming import windows as W

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

BASE = """
WITH client AS (SELECT c_custkey AS client_id, c_name AS name, CASE WHEN c_custkey % 61 <> 0 THEN make_date(1945 + c_custkey % 60, 1 + c_custkey % 12, 1 + c_custkey % 28) END AS birth,
  c_mktsegment AS segment, n_name AS nation, r_name AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
policy AS (SELECT o_orderkey AS policy_id, o_custkey AS client_id, o_orderpriority AS product, o_orderdate::DATE AS start_date, o_orderdate::DATE + 364 AS end_date, o_totalprice::DECIMAL(12,2) AS premium, o_orderstatus AS status FROM orders),
version AS (SELECT l_orderkey || '-' || l_linenumber AS claim_id, l_orderkey AS policy_id, l_shipdate::DATE AS claim_date, l_shipdate::DATE + l_quantity::INT AS report_date, l_returnflag AS kind,
  l_extendedprice::DECIMAL(12,2) AS claimed, CASE WHEN l_linestatus <> 'O' THEN (l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(4,2)))::DECIMAL(16,4) END AS paid,
  CASE WHEN l_linestatus <> 'O' THEN 'CLOSED' ELSE 'OPEN' END AS status, l_partkey AS p, l_suppkey AS s FROM lineitem),
claim AS (SELECT * EXCLUDE (p, s) FROM version QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY claim_date DESC, p DESC, s DESC, claimed DESC) = 1),
enriched AS (SELECT c.*, p.client_id, p.product, p.start_date, p.premium, k.segment, k.region, CASE WHEN claimed < 10000 THEN 'SMALL' WHEN claimed < 50000 THEN 'MEDIUM' ELSE 'LARGE' END AS band,
  round(paid::DOUBLE / nullif(claimed::DOUBLE, 0), 6) AS pay_rate, year(claim_date) AS claim_year FROM claim c JOIN policy p USING (policy_id) LEFT JOIN client k USING (client_id)),
cversion AS (SELECT o_custkey AS client_id, o_orderdate::DATE AS updated, arg_max(o_orderstatus, o_orderkey) AS status, arg_max(o_orderpriority, o_orderkey) AS product FROM orders GROUP BY ALL),
scd AS (SELECT *, row_number() OVER w AS version_no, CASE WHEN row_number() OVER w = 1 THEN DATE '1900-01-01' ELSE updated END AS valid_from,
  coalesce(lead(updated) OVER w, DATE '9999-12-31') AS valid_to, lead(updated) OVER w IS NULL AS is_current FROM cversion WINDOW w AS (PARTITION BY client_id ORDER BY updated)),
earned AS (SELECT product, y AS year, sum(round(premium::DOUBLE * (least(end_date, make_date(y, 12, 31)) - greatest(start_date, make_date(y, 1, 1)) + 1) / 365.0, 4)::DECIMAL(18,4)) AS earned, count(*) AS n_policies
  FROM policy JOIN (VALUES (1996), (1997), (1998)) t(y) ON start_date <= make_date(y, 12, 31) AND end_date >= make_date(y, 1, 1) GROUP BY ALL),
settled AS (SELECT claim_id, product, strftime(claim_date, '%Y%m') AS month, paid, CASE product WHEN '1-URGENT' THEN 500 WHEN '2-HIGH' THEN 1000 ELSE 0 END AS ded, premium,
  greatest(paid - CASE product WHEN '1-URGENT' THEN 500 WHEN '2-HIGH' THEN 1000 ELSE 0 END, 0) AS net FROM enriched WHERE status = 'CLOSED'),
fraud0 AS (SELECT *, report_date - claim_date AS delay, claim_date - start_date AS since_start, row_number() OVER w AS n_so_far, sum(claimed) OVER (w ROWS UNBOUNDED PRECEDING)::DOUBLE AS claimed_so_far,
  claim_date - lag(claim_date) OVER w AS gap_days FROM enriched WINDOW w AS (PARTITION BY client_id ORDER BY claim_date NULLS LAST, claim_id)),
fraud AS (SELECT *, CASE WHEN gap_days <= 30 THEN 1 ELSE 0 END AS flag_gap, CASE WHEN since_start <= 30 THEN 1 ELSE 0 END AS flag_new, CASE WHEN delay > 45 THEN 1 ELSE 0 END AS flag_delay FROM fraud0),
stream AS (SELECT event_id, ts, event_type, user_id % 9 AS province, value FROM events UNION ALL SELECT event_id, ts + INTERVAL 1 MINUTE, event_type, user_id % 9, value FROM events WHERE event_id % 30 = 0
  UNION ALL SELECT -event_id, ts - INTERVAL 45 MINUTE, event_type, user_id % 9, value FROM events WHERE event_id % 25 = 0),
once AS (SELECT * FROM stream QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1),
win AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, province, count(*) FILTER (event_type = 'purchase') AS n_declared, count(*) FILTER (event_type = 'click') AS n_paid,
  round(coalesce(sum(round(value, 4)::DECIMAL(18,4)) FILTER (event_type = 'purchase'), 0)::DOUBLE, 2) AS declared FROM once GROUP BY ALL)
"""


def query(sql: str | None):
    """Registers a query; its SQL follows the shared definitions."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = BASE + sql
        return f

    return add


def money(c: str):
    return F.round(F.sum(c).cast("double"), 2)


# --- semantics -------------------------------------------------------------------------------------------


@query(
    """SELECT product, e.year, round(e.earned::DOUBLE, 2) AS earned, CASE WHEN c.n IS NULL THEN 0 ELSE c.n END AS n_claims,
      CASE WHEN c.n IS NULL THEN 0 ELSE round(c.claimed::DOUBLE, 2) END AS claimed, CASE WHEN c.n IS NULL THEN 0 ELSE round(c.paid::DOUBLE, 2) END AS paid,
      round(CASE WHEN c.n IS NULL THEN 0 ELSE c.paid END::DOUBLE / nullif(e.earned::DOUBLE, 0), 6) AS ratio
    FROM earned e
    LEFT JOIN (SELECT product, claim_year AS year, count(*) AS n, sum(claimed) AS claimed, sum(paid) AS paid
    FROM enriched
    GROUP BY ALL) c USING (product, year)"""
)
def loss_ratio(spark, d) -> DataFrame:
    return D.loss_ratio(spark, d)


@query("SELECT product, year, round(earned::DOUBLE, 2) AS earned, n_policies FROM earned")
def earned_premium(spark, d):
    return D.earned(spark, d).select("product", "year", F.round(F.col("earned").cast("double"), 2).alias("earned"), "n_policies")


@query("SELECT client_id, (birth IS NULL OR year(birth) < 1960)::INT AS low, (year(birth) < 1960)::INT AS sql_low FROM client")
def sas_missing_compare(spark, d):
    y = F.year("birth")
    return D.clients(spark, d).select("client_id", S.missing_lt(y, 1960).cast("int").alias("low"), (y < 1960).cast("int").alias("sql_low"))


@query(
    """SELECT client_id, (year(DATE '2001-02-28') - year(birth) - CASE WHEN month(birth) * 100 + day(birth) > 228 THEN 1 ELSE 0 END)::BIGINT AS age
    FROM client"""
)
def completed_years(spark, d):
    return D.clients(spark, d).select("client_id", S.completed_years(F.col("birth"), F.to_date(F.lit("2001-02-28"))).cast("bigint").alias("age"))


_PROP = "array_to_string(list_transform(string_split(array_to_string(list_transform(string_split(lower(trim({0})), ' '), lambda x: upper(x[1]) || x[2:]), ' '), '-'), lambda x: upper(x[1]) || x[2:]), '-')"


@query(
    f"""SELECT c_custkey AS client_id, {_PROP.format(chr(39) + '  jean-FRANÇOIS  ' + chr(39) + ' || upper(c_name)')} AS name, {_PROP.format('c_mktsegment')} AS segment
    FROM customer"""
)
def propcase(spark, d):
    return D.table(spark, d, "customer").select(F.col("c_custkey").alias("client_id"), S.propcase(F.concat(F.lit("  jean-FRANÇOIS  "), F.upper("c_name"))).alias("name"), S.propcase(F.col("c_mktsegment")).alias("segment"))


@query(
    """SELECT p_partkey, upper(trim('  ' || p_name || ' ')) AS up, lower(p_type) AS low, nullif(trim(CASE WHEN p_partkey % 5 = 0 THEN '   ' ELSE p_brand END), '') AS brand
    FROM part"""
)
def string_std(spark, d):
    blank = F.when(F.col("p_partkey") % 5 == 0, "   ").otherwise(F.col("p_brand"))
    return D.table(spark, d, "part").select("p_partkey", F.upper(F.trim(F.concat(F.lit("  "), "p_name", F.lit(" ")))).alias("up"), F.lower("p_type").alias("low"), S.blank_to_null(blank).alias("brand"))


@query(
    """SELECT event_id, try_cast(CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 11 = 0 THEN 'x1' ELSE event_id::VARCHAR END AS BIGINT) AS n,
      try_cast(CASE WHEN event_id % 5 = 0 THEN '2024-02-31' ELSE '2024-02-0' || (event_id % 9 + 1) END AS DATE) AS day,
      try_cast(CASE WHEN event_id % 13 = 0 THEN 'abc' ELSE (event_id % 1000)::VARCHAR || '.25' END AS DECIMAL(12,2))::DOUBLE AS amount
    FROM events"""
)
def typed_casts(spark, d):
    e, i = D.table(spark, d, "events"), F.col("event_id")
    n = F.when(i % 7 == 0, "").when(i % 11 == 0, "x1").otherwise(i.cast("string"))
    day = F.when(i % 5 == 0, "2024-02-31").otherwise(F.concat(F.lit("2024-02-0"), (i % 9 + 1).cast("string")))
    amount = F.when(i % 13 == 0, "abc").otherwise(F.concat((i % 1000).cast("string"), F.lit(".25")))
    return e.select("event_id", n.try_cast("bigint").alias("n"), day.try_cast("date").alias("day"), amount.try_cast("decimal(12,2)").cast("double").alias("amount"))


@query(
    """SELECT policy_id, CASE product WHEN '1-URGENT' THEN 500 WHEN '2-HIGH' THEN 1000 ELSE 0 END AS deductible, CASE WHEN status = 'P' THEN 'N' ELSE 'Y' END AS active,
      regexp_replace(trim('  a   b ' || product), ' +', ' ', 'g') AS tight
    FROM policy"""
)
def decode_iif(spark, d):
    p = D.policies(spark, d)
    return p.select("policy_id", S.decode(F.col("product"), 0, **D.DEDUCTIBLE).alias("deductible"), F.when(F.col("status") == "P", "N").otherwise("Y").alias("active"), S.tight_trim(F.concat(F.lit("  a   b "), "product")).alias("tight"))


@query("SELECT client_id, version_no, md5(client_id || '|' || strftime(updated, '%Y-%m-%d')) AS sk FROM scd")
def surrogate_key(spark, d):
    v = history.scd2(D.client_versions(spark, d), "client_id", "updated")
    return v.select("client_id", "version_no", S.surrogate_key(F.col("client_id"), F.date_format("updated", "yyyy-MM-dd")).alias("sk"))


@query("SELECT claim_id, (report_date - claim_date)::BIGINT AS delay FROM claim")
def reporting_delay(spark, d):
    return D.claims(spark, d).select("claim_id", S.days_between(F.col("claim_date"), F.col("report_date")).alias("delay"))


@query("SELECT s_suppkey, try_cast(nullif(regexp_extract(CASE WHEN s_suppkey % 4 = 0 THEN 'other.csv' ELSE 'batch_' || lpad(s_suppkey::VARCHAR, 3, '0') || '.csv' END, 'batch_(\\d+)', 1), '') AS INT) AS batch FROM supplier")
def batch_id_extract(spark, d):
    k = F.col("s_suppkey")
    name = F.when(k % 4 == 0, "other.csv").otherwise(F.concat(F.lit("batch_"), F.lpad(k.cast("string"), 3, "0"), F.lit(".csv")))
    return D.table(spark, d, "supplier").select("s_suppkey", S.batch_number(name).alias("batch"))


@query(
    """SELECT strftime(g, '%Y%m%d')::BIGINT AS date_id, g::DATE AS day, year(g) AS year, quarter(g) AS quarter, month(g) AS month,
      ['janvier','février','mars','avril','mai','juin','juillet','août','septembre','octobre','novembre','décembre'][month(g)] AS month_name, isodow(g) AS weekday,
      isodow(g) IN (6, 7) AS weekend
    FROM range(DATE '1995-01-01', DATE '2002-01-01', INTERVAL 1 DAY) t(g)"""
)
def dim_date(spark, d):
    g, big = F.col("day"), lambda c: c.cast("bigint")
    return relational.days(spark, "1995-01-01", "2002-01-01").select(
        S.date_id(g).alias("date_id"), "day", big(F.year(g)).alias("year"), big(F.quarter(g)).alias("quarter"), big(F.month(g)).alias("month"), S.month_name(g).alias("month_name"), S.iso_weekday(g).alias("weekday"), S.iso_weekday(g).isin(6, 7).alias("weekend")
    )


@query(
    """SELECT md5(policy_id::VARCHAR) AS policy_sk, policy_id, client_id, product, start_date, end_date, premium::DOUBLE AS premium, status,
      (end_date - start_date)::BIGINT AS days
    FROM policy"""
)
def dim_policy(spark, d):
    return D.policies(spark, d).select(S.surrogate_key(F.col("policy_id")).alias("policy_sk"), "policy_id", "client_id", "product", "start_date", "end_date", F.col("premium").cast("double").alias("premium"), "status", S.days_between(F.col("start_date"), F.col("end_date")).alias("days"))


# --- relational ------------------------------------------------------------------------------------------


@query("SELECT claim_id, claim_date, claimed::DOUBLE AS claimed FROM claim")
def dedup_latest(spark, d):
    return D.claims(spark, d).select("claim_id", "claim_date", F.col("claimed").cast("double").alias("claimed"))


@query(
    """SELECT claim_id, policy_id, client_id, product, segment, region, band, pay_rate, claim_year, claimed::DOUBLE AS claimed, paid::DOUBLE AS paid
    FROM enriched"""
)
def claims_enriched(spark, d):
    return D.enriched(spark, d).select("claim_id", "policy_id", "client_id", "product", "segment", "region", "band", "pay_rate", "claim_year", F.col("claimed").cast("double").alias("claimed"), F.col("paid").cast("double").alias("paid"))


@query(
    """SELECT client_id, age, CASE WHEN age IS NULL OR age < 30 THEN '<30' WHEN age < 45 THEN '30-44' WHEN age < 60 THEN '45-59' ELSE '60+' END AS band
    FROM (SELECT client_id, (year(DATE '2001-06-30') - year(birth) - CASE WHEN month(birth) * 100 + day(birth) > 630 THEN 1 ELSE 0 END)::BIGINT AS age
    FROM client)"""
)
def customer_age_band(spark, d):
    c = D.clients(spark, d).select("client_id", S.completed_years(F.col("birth"), F.to_date(F.lit(D.P.date_ref))).cast("bigint").alias("age"))
    return c.withColumn("band", F.when(S.missing_lt(F.col("age"), 30), "<30").when(F.col("age") < 45, "30-44").when(F.col("age") < 60, "45-59").otherwise("60+"))


@query(
    """SELECT policy_id, coalesce(segment, 'UNKNOWN') AS segment
    FROM policy
    LEFT JOIN (SELECT *
    FROM client
    WHERE client_id % 17 <> 0) USING (client_id)"""
)
def lookup_continue(spark, d):
    seg = D.clients(spark, d).where("client_id % 17 <> 0").select("client_id", "segment")
    return relational.lookup(D.policies(spark, d), seg, ["client_id"]).select("policy_id", F.coalesce("segment", F.lit("UNKNOWN")).alias("segment"))


@query("SELECT policy_id FROM policy WHERE client_id % 17 = 0")
def lookup_reject(spark, d):
    seg = D.clients(spark, d).where("client_id % 17 <> 0").select("client_id", "segment")
    return relational.lookup(D.policies(spark, d), seg, ["client_id"], "reject").select("policy_id")


_SETTLED = "SELECT claim_id, product, month, paid::DOUBLE AS paid, ded::DOUBLE AS deductible, net::DOUBLE AS net, round(net::DOUBLE / nullif(premium::DOUBLE, 0), 6) AS premium_ratio FROM settled"


@query(_SETTLED)
def settled_claims(spark, d):
    return D.settled(spark, d)


@query(_SETTLED + " WHERE NOT coalesce(net >= 50000, false)")
def router_default(spark, d):
    return D.routed(spark, d)["default"]


@query(_SETTLED + " WHERE net >= 50000")
def router_large(spark, d):
    return D.routed(spark, d)["large"]


@query(
    """SELECT strftime(start_date, '%Y%m') AS month, product, coalesce(segment, 'UNKNOWN') AS segment, count(*) AS n_policies, sum(premium)::DOUBLE AS premiums,
      round(sum(premium)::DOUBLE / count(*), 6) AS mean_premium
    FROM policy
    LEFT JOIN (SELECT client_id, segment
    FROM client
    WHERE client_id % 17 <> 0) USING (client_id)
    WHERE policy.status <> 'P'
    GROUP BY ALL"""
)
def monthly_premiums(spark, d):
    return D.monthly_premiums(spark, d)


@query(
    """SELECT claim_id, count(*) AS n
    FROM version
    WHERE policy_id IN (SELECT o_orderkey
    FROM orders
    WHERE o_orderdate >= TIMESTAMP '2001-01-01')
    GROUP BY ALL"""
)
def semi_touched_keys(spark, d):
    touched = D.table(spark, d, "orders").where("o_orderdate >= timestamp_ntz'2001-01-01'").select(F.col("o_orderkey").alias("policy_id"))
    return D.claim_versions(spark, d).join(touched, "policy_id", "left_semi").groupBy("claim_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance
    FROM customer
    UNION ALL BY NAME SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance
    FROM supplier"""
)
def union_by_name(spark, d):
    c = D.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return relational.union_by_name(c, D.table(spark, d, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")))


@query("SELECT y AS year FROM (VALUES (1996), (1997), (1998)) t(y)")
def src_param_table(spark, d):
    return relational.inline_table(spark, [*D.P.ratio_years], "year").select(F.col("year").cast("int").alias("year"))


@query(
    """SELECT product, claim_id, net::DOUBLE AS net, rank() OVER (PARTITION BY product ORDER BY net DESC) AS rank
    FROM settled
    WHERE net IS NOT NULL
    QUALIFY rank() OVER (PARTITION BY product ORDER BY net DESC) <= 10"""
)
def topn_large_claims(spark, d):
    return relational.top_n(D.settled(spark, d).where("net is not null").select("product", "claim_id", "net"), ["product"], [F.desc("net")], 10)


@query(
    """SELECT product, round(sum(CASE WHEN year = 1996 THEN earned END)::DOUBLE, 2) AS earned_1996, round(sum(CASE WHEN year = 1997 THEN earned END)::DOUBLE,
      2) AS earned_1997, round(sum(CASE WHEN year = 1998 THEN earned END)::DOUBLE, 2) AS earned_1998
    FROM earned
    WHERE year BETWEEN 1996 AND 1998
    GROUP BY ALL"""
)
def report_ratio(spark, d):
    e = D.earned(spark, d).where(F.col("year").between(1996, 1998))
    return e.groupBy("product").pivot("year", [*D.P.ratio_years]).agg(F.round(F.sum("earned").cast("double"), 2)).select("product", *[F.col(str(y)).alias(f"earned_{y}") for y in D.P.ratio_years])


@query(
    """SELECT product, substring(strftime(start_date, '%Y%m'), 1, 4) AS year, sum(premium)::DOUBLE AS premiums, round(avg(premium::DOUBLE), 2) AS mean_premium
    FROM policy
    WHERE substring(strftime(start_date, '%Y%m'), 1, 4) = '1997'
    GROUP BY ALL"""
)
def report_premiums(spark, d):
    p = D.policies(spark, d).withColumn("year", F.substring(S.year_month(F.col("start_date")), 1, 4)).where(F.col("year") == F.lit("1997"))
    return p.groupBy("product", "year").agg(F.sum("premium").cast("double").alias("premiums"), F.round(F.sum("premium").cast("double") / F.count(F.lit(1)), 2).alias("mean_premium"))


@query(
    """SELECT region, claim_year, round(sum(paid)::DOUBLE / nullif(sum(claimed)::DOUBLE, 0), 6) AS ratio, round(sum(paid)::DOUBLE, 2) AS paid
    FROM enriched
    GROUP BY ALL"""
)
def metric_loss_ratio(spark, d):
    return metrics.at_grain(D.enriched(spark, d), ["region", "claim_year"], ratio=metrics.ratio_of_sums("paid", "claimed"), paid=metrics.total("paid"))


@query("SELECT product, round(sum(premium)::DOUBLE / count(*)::DOUBLE, 6) AS mean_premium, count(*) AS n_policies FROM policy GROUP BY ALL")
def metric_avg_premium(spark, d):
    p = D.policies(spark, d).withColumn("one", F.lit(1))
    return metrics.at_grain(p, ["product"], mean_premium=metrics.ratio_of_sums("premium", "one"), n_policies=F.count(F.lit(1)))


_LOSS = """, loss AS (SELECT e.product, e.year, round(e.earned::DOUBLE, 2) AS earned, round(coalesce(c.paid, 0)::DOUBLE, 2) AS paid FROM earned e
  LEFT JOIN (SELECT product, claim_year AS year, sum(paid) AS paid FROM enriched GROUP BY ALL) c USING (product, year)),
monthly AS (SELECT strftime(start_date, '%Y%m') AS month, product, CASE WHEN p.client_id % 17 <> 0 THEN coalesce(segment, 'UNKNOWN') ELSE 'UNKNOWN' END AS segment,
  count(*) AS n_policies, sum(premium)::DOUBLE AS premiums FROM policy p LEFT JOIN client USING (client_id) WHERE p.status <> 'P' GROUP BY ALL)
"""


@query(
    _LOSS
    + """SELECT product, total_paid, earned_premium, loss_ratio, policies, written_premium, mean_premium
    FROM (SELECT product, round(sum(paid), 2) AS total_paid, round(sum(earned), 2) AS earned_premium, round(sum(paid) / nullif(sum(earned), 0), 6) AS loss_ratio FROM loss GROUP BY product)
    FULL JOIN (SELECT product, round(sum(n_policies)::DOUBLE, 2) AS policies, round(sum(premiums), 2) AS written_premium, round(sum(premiums) / nullif(sum(n_policies), 0), 6) AS mean_premium FROM monthly GROUP BY product) USING (product)"""
)
def metrics_by_product(spark, d):
    return semantic.REGISTRY.ask(spark, d, [*semantic.REGISTRY.metrics], ["product"])


# --- history ---------------------------------------------------------------------------------------------


@query("SELECT client_id, version_no, valid_from, valid_to, is_current, status, product FROM scd")
def scd2_versions(spark, d):
    return history.scd2(D.client_versions(spark, d), "client_id", "updated").select("client_id", "version_no", "valid_from", "valid_to", "is_current", "status", "product")


@query("SELECT client_id, version_no, status FROM scd WHERE is_current")
def scd2_current(spark, d):
    return history.scd2(D.client_versions(spark, d), "client_id", "updated").where("is_current").select("client_id", "version_no", "status")


@query(
    """SELECT claim_id, client_id, version_no, s.status AS status_then
    FROM enriched
    LEFT JOIN scd s USING (client_id)
    WHERE version_no IS NULL OR (claim_date >= valid_from AND claim_date < valid_to)"""
)
def pit_join(spark, d):
    facts = D.enriched(spark, d).select("claim_id", "client_id", "claim_date")
    dim = history.scd2(D.client_versions(spark, d), "client_id", "updated").select("client_id", "version_no", F.col("status").alias("status_then"), "valid_from", "valid_to")
    return history.point_in_time(facts, dim, "client_id", "claim_date").select("claim_id", "client_id", "version_no", "status_then")


_TARGET = "target AS (SELECT claim_id, claim_date, p, s, claimed FROM version WHERE p % 3 <> 0 AND claim_date < DATE '1999-01-01' QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY claim_date DESC, p DESC, s DESC, claimed DESC) = 1)"
_ORDER = lambda: [F.desc("claim_date"), F.desc("p"), F.desc("s"), F.desc("claimed")]


def _target(spark, d):
    v = D.claim_versions(spark, d).where("p % 3 <> 0 and claim_date < date'1999-01-01'").select("claim_id", "claim_date", "p", "s", "claimed")
    return relational.dedup_latest(v, ["claim_id"], _ORDER())


@query(f", {_TARGET} SELECT claim_id, claim_date, claimed::DOUBLE AS claimed FROM version WHERE claim_date > (SELECT max(claim_date) FROM target)")
def incr_high_water(spark, d):
    return history.above_high_water(D.claim_versions(spark, d), _target(spark, d), "claim_date").select("claim_id", "claim_date", F.col("claimed").cast("double").alias("claimed"))


@query(
    f""", {_TARGET}, new AS (SELECT claim_id, claim_date, p, s, claimed
    FROM version
    WHERE p % 3 = 0),
    winner AS (SELECT *
    FROM (SELECT *
    FROM target
    WHERE claim_id IN (SELECT claim_id
    FROM new)
    UNION ALL SELECT *
    FROM new)
    QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY claim_date DESC, p DESC, s DESC, claimed DESC) = 1) SELECT claim_id, claim_date, p,
      claimed::DOUBLE AS claimed
    FROM (SELECT *
    FROM target
    WHERE claim_id NOT IN (SELECT claim_id
    FROM new)
    UNION ALL SELECT *
    FROM winner)"""
)
def incr_merge(spark, d):
    new = D.claim_versions(spark, d).where("p % 3 = 0").select("claim_id", "claim_date", "p", "s", "claimed")
    return history.merge_latest(_target(spark, d), new, ["claim_id"], _ORDER()).select("claim_id", "claim_date", "p", F.col("claimed").cast("double").alias("claimed"))


# --- analytics -------------------------------------------------------------------------------------------


@query(
    """SELECT claim_id, client_id, n_so_far, claimed_so_far, gap_days, flag_gap::BIGINT AS flag_gap, flag_new::BIGINT AS flag_new, flag_delay::BIGINT AS flag_delay,
      (40 * flag_gap + 35 * flag_new + 25 * flag_delay)::BIGINT AS score
    FROM fraud"""
)
def fraud_indicators(spark, d):
    return D.fraud_indicators(spark, d)


@query(
    """SELECT f.claim_id, f.product, f.kind, f.segment, f.claimed::DOUBLE AS claimed, round(f.claimed::DOUBLE / nullif(f.premium::DOUBLE, 0), 6) AS claim_to_premium,
      n_so_far - 1 AS earlier, gap_days, (month(f.claim_date) IN (1, 7, 12))::INT AS peak_month, (k.birth IS NOT NULL)::INT AS has_birth,
      (f.pay_rate IS NOT NULL)::INT AS has_rate, CASE WHEN f.kind = 'R' THEN 1 WHEN f.kind = 'A' THEN 0 END AS label
    FROM fraud f
    LEFT JOIN client k USING (client_id)"""
)
def fraud_features(spark, d):
    return model.features(spark, d)


@query(
    """, scored AS (SELECT claim_id, (40 * flag_gap + 35 * flag_new + 25 * flag_delay)::BIGINT AS score
    FROM fraud),
    ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, claim_id) AS rank
    FROM scored) SELECT claim_id, score, rank, rank <= floor((SELECT count(*)
    FROM scored) * 0.1) AS review
    FROM ranked"""
)
def score_rank(spark, d):
    return model.rank_scores(D.fraud_indicators(spark, d).select("claim_id", "score"), "score", "claim_id", 0.1)


@query(
    """, scored AS (SELECT claim_id, (40 * flag_gap + 35 * flag_new + 25 * flag_delay)::BIGINT AS score, CASE WHEN kind = 'R' THEN 1 ELSE 0 END AS y
    FROM fraud),
    top AS (SELECT *, row_number() OVER (ORDER BY score DESC, claim_id) AS rank
    FROM scored) SELECT round(sum(y)::DOUBLE / count(*), 6) AS precision_at_k, count(*) AS k
    FROM top
    WHERE rank <= greatest(1, round((SELECT count(*)
    FROM scored) * 0.1))"""
)
def precision_at_k(spark, d):
    s = D.fraud_indicators(spark, d).select("claim_id", "score").join(D.claims(spark, d).select("claim_id", F.when(F.col("kind") == "R", 1).otherwise(0).alias("y")), "claim_id")
    return model.precision_at(s, "y", "score", "claim_id", 0.1)


@query(
    """, scored AS (SELECT CASE WHEN kind = 'R' THEN 1 ELSE 0 END AS y, (40 * flag_gap + 35 * flag_new + 25 * flag_delay)::BIGINT AS score
    FROM fraud),
    t AS (SELECT score, sum(y)::BIGINT AS p, count(*) - sum(y)::BIGINT AS n
    FROM scored
    GROUP BY score),
    c AS (SELECT *, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
      sum(p) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp, sum(p + n) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS taken
    FROM t) SELECT round(sum(p * (2 * below + n))::DOUBLE / (2 * sum(p) * sum(n))::DOUBLE, 6) AS roc_auc, round(sum(p::DOUBLE * tp / taken) / sum(p)::DOUBLE,
      6) AS average_precision
    FROM c"""
)
def ranking_quality(spark, d):
    s = D.fraud_indicators(spark, d).select("claim_id", "score").join(D.claims(spark, d).select("claim_id", F.when(F.col("kind") == "R", 1).otherwise(0).alias("y")), "claim_id")
    return model.ranking_quality(s, "y", "score")


# --- event windows in batch form ---------------------------------------------------------------------------


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type, province FROM once")
def event_dedup(spark, d):
    return W.first_by_id(W.sample_stream(spark, d)).select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "event_type", "province")


@query(
    """, marked AS (SELECT *, abs(event_id) AS arrival FROM once),
    w AS (SELECT *, max(ts) OVER (ORDER BY arrival, event_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 30 MINUTE AS mark FROM marked)
    SELECT event_id, coalesce(ts < mark, false) AS late FROM w"""
)
def late_events(spark, d):
    return W.late(W.first_by_id(W.sample_stream(spark, d))).select("event_id", "late")


@query("SELECT strftime(window_start, '%Y-%m-%d %H:%M') AS window_start, province, n_declared, n_paid, declared FROM win")
def event_windows(spark, d):
    return W.by_window(W.first_by_id(W.sample_stream(spark, d))).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


@query("SELECT DISTINCT strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y-%m-%d %H:%M') AS window_start, province FROM once")
def touched_windows(spark, d):
    return W.touched(W.first_by_id(W.sample_stream(spark, d))).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


@query("SELECT strftime(window_start, '%Y-%m-%d %H:%M') AS window_start, province, n_declared, n_paid, declared FROM win")
def window_refresh(spark, d):
    """Windows of the events in time, refreshed by the batch of late copies."""
    rows = W.first_by_id(W.sample_stream(spark, d))
    return W.refresh(W.by_window(rows.where("event_id >= 0")), rows, rows.where("event_id < 0")).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


@query(
    """SELECT strftime(window_start, '%Y-%m-%d %H:%M') AS window_start, province, n_declared, 1 AS threshold
    FROM win
    WHERE n_declared >= 1 AND province <> 0"""
)
def alerts_once(spark, d):
    win = W.by_window(W.first_by_id(W.sample_stream(spark, d)))
    before = W.alerts(win.where("province = 0"), 1)
    return W.new_alerts(W.alerts(win, 1), before).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


# --- reconciliation ----------------------------------------------------------------------------------------

_PAIR = """, l AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS amount FROM orders),
r AS (SELECT o_orderkey + CASE WHEN o_orderkey % 1009 = 0 THEN 10000000 ELSE 0 END AS id, CASE WHEN o_orderkey % 101 = 0 THEN 'X' ELSE o_orderstatus END AS status,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN o_totalprice + 0.004 WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS amount FROM orders WHERE o_orderkey % 997 <> 0),
j AS (SELECT l.id AS lid, r.id AS rid, l.status AS ls, r.status AS rs, l.amount AS la, r.amount AS ra, coalesce((l.amount IS NULL) <> (r.amount IS NULL) OR abs(l.amount - r.amount) > 0.01, false) AS da, l.status IS DISTINCT FROM r.status AS ds FROM l FULL OUTER JOIN r ON l.id::VARCHAR = r.id::VARCHAR)
"""


def _pair(spark, d):
    o, k = D.table(spark, d, "orders"), F.col("o_orderkey")
    left = o.select(k.alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"))
    amount = F.when(k % 53 == 0, F.lit(None).cast("double")).when(k % 7 == 0, F.col("o_totalprice") + 0.004).when(k % 89 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    right = o.where(k % 997 != 0).select((k + F.when(k % 1009 == 0, 10000000).otherwise(0)).alias("id"), F.when(k % 101 == 0, "X").otherwise(F.col("o_orderstatus")).alias("status"), amount.alias("amount"))
    return left, right


@query(
    _PAIR + """SELECT count(lid) AS left_rows, count(rid) AS right_rows, count(*) FILTER (rid IS NULL) AS missing, count(*) FILTER (lid IS NULL) AS extra
    FROM j"""
)
def reconcile_counts(spark, d):
    return reconcile.summary(*_pair(spark, d), ["id"], []).select("left_rows", "right_rows", "missing", "extra")


@query(_PAIR + "SELECT count(*) FILTER (ds) AS diff_status, count(*) FILTER (da) AS diff_amount FROM j WHERE lid IS NOT NULL AND rid IS NOT NULL")
def reconcile_columns(spark, d):
    return reconcile.summary(*_pair(spark, d), ["id"], ["status", "amount"]).select("diff_status", "diff_amount")


@query(_PAIR + "SELECT round(sum(la::DECIMAL(38,4))::DOUBLE, 2) AS left_amount, round(sum(ra::DECIMAL(38,4))::DOUBLE, 2) AS right_amount FROM j")
def reconcile_checksums(spark, d):
    return reconcile.summary(*_pair(spark, d), ["id"], ["amount"]).select("left_amount", "right_amount")


@query(_PAIR + "SELECT lid AS id, ls AS left_value, rs AS right_value FROM j WHERE lid IS NOT NULL AND rid IS NOT NULL AND ds ORDER BY ALL LIMIT 5")
def reconcile_samples(spark, d):
    return reconcile.samples(*_pair(spark, d), ["id"], "status", 0.01)


# --- data quality ------------------------------------------------------------------------------------------


@query("SELECT claim_id, count(*) AS n FROM version GROUP BY ALL HAVING count(*) > 1")
def dq_unique(spark, d):
    return quality.unique(D.claim_versions(spark, d), "claim_id")


@query("SELECT client_id FROM client WHERE birth IS NULL")
def dq_not_null(spark, d):
    return quality.not_null(D.clients(spark, d), "birth").select("client_id")


@query("SELECT status, count(*) AS n FROM policy WHERE status IS NOT NULL AND status NOT IN ('F', 'O') GROUP BY ALL")
def dq_accepted_values(spark, d):
    return quality.accepted_values(D.policies(spark, d), "status", ["F", "O"])


@query("SELECT policy_id FROM policy WHERE client_id NOT IN (SELECT client_id FROM client WHERE client_id % 19 <> 0)")
def dq_relationships(spark, d):
    return quality.relationships(D.policies(spark, d), "client_id", D.clients(spark, d).where("client_id % 19 <> 0"), "client_id").select("policy_id")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 3 OR l_quantity > 48")
def dq_value_between(spark, d):
    return quality.value_between(D.table(spark, d, "lineitem"), "l_quantity", 3, 48).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    """, bad AS (SELECT client_id, valid_from, CASE WHEN client_id % 10 = 1 AND is_current THEN valid_from WHEN client_id % 10 = 2 AND version_no = 1 THEN valid_to - 1 ELSE valid_to END AS valid_to, is_current AND client_id % 10 <> 3 AS is_current
    FROM scd),
    x AS (SELECT *, lead(valid_from) OVER (PARTITION BY client_id ORDER BY valid_from) AS nxt
    FROM bad) SELECT client_id, 'reversed' AS anomaly
    FROM x
    WHERE valid_to <= valid_from
    UNION ALL SELECT client_id, 'gap or overlap'
    FROM x
    WHERE nxt <> valid_to
    UNION ALL SELECT client_id, 'current rows'
    FROM bad
    GROUP BY client_id
    HAVING sum(is_current::INT) <> 1"""
)
def dq_scd2(spark, d):
    v, k = history.scd2(D.client_versions(spark, d), "client_id", "updated"), F.col("client_id") % 10
    bad = v.select("client_id", "valid_from", F.when((k == 1) & F.col("is_current"), F.col("valid_from")).when((k == 2) & (F.col("version_no") == 1), F.date_sub("valid_to", 1)).otherwise(F.col("valid_to")).alias("valid_to"), (F.col("is_current") & (k != 3)).alias("is_current"))
    return quality.scd2_anomalies(bad, "client_id")


@query(f", {_TARGET} SELECT v.claim_id, v.claim_date FROM version v JOIN target t ON v.claim_id = t.claim_id AND v.claim_date > t.claim_date")
def dq_no_stale_version(spark, d):
    return quality.stale_versions(D.claim_versions(spark, d), _target(spark, d), "claim_id", "claim_date").select("claim_id", "claim_date")


@query(
    """SELECT (SELECT coalesce(sum(paid), 0)::DOUBLE
    FROM claim) AS left_sum, (SELECT coalesce(sum(paid), 0)::DOUBLE
    FROM claim
    WHERE kind <> 'R') AS right_sum"""
)
def dq_amount_conservation(spark, d):
    c = D.claims(spark, d)
    return quality.conserved(c, c.where("kind <> 'R'"), "paid")


@query(
    """SELECT claim_id, CASE WHEN net >= 50000 THEN 2 ELSE 1 END - CASE WHEN product = '5-LOW' THEN 1 ELSE 0 END AS n
    FROM settled
    WHERE (CASE WHEN net >= 50000 THEN 2 ELSE 1 END - CASE WHEN product = '5-LOW' THEN 1 ELSE 0 END) <> 1"""
)
def dq_router_partition(spark, d):
    whole = written(D.settled(spark, d))  # used four times
    parts = D.routed(spark, d, of=whole)
    both = parts["default"].unionAll(parts["large"]).where("product <> '5-LOW'")
    return quality.not_once(whole, "claim_id", both, parts["large"])


# --- guarded SQL -------------------------------------------------------------------------------------------


def _views(spark, d):
    """A session of its own, so that the caller's views stay."""
    own = spark.newSession()
    for name in ("customer", "orders"):
        D.table(own, d, name).createOrReplaceTempView(name)
    return own


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 200")
def guarded_limit(spark, d):
    return guard.run(_views(spark, d), "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey", {"customer", "orders"}, 200)


_SETOPS = """
SELECT c_mktsegment, c_nationkey FROM customer JOIN orders ON c_custkey = o_custkey
INTERSECT SELECT c_mktsegment, c_nationkey FROM customer WHERE c_acctbal > 0
EXCEPT SELECT c_mktsegment, c_nationkey FROM customer WHERE c_acctbal > 9990
"""


@query(_SETOPS)
def guarded_setops(spark, d):
    return guard.run(_views(spark, d), _SETOPS, {"customer", "orders"}, 200)
