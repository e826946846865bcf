"""The fraud model: features, a linear pipeline, global ranks and ranking metrics by ranges of scores."""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covelake.functions import semantics as S
from covelake.sources.work import written


def features(spark, d) -> DataFrame:
    """One row a claim; the label is null where no verdict exists."""
    from covelake.plans import domain as D

    e = written(D.enriched(spark, d))  # used twice
    f = D.fraud_indicators(spark, d, e).select("claim_id", "n_so_far", "gap_days")
    k = D.clients(spark, d).select("client_id", "birth")
    flag = lambda c: c.cast("int")
    return (
        e.join(f, "claim_id", "left").join(k, "client_id", "left")
        .select(
            "claim_id", "product", "kind", "segment", F.col("claimed").cast("double").alias("claimed"), F.round(S.safe_div(F.col("claimed").cast("double"), F.col("premium").cast("double")), 6).alias("claim_to_premium"),
            (F.col("n_so_far") - 1).alias("earlier"), "gap_days", flag(F.month("claim_date").isin(1, 7, 12)).alias("peak_month"), flag(F.col("birth").isNotNull()).alias("has_birth"), flag(F.col("pay_rate").isNotNull()).alias("has_rate"),
            F.when(F.col("kind") == "R", 1).when(F.col("kind") == "A", 0).alias("label"),
        )
    )


def pipeline(categories: list[str], numbers: list[str], constants: dict[str, float], regularisation: float):
    """Impute (median, or a constant), one-hot with unknown values kept apart, standardise, logistic regression."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler

    filled = [c for c in numbers if c not in constants]
    stages = [StringIndexer(inputCols=categories, outputCols=[f"{c}_ix" for c in categories], handleInvalid="keep"), OneHotEncoder(inputCols=[f"{c}_ix" for c in categories], outputCols=[f"{c}_oh" for c in categories])]
    if filled:
        stages.append(Imputer(inputCols=filled, outputCols=[f"{c}_im" for c in filled], strategy="median"))
    stages += [
        VectorAssembler(inputCols=[f"{c}_im" for c in filled] + list(constants), outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True),
        VectorAssembler(inputCols=["scaled"] + [f"{c}_oh" for c in categories], outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="label", regParam=regularisation, standardization=False, maxIter=200),
    ]
    return Pipeline(stages=stages)


def prepared(df: DataFrame, categories: list[str], numbers: list[str], constants: dict[str, float]) -> DataFrame:
    return df.fillna("UNKNOWN", categories).fillna(constants).withColumns({c: F.col(c).cast("double") for c in numbers})


def train_and_score(rows: DataFrame, train, categories: list[str], numbers: list[str], constants: dict[str, float], c: float = 0.5):
    """(fitted on the training rows, all rows with ``proba``). ``c``: inverse strength of the L2 penalty."""
    from pyspark.ml.functions import vector_to_array

    x = prepared(rows, categories, numbers, constants)
    known = x.where(F.col("label").isNotNull() & train)
    fitted = pipeline(categories, numbers, constants, 1.0 / (c * max(1, known.count()))).fit(known)
    return fitted, fitted.transform(x).withColumn("proba", vector_to_array("probability")[1])


def refit_and_rank(rows: DataFrame, categories: list[str], numbers: list[str], constants: dict[str, float], key: str, version: str, share: float = 0.1, c: float = 0.5):
    """(model fitted on all labelled rows, all rows with key, proba, rank, review and model_version): what goes to reviewers after the test."""
    fitted, scored = train_and_score(rows, F.lit(True), categories, numbers, constants, c)
    return fitted, rank_scores(scored.select(key, "proba"), "proba", key, share).withColumn("model_version", F.lit(version))


def _cuts(df: DataFrame, column: str) -> list[float]:
    """Distinct quantiles of a number, about one a shuffle partition."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sorted(set(df.select(F.col(column).cast("double").alias("x")).approxQuantile("x", [i / n for i in range(1, n)], 0.2 / n))) if n > 1 else []


def _key_cuts(df: DataFrame, key: str) -> list:
    """Values that cut a key of any order into ranges of about equal size, from a bounded sample; they only balance tasks."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, 100 * n / max(1, df.count()))
    some = sorted(r[0] for r in df.select(key).where(F.col(key).isNotNull() & (F.pmod(F.xxhash64(key), F.lit(1 << 20)) < (1 << 20) * share)).limit(1000 * n).collect())
    return sorted({some[i * len(some) // n] for i in range(1, n)}) if some else []


def _range(column, cuts: list[float]):
    """(range, whether it is of one value): numbers equal to a cut are ranges of their own, odd ones; the others lie between. Nulls come lowest."""
    x, points = F.col(column).cast("double"), F.array(*[F.lit(c) for c in cuts]).cast("array<double>")
    below, on = F.size(F.filter(points, lambda c: c < x)), F.array_contains(points, x)
    return F.when(x.isNull(), -1).otherwise(2 * below + F.coalesce(on, F.lit(False)).cast("int")), F.coalesce(on, F.lit(False))


def ranked(df: DataFrame, score: str, key: str) -> DataFrame:
    """``df`` with its global ``rank``: descending by score (a number), ties by key (distinct).

    Scores are cut into ranges, and a score with very many rows into ranges of keys; rows are ranked within a range, after
    the number of rows in better ranges. Only the ranges' counts meet in one task.
    """
    df = written(df)
    part, single = _range(score, _cuts(df, score))
    points = _key_cuts(df, key)
    sub = F.size(F.filter(F.array(*[F.lit(c) for c in points]), lambda c: c <= F.col(key))) if points else F.lit(0)
    dealt = df.withColumn("_part", part).withColumn("_sub", F.when(single, sub).otherwise(0))
    size = dealt.groupBy("_part", "_sub").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(F.desc("_part"), "_sub").rowsBetween(Window.unboundedPreceding, -1)
    size = size.select("_part", "_sub", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_better"))  # a fixed number of ranges
    within = F.row_number().over(Window.partitionBy("_part", "_sub").orderBy(F.desc(score), key))
    return dealt.withColumn("_w", within).join(F.broadcast(size), ["_part", "_sub"]).withColumn("rank", (F.col("_w") + F.col("_better")).cast("bigint")).drop("_part", "_sub", "_w", "_better")


def rank_scores(df: DataFrame, score: str, key: str, share: float) -> DataFrame:
    """Global rank (descending, ties by key) and whether it is in the top share."""
    rows = ranked(df, score, key)
    n = rows.count()
    return rows.select(key, score, "rank").withColumn("review", F.col("rank") <= int(n * share))


def precision_at(df: DataFrame, label: str, score: str, key: str, share: float) -> DataFrame:
    """Share of the label among the best ``share`` of all rows, by global rank: no task holds them all."""
    rows = ranked(df, score, key)
    k = max(1, round(rows.count() * share))
    return rows.where(F.col("rank") <= k).agg(F.round(F.sum(label).cast("double") / F.count(F.lit(1)), 6).alias("precision_at_k"), F.count(F.lit(1)).alias("k"))


def ranking_quality(df: DataFrame, label: str, score: str) -> DataFrame:
    """ROC-AUC and average precision from counts by distinct score, cumulated within ranges of scores and over the ranges."""
    t = written(df.groupBy(score).agg(F.sum(label).cast("bigint").alias("p"), F.sum(1 - F.col(label)).cast("bigint").alias("n")))
    t = t.withColumn("_part", _range(score, _cuts(t, score))[0])
    totals = t.groupBy("_part").agg(F.sum("p").alias("_p"), F.sum("n").alias("_n"))
    over = lambda order: Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    totals = totals.select("_part", zero(F.sum("_n").over(over("_part"))).alias("_below"), *[zero(F.sum(x).over(over(F.desc("_part")))).alias(f"_above{x}") for x in ("_p", "_n")])  # a fixed number of ranges
    inside = Window.partitionBy("_part")
    down = inside.orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = t.join(F.broadcast(totals), "_part").withColumns({
        "below": F.col("_below") + zero(F.sum("n").over(inside.orderBy(score).rowsBetween(Window.unboundedPreceding, -1))),
        "tp": F.col("_above_p") + F.sum("p").over(down),
        "taken": F.col("_above_p") + F.col("_above_n") + F.sum(F.col("p") + F.col("n")).over(down),
    })
    return c.agg(
        F.round(F.sum(F.col("p") * (2 * F.col("below") + F.col("n"))).cast("double") / (2 * F.sum("p") * F.sum("n")).cast("double"), 6).alias("roc_auc"),
        F.round(F.sum(F.col("p").cast("double") * F.col("tp") / F.col("taken")) / F.sum("p").cast("double"), 6).alias("average_precision"),
    )


def permuted(df: DataFrame, column: str, key: str, seed: int, bucket_rows: int = 10_000) -> DataFrame:
    """``df`` with the values of ``column`` exchanged among rows: within random buckets, so that no task orders all rows. ``key`` is unique."""
    buckets = max(1, math.ceil(df.count() / bucket_rows))
    place = lambda salt: F.row_number().over(Window.partitionBy("_bucket").orderBy(F.xxhash64(key, F.lit(salt)), key))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(buckets)))
    given = dealt.select("_bucket", place(f"{seed} from").alias("_at"), column)
    return dealt.withColumn("_at", place(f"{seed} to")).drop(column).join(given, ["_bucket", "_at"]).select(df.columns)


def permutation_importance(fitted, rows: DataFrame, columns: list[str], label: str, key: str, repeats: int = 5, seed: int = 42) -> DataFrame:
    """(feature, importance, spread): mean and population deviation of the loss of ROC-AUC when a feature's values change places."""
    from pyspark.ml.functions import vector_to_array

    auc = lambda x: ranking_quality(fitted.transform(x).withColumn("proba", vector_to_array("probability")[1]), label, "proba").first()["roc_auc"]
    base, out = auc(rows), []
    for i, c in enumerate(columns):
        lost = [base - auc(permuted(rows, c, key, seed + i * repeats + r)) for r in range(repeats)]
        mean = sum(lost) / repeats
        out.append((c, mean, math.sqrt(sum((x - mean) ** 2 for x in lost) / repeats)))
    return rows.sparkSession.createDataFrame(out, "feature string, importance double, spread double")


def model_card(name: str, trained_on: int, tested_on: int, metrics: dict[str, float], importances: dict[str, float], day: str) -> str:
    """The model's card as JSON; ``day`` is part of the version tag and given by the caller."""
    ranked = sorted(importances.items(), key=lambda x: (-x[1], x[0]))
    return json.dumps({"name": name, "version": f"{name}-{day}", "trained_on": trained_on, "tested_on": tested_on, "metrics": metrics, "importances": [{"feature": f, "importance": v} for f, v in ranked]}, ensure_ascii=False, sort_keys=True)
