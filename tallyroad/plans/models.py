"""Queries of the learning operators. They have no SQL: fits and draws can't be stated in it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroad.functions import scalars as C
from tallyroad.operators import learning as L
from tallyroad.operators import profiles
from tallyroad.plans.extra import site_series
from tallyroad.sources.fixtures import table
from tallyroad.sources.scratch import materialize


def _weekly(spark: SparkSession, sf: str):
    arrays = profiles.as_array(profiles.weekly(site_series(spark, sf)), profiles.WEEK, "week")
    rows, metric = L.representation(arrays, ("week",))
    return materialize(rows, "weekly"), metric


def funfem_assign(spark: SparkSession, sf: str) -> DataFrame:
    rows, metric = _weekly(spark, sf)
    return L.assign(rows, L.fit_mixture(rows, metric, 2, "AkBk", 42, 15))


def seed_search(spark: SparkSession, sf: str) -> DataFrame:
    """All twelve covariance models with two and three clusters and two seeds, the best three fitted to the end."""
    rows, metric = _weekly(spark, sf)
    found = L.search(rows, metric, (2, 3), L.MODELS, (1, 2), maxit=10, refit=3)
    return spark.createDataFrame([(i, *r.values()) for i, r in enumerate(found)], "rank int, k int, model string, seed int, loglik double, bic double, aic double, icl double")


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").withColumn("half", F.col("c_custkey") % 2).withColumn("weight", F.lit(1.0))
    return L.group_folds(c, "c_nationkey").withColumn("nation", F.col("c_nationkey").cast("double"))


def forest_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Classes by a balanced forest of all rows, and out of fold by forests that haven't seen the row's nation."""
    c = _customers(spark, sf)
    fit = lambda rows: L.fit_forest(rows.withColumn("weight", L.balanced_weight("c_mktsegment", F.col("weight"))), ["c_acctbal", "nation"], "c_mktsegment", "weight", trees=10)
    apart = [L.predict_classes(fit(c.where(F.col("fold") != k)), c.where(F.col("fold") == k), ["c_custkey"], F.lit(True)).select("c_custkey", F.col("predicted").alias("out_of_fold")) for k in range(5)]
    whole = L.predict_classes(fit(c), c, ["c_custkey"], F.col("c_mktsegment").isNotNull())
    return whole.join(reduce(DataFrame.unionByName, apart), "c_custkey", "left")


def forest_search(spark: SparkSession, sf: str) -> DataFrame:
    """Balanced accuracy of forty drawn parameter sets over five grouped folds."""
    tried = L.drawn_parameters()
    fitted = L.tuned_forest(_customers(spark, sf), ["c_acctbal", "nation"], "c_mktsegment", "weight", tried, trees=3, parallelism=8)
    rows = [(k, one["maxDepth"], one["minInstancesPerNode"], one["featureSubsetStrategy"], float(score)) for k, (one, score) in enumerate(zip(tried, fitted.avgMetrics, strict=True))]
    return spark.createDataFrame(rows, "draw int, depth int, leaf int, features string, balanced_accuracy double")


#: Attributes of a part that are learnt, the two that are tuned, and the key of each one's lookup baseline.
TARGETS = ("kind", "maker", "brand", "shape", "tone", "ending", "band", "large", "decade", "cents")
TUNED = ("kind", "maker")


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    price, size = F.col("p_retailprice"), F.col("p_size")
    number = lambda c: F.floor(c).cast("string")
    return table(spark, sf, "part").select(
        "p_partkey", "p_brand", "p_type", size.cast("double").alias("size"), price.alias("price"), (F.col("p_partkey") % 7).cast("double").alias("line"), C.fold_of(F.col("p_partkey")).alias("fold"), F.lit(1.0).alias("weight"),
        F.get(F.split("p_type", " "), F.lit(0)).alias("kind"), F.substring("p_brand", 7, 1).alias("maker"), F.col("p_brand").alias("brand"), F.substring("p_brand", 8, 1).alias("shape"), F.substring("p_name", 1, 1).alias("tone"), F.right("p_name", F.lit(1)).alias("ending"),
        number(price / 200).alias("band"), (size > 35).cast("int").cast("string").alias("large"), number(size / 10).alias("decade"), number(F.round(price * 100) % 5).alias("cents"),
    )


def inclusion_model(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    parts = _parts(spark, sf)
    parts = parts.withColumn("large", F.col("large").cast("int"))
    model = L.fit_inclusion(parts.where("fold >= 2"), ["size", "price"], "large")
    scored = model.transform(parts).withColumn("p", vector_to_array("probability")[1])
    best = L.best_threshold(scored.where("fold = 1"), "large", "p").first()
    return scored.select("p_partkey", "p", (F.col("p") >= 0.02).alias("candidate"), (F.col("p") >= F.lit(best["threshold"] if best else 0.5)).alias("included"))


def _attributes(spark: SparkSession, sf: str) -> DataFrame:
    """All parts with the prediction of every target: two targets tuned, their parameters shared by the others."""
    parts = materialize(_parts(spark, sf), "parts")
    some = [t for t in TARGETS if parts.where("fold >= 2").where(F.col(t).isNotNull()).select(t).distinct().limit(2).count() > 1]  # what has one value needs no model
    models, _ = L.fit_attributes(parts, ["size", "price", "line"], some, [t for t in TUNED if t in some], [{"maxDepth": 3, "minInstancesPerNode": 5}, {"maxDepth": 6, "minInstancesPerNode": 8}], "weight", trees=5)
    return parts.join(L.score_attributes(models, parts, ["p_partkey"]), "p_partkey")


def attribute_models(spark: SparkSession, sf: str) -> DataFrame:
    scored = _attributes(spark, sf)
    return scored.select("p_partkey", "fold", *[c for c in scored.columns if c.startswith(("pred_", "conf_"))])


def attribute_report(spark: SparkSession, sf: str) -> DataFrame:
    scored = materialize(_attributes(spark, sf), "attributes")
    found = L.attribute_report(scored, {t: ["line", "size"] if t in TUNED else ["size"] for t in TARGETS if f"pred_{t}" in scored.columns})
    return spark.createDataFrame([tuple(r.values()) for r in found], "target string, n_holdout long, n_train long, n_classes int, accuracy double, balanced_accuracy double, macro_f1 double, weighted_f1 double, cohen_kappa double, baseline_majority double, baseline_lookup double")


def queries():
    return {f.__name__: f for f in (funfem_assign, seed_search, forest_predict, forest_search, inclusion_model, attribute_models, attribute_report)}
