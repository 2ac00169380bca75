"""Indicator tables, pivots and growth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyroad.functions.scalars import ratio
from tallyroad.operators.estimation import CLUSTERS, complete, extrapolated_detail, national
from tallyroad.operators.robustness import panel_km
from tallyroad.operators.sensors import balanced_panel
from tallyroad.sources.scratch import materialize


def pivot_by_cluster(df: DataFrame, value: str, how: str = "sum") -> DataFrame:
    """One column for each cluster by year; rows without a cluster are left out, a cluster that never occurs is 0."""
    rows = df.where("cluster is not null")
    column = F.sum(value) if how == "sum" else F.countDistinct(value)
    wide = rows.groupBy("year").pivot("cluster", list(CLUSTERS)).agg(column)
    return wide.select("year", *[F.col(str(c)).alias(f"cluster_{c}") for c in CLUSTERS])


def growth_factor(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each year's value over the year before; years are few, one row each."""
    w = Window.partitionBy(F.lit(0)).orderBy("year")
    return df.select("year", *[F.try_divide(F.col(c), F.lag(c).over(w)).alias(f"{c}_growth") for c in columns])


def index_base_100(df: DataFrame, columns: list[str]) -> DataFrame:
    w = Window.partitionBy(F.lit(0)).orderBy("year")
    return df.select("year", *[F.try_divide(F.col(c) * 100.0, F.first(c).over(w)).alias(f"{c}_index") for c in columns])


def ratio_by_cluster(a: DataFrame, b: DataFrame) -> DataFrame:
    """Ratio of two pivots, cluster by cluster, zero-safe."""
    x, y = a.alias("x"), b.alias("y")
    return x.join(y, "year").select("year", *[ratio(F.col(f"x.cluster_{c}"), F.col(f"y.cluster_{c}")).alias(f"cluster_{c}") for c in CLUSTERS])


def all_indicators(observed: DataFrame, detail: DataFrame, population: DataFrame, years: tuple[int, ...]) -> DataFrame:
    """One row a year: population, sensors, network length, flow, observed and extrapolated distance, also of the balanced panel."""
    panel = balanced_panel(detail, years)
    mini = materialize(panel_km(observed, detail, panel), "panel")
    sensors = detail.groupBy("year").agg(F.countDistinct("id_site").alias("n_sensors"), F.sum("annual_flow").alias("total_flow"))
    lengths = observed.groupBy("year").agg(F.sum("length_km").alias("length_km"), (F.sum(F.when(complete(), F.col("km_obs"))) / 1e9).alias("km_obs_bn"))
    standard = national(extrapolated_detail(observed, years, instrumented=False)).select("year", "km_ext_bn")
    mini_obs = mini.groupBy("year").agg((F.sum("km_panel") / 1e9).alias("km_panel_obs_bn"))
    mini_ext = national(extrapolated_detail(mini.drop("km_obs").withColumnRenamed("km_panel", "km_obs"), years, instrumented=False)).select("year", F.col("km_ext_bn").alias("km_panel_ext_bn"))
    size = panel.agg(F.count(F.lit(1)).alias("n_panel"))
    n_panel = size.withColumn("year", F.explode(F.array(*[F.lit(y) for y in years])))
    out = population.select("year", "population")
    for part in (sensors, n_panel, lengths, standard, mini_obs, mini_ext):
        out = out.join(part, "year", "left")
    return out


def with_total(wide: DataFrame, total: DataFrame | None = None) -> DataFrame:
    """A pivot with a total column: the sum of the clusters, or a supplied (year, total)."""
    if total is None:
        return wide.withColumn("total", sum((F.coalesce(F.col(f"cluster_{c}"), F.lit(0)) for c in CLUSTERS[1:]), F.coalesce(F.col(f"cluster_{CLUSTERS[0]}"), F.lit(0))))
    return wide.join(total, "year", "left")


def growth_table(by_cluster: DataFrame, total: DataFrame) -> DataFrame:
    """Growth ratios of all clusters and of the whole as rows of one table."""
    return by_cluster.select("transition", F.col("cluster").cast("string").alias("part"), "ratio_median", "low_95", "high_95").unionByName(total.select("transition", F.lit("all").alias("part"), "ratio_median", "low_95", "high_95"))
