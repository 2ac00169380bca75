"""Observed and extrapolated distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CLUSTERS = (0, 1, 2, 3)
#: Names of the usage clusters and share trimmed at each end of their rates.
CLUSTER_NAMES = {0: "Péri-urbain loisirs", 1: "Domicile travail", 2: "Tourisme aménagé", 3: "Tourisme rural"}
TRIMS = {0: 0.34, 1: 0.46, 2: 0.48, 3: 0.40}
LEAST, RATE_DIGITS = 5, 6


def observed_km(zones: DataFrame, detail: DataFrame, scenario: str = "ALL") -> DataFrame:
    """(year, zone, cluster) rows: length attributed by traffic, mean annualised traffic and observed distance.

    A zone without active labelled sensors in a year has one row with its whole length on its own cluster.
    Sensors in zones that have no row keep null lengths, and their traffic is not observed anywhere.
    """
    base = zones.withColumn("total_length_km", F.col(f"len_d_{scenario}") + F.col(f"len_g_{scenario}")).select("year", "zone", "department", "instrumented", F.col("cluster").alias("own_cluster"), "total_length_km")
    per = detail.where("cluster is not null").groupBy("year", "zone", "cluster").agg(F.avg("qta").alias("qta_mean"), F.countDistinct("id_site").alias("n_sensors"))
    per = per.withColumn("share", F.try_divide(F.col("qta_mean") * F.col("n_sensors"), F.sum(F.col("qta_mean") * F.col("n_sensors")).over(Window.partitionBy("year", "zone"))))
    measured = per.join(base, ["year", "zone"], "left").withColumn("length_km", F.col("total_length_km") * F.col("share")).withColumn("km_obs", F.col("qta_mean") * F.col("length_km"))
    rest = base.join(per.select("year", "zone").distinct(), ["year", "zone"], "left_anti").select(
        "year", "zone", "department", "instrumented", F.col("own_cluster").alias("cluster"), "total_length_km", F.lit(1.0).alias("share"), F.col("total_length_km").alias("length_km"), F.lit(0).cast("long").alias("n_sensors"), F.lit(0.0).alias("qta_mean"), F.lit(0.0).alias("km_obs")
    )
    return measured.select(*rest.columns).unionByName(rest)


def complete(km: str = "km_obs", instrumented: bool = True) -> Column:
    """Rows that count as observed: positive length and distance, in an instrumented zone if asked."""
    out = (F.col("length_km") > 0) & (F.col(km) > 0)
    return out & (F.col("instrumented") == 1) if instrumented else out


def rate_of(km: str = "km_obs") -> Column:
    """Distance to a km of network, to RATE_DIGITS digits, so that equal rates compare equal whatever the order of sums."""
    return F.round(F.try_divide(km, F.col("length_km")), RATE_DIGITS)


def trims() -> Column:
    out = F.when(F.col("cluster") == 0, TRIMS[0])
    for c in CLUSTERS[1:]:
        out = out.when(F.col("cluster") == c, TRIMS[c])
    return out


def trimmed_rates(rates: DataFrame, keys: list[str]) -> DataFrame:
    """Trimmed mean of ``rate`` for each key (which includes cluster): two exact aggregates, no collected groups.

    The quantiles of all trims are taken in one aggregate and the cluster's pair is chosen, then the rates
    between them are averaged; under LEAST rates the median.
    """
    points = sorted({p for t in TRIMS.values() for p in (t, 1 - t)})
    bounds = rates.groupBy(*keys).agg(F.count("rate").alias("n"), F.percentile("rate", F.array(*[F.lit(p) for p in points])).alias("q"), F.percentile("rate", F.lit(0.5)).alias("median"))
    pick = lambda low: F.coalesce(*[F.when(F.col("cluster") == c, F.col("q")[points.index(t if low else 1 - t)]) for c, t in TRIMS.items()])
    bounds = bounds.select(*keys, "n", "median", F.round(pick(True), RATE_DIGITS).alias("low"), F.round(pick(False), RATE_DIGITS).alias("high"))
    kept = rates.join(bounds, keys).groupBy(*keys).agg(F.first("n").alias("n"), F.first("median").alias("median"), F.avg(F.when(F.col("rate").between(F.col("low"), F.col("high")), F.col("rate"))).alias("mean"))
    return kept.select(*keys, "n", F.when(F.col("n") < LEAST, F.col("median")).otherwise(F.coalesce("mean", F.lit(0.0))).alias("rate"))


def scaffold(years: tuple[int, ...], df: DataFrame) -> DataFrame:
    """Every (year, cluster), bounded constants."""
    return df.sparkSession.createDataFrame([(y, c, CLUSTER_NAMES[c]) for y in years for c in CLUSTERS], "year int, cluster int, cluster_name string")


def extrapolated_detail(observed: DataFrame, years: tuple[int, ...], km: str = "km_obs", instrumented: bool = True) -> DataFrame:
    """(year, cluster): observed distance plus the trimmed rate on the length without observation, zeros where empty."""
    rows = observed.where("cluster is not null")
    ok = complete(km, instrumented)
    frames = rows.groupBy("year", "cluster").agg(F.count_if(ok).alias("n_active"), F.sum(F.when(ok, F.col("length_km"))).alias("l_obs"), F.sum("length_km").alias("l_total"), F.sum(F.when(ok, F.col(km))).alias("km_obs"))
    rates = trimmed_rates(rows.where(ok).select("year", "cluster", rate_of(km).alias("rate")), ["year", "cluster"]).drop("n")
    out = F.broadcast(scaffold(years, observed)).join(frames, ["year", "cluster"], "left").join(rates, ["year", "cluster"], "left").fillna(0, subset=["n_active", "l_obs", "l_total", "km_obs", "rate"])
    return out.withColumn("km_ext", F.col("km_obs") + F.col("rate") * F.greatest(F.col("l_total") - F.col("l_obs"), F.lit(0.0)))


def national(detail: DataFrame) -> DataFrame:
    """Distance of all clusters by year, in billions of km."""
    return detail.groupBy("year").agg((F.sum("km_obs") / 1e9).alias("km_obs_bn"), (F.sum("km_ext") / 1e9).alias("km_ext_bn"))
