"""Multi-scale usage profiles of hourly series."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroad.functions.scalars import hour_of_week, week_index

DAY, WEEK, YEAR = 24, 168, 52
#: Periods in hours whose share of spectral energy is a feature.
PERIODS = (12, 24, 168, 8760)


def hour_grid(sites: DataFrame, start: Column, hours: int) -> DataFrame:
    """Each site's full hour grid: hour_idx and timestamp from a start."""
    return sites.select("site", F.explode(F.sequence(F.lit(0), F.lit(hours - 1))).alias("hour_idx")).withColumn("ts", F.timestamp_add("HOUR", F.col("hour_idx"), start))


def position_means(series: DataFrame, position: Column, size: int, name: str = "mean") -> DataFrame:
    """(site, pos, mean) over a series with missing hours as zero; positions from ``size`` on are left out."""
    return series.withColumn("pos", position.cast("int")).where(F.col("pos") < size).groupBy("site", "pos").agg((F.sum(F.coalesce("value", F.lit(0.0))) / F.count(F.lit(1))).alias(name))


def on_grid(hours: DataFrame, start: Column, length: int) -> DataFrame:
    """Series with every hour of the grid; hours without a row are null."""
    grid = hour_grid(hours.select("site").distinct(), start, length)
    return grid.join(hours, ["site", "hour_idx"], "left").select("site", "hour_idx", "ts", "value")


def daily(series: DataFrame) -> DataFrame:
    return position_means(series, F.hour("ts"), DAY)


def weekly(series: DataFrame) -> DataFrame:
    return position_means(series, hour_of_week(F.col("ts")), WEEK)


def annual(series: DataFrame, start: Column) -> DataFrame:
    return position_means(series, week_index(F.col("ts"), start), YEAR)


def as_array(means: DataFrame, size: int, name: str) -> DataFrame:
    """(site, array) in order of position; positions without hours are 0."""
    filled = means.groupBy("site").agg(F.map_from_entries(F.collect_list(F.struct("pos", "mean"))).alias("m"))
    return filled.select("site", F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.element_at("m", i), F.lit(0.0))).alias(name))


def unit_norm(values: Column) -> Column:
    """Array divided by its Euclidean norm; an array of zeros stays."""
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(values, lambda x: x / F.when(norm != 0, norm).otherwise(1.0))


def standardised(df: DataFrame, columns: list[str], eps: float = 1e-12) -> DataFrame:
    """Columns less their mean over their population deviation; constant columns become 0."""
    stats = df.agg(*[x for c in columns for x in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()
    scale = {c: max(stats[f"s_{c}"] or 0.0, eps) for c in columns}
    return df.select(*[c for c in df.columns if c not in columns], *[((F.col(c) - F.lit(stats[f"m_{c}"])) / F.lit(scale[c])).alias(c) for c in columns])


def spectral_features(values: np.ndarray) -> list[float]:
    """Energy shares of the frequencies nearest to the PERIODS, and the entropy of the spectrum; missing hours are zero."""
    x = np.nan_to_num(np.asarray(values, float))
    power = np.abs(np.fft.rfft(x - x.mean())) ** 2
    frequencies = np.fft.rfftfreq(len(x))
    share = power / (power.sum() + 1e-12)
    nearest = [int(np.abs(frequencies - 1 / p).argmin()) for p in PERIODS]
    return [*share[nearest].tolist(), float(-(share * np.log(share + 1e-12)).sum())]


def spectral(series: DataFrame) -> DataFrame:
    """(site, spectral): the transform needs a site's whole series, which the year's hours bound."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values("hour_idx")
        return pd.DataFrame({"site": [ordered["site"].iloc[0]], "spectral": [spectral_features(ordered["value"].to_numpy(float))]})

    return series.groupBy("site").applyInPandas(run, "site long, spectral array<double>")


def profiles(series: DataFrame, start: Column) -> DataFrame:
    """One row a site with the four blocks: 24, 168, 52 and 5 numbers."""
    return as_array(daily(series), DAY, "day").join(as_array(weekly(series), WEEK, "week"), "site").join(as_array(annual(series, start), YEAR, "year"), "site").join(spectral(series), "site")


def flat(df: DataFrame) -> DataFrame:
    """Arrays to 249 columns."""
    blocks = (("day", "d", DAY, 2), ("week", "h", WEEK, 3), ("year", "y", YEAR, 2), ("spectral", "s", 5, 1))
    return df.select("site", *[F.col(b)[i].alias(f"{p}{i:0{w}d}") for b, p, n, w in blocks for i in range(n)])


def from_flat(df: DataFrame) -> DataFrame:
    blocks = (("day", "d", DAY, 2), ("week", "h", WEEK, 3), ("year", "y", YEAR, 2), ("spectral", "s", 5, 1))
    return df.select("site", *[F.array(*[F.col(f"{p}{i:0{w}d}") for i in range(n)]).alias(b) for b, p, n, w in blocks])


def curves(arrays: DataFrame, labels: DataFrame, block: str) -> DataFrame:
    """(cluster, pos): mean and population deviation of unit-norm profiles."""
    rows = arrays.join(labels, "site").select("cluster", F.posexplode(unit_norm(F.col(block))).alias("pos", "value"))
    return rows.groupBy("cluster", "pos").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation"))
