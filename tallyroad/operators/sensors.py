"""Sensor series: sums over a site's flows, sensor-years and their predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyroad.functions.scalars import YEAR_HOURS

SHARE, TOTAL = 0.05, 100.0


def site_hours(flow_hours: DataFrame) -> DataFrame:
    """Sum of a site's flows at each hour: null unless every flow of the site has a value there.

    ``flow_hours``: site, flow, hour_idx, value. Hours after the end of a site's shortest flow are dropped.
    """
    flows = flow_hours.groupBy("site", "flow").agg(F.max("hour_idx").alias("last"))
    sites = flows.groupBy("site").agg(F.count(F.lit(1)).alias("n_flows"), F.min("last").alias("last"))
    sums = flow_hours.groupBy("site", "hour_idx").agg(F.count("value").alias("n"), F.sum("value").alias("total"))
    return sums.join(sites, "site").where("hour_idx <= last").select("site", "hour_idx", F.when(F.col("n") == F.col("n_flows"), F.col("total")).alias("value"))


def sensor_years(flows: DataFrame, sensors: DataFrame, threshold: float = TOTAL) -> DataFrame:
    """Sensor-year table: annual flow, annualised traffic, share of active slots, validity and activity.

    The share's denominator is the longest series of the year, a table of one row a year that is joined back.
    """
    own = flows.join(sensors, "id_site")
    longest = own.groupBy("year").agg(F.max("active_slots").alias("longest"))
    return (
        own.join(F.broadcast(longest), "year")  # a row a year
        .withColumn("qta", F.coalesce(F.try_divide("annual_flow", F.col("n_valid_h")) * YEAR_HOURS, F.lit(0.0)))
        .withColumn("activity_share", F.try_divide("active_slots", F.col("longest")))
        .withColumn("valid", F.col("qta") > 0)
        .withColumn("active", (F.col("activity_share") > SHARE) & (F.col("annual_flow") > threshold))
        .select("id_site", "site_name", "zone", "department", "cluster", "year", "annual_flow", "n_valid_h", "qta", "activity_share", "valid", "active")
    )


def active_detail(years: DataFrame) -> DataFrame:
    """Active sensor-years with their cluster, unlabelled ones kept with a null."""
    return years.where("active").drop("activity_share", "valid", "active")


def balanced_panel(detail: DataFrame, years: tuple[int, ...]) -> DataFrame:
    """Sensors present in every year."""
    return detail.groupBy("id_site").agg(F.countDistinct("year").alias("n")).where(F.col("n") == len(years)).select("id_site")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by a total order; keys with very many rows aggregate before they are shuffled."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("row")).select(*keys, "row.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("row")).select(*keys, "row.*").select(*df.columns)


def top_n(df: DataFrame, order: list, n: int) -> DataFrame:
    """Top-N report; the limit is the feature."""
    return df.orderBy(*order).limit(n)


def inverse_frequency(df: DataFrame, key: str) -> DataFrame:
    """Weight 1 / size of the key's group."""
    return df.withColumn("weight", 1.0 / F.count(F.lit(1)).over(Window.partitionBy(key)))


def densest_member(members: DataFrame) -> DataFrame:
    """Member of each group with the greatest density, core members before others, the smaller code of equals. ``members``: grp, code, core, density."""
    return members.groupBy("grp").agg(F.min_by("code", F.struct((~F.col("core")).alias("outside"), (-F.col("density")).alias("d"), "code")).alias("code"))


def nested_records(series: DataFrame) -> DataFrame:
    """One record a site: a map from year to its hourly values in order, and one to its flows. ``series``: site, flow, year, hour_idx, value."""
    hours = series.groupBy("site", "year", "hour_idx").agg(F.when(F.count("value") == F.count(F.lit(1)), F.sum("value")).alias("value"))
    years = hours.groupBy("site", "year").agg(F.transform(F.array_sort(F.collect_list(F.struct("hour_idx", "value"))), lambda x: x["value"]).alias("values"))
    flows = series.groupBy("site", "year").agg(F.array_sort(F.collect_set("flow")).alias("flows"))
    return years.join(flows, ["site", "year"]).groupBy("site").agg(F.map_from_entries(F.collect_list(F.struct("year", "values"))).alias("values"), F.map_from_entries(F.collect_list(F.struct("year", "flows"))).alias("flows"))
