"""Assembly of zones: votes, fallbacks, scenarios, population vintages, instrumented zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyroad.sources.fixtures import SCENARIOS

#: Names of the vintage rules.
EXACT, LATER, EARLIER = "année", "plus proche après", "plus proche avant (aucun millésime plus récent n'existe)"


def cluster_votes(detail: DataFrame) -> DataFrame:
    """Cluster of most annualised traffic for each (year, zone); the smaller cluster wins a tie."""
    totals = detail.where("cluster is not null").groupBy("year", "zone", "cluster").agg(F.sum("qta").alias("qta"))
    return totals.groupBy("year", "zone").agg(F.max_by("cluster", F.struct(F.round("qta", 6), -F.col("cluster"))).alias("vote"))


def years_frame(spark: SparkSession, years: tuple[int, ...]) -> DataFrame:
    return spark.createDataFrame([(y,) for y in years], "year int")


def every_year(zones: DataFrame, years: tuple[int, ...]) -> DataFrame:
    """Each zone once a year: the years are a constant array of a bounded length."""
    return zones.withColumn("year", F.explode(F.array(*[F.lit(y) for y in years])))


def resolve_clusters(detail: DataFrame, zones: DataFrame, years: tuple[int, ...]) -> DataFrame:
    """(year, zone, cluster): the vote of the zone's sensors, else the earlier classification."""
    return every_year(zones.select("zone", "fallback"), years).join(cluster_votes(detail), ["year", "zone"], "left").select("year", "zone", F.coalesce("vote", "fallback").alias("cluster"))


def expand_cities(codes: DataFrame, members: DataFrame) -> DataFrame:
    """``codes`` (zone) and, of every city that has one of them, all districts. ``members``: any_code, district."""
    more = codes.join(members, codes["zone"] == members["any_code"]).select(F.col("district").alias("zone"))
    return codes.select("zone").unionByName(more).distinct()


def city_members(cities: list[tuple[list[str], list[str]]], spark: SparkSession) -> DataFrame:
    """(any_code, district) pairs of cities given as (districts, codes of the whole city)."""
    rows = [(code, d) for districts, parents in cities for code in [*districts, *parents] for d in districts]
    return spark.createDataFrame(rows, "any_code string, district string")


#: Districts and whole-city codes of the three cities that have districts.
DISTRICT_CITIES = [
    ([f"751{i:02d}" for i in range(1, 21)], ["75056", "75100", "00751"]),
    ([f"6938{i}" for i in range(1, 10)], ["69123", "69380"]),
    ([f"132{i:02d}" for i in range(1, 17)], ["13055", "13200", "01305"]),
]


def instrumented_zones(years: DataFrame) -> DataFrame:
    """Zones with an active sensor in any year."""
    return years.where("active and zone is not null").select("zone").distinct()


def unpivot_lengths(wide: DataFrame) -> DataFrame:
    """(year, zone, scenario, len_d, len_g) from one column pair for each scenario."""
    pairs = ", ".join(f"'{s}', len_d_{s}, len_g_{s}" for s in SCENARIOS)
    return wide.selectExpr("year", "zone", f"stack({len(SCENARIOS)}, {pairs}) as (scenario, len_d, len_g)")


def population_used(population: DataFrame, years: tuple[int, ...], vintages: tuple[int, ...]) -> DataFrame:
    """Vintage that serves each year, why, and its total: the year's own, else the nearest later, else the nearest earlier one."""
    spark = population.sparkSession
    rows = []
    for y in years:
        later, earlier = [v for v in vintages if v > y], [v for v in vintages if v < y]
        rows.append((y, y, EXACT) if y in vintages else (y, min(later), LATER) if later else (y, max(earlier), EARLIER))
    rule = spark.createDataFrame(rows, "year int, vintage int, rule string")
    totals = population.groupBy("vintage").agg(F.sum("population").alias("population"), F.count(F.lit(1)).alias("n_areas"))
    return F.broadcast(rule).join(totals, "vintage", "left").select("year", "vintage", "rule", F.coalesce("population", F.lit(0.0)).alias("population"), F.coalesce("n_areas", F.lit(0)).cast("long").alias("n_areas"))


def assembled_zones(zones: DataFrame, lengths: DataFrame, clusters: DataFrame, instrumented: DataFrame, years: tuple[int, ...]) -> DataFrame:
    """One row for each (year, zone) that has network in any scenario."""
    names = [f"len_{side}_{s}" for side in "dg" for s in SCENARIOS]
    flag = instrumented.withColumn("instrumented", F.lit(1))
    some = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return (
        every_year(zones.select("zone", "department"), years)
        .join(lengths, ["year", "zone"], "left")
        .fillna(0.0, subset=names)
        .where(some > 0)
        .join(clusters, ["year", "zone"], "left")
        .join(flag, "zone", "left")
        .withColumn("instrumented", F.coalesce("instrumented", F.lit(0)))
        .select("year", "zone", "department", "cluster", "instrumented", *names)
    )


def share_of_group(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Share of a value in its group's total."""
    return df.withColumn("share", F.try_divide(value, F.sum(value).over(Window.partitionBy(*keys))))


def mainland(df: DataFrame, department: str = "department") -> DataFrame:
    """Rows of the mainland departments, 01 to 95 as text."""
    return df.where(F.col(department).isin([f"{i:02d}" for i in range(1, 96)]))


def fill_counts(df: DataFrame, prefixes: tuple[str, ...], not_counts: tuple[str, ...] = ("taux", "voirie")) -> DataFrame:
    """Missing counts become 0 in columns of the given prefixes; rates and lengths, told by their names, stay missing."""
    names = [c for c in df.columns if c.startswith(prefixes) and not any(w in c for w in not_counts)]
    return df.fillna(0, subset=names) if names else df


def override(df: DataFrame, key: str, keys: list[str], values: dict[str, str]) -> DataFrame:
    """Constant values for the rows of some keys."""
    return df.withColumns({c: F.when(F.col(key).isin(keys), F.lit(v)).otherwise(F.col(c)) for c, v in values.items()})


def wide_zones(zones: DataFrame, parts: list[DataFrame], key: str = "zone") -> DataFrame:
    """Zones with the columns of every part, left-joined on the key in turn."""
    for part in parts:
        zones = zones.join(part, key, "left")
    return zones
