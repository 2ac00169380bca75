"""Domain tables made from the star-schema test tables.

Parts whose key divides by three are sensors, (brand, size) is a zone, the part type gives
the usage cluster, line items give a sensor's flow and a zone's network length by year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

YEARS = tuple(range(1995, 2002))
VINTAGES = tuple(range(1995, 2000))
SCENARIOS = ("PARTIAL", "ALL", "DEDICATED")
#: Cluster of a part type; other types have none.
TYPE_CLUSTERS = {"ECONOMY": 0, "SMALL": 1, "MEDIUM": 2, "PROMO": 3}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def zone_of() -> Column:
    return F.concat("p_brand", F.lit("/"), F.lpad(F.col("p_size").cast("string"), 2, "0"))


def cluster_of() -> Column:
    kind = F.split("p_type", " ")[0]
    out = F.when(kind == "ECONOMY", 0)
    for name, code in list(TYPE_CLUSTERS.items())[1:]:
        out = out.when(kind == name, code)
    return out


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id_site, site_name, zone, department and cluster (null where unlabelled)."""
    return table(spark, sf_dir, "part").where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("id_site"), F.col("p_name").alias("site_name"), zone_of().alias("zone"), F.col("p_brand").alias("department"), cluster_of().alias("cluster"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """zone, department and the fallback cluster of an earlier classification."""
    return table(spark, sf_dir, "part").groupBy(zone_of().alias("zone")).agg(F.min("p_brand").alias("department"), (F.min("p_size") % 4).cast("int").alias("fallback"))


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id_site, year) totals of every part's line items, before the sensors are known."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("id_site"), F.year("l_shipdate").alias("year"))
        .agg(F.sum("l_quantity").alias("annual_flow"), F.count("l_quantity").alias("n_valid_h"), F.countDistinct(F.to_date("l_shipdate")).alias("active_slots"))
    )


def lengths_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(year, zone) network lengths in km, right (d) and left (g) side, one column pair for each scenario."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    cut = {"PARTIAL": F.col("l_returnflag") == "N", "ALL": F.lit(True), "DEDICATED": F.col("l_returnflag").isin("A", "R")}
    # summed by part before the zones are joined
    sums = [F.sum(F.when(cut[s] & (F.col("l_linestatus") == status), price).otherwise(F.lit(0).cast("decimal(18,2)"))).alias(f"len_{side}_{s}") for side, status in (("d", "F"), ("g", "O")) for s in SCENARIOS]
    by_part = table(spark, sf_dir, "lineitem").groupBy("l_partkey", F.year("l_shipdate").alias("year")).agg(*sums)
    part = table(spark, sf_dir, "part").select("p_partkey", zone_of().alias("zone"))
    names = [f"len_{side}_{s}" for side in "dg" for s in SCENARIOS]
    return by_part.join(part, by_part["l_partkey"] == part["p_partkey"]).groupBy("year", "zone").agg(*[(F.sum(n).cast("double") / 10000.0).alias(n) for n in names])


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vintage, area) population for the published vintages only."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    by_customer = orders.groupBy("o_custkey", F.year("o_orderdate").alias("vintage")).agg(F.count(F.lit(1)).alias("n")).where(F.col("vintage").isin(*VINTAGES))
    return by_customer.join(customer, by_customer["o_custkey"] == customer["c_custkey"]).groupBy("vintage", F.col("c_nationkey").alias("area")).agg((F.sum("n") * 1000.0).alias("population"))
