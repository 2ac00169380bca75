"""Constraints of tables, checked over all rows in one aggregate each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Constraints of the test tables, as (name, SQL condition).
CONSTRAINTS = {
    "part": (("size_positive", "p_size > 0"), ("price_not_negative", "p_retailprice >= 0"), ("brand_known", "p_brand is not null")),
    "lineitem": (("quantity_positive", "l_quantity > 0"), ("discount_share", "l_discount between 0 and 1"), ("flag_known", "l_returnflag in ('A', 'N', 'R')")),
    "customer": (("nation_in_range", "c_nationkey between 0 and 24"), ("balance_positive", "c_acctbal > 0")),
    "orders": (("price_positive", "o_totalprice > 0"), ("status_known", "o_orderstatus in ('F', 'O', 'P')")),
}
KEYS = {"part": "p_partkey", "customer": "c_custkey", "orders": "o_orderkey"}


def violations(df: DataFrame, table: str, constraints: tuple[tuple[str, str], ...], key: str | None = None) -> DataFrame:
    """(table, constraint, n_rows, n_bad): a null condition counts as bad; ``unique`` counts repeated keys."""
    aggregates = [F.count_if(~F.coalesce(F.expr(c), F.lit(False))).alias(f"c{i}") for i, (_, c) in enumerate(constraints)]
    if key:
        aggregates.append((F.count(F.lit(1)) - F.countDistinct(key)).alias(f"c{len(constraints)}"))
    names = [n for n, _ in constraints] + (["unique"] if key else [])
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *aggregates)
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("constraint"), F.col(f"c{i}").alias("n_bad")) for i, n in enumerate(names)]))
    return one.select("n_rows", rows.alias("r")).select(F.lit(table).alias("table"), "r.constraint", "n_rows", "r.n_bad")


def require(df: DataFrame, constraints: tuple[tuple[str, str], ...], key: str | None = None) -> DataFrame:
    """Raise ValueError if any row breaks a constraint, else return the table."""
    bad = [r for r in violations(df, "table", constraints, key).collect() if r["n_bad"]]
    if bad:
        raise ValueError("; ".join(f"{r['constraint']}: {r['n_bad']} of {r['n_rows']} rows" for r in bad))
    return df


def integrity_report(spark: SparkSession, sf: str) -> DataFrame:
    out = None
    for name, constraints in CONSTRAINTS.items():
        part = violations(spark.read.parquet(f"{sf}/{name}.parquet"), name, constraints, KEYS.get(name))
        out = part if out is None else out.unionByName(part)
    return out


INTEGRITY_SQL = " UNION ALL ".join(
    [f"SELECT '{t}' AS \"table\", '{n}' AS \"constraint\", count(*) AS n_rows, count(*) FILTER (WHERE NOT coalesce({c}, false)) AS n_bad FROM {t}" for t, cs in CONSTRAINTS.items() for n, c in cs]
    + [f"SELECT '{t}', 'unique', count(*), count(*) - count(DISTINCT {k}) FROM {t}" for t, k in KEYS.items()]
)


def differences(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that only one of two tables has, and which one."""
    only = lambda x, y, side: x.select(*keys).distinct().join(y.select(*keys).distinct(), keys, "left_anti").withColumn("only_in", F.lit(side))
    return only(a, b, "a").unionByName(only(b, a, "b"))
