"""Operators on tagged objects: vocabularies, lookups, lengths by commune and family."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroad.functions.scalars import count_present, direction_factor, principal_type, recode, tag_number
from tallyroad.sources.scratch import materialize

LEAST_USES, MOST_VALUES = 20, 250
#: Infrastructure types from best to least, those that are not dedicated, families, ranks of route networks.
HIERARCHY = [
    "VOIE VERTE",
    "PISTE CYCLABLE",
    "AMENAGEMENT MIXTE PIETON VELO HORS VOIE VERTE",
    "GOULOTTE",
    "BANDE CYCLABLE",
    "COULOIR BUS+VELO",
    "ACCOTEMENT REVETU HORS CVCB",
    "CHAUSSEE A VOIE CENTRALE BANALISEE",
    "DOUBLE SENS CYCLABLE PISTE",
    "DOUBLE SENS CYCLABLE BANDE",
    "DOUBLE SENS CYCLABLE NON MATERIALISE",
    "VELO RUE",
    "AUTRE",
    "AUCUN",
    "NON_RENSEIGNE",
]
NOT_DEDICATED = ["AUTRE", "AUCUN", "NON_RENSEIGNE"]
FAMILIES = {
    "PISTE CYCLABLE": "Piste cyclable",
    "VOIE VERTE": "Voie verte",
    "AMENAGEMENT MIXTE PIETON VELO HORS VOIE VERTE": "Aménagement mixte piéton-vélo",
    "BANDE CYCLABLE": "Bande cyclable",
    "COULOIR BUS+VELO": "Autre aménagement de chaussée",
    "ACCOTEMENT REVETU HORS CVCB": "Autre aménagement de chaussée",
    "CHAUSSEE A VOIE CENTRALE BANALISEE": "Autre aménagement de chaussée",
    "GOULOTTE": "Autre aménagement de chaussée",
    "DOUBLE SENS CYCLABLE PISTE": "Double sens cyclable / vélo-rue",
    "DOUBLE SENS CYCLABLE BANDE": "Double sens cyclable / vélo-rue",
    "DOUBLE SENS CYCLABLE NON MATERIALISE": "Double sens cyclable / vélo-rue",
    "VELO RUE": "Double sens cyclable / vélo-rue",
}
NETWORK_RANKS = {"lcn": 1, "rcn": 2, "ncn": 3, "icn": 4}
#: Tag keys that are read as numbers and under which name, and fallbacks of a side's tags.
NUMERIC = {"maxspeed": "maxspeed_num", "lanes": "lanes_num", "width": "width_num", "cycleway:width": "cw_width_num"}
SIDES = {
    "cw_right_eff": ["cycleway:right", "cycleway:both", "cycleway"],
    "cw_left_eff": ["cycleway:left", "cycleway:both", "cycleway"],
    "cw_lane_right_eff": ["cycleway:right:lane", "cycleway:both:lane", "cycleway:lane"],
    "cw_lane_left_eff": ["cycleway:left:lane", "cycleway:both:lane", "cycleway:lane"],
}
WIDTHS = ["cycleway:width", "cycleway:right:width", "cycleway:left:width", "cycleway:both:width"]
CYCLE_PREFIXES = ("cycleway", "bicycle", "oneway:bicycle", "cyclestreet")


def value_counts(tags: DataFrame) -> DataFrame:
    """(key, value, n) of a (key, value) table."""
    return tags.where("value is not null").groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))


def key_usage(tags: DataFrame, column: str = "tags") -> DataFrame:
    """How many rows use each key of a map column."""
    return tags.select(F.explode(F.map_keys(column)).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def vocabulary(tags: DataFrame, least: int = LEAST_USES, most: int = MOST_VALUES) -> DataFrame:
    """Frequent values of each key, ranked: those with ``least`` uses, at most ``most`` of a key (the feature's limit)."""
    w = Window.partitionBy("key").orderBy(F.desc("n"), "value")
    return value_counts(tags).where(F.col("n") >= least).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def recoded(df: DataFrame, vocab: dict[str, list[str]]) -> DataFrame:
    return reduce(lambda d, kv: d.withColumn(kv[0], recode(F.col(kv[0]), kv[1])), vocab.items(), df)


def lookup_baseline(df: DataFrame, keys: list[str], label: str, train: Column, default: str) -> DataFrame:
    """Most frequent label of each key combination among training rows (the smaller of equals), ``default`` for unseen ones."""
    counts = df.where(train).groupBy(*keys, F.col(label).alias("guess")).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(*keys).agg(F.min_by("guess", F.struct((-F.col("n")).alias("n"), "guess")).alias("guess"))
    same = reduce(lambda a, b: a & b, [F.col(f"d.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    return df.where(~train).alias("d").join(best.alias("b"), same, "left").select("d.*", F.coalesce("b.guess", F.lit(default)).alias("guess"))


def route_ranks(members: DataFrame, ways: DataFrame) -> DataFrame:
    """Highest network rank and number of routes of each way; -1 and 0 without routes. ``members``: way, network."""
    rank = F.coalesce(*[F.when(F.col("network") == k, v) for k, v in NETWORK_RANKS.items()], F.lit(0))
    found = members.groupBy("way").agg(F.max(rank).alias("rank"), F.count(F.lit(1)).alias("n_routes"))
    return ways.join(found, "way", "left").select(*ways.columns, F.coalesce("rank", F.lit(-1)).alias("rank"), F.coalesce("n_routes", F.lit(0)).cast("long").alias("n_routes"))


def effective_lengths(pieces: DataFrame, alpha: float = 2.0) -> DataFrame:
    """Length by zone with lanes open in both directions counted ``alpha`` times; dedicated ones beside. ``pieces``: zone, side, km, direction, type."""
    km = F.col("km") * direction_factor(F.col("direction"), alpha)
    dedicated = ~F.col("type").isin(NOT_DEDICATED)
    total = lambda cond: F.coalesce(F.sum(F.when(cond, km)), F.lit(0.0))
    return pieces.groupBy("zone").agg(total(F.col("side") == "d").alias("len_d"), total(F.col("side") == "g").alias("len_g"), total((F.col("side") == "d") & dedicated).alias("len_d_dedicated"), total((F.col("side") == "g") & dedicated).alias("len_g_dedicated"))


def two_sided_lengths(segments: DataFrame) -> DataFrame:
    """Right and left lengths by zone when the sides may lie in different zones: one union and one sum instead of an outer join."""
    both = segments.selectExpr("stack(2, zone_d, km_d, 0.0D, zone_g, 0.0D, km_g) as (zone, km_d, km_g)").where("zone is not null")
    return both.groupBy("zone").agg(F.sum(F.coalesce("km_d", F.lit(0.0))).alias("len_d"), F.sum(F.coalesce("km_g", F.lit(0.0))).alias("len_g"))


def principal_types(df: DataFrame, right: str, left: str) -> DataFrame:
    kind = principal_type(F.col(right), F.col(left), HIERARCHY)
    return df.withColumn("principal", kind).withColumn("dedicated", F.coalesce(~F.col("principal").isin(NOT_DEDICATED), F.lit(False)))


def family_of(kind: Column) -> Column:
    """Family of a dedicated type; null for types that are not dedicated."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in FAMILIES.items() for x in kv]), kind)


def family_shares(df: DataFrame, family: Column, length: str) -> DataFrame:
    """Number, length and share of each family; rows without one are left out, families are a fixed few."""
    sums = df.withColumn("family", family).where("family is not null").groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.sum(length).alias("km"))
    return sums.withColumn("share", F.try_divide("km", F.sum("km").over(Window.partitionBy(F.lit(0)))))


def way_totals(pieces: DataFrame, ways: DataFrame) -> DataFrame:
    """Length inside the zones, number of zones and length outside of each way; outside is never negative."""
    inside = pieces.groupBy("way").agg(F.sum("km").alias("inside_km"), F.countDistinct("zone").alias("n_zones"))
    return ways.join(inside, "way", "left").select("way", F.coalesce("inside_km", F.lit(0.0)).alias("inside_km"), F.coalesce("n_zones", F.lit(0)).cast("long").alias("n_zones"), F.greatest(F.col("km") - F.coalesce("inside_km", F.lit(0.0)), F.lit(0.0)).alias("outside_km"))


def run_statistics(pieces: DataFrame) -> DataFrame:
    """One row of control figures: both counts are named, candidates and kept."""
    return pieces.agg(F.count(F.lit(1)).alias("n_candidates"), F.count_if(F.col("km") > 0).alias("n_kept"), F.sum("km").alias("km"), F.countDistinct("zone").alias("n_zones"))


def confusion(df: DataFrame, truth: Column, guess: Column) -> DataFrame:
    """Counts, precision, recall and F1 in one pass."""
    t, g = F.coalesce(truth, F.lit(False)), F.coalesce(guess, F.lit(False))
    c = df.agg(F.count_if(t & g).alias("tp"), F.count_if(~t & g).alias("fp"), F.count_if(t & ~g).alias("fn"), F.count_if(~t & ~g).alias("tn"))
    p = F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1))
    r = F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1))
    return c.select("*", p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"))


def feature_row(df: DataFrame, keys: list[str], vocab: dict[str, list[str]]) -> DataFrame:
    """Features from a map column ``tags``: every key recoded to its vocabulary, the numbers of some, the first present
    tag of each side, the first present cycleway width, and how many cycle keys are set. Colons become two underscores."""
    raw = {k: F.element_at("tags", F.lit(k)) for k in keys}
    coded = {k: recode(v, vocab.get(k, [])) for k, v in raw.items()}
    number = lambda k: tag_number(F.when(coded[k] != "(autre)", coded[k])) if k in coded else F.lit(None).cast("double")
    first = lambda names: F.coalesce(*[coded[k] for k in names if k in coded], F.lit(None).cast("string"))
    cycle = [raw[k] for k in keys if k.startswith(CYCLE_PREFIXES)]
    return df.select(
        *[c for c in df.columns if c != "tags"],
        *[c.alias(k.replace(":", "__")) for k, c in coded.items()],
        *[number(k).alias(n) for k, n in NUMERIC.items()],
        *[first(names).alias(n) for n, names in SIDES.items()],
        F.coalesce(*[number(k) for k in WIDTHS]).alias("cw_width_eff"),
        (count_present(*cycle) if cycle else F.lit(0)).alias("n_cycle_keys"),
    )


def offsets(df: DataFrame, key: str, size: str) -> DataFrame:
    """Add ``offset``: the sum of ``size`` over all rows with a smaller unique key. Ranges of the sorted key are summed first, so no task runs over the whole table."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(df.repartitionByRange(parts, key).withColumn("part", F.spark_partition_id()), "offsets")
    sums = dealt.groupBy("part").agg(F.sum(size).alias("held"))  # a row a range
    before = sums.select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("before"))
    inside = F.sum(size).over(Window.partitionBy("part").orderBy(key)) - F.col(size)
    return dealt.withColumn("inside", inside).join(before, "part").select(*df.columns, (F.col("before") + F.col("inside")).alias("offset"))
