"""Trim selection, bootstrap intervals, growth tests, balanced-panel estimates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyroad.operators.estimation import CLUSTERS, LEAST, TRIMS, complete, rate_of
from tallyroad.sources.scratch import materialize

DRAWS = 3000
GRID = tuple(round(0.02 * k, 2) for k in range(25))
#: Digits that errors of trims are compared at, so that the order of sums can't choose one.
ERROR_DIGITS = 3
#: Draws that share one copy of a frame's rates.
DRAWS_A_COPY = 100
#: Prime modulus and multipliers of the draws, the same in any engine: no product exceeds 63 bits.
PRIME, STEP_DRAW, STEP_SLOT, STEP_MIX = 2147483647, 16807, 69621, 39373


def draw_indexes(frame: int, draws: np.ndarray, n: int) -> np.ndarray:
    """(draws, n) indexes in 0..n-1 made from the numbers of the frame, the draw and the slot."""
    x = (frame % PRIME * 48271 + draws.astype(np.int64) * STEP_DRAW + 1) % PRIME
    base = (x * x + 5) % PRIME
    x = (base[:, None] + np.arange(n, dtype=np.int64) * STEP_SLOT) % PRIME
    x = ((x * x + 7) % PRIME * STEP_MIX + 11) % PRIME
    return np.floor((x * x + 13) % PRIME * n / PRIME).astype(np.int64)


def trimmed_means(samples: np.ndarray, trim: float, least: int = LEAST) -> np.ndarray:
    """Trimmed mean of each row: under ``least`` values their median, 0 for none; else the mean between the linear quantiles ``trim`` and 1 - ``trim``, both included."""
    s = np.sort(samples, axis=1)
    n = s.shape[1]
    if n == 0:
        return np.zeros(len(s))

    def quantile(p: float) -> np.ndarray:
        at = p * (n - 1)
        low = int(np.floor(at))
        return s[:, low] + (s[:, min(low + 1, n - 1)] - s[:, low]) * (at - low)

    if n < least:
        return quantile(0.5)
    inside = (s >= quantile(trim)[:, None]) & (s <= quantile(1 - trim)[:, None])
    return np.where(inside, s, 0.0).sum(axis=1) / np.maximum(inside.sum(axis=1), 1)


def _spread(frames: DataFrame, draws: int, keys: list[str]) -> DataFrame:
    """Frames with a row for each DRAWS_A_COPY draws (``copy``), dealt out: a copy of a frame travels once for all of them."""
    return frames.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit((draws - 1) // DRAWS_A_COPY)))).repartition(*keys, "copy")


def _resampled(arrays: list[str], draws: int):
    """Rows of (frame, cluster, copy, arrays) -> (number, draw, a trimmed mean for each array) under the same resampled slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, frames, clusters, copies = (batch.column(c).to_pylist() for c in ("number", "frame", "cluster", "copy"))
            for k in range(batch.num_rows):
                own = np.arange(copies[k] * DRAWS_A_COPY, min((copies[k] + 1) * DRAWS_A_COPY, draws))
                values = [np.array(batch.column(a)[k].as_py(), float) for a in arrays]
                trim = TRIMS.get(clusters[k])
                at = draw_indexes(frames[k], own, len(values[0]))
                means = [pa.array(trimmed_means(v[at], trim)) if trim is not None else pa.nulls(len(own), pa.float64()) for v in values]
                yield pa.RecordBatch.from_arrays([pa.array([numbers[k]] * len(own), pa.int64()), pa.array(own, pa.int32()), *means], names=["number", "draw", *[f"mean_{a}" for a in arrays]])

    return run


def rate_arrays(observed: DataFrame, km: str = "km_obs", instrumented: bool = True) -> DataFrame:
    """(year, cluster): zones' rates in order of zone with the frame's lengths and observed distance."""
    ok = complete(km, instrumented)
    rows = observed.where("cluster is not null")
    return rows.groupBy("year", "cluster").agg(
        F.transform(F.array_sort(F.collect_list(F.when(ok, F.struct("zone", rate_of(km).alias("rate"))))), lambda r: r["rate"]).alias("rates"),
        F.coalesce(F.sum(F.when(ok, F.col("length_km"))), F.lit(0.0)).alias("l_obs"),
        F.sum("length_km").alias("l_total"),
        F.coalesce(F.sum(F.when(ok, F.col(km))), F.lit(0.0)).alias("km_obs"),
    )


def bootstrap_national(observed: DataFrame, draws: int = DRAWS, km: str = "km_obs", instrumented: bool = True) -> DataFrame:
    """(year, draw, km_ext): rates resampled within each cluster, observed distance fixed, clusters summed.

    A (year, cluster) frame is one row with at most one rate a zone; DRAWS_A_COPY draws are made together where a copy of it arrives.
    """
    frames = materialize(rate_arrays(observed, km, instrumented).withColumn("frame", F.col("year").cast("bigint") * 10 + F.col("cluster")).withColumn("number", F.col("frame")), "frames")
    means = _spread(frames.select("number", "frame", "year", "cluster", "rates"), draws, ["year", "cluster"]).select("number", "frame", "cluster", "copy", "rates").mapInArrow(_resampled(["rates"], draws), "number long, draw int, mean_rates double")
    value = F.col("km_obs") + F.col("mean_rates") * F.greatest(F.col("l_total") - F.col("l_obs"), F.lit(0.0))
    return means.join(frames.drop("rates", "frame"), "number").select("year", "draw", value.alias("km")).groupBy("year", "draw").agg(F.sum("km").alias("km_ext"))


def interval(draws: DataFrame, value: str = "km_ext", keys: tuple[str, ...] = ("year",)) -> DataFrame:
    """Median, 95 % interval and its relative width in per cent."""
    q = F.percentile(value, F.array(F.lit(0.025), F.lit(0.5), F.lit(0.975)))
    return draws.groupBy(*keys).agg(q.alias("q")).select(*keys, F.col("q")[1].alias("median"), F.col("q")[0].alias("low_95"), F.col("q")[2].alias("high_95"), (100 * F.try_divide(F.col("q")[2] - F.col("q")[0], F.col("q")[1])).alias("relative_width_pct"))


def transitions(years: tuple[int, ...]) -> list[tuple[int, int, str]]:
    """Consecutive years, and the first with the last."""
    return [(a, b, f"{a} -> {b}") for a, b in zip(years[:-1], years[1:], strict=True)] + [(years[0], years[-1], f"{years[0]} -> {years[-1]} (cumulé)")]


def paired_frames(observed: DataFrame, years: tuple[int, ...]) -> DataFrame:
    """(transition, cluster): rates of zones observed in both years, as pairs in order of zone, with both frames."""
    pairs = observed.sparkSession.createDataFrame(transitions(years), "year_ref int, year_cmp int, transition string")
    ok = complete()
    rows = observed.where("cluster is not null")
    frames = rows.groupBy("year", "cluster").agg(F.coalesce(F.sum(F.when(ok, F.col("length_km"))), F.lit(0.0)).alias("l_obs"), F.sum("length_km").alias("l_total"), F.coalesce(F.sum(F.when(ok, F.col("km_obs"))), F.lit(0.0)).alias("km_obs"))
    gap = F.greatest(F.col("l_total") - F.col("l_obs"), F.lit(0.0))
    side = lambda s: frames.select(F.col("year").alias(f"year_{s}"), "cluster", F.col("km_obs").alias(f"km_{s}"), gap.alias(f"gap_{s}"))
    rates = rows.where(ok).select("year", "cluster", "zone", rate_of().alias("rate"))
    one = lambda s: rates.select(F.col("year").alias(f"year_{s}"), "cluster", "zone", F.col("rate").alias(f"rate_{s}"))
    both = F.broadcast(pairs).join(one("ref"), "year_ref").join(one("cmp"), ["year_cmp", "cluster", "zone"])
    arrays = both.groupBy("transition", "cluster").agg(F.array_sort(F.collect_list(F.struct("zone", "rate_ref", "rate_cmp"))).alias("pairs"))
    full = F.broadcast(pairs).join(side("ref"), "year_ref").join(side("cmp"), ["year_cmp", "cluster"])
    return full.join(arrays, ["transition", "cluster"], "left").withColumn("pairs", F.coalesce("pairs", F.expr("cast(array() as array<struct<zone:string,rate_ref:double,rate_cmp:double>>)")))


def growth_draws(observed: DataFrame, years: tuple[int, ...], draws: int = DRAWS) -> DataFrame:
    """(transition, cluster, draw): both years' extrapolated distance under the same resampled zones."""
    frame = (F.col("year_ref").cast("bigint") * 10_000 + F.col("year_cmp")) * 10 + F.col("cluster")
    side = lambda s: F.transform("pairs", lambda p: p[f"rate_{s}"]).alias(s)
    frames = materialize(paired_frames(observed, years).withColumn("frame", frame).select("*", F.xxhash64("transition", "cluster").alias("number"), side("ref"), side("cmp")).drop("pairs"), "paired")
    means = _spread(frames.select("number", "frame", "transition", "cluster", "ref", "cmp"), draws, ["transition", "cluster"]).select("number", "frame", "cluster", "copy", "ref", "cmp").mapInArrow(_resampled(["ref", "cmp"], draws), "number long, draw int, mean_ref double, mean_cmp double")
    joined = means.join(frames.drop("ref", "cmp", "frame"), "number")
    return joined.select("transition", "cluster", "draw", *[(F.col(f"km_{s}") + F.col(f"mean_{s}") * F.col(f"gap_{s}")).alias(f"ext_{s}") for s in ("ref", "cmp")])


def growth_test(observed: DataFrame, years: tuple[int, ...], draws: int = DRAWS, by_cluster: bool = False) -> DataFrame:
    """Growth ratio of each transition: median, 95 % interval and one-sided p-value of no growth."""
    keys = ("transition", "cluster") if by_cluster else ("transition",)
    ratio = growth_draws(observed, years, draws).groupBy(*keys, "draw").agg(F.try_divide(F.sum("ext_cmp"), F.sum("ext_ref")).alias("ratio"))
    q = F.percentile("ratio", F.array(F.lit(0.025), F.lit(0.5), F.lit(0.975)))
    out = ratio.groupBy(*keys).agg(q.alias("q"), F.avg((F.col("ratio") <= 1).cast("double")).alias("p_value"))
    return out.select(*keys, F.col("q")[1].alias("ratio_median"), F.col("q")[0].alias("low_95"), F.col("q")[2].alias("high_95"), "p_value", F.when(F.col("p_value") < 0.05, "oui").otherwise("non").alias("significant"))


def _ranked(rates: DataFrame) -> DataFrame:
    """Add ``rank`` (from 0) of each rate in its cluster: ranges of a sorted table are counted, and a row's place in its range is added."""
    parts = int(rates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(rates.repartitionByRange(parts, "cluster", "rate", "year", "zone").withColumn("part", F.spark_partition_id()), "loo-rates")
    counts = dealt.groupBy("cluster", "part").agg(F.count(F.lit(1)).alias("n"))  # a row a range
    before = counts.select("cluster", "part", (F.sum("n").over(Window.partitionBy("cluster").orderBy("part")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("cluster", "part").orderBy("rate", "year", "zone"))
    return dealt.withColumn("inside", inside).join(before, ["cluster", "part"]).select("cluster", "rate", (F.col("before") + F.col("inside") - 1).alias("rank"))


def loocv_errors(observed: DataFrame, grid: tuple[float, ...] = GRID) -> DataFrame:
    """(cluster, n, trim, error): leave-one-out error of each trim over all years' observed zones.

    Without a rate v, the k-th smallest of the others is the k-th of all if that is less than v, else the one
    behind it. So a bound of the trimmed mean takes one of three values, whatever rate is left out; sums and
    counts between the few pairs of bounds are aggregates, and a left-out rate only looks its pair up.
    """
    rates = observed.where(complete()).where(F.col("cluster").isin(*CLUSTERS)).select("cluster", "year", "zone", rate_of().alias("rate"))
    ranked = materialize(_ranked(rates), "loo-ranks")
    totals = materialize(ranked.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("rate").alias("total")), "loo-totals")
    few = F.col("n") - 1 < LEAST
    at = lambda p: F.col(p) * (F.col("n") - 2)  # noqa: E731  place among the others
    asked = totals.where("n > 1").withColumn("trim", F.explode(F.array(*[F.lit(float(t)) for t in grid])))
    asked = asked.withColumn("low", F.when(few, 0.0).otherwise(F.col("trim"))).withColumn("high", F.when(few, 1.0).otherwise(1 - F.col("trim")))
    asked = asked.select("cluster", "n", "total", "trim", F.posexplode(F.array(at("low"), at("high"))).alias("side", "at")).withColumn("k", F.floor("at"))
    # the k-th, the next and the one behind that, of all rates
    points = asked.withColumn("offset", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).withColumn("rank", F.least(F.col("k") + F.col("offset"), F.col("n") - 1))
    found = points.join(ranked, ["cluster", "rank"]).groupBy("cluster", "n", "total", "trim", "side", "at", "k").agg(*[F.max(F.when(F.col("offset") == o, F.col("rate"))).alias(f"s{o}") for o in range(3)])
    # left out: above the next, equal to the next, or not above the k-th
    value = lambda a, b: a + (b - a) * (F.col("at") - F.col("k"))
    last = F.col("k") + 1 > F.col("n") - 2  # no other rate behind the k-th one
    s0, s1, s2 = F.col("s0"), F.col("s1"), F.col("s2")
    cases = F.array(value(s0, F.when(last, s0).otherwise(s1)), value(s0, F.when(last, s0).otherwise(s2)), value(s1, F.when(last, s1).otherwise(s2)))
    sides = found.withColumn("cases", cases)
    side = lambda k, name: sides.where(F.col("side") == k).select("cluster", "n", "total", "trim", F.col("s0").alias(f"{name}0"), F.col("s1").alias(f"{name}1"), F.posexplode("cases").alias(f"{name}_case", name))
    bounds = materialize(side(0, "low").join(side(1, "high").drop("n", "total"), ["cluster", "trim"]), "loo-bounds")  # nine rows a trim and cluster
    between = F.col("rate").between(F.col("low"), F.col("high"))
    sums = ranked.join(F.broadcast(bounds.select("cluster", "trim", "low_case", "high_case", "low", "high")), "cluster").where(between).groupBy("cluster", "trim", "low_case", "high_case").agg(F.count(F.lit(1)).alias("count"), F.sum("rate").alias("sum"))
    bounds = materialize(bounds.join(sums, ["cluster", "trim", "low_case", "high_case"], "left").fillna(0, subset=["count", "sum"]), "loo-sums")
    case = lambda name: F.when(F.col(f"{name}1") < F.col("rate"), 0).when(F.col(f"{name}0") < F.col("rate"), 1).otherwise(2)
    left = ranked.select("cluster", "rate").join(F.broadcast(bounds), "cluster").where((F.col("low_case") == case("low")) & (F.col("high_case") == case("high")))
    own = F.when(between, 1).otherwise(0)
    mean = F.coalesce(F.try_divide(F.col("sum") - own * F.col("rate"), F.col("count") - own), F.try_divide(F.col("total") - F.col("rate"), F.col("n") - 1))
    errors = left.groupBy("cluster", "n", "trim").agg(F.percentile(F.abs(mean - F.col("rate")), F.lit(0.5)).alias("error"))
    alone = totals.where("n <= 1").select("cluster", "n", F.explode(F.array(*[F.lit(float(t)) for t in grid])).alias("trim"), F.lit(None).cast("double").alias("error"))
    return errors.unionByName(alone)


def best_trim(errors: DataFrame) -> DataFrame:
    """Trim of least error for each cluster, the smaller one of equals."""
    errors = errors.where("error is not null").withColumn("error", F.round("error", ERROR_DIGITS))
    return errors.groupBy("cluster").agg(F.first("n").alias("n"), F.min_by("trim", F.struct("error", "trim")).alias("best_trim"), F.min("error").alias("error"))


def panel_km(observed: DataFrame, detail: DataFrame, panel: DataFrame) -> DataFrame:
    """Observed distance from the balanced panel's sensors alone, on the lengths attributed before."""
    mean = detail.join(panel, "id_site", "left_semi").where("cluster is not null").groupBy("year", "zone", "cluster").agg(F.avg("qta").alias("qta_panel"))
    return observed.join(mean, ["year", "zone", "cluster"], "left").withColumn("km_panel", F.col("length_km") * F.coalesce("qta_panel", F.lit(0.0)))
