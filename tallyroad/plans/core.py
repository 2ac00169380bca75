"""Queries of the core chain, with their SQL."""

from __future__ import annotations

from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroad.operators import assembly, estimation, indicators, robustness
from tallyroad.operators import sensors as S
from tallyroad.plans.core_sql import arrays_sql, chain, generic_extrapolation, index_sql
from tallyroad.sources import fixtures as X
from tallyroad.sources.fixtures import YEARS
from tallyroad.sources.scratch import materialize

#: Least annual flow of an active sensor: of the flagship chain and of balanced-panel queries.
THRESHOLD, PANEL_THRESHOLD = 100, 20


def rounded(df: DataFrame, digits: int = 4, keep: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded, so that sums of different order agree."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" and c not in keep else F.col(c) for c, t in df.dtypes])


class Chain:
    """Tables of the core chain for one query. Facts are scanned once: sensor-years and lengths, and what is observed, are written where several steps read them."""

    def __init__(self, spark: SparkSession, sf: str, threshold: int = THRESHOLD):
        self.spark, self.sf, self.threshold = spark, sf, threshold

    @cached_property
    def years(self) -> DataFrame:
        return materialize(sensor_years(self.spark, self.sf, self.threshold), "sensor-years")

    @cached_property
    def detail(self) -> DataFrame:
        return S.active_detail(self.years)

    @cached_property
    def zones(self) -> DataFrame:
        return X.zones(self.spark, self.sf)

    @cached_property
    def clusters(self) -> DataFrame:
        return assembly.resolve_clusters(self.detail, self.zones, YEARS)

    @cached_property
    def assembled(self) -> DataFrame:
        return assembly.assembled_zones(self.zones, X.lengths_wide(self.spark, self.sf), self.clusters, assembly.instrumented_zones(self.years), YEARS)

    @cached_property
    def observed_once(self) -> DataFrame:
        """Observed distance for a single reader; the assembled zones are read twice and written first."""
        return estimation.observed_km(materialize(self.assembled, "assembled"), self.detail)

    @cached_property
    def observed(self) -> DataFrame:
        return materialize(self.observed_once, "observed")

    @cached_property
    def extrapolated(self) -> DataFrame:
        return estimation.extrapolated_detail(self.observed, YEARS)


def sensor_years(spark: SparkSession, sf: str, threshold: int = THRESHOLD) -> DataFrame:
    return S.sensor_years(X.flows(spark, sf), X.sensors(spark, sf), threshold)


def detail(spark: SparkSession, sf: str) -> DataFrame:
    return S.active_detail(sensor_years(spark, sf))


def clusters(spark: SparkSession, sf: str) -> DataFrame:
    return Chain(spark, sf).clusters


def observed(spark: SparkSession, sf: str) -> DataFrame:
    return Chain(spark, sf).observed


def extrapolated(spark: SparkSession, sf: str) -> DataFrame:
    return Chain(spark, sf).extrapolated


def national_km(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: observed and extrapolated distance by year."""
    return rounded(estimation.national(extrapolated(spark, sf)), 9)


def _population(spark: SparkSession, sf: str) -> DataFrame:
    return assembly.population_used(X.population(spark, sf), YEARS, X.VINTAGES)


def _trimmed(spark, sf):
    rates = observed(spark, sf).where(estimation.complete()).where("cluster is not null").select("year", "cluster", estimation.rate_of().alias("rate"))
    return rounded(estimation.trimmed_rates(rates, ["year", "cluster"]))


def _panel(spark, sf):
    return S.balanced_panel(S.active_detail(sensor_years(spark, sf, PANEL_THRESHOLD)), YEARS)


def _mini(spark, sf):
    c = Chain(spark, sf, PANEL_THRESHOLD)
    mini = robustness.panel_km(c.observed_once, c.detail, S.balanced_panel(c.detail, YEARS))
    return rounded(mini.groupBy("year", "cluster").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("km_panel") > 0).alias("n_panel_zones"), F.sum("km_panel").alias("km_panel")).where("cluster is not null"), 3)


def _indicators(spark, sf):
    c = Chain(spark, sf, PANEL_THRESHOLD)
    out = indicators.all_indicators(c.observed, c.detail, _population(spark, sf), YEARS)
    return rounded(out, 6)


def _totals(spark, sf):
    long = assembly.unpivot_lengths(X.lengths_wide(spark, sf))
    wide = long.groupBy("year").pivot("scenario", list(X.SCENARIOS)).agg(F.sum(F.col("len_d") + F.col("len_g")))
    gap = F.col("ALL") - F.col("PARTIAL")
    return rounded(wide.select("year", *[F.col(s).alias(f"total_{s}") for s in X.SCENARIOS], gap.alias("gap"), (100 * F.try_divide(gap, F.col("PARTIAL"))).alias("gap_pct")))


def _growth(spark, sf):
    return rounded(indicators.growth_factor(estimation.national(extrapolated(spark, sf)), ["km_obs_bn", "km_ext_bn"]), 8)


def _index(spark, sf):
    return rounded(indicators.index_base_100(estimation.national(extrapolated(spark, sf)), ["km_obs_bn", "km_ext_bn"]), 6)


def _flow_ratio(spark, sf):
    d = Chain(spark, sf).detail
    return rounded(indicators.ratio_by_cluster(indicators.pivot_by_cluster(d, "annual_flow"), indicators.pivot_by_cluster(d, "id_site", "distinct")), 6)


def _bootstrap(spark, sf):
    return rounded(robustness.interval(robustness.bootstrap_national(observed(spark, sf))), 3)


def _growth_test(spark, sf, by_cluster=False):
    return rounded(robustness.growth_test(observed(spark, sf), YEARS, by_cluster=by_cluster), 8)


def _loocv(spark, sf):
    return rounded(robustness.loocv_errors(observed(spark, sf)), 3)


def _loocv_best(spark, sf):
    return rounded(robustness.best_trim(robustness.loocv_errors(observed(spark, sf))), 3)


def _coverage(spark, sf):
    seen = observed(spark, sf).groupBy("zone").agg(F.max("instrumented").alias("i"), F.max(F.coalesce("length_km", F.lit(0.0))).alias("l"))
    label = F.when(F.col("i") == 1, "Instrumentée").when(F.col("l") > 0, "Linéaire seulement").otherwise("Sans rien")
    return X.zones(spark, sf).join(seen, "zone", "left").select("zone", label.alias("coverage"))


def queries():
    return {
        "national_km": national_km,
        "sensor_years": lambda s, d: rounded(sensor_years(s, d), 6),
        "sensor_detail_labelled": lambda s, d: rounded(detail(s, d), 6),
        "zone_cluster_vote": clusters,
        "assembled_zones": lambda s, d: rounded(Chain(s, d).assembled, 6),
        "network_long": lambda s, d: rounded(assembly.unpivot_lengths(X.lengths_wide(s, d)), 6),
        "network_totals_by_scenario": _totals,
        "population_vintage": _population,
        "observed_km": lambda s, d: rounded(Chain(s, d).observed_once, 3),
        "extrapolated_detail": lambda s, d: rounded(extrapolated(s, d), 3),
        "trimmed_rate": _trimmed,
        "loocv_error": _loocv,
        "loocv_best_trim": _loocv_best,
        "balanced_panel": _panel,
        "mini_km": _mini,
        "all_indicators": _indicators,
        "flow_by_cluster_pivot": lambda s, d: indicators.pivot_by_cluster(detail(s, d), "annual_flow"),
        "sensors_by_cluster_pivot": lambda s, d: indicators.pivot_by_cluster(detail(s, d), "id_site", "distinct"),
        "growth_factor": _growth,
        "index_base_100": _index,
        "flow_per_sensor_ratio": _flow_ratio,
        "bootstrap_ci": _bootstrap,
        "growth_test": _growth_test,
        "growth_test_by_cluster": partial(_growth_test, by_cluster=True),
        "coverage_category": _coverage,
    }


def _select(body: str, threshold: int = THRESHOLD, more: str = "") -> str:
    return f"WITH {chain(threshold)}{',' + more if more else ''}\n{body}"


def oracle_sql():
    lengths = "len_d_PARTIAL, len_d_ALL, len_d_DEDICATED, len_g_PARTIAL, len_g_ALL, len_g_DEDICATED".split(", ")
    pivot = lambda agg: ", ".join(f"{agg.format(c=c)} AS cluster_{c}" for c in range(4))
    growth = lambda by: _select(f"SELECT transition{', cluster' if by else ''}, round(quantile_cont(ratio, 0.5), 8) AS ratio_median, round(quantile_cont(ratio, 0.025), 8) AS low_95, round(quantile_cont(ratio, 0.975), 8) AS high_95, round(avg((ratio <= 1)::INTEGER), 8) AS p_value, CASE WHEN avg((ratio <= 1)::INTEGER) < 0.05 THEN 'oui' ELSE 'non' END AS significant FROM (SELECT transition{', cluster' if by else ''}, draw, sum(ext_cmp) / nullif(sum(ext_ref), 0) AS ratio FROM growth_draws GROUP BY ALL) GROUP BY ALL", more=_growth_sql(robustness.DRAWS))
    return {
        "national_km": _select("SELECT year, round(km_obs_bn, 9) AS km_obs_bn, round(km_ext_bn, 9) AS km_ext_bn FROM national"),
        "sensor_years": _select("SELECT id_site, site_name, zone, department, cluster, year, round(annual_flow, 6) AS annual_flow, n_valid_h, round(qta, 6) AS qta, round(activity_share, 6) AS activity_share, valid, active FROM flagged"),
        "sensor_detail_labelled": _select("SELECT * REPLACE (round(annual_flow, 6) AS annual_flow, round(qta, 6) AS qta) FROM detail"),
        "zone_cluster_vote": _select("SELECT * FROM clusters"),
        "assembled_zones": _select("SELECT year, zone, department, cluster, instrumented, " + ", ".join(f"round({n}, 6) AS {n}" for n in lengths) + " FROM assembled"),
        "network_long": _select("SELECT year, zone, v.scenario, round(v.d, 6) AS len_d, round(v.g, 6) AS len_g FROM lengths, LATERAL (VALUES ('PARTIAL', len_d_PARTIAL, len_g_PARTIAL), ('ALL', len_d_ALL, len_g_ALL), ('DEDICATED', len_d_DEDICATED, len_g_DEDICATED)) AS v(scenario, d, g)"),
        "network_totals_by_scenario": _select("SELECT year, " + ", ".join(f"round(sum(len_d_{s} + len_g_{s}), 4) AS total_{s}" for s in X.SCENARIOS) + ", round(sum(len_d_ALL + len_g_ALL) - sum(len_d_PARTIAL + len_g_PARTIAL), 4) AS gap, round(100 * (sum(len_d_ALL + len_g_ALL) - sum(len_d_PARTIAL + len_g_PARTIAL)) / nullif(sum(len_d_PARTIAL + len_g_PARTIAL), 0), 4) AS gap_pct FROM lengths GROUP BY year"),
        "population_vintage": _select("SELECT year, vintage, rule, population, n_areas FROM population_used"),
        "observed_km": _select("SELECT year, zone, department, instrumented, cluster, round(total_length_km, 3) AS total_length_km, round(share, 3) AS share, round(length_km, 3) AS length_km, n_sensors, round(qta_mean, 3) AS qta_mean, round(km_obs, 3) AS km_obs FROM observed"),
        "extrapolated_detail": _select("SELECT year, cluster, cluster_name, n_active, " + ", ".join(f"round({c}, 3) AS {c}" for c in ("l_obs", "l_total", "km_obs", "rate", "km_ext")) + " FROM extrapolated"),
        "trimmed_rate": _select("SELECT year, cluster, n, round(rate, 4) AS rate FROM rates"),
        "loocv_error": _select("SELECT cluster, n, trim, round(median(error), 3) AS error FROM loo_errors GROUP BY ALL", more=_LOO),
        "loocv_best_trim": _select("SELECT cluster, n, arg_min(trim, (error, trim)) AS best_trim, round(min(error), 3) AS error FROM (SELECT cluster, n, trim, round(median(error), LOO_DIGITS) AS error FROM loo_errors GROUP BY ALL) WHERE error IS NOT NULL GROUP BY ALL".replace("LOO_DIGITS", str(robustness.ERROR_DIGITS)), more=_LOO),
        "balanced_panel": _select("SELECT id_site FROM panel", PANEL_THRESHOLD),
        "mini_km": _select("SELECT year, cluster, count(*) AS n_rows, count(*) FILTER (WHERE km_panel > 0) AS n_panel_zones, round(sum(km_panel), 3) AS km_panel FROM mini WHERE cluster IS NOT NULL GROUP BY ALL", PANEL_THRESHOLD),
        "all_indicators": _select(
            """SELECT p.year, p.population, s.n_sensors, s.total_flow, (SELECT count(*) FROM panel) AS n_panel, round(o.length_km, 6) AS length_km, round(o.km_obs_bn, 6) AS km_obs_bn,
       round(e.ext_bn, 6) AS km_ext_bn, round(m.km_panel_obs_bn, 6) AS km_panel_obs_bn, round(x.ext_bn, 6) AS km_panel_ext_bn
FROM population_used p LEFT JOIN (SELECT year, count(DISTINCT id_site) AS n_sensors, sum(annual_flow) AS total_flow FROM detail GROUP BY year) s USING (year)
LEFT JOIN (SELECT year, sum(length_km) AS length_km, sum(km_obs) FILTER (WHERE instrumented = 1 AND length_km > 0 AND km_obs > 0) / 1e9 AS km_obs_bn FROM observed GROUP BY year) o USING (year)
LEFT JOIN std e USING (year) LEFT JOIN (SELECT year, sum(km_panel) / 1e9 AS km_panel_obs_bn FROM mini GROUP BY year) m USING (year) LEFT JOIN pan x USING (year)""",
            PANEL_THRESHOLD,
            generic_extrapolation("std", "observed", "km_obs") + "," + generic_extrapolation("pan", "mini", "km_panel"),
        ),
        "flow_by_cluster_pivot": _select(f"SELECT year, {pivot('sum(annual_flow) FILTER (WHERE cluster = {c})')} FROM detail WHERE cluster IS NOT NULL GROUP BY year"),
        "sensors_by_cluster_pivot": _select(f"SELECT year, {pivot('count(DISTINCT id_site) FILTER (WHERE cluster = {c})')} FROM detail WHERE cluster IS NOT NULL GROUP BY year"),
        "growth_factor": _select("SELECT year, round(km_obs_bn / lag(km_obs_bn) OVER (ORDER BY year), 8) AS km_obs_bn_growth, round(km_ext_bn / lag(km_ext_bn) OVER (ORDER BY year), 8) AS km_ext_bn_growth FROM national"),
        "index_base_100": _select("SELECT year, round(km_obs_bn * 100 / first_value(km_obs_bn) OVER (ORDER BY year), 6) AS km_obs_bn_index, round(km_ext_bn * 100 / first_value(km_ext_bn) OVER (ORDER BY year), 6) AS km_ext_bn_index FROM national"),
        "flow_per_sensor_ratio": _select(f"SELECT year, {pivot('round(coalesce(sum(annual_flow) FILTER (WHERE cluster = {c}) / nullif(count(DISTINCT id_site) FILTER (WHERE cluster = {c}), 0), 0), 6)')} FROM detail WHERE cluster IS NOT NULL GROUP BY year"),
        "bootstrap_ci": _select("SELECT year, round(quantile_cont(km_ext, 0.5), 3) AS median, round(quantile_cont(km_ext, 0.025), 3) AS low_95, round(quantile_cont(km_ext, 0.975), 3) AS high_95, round(100 * (quantile_cont(km_ext, 0.975) - quantile_cont(km_ext, 0.025)) / quantile_cont(km_ext, 0.5), 3) AS relative_width_pct FROM boot GROUP BY year", more=arrays_sql(robustness.DRAWS)),
        "growth_test": growth(False),
        "growth_test_by_cluster": growth(True),
        "coverage_category": _select("SELECT z.zone, CASE WHEN max(instrumented) = 1 THEN 'Instrumentée' WHEN max(coalesce(length_km, 0)) > 0 THEN 'Linéaire seulement' ELSE 'Sans rien' END AS coverage FROM zones z LEFT JOIN observed o USING (zone) GROUP BY z.zone"),
    }


def _loo_sql(grid: str) -> str:
    """Leave-one-out by ranks of the sorted rates: the k-th of the others is the k-th or the one behind it."""
    other = lambda k: f"s[1 + CASE WHEN {k} < i THEN {k} ELSE {k} + 1 END]"
    q = lambda p: f"({other(f'floor({p} * (n - 2))::INTEGER')} + ({other(f'least(floor({p} * (n - 2)) + 1, n - 2)::INTEGER')} - {other(f'floor({p} * (n - 2))::INTEGER')}) * ({p} * (n - 2) - floor({p} * (n - 2))))"
    return f"""
loo_lists AS (SELECT cluster, count(*) AS n, list(rate ORDER BY rate) AS s FROM complete GROUP BY cluster),
loo_rows AS (SELECT cluster, n, s, unnest(range(0, n))::INTEGER AS i, trim::DOUBLE AS trim FROM loo_lists CROSS JOIN (VALUES {grid}) AS g(trim)),
loo_bounds AS (SELECT *, s[1 + i] AS own, CASE WHEN n - 1 >= 5 THEN {q('trim')} ELSE {other('0')} END AS low, CASE WHEN n - 1 >= 5 THEN {q('(1 - trim)')} ELSE {other('(n - 2)')} END AS high FROM loo_rows),
loo_errors AS (SELECT cluster, n, trim, abs(coalesce((list_sum(list_filter(s, lambda x: x >= low AND x <= high)) - CASE WHEN own >= low AND own <= high THEN own ELSE 0 END) / nullif(len(list_filter(s, lambda x: x >= low AND x <= high)) - (own >= low AND own <= high)::INTEGER, 0), (list_sum(s) - own) / (n - 1)) - own) AS error FROM loo_bounds)"""


_LOO = _loo_sql(", ".join(f"({t})" for t in robustness.GRID))


def _growth_sql(draws: int) -> str:
    pairs = ", ".join(f"({a}, {b}, '{label}')" for a, b, label in robustness.transitions(YEARS))
    q = lambda s, p: f"(list_extract({s}, 1 + floor({p} * (len({s}) - 1))::INTEGER) + (list_extract({s}, 1 + least(floor({p} * (len({s}) - 1)) + 1, len({s}) - 1)::INTEGER) - list_extract({s}, 1 + floor({p} * (len({s}) - 1))::INTEGER)) * ({p} * (len({s}) - 1) - floor({p} * (len({s}) - 1))))"
    trim = "CASE cluster " + " ".join(f"WHEN {c} THEN {t}" for c, t in estimation.TRIMS.items()) + " END"
    rate = lambda s: f"CASE WHEN len({s}) = 0 THEN 0 WHEN len({s}) < 5 THEN {q(s, '0.5')} ELSE coalesce(list_avg(list_filter({s}, lambda x: x >= {q(s, 'trim')} AND x <= {q(s, '(1 - trim)')})), 0) END"
    return f"""
pairs AS (SELECT * FROM (VALUES {pairs}) AS v(year_ref, year_cmp, transition)),
frame AS (SELECT year, cluster, coalesce(sum(length_km) FILTER (WHERE ok), 0) AS l_obs, sum(length_km) AS l_total, coalesce(sum(km_obs) FILTER (WHERE ok), 0) AS km FROM (SELECT *, coalesce(instrumented = 1 AND length_km > 0 AND km_obs > 0, false) AS ok FROM observed WHERE cluster IS NOT NULL) GROUP BY ALL),
paired AS (SELECT transition, a.cluster, list(a.rate ORDER BY a.zone) AS r, list(b.rate ORDER BY a.zone) AS c FROM pairs JOIN complete a ON a.year = year_ref JOIN complete b ON b.year = year_cmp AND b.cluster = a.cluster AND b.zone = a.zone GROUP BY ALL),
framed AS (SELECT transition, year_ref, year_cmp, x.cluster, x.km AS km_ref, greatest(x.l_total - x.l_obs, 0) AS gap_ref, y.km AS km_cmp, greatest(y.l_total - y.l_obs, 0) AS gap_cmp FROM pairs JOIN frame x ON x.year = year_ref JOIN frame y ON y.year = year_cmp AND y.cluster = x.cluster),
drawn AS (SELECT f.*, draw, {trim}::DOUBLE AS trim, coalesce(r, []) AS r, coalesce(c, []) AS c, list_transform(range(0, len(coalesce(r, []))), lambda j: 1 + {index_sql('(year_ref * 10000 + year_cmp) * 10 + f.cluster', 'draw', 'j', 'len(r)')}) AS picks FROM framed f LEFT JOIN paired USING (transition, cluster), range(0, {draws}) AS g(draw)),
samples AS (SELECT * REPLACE (list_sort(list_transform(picks, lambda k: r[k])) AS r, list_sort(list_transform(picks, lambda k: c[k])) AS c) FROM drawn),
growth_draws AS (SELECT transition, cluster, draw, km_ref + gap_ref * {rate('r')} AS ext_ref, km_cmp + gap_cmp * {rate('c')} AS ext_cmp FROM samples)"""
