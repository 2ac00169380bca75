"""SQL of the core chain for the oracle: the same tables, named step by step."""

from __future__ import annotations

from tallyroad.operators.assembly import EARLIER, EXACT, LATER
from tallyroad.operators.estimation import CLUSTER_NAMES, LEAST, TRIMS
from tallyroad.operators.robustness import PRIME, STEP_DRAW, STEP_MIX, STEP_SLOT
from tallyroad.sources.fixtures import SCENARIOS, VINTAGES, YEARS

ZONE = "p_brand || '/' || lpad(p_size::VARCHAR, 2, '0')"
_KIND = "CASE split_part(p_type, ' ', 1) WHEN 'ECONOMY' THEN 0 WHEN 'SMALL' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'PROMO' THEN 3 END"
_CUT = {"PARTIAL": "l_returnflag = 'N'", "ALL": "true", "DEDICATED": "l_returnflag IN ('A', 'R')"}
_SUMS = ", ".join(f"sum(CASE WHEN {_CUT[s]} AND l_linestatus = '{status}' THEN l_extendedprice::DECIMAL(18,2) ELSE 0 END)::DOUBLE / 10000.0 AS len_{side}_{s}" for side, status in (("d", "F"), ("g", "O")) for s in SCENARIOS)
_NAMES = [f"len_{side}_{s}" for side in "dg" for s in SCENARIOS]
_TRIM = "CASE cluster " + " ".join(f"WHEN {c} THEN {t}" for c, t in TRIMS.items()) + " END"


def _rule(y: int) -> tuple[int, str]:
    later, earlier = [v for v in VINTAGES if v > y], [v for v in VINTAGES if v < y]
    return (y, EXACT) if y in VINTAGES else (min(later), LATER) if later else (max(earlier), EARLIER.replace("'", "''"))


def chain(threshold: int = 100) -> str:
    """Common tables from sensors to national totals; put after WITH."""
    return f"""
sensors AS (SELECT p_partkey AS id_site, p_name AS site_name, {ZONE} AS zone, p_brand AS department, {_KIND} AS cluster FROM part WHERE p_partkey % 3 = 0),
zones AS (SELECT {ZONE} AS zone, min(p_brand) AS department, (min(p_size) % 4)::INTEGER AS fallback FROM part GROUP BY 1),
flows AS (SELECT l_partkey AS id_site, year(l_shipdate)::INTEGER AS year, sum(l_quantity) AS annual_flow, count(l_quantity) AS n_valid_h, count(DISTINCT l_shipdate::DATE) AS active_slots FROM lineitem GROUP BY 1, 2),
sensor_years AS (
  SELECT s.*, year, annual_flow, n_valid_h, annual_flow / n_valid_h * 8760 AS qta,
         active_slots / max(active_slots) OVER (PARTITION BY year) AS activity_share
  FROM flows JOIN sensors s USING (id_site)),
flagged AS (SELECT *, qta > 0 AS valid, activity_share > 0.05 AND annual_flow > {threshold} AS active FROM sensor_years),
detail AS (SELECT id_site, site_name, zone, department, cluster, year, annual_flow, n_valid_h, qta FROM flagged WHERE active),
lengths AS (SELECT year(l_shipdate)::INTEGER AS year, {ZONE} AS zone, {_SUMS} FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
years AS (SELECT unnest({list(YEARS)})::INTEGER AS year),
totals AS (SELECT year, zone, cluster, sum(qta) AS qta FROM detail WHERE cluster IS NOT NULL GROUP BY ALL),
votes AS (SELECT year, zone, cluster AS vote FROM totals QUALIFY row_number() OVER (PARTITION BY year, zone ORDER BY round(qta, 6) DESC, cluster) = 1),
clusters AS (SELECT year, zone, coalesce(vote, fallback) AS cluster FROM zones CROSS JOIN years LEFT JOIN votes USING (year, zone)),
assembled AS (
  SELECT year, z.zone, department, c.cluster, (z.zone IN (SELECT zone FROM flagged WHERE active))::INTEGER AS instrumented, {', '.join(_NAMES)}
  FROM zones z CROSS JOIN years JOIN lengths USING (year, zone) JOIN clusters c USING (year, zone)
  WHERE {' + '.join(_NAMES)} > 0),
base AS (SELECT year, zone, department, instrumented, cluster AS own_cluster, len_d_ALL + len_g_ALL AS total_length_km FROM assembled),
per AS (SELECT year, zone, cluster, avg(qta) AS qta_mean, count(DISTINCT id_site) AS n_sensors FROM detail WHERE cluster IS NOT NULL GROUP BY ALL),
shared AS (SELECT *, qta_mean * n_sensors / sum(qta_mean * n_sensors) OVER (PARTITION BY year, zone) AS share FROM per),
observed AS (
  SELECT year, zone, department, instrumented, cluster, total_length_km, share, total_length_km * share AS length_km, n_sensors, qta_mean, qta_mean * (total_length_km * share) AS km_obs
  FROM shared LEFT JOIN base USING (year, zone)
  UNION ALL
  SELECT year, zone, department, instrumented, own_cluster, total_length_km, 1.0, total_length_km, 0, 0.0, 0.0
  FROM base WHERE NOT EXISTS (SELECT 1 FROM per WHERE per.year = base.year AND per.zone = base.zone)),
complete AS (SELECT *, round(km_obs / length_km, 6) AS rate FROM observed WHERE cluster IS NOT NULL AND instrumented = 1 AND length_km > 0 AND km_obs > 0),
bounds AS (SELECT year, cluster, count(*) AS n, median(rate) AS median, quantile_cont(rate, {list(TRIMS.values())}) AS lows, quantile_cont(rate, {[1 - t for t in TRIMS.values()]}) AS highs FROM complete GROUP BY ALL),
rates AS (
  SELECT c.year, c.cluster, any_value(n) AS n, CASE WHEN any_value(n) < {LEAST} THEN any_value(b.median) ELSE coalesce(avg(rate) FILTER (WHERE rate BETWEEN round(lows[c.cluster + 1], 6) AND round(highs[c.cluster + 1], 6)), 0.0) END AS rate
  FROM complete c JOIN bounds b USING (year, cluster) GROUP BY c.year, c.cluster),
scaffold AS (SELECT year, cluster, cluster_name FROM years CROSS JOIN (VALUES {', '.join(f"({c}, '{n}')" for c, n in CLUSTER_NAMES.items())}) AS v(cluster, cluster_name)),
frames AS (SELECT year, cluster, count(*) FILTER (WHERE ok) AS n_active, sum(length_km) FILTER (WHERE ok) AS l_obs, sum(length_km) AS l_total, sum(km_obs) FILTER (WHERE ok) AS km_obs
  FROM (SELECT *, coalesce(instrumented = 1 AND length_km > 0 AND km_obs > 0, false) AS ok FROM observed WHERE cluster IS NOT NULL) GROUP BY ALL),
extrapolated AS (
  SELECT year, cluster, cluster_name, coalesce(n_active, 0) AS n_active, coalesce(l_obs, 0) AS l_obs, coalesce(l_total, 0) AS l_total, coalesce(f.km_obs, 0) AS km_obs, coalesce(rate, 0) AS rate,
         coalesce(f.km_obs, 0) + coalesce(rate, 0) * greatest(coalesce(l_total, 0) - coalesce(l_obs, 0), 0) AS km_ext
  FROM scaffold LEFT JOIN frames f USING (year, cluster) LEFT JOIN rates USING (year, cluster)),
national AS (SELECT year, sum(km_obs) / 1e9 AS km_obs_bn, sum(km_ext) / 1e9 AS km_ext_bn FROM extrapolated GROUP BY year),
by_customer AS (SELECT year(o_orderdate)::INTEGER AS vintage, c_nationkey AS area FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) IN {VINTAGES}),
population AS (SELECT vintage, area, count(*) * 1000.0::DOUBLE AS population FROM by_customer GROUP BY ALL),
rule AS (SELECT * FROM (VALUES {', '.join(f"({y}, {_rule(y)[0]}, '{_rule(y)[1]}')" for y in YEARS)}) AS v(year, vintage, rule)),
population_used AS (SELECT year, vintage, any_value(rule) AS rule, coalesce(sum(population), 0)::DOUBLE AS population, count(area) AS n_areas FROM rule LEFT JOIN population USING (vintage) GROUP BY year, vintage),
panel AS (SELECT id_site FROM detail GROUP BY id_site HAVING count(DISTINCT year) = {len(YEARS)}),
panel_mean AS (SELECT year, zone, cluster, avg(qta) AS qta_panel FROM detail WHERE cluster IS NOT NULL AND id_site IN (SELECT id_site FROM panel) GROUP BY ALL),
mini AS (SELECT o.*, length_km * coalesce(qta_panel, 0) AS km_panel FROM observed o LEFT JOIN panel_mean USING (year, zone, cluster))"""


def generic_extrapolation(name: str, source: str, km: str) -> str:
    """Extrapolation without the instrumentation rule, over any distance column."""
    return f"""
{name}_ok AS (SELECT year, cluster, length_km, {km} AS km, round({km} / length_km, 6) AS rate FROM {source} WHERE cluster IS NOT NULL AND length_km > 0 AND {km} > 0),
{name}_b AS (SELECT year, cluster, count(*) AS n, median(rate) AS median, quantile_cont(rate, {list(TRIMS.values())}) AS lows, quantile_cont(rate, {[1 - t for t in TRIMS.values()]}) AS highs, sum(length_km) AS l_obs, sum(km) AS km FROM {name}_ok GROUP BY ALL),
{name}_r AS (SELECT o.year, o.cluster, CASE WHEN any_value(n) < {LEAST} THEN any_value(b.median) ELSE coalesce(avg(rate) FILTER (WHERE rate BETWEEN round(lows[o.cluster + 1], 6) AND round(highs[o.cluster + 1], 6)), 0.0) END AS rate, any_value(b.l_obs) AS l_obs, any_value(b.km) AS km FROM {name}_ok o JOIN {name}_b b USING (year, cluster) GROUP BY o.year, o.cluster),
{name}_t AS (SELECT year, cluster, sum(length_km) AS l_total FROM {source} WHERE cluster IS NOT NULL GROUP BY ALL),
{name} AS (SELECT year, sum(coalesce(km, 0) + coalesce(rate, 0) * greatest(coalesce(l_total, 0) - coalesce(l_obs, 0), 0)) / 1e9 AS ext_bn FROM {name}_t LEFT JOIN {name}_r USING (year, cluster) GROUP BY year)"""


def index_sql(frame: str, draw: str, slot: str, n: str) -> str:
    """Index in 0..n-1 of a slot of a draw."""
    base = f"((({frame})::BIGINT % {PRIME} * 48271 + {draw} * {STEP_DRAW} + 1) % {PRIME})"
    first = f"((({base} * {base} + 5) % {PRIME} + {slot} * {STEP_SLOT}) % {PRIME})"
    mixed = f"((({first} * {first} + 7) % {PRIME} * {STEP_MIX} + 11) % {PRIME})"
    return f"floor(({mixed} * {mixed} + 13) % {PRIME} * {n} / {PRIME})::BIGINT"


def arrays_sql(draws: int) -> str:
    """Bootstrap draws: rates in order of zone, resampled by hash, trimmed by array quantiles."""
    q = lambda s, p: f"list_extract({s}, 1 + floor({p} * (len({s}) - 1))::INTEGER) + (list_extract({s}, 1 + least(floor({p} * (len({s}) - 1)) + 1, len({s}) - 1)::INTEGER) - list_extract({s}, 1 + floor({p} * (len({s}) - 1))::INTEGER)) * ({p} * (len({s}) - 1) - floor({p} * (len({s}) - 1)))"
    return f"""
boot_frames AS (SELECT year, cluster, coalesce(list(round(km_obs / length_km, 6) ORDER BY zone) FILTER (WHERE ok), []) AS rates, coalesce(sum(length_km) FILTER (WHERE ok), 0) AS l_obs, sum(length_km) AS l_total, coalesce(sum(km_obs) FILTER (WHERE ok), 0) AS km_obs
  FROM (SELECT *, coalesce(instrumented = 1 AND length_km > 0 AND km_obs > 0, false) AS ok FROM observed WHERE cluster IS NOT NULL) GROUP BY ALL),
boot_draws AS (SELECT *, {_TRIM}::DOUBLE AS trim, list_sort(list_transform(range(0, len(rates)), lambda j: rates[1 + {index_sql('year * 10 + cluster', 'draw', 'j', 'len(rates)')}])) AS s
  FROM boot_frames, range(0, {draws}) AS r(draw)),
boot_bounds AS (SELECT *, {q('s', 'trim')} AS low, {q('s', '(1 - trim)')} AS high, {q('s', '0.5')} AS mid FROM boot_draws),
boot AS (SELECT year, draw, sum(km_obs + greatest(l_total - l_obs, 0) * CASE WHEN len(s) = 0 THEN 0 WHEN len(s) < {LEAST} THEN mid ELSE coalesce(list_avg(list_filter(s, lambda x: x >= low AND x <= high)), 0) END) AS km_ext FROM boot_bounds GROUP BY ALL)"""
