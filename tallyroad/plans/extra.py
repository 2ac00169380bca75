"""Queries of the series, tag, spatial and table operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroad.functions import scalars as C
from tallyroad.operators import assembly, profiles, spatial, tags
from tallyroad.operators import checks as Q
from tallyroad.operators import sensors as S
from tallyroad.plans.core import rounded
from tallyroad.plans.core_sql import ZONE
from tallyroad.sources import fixtures as X
from tallyroad.sources.fixtures import table

HOURS = 720
DIRECTIONS = {"R": "Bidirectionnel", "A": " BIDIRECTIONNEL ", "N": "unidirectional"}


def start():
    return F.lit("2024-01-01").cast("timestamp_ntz")


def kind():
    return F.split("p_type", " ")[0]


def flow_hours(spark: SparkSession, sf: str) -> DataFrame:
    """(site, flow, hour_idx, value): hourly counts of two flows a user; flow 1 is missing in hours with an error."""
    events = table(spark, sf, "events").where("user_id is not null")
    hour = F.floor((F.unix_timestamp("ts") - F.unix_timestamp(start())) / 3600).cast("int")
    counted = events.groupBy(F.col("user_id").alias("site"), hour.alias("hour_idx")).agg(
        F.count_if(F.col("event_type").isin("click", "view")).alias("f1"), F.count_if(F.col("event_type").isin("purchase", "signup")).alias("f2"), F.count_if(F.col("event_type") == "error").alias("bad")
    )
    grid = events.select(F.col("user_id").alias("site")).distinct().select("site", F.explode(F.sequence(F.lit(0), F.lit(HOURS - 1))).alias("hour_idx"))
    filled = grid.join(counted, ["site", "hour_idx"], "left").fillna(0, subset=["f1", "f2", "bad"])
    flows = F.array(F.struct(F.lit(1).alias("flow"), F.when(F.col("bad") == 0, F.col("f1").cast("double")).alias("value")), F.struct(F.lit(2).alias("flow"), F.col("f2").cast("double").alias("value")))
    return filled.select("site", "hour_idx", F.explode(flows).alias("x")).select("site", "x.flow", "hour_idx", "x.value")


def site_series(spark: SparkSession, sf: str) -> DataFrame:
    return S.site_hours(flow_hours(spark, sf)).withColumn("ts", F.timestamp_add("HOUR", F.col("hour_idx"), start()))


def _curve(spark, sf):
    arrays = profiles.as_array(profiles.daily(site_series(spark, sf)), profiles.DAY, "day")
    labels = arrays.select("site", (F.col("site") % 4).cast("int").alias("cluster"))
    return rounded(profiles.curves(arrays, labels, "day"), 9)


def _spectral(spark, sf):
    return profiles.spectral(site_series(spark, sf)).select("site", *[F.round(F.col("spectral")[i], 6).alias(f"s{i}") for i in range(5)])


def _flat(spark, sf):
    p = profiles.profiles(site_series(spark, sf), start())
    out = profiles.flat(profiles.from_flat(profiles.flat(p)))
    return out.select("site", *[F.round(c, 6).alias(c) for c in out.columns if c != "site"])


def _encode(spark, sf):
    v = table(spark, sf, "events").select("event_id", F.when(F.col("event_type") != "error", F.bround("value", 2)).alias("v"))
    return v.select("event_id", C.encode_flow(F.col("v")).alias("code")).withColumn("decoded", C.decode_flow(F.col("code")))


def _codes(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", C.pad_code(F.col("c_nationkey"), 2).alias("department"), C.pad_code(F.concat(F.lit(" "), F.col("c_custkey"), F.lit(".0 ")), 5).alias("code"), C.to_int(F.concat(F.lit(" "), F.col("c_acctbal").cast("string"))).alias("whole"), F.array_join(C.split_clean(F.concat(F.col("c_mktsegment"), F.lit(" / / "), F.col("c_nationkey"))), "|").alias("parts"))


def _tag_literals(spark, sf):
    raw = F.when(F.col("p_partkey") % 5 == 0, F.concat("p_size", F.lit(" mph"))).when(F.col("p_partkey") % 5 == 1, F.concat("p_size", F.lit(",5 m"))).when(F.col("p_partkey") % 5 == 2, "fr:urban").when(F.col("p_partkey") % 5 == 3, F.concat(F.lit("zone "), "p_size")).otherwise("walk")
    return rounded(table(spark, sf, "part").select("p_partkey", raw.alias("raw")).select("p_partkey", C.tag_number(F.col("raw")).alias("number"), C.first_digits(F.col("raw")).alias("digits")), 6)


#: Words of part names that stand for the kinds of street names in the test tables.
def _name():
    return F.concat_ws(" ", F.when(F.col("p_partkey") % 7 == 0, "Voie verte").when(F.col("p_partkey") % 7 == 1, "Piste").when(F.col("p_partkey") % 7 == 2, "Chemin").when(F.col("p_partkey") % 7 == 3, "Rue").when(F.col("p_partkey") % 7 == 4, "Route").when(F.col("p_partkey") % 7 == 5, "Quai"), F.lit("du,"), F.col("p_brand"))


_NAME_SQL = "concat_ws(' ', CASE p_partkey % 7 WHEN 0 THEN 'Voie verte' WHEN 1 THEN 'Piste' WHEN 2 THEN 'Chemin' WHEN 3 THEN 'Rue' WHEN 4 THEN 'Route' WHEN 5 THEN 'Quai' END, 'du,', p_brand)"


def _names(spark, sf):
    ref = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("EV "), "p_size")).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("D"), "p_size"))
    return table(spark, sf, "part").select("p_partkey", C.kind_of_name(_name()).alias("name_kind"), C.kind_of_reference(ref).alias("ref_kind"), C.street_name(_name()).alias("street"), F.coalesce(ref, _name()).alias("first_present"), C.count_present(ref, _name(), F.col("p_brand")).alias("n_present"))


def _roads(spark, sf):
    """Tag rows made from parts."""
    n = F.col("p_partkey")
    pick = lambda *v: F.get(F.array(*[F.lit(x).cast("string") for x in v]), F.pmod(n, F.lit(len(v))).cast("int"))
    return table(spark, sf, "part").select(n.alias("id"), pick("residential", "motorway", "cycleway", "tertiary", "track", "primary", None).alias("highway"), pick(None, "no", "yes", "designated", None).alias("bicycle"), pick(None, "private", None).alias("access"), pick(None, None, "lane", "track").alias("cycleway"), pick("asphalt", None, "gravel", None, "paved", None, None, None, None, None, None).alias("surface"), pick(None, "30", "50 ", "70", "80", None, "90", None, None, "20 mph", None, None, None).alias("maxspeed"))


_ROADS_SQL = "SELECT p_partkey AS id, ['residential','motorway','cycleway','tertiary','track','primary',NULL][1 + p_partkey % 7] AS highway, [NULL,'no','yes','designated',NULL][1 + p_partkey % 5] AS bicycle, [NULL,'private',NULL][1 + p_partkey % 3] AS access, [NULL,NULL,'lane','track'][1 + p_partkey % 4] AS cycleway, ['asphalt',NULL,'gravel',NULL,'paved',NULL,NULL,NULL,NULL,NULL,NULL][1 + p_partkey % 11] AS surface, [NULL,'30','50 ','70','80',NULL,'90',NULL,NULL,'20 mph',NULL,NULL,NULL][1 + p_partkey % 13] AS maxspeed FROM part"
_CLEAN_SQL = f"SELECT id, coalesce(highway, '') AS highway, coalesce(bicycle, '') AS bicycle, coalesce(access, '') AS access, coalesce(cycleway, '') AS cycleway, coalesce(surface, '') AS surface, try_cast(nullif(regexp_extract(maxspeed, '([0-9]+)', 1), '') AS INTEGER) AS speed FROM ({_ROADS_SQL})"


def _long_tags(spark, sf):
    part = table(spark, sf, "part")
    return part.select("p_partkey", F.explode(F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type"), F.lit("size"), F.col("p_size").cast("string"))).alias("key", "value"))


def _recode(spark, sf):
    vocab = {"p_type": ["ECONOMY", "SMALL", "PROMO"], "p_brand": ["Brand#11", "Brand#12", "Brand#13"]}
    return tags.recoded(table(spark, sf, "part").select("p_partkey", "p_type", "p_brand"), vocab)


_H = {k: v for k, v in zip(["ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD", "LARGE"], ["VOIE VERTE", "PISTE CYCLABLE", "BANDE CYCLABLE", "VELO RUE", "AUTRE", "AUCUN"], strict=True)}


def _kind_name(col):
    out = F.when(col == "ECONOMY", _H["ECONOMY"])
    for k, v in list(_H.items())[1:]:
        out = out.when(col == k, v)
    return out


def _principal(spark, sf):
    part = table(spark, sf, "part").withColumn("right", _kind_name(kind())).withColumn("left", F.when(F.col("p_size") % 3 == 0, "GOULOTTE").when(F.col("p_size") % 3 == 1, "PISTE CYCLABLE"))
    return tags.principal_types(part.select("p_partkey", "right", "left"), "right", "left").select("p_partkey", "principal", "dedicated")


def _pieces(spark, sf):
    """Network pieces by zone, summed by part before zones are joined."""
    line = table(spark, sf, "lineitem").groupBy("l_partkey", "l_returnflag", "l_linestatus").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("price"))
    direction = F.when(F.col("l_returnflag") == "R", DIRECTIONS["R"]).when(F.col("l_returnflag") == "A", DIRECTIONS["A"]).otherwise(DIRECTIONS["N"])
    part = table(spark, sf, "part").select("p_partkey", X.zone_of().alias("zone"), _kind_name(kind()).alias("type"))
    return line.join(part, line["l_partkey"] == part["p_partkey"]).select(F.col("p_partkey").alias("way"), "zone", F.when(F.col("l_linestatus") == "F", "d").otherwise("g").alias("side"), (F.col("price") / 10000.0).alias("km"), direction.alias("direction"), "type")


_PIECES_SQL = f"""SELECT p_partkey AS way, {ZONE} AS zone, CASE WHEN l_linestatus = 'F' THEN 'd' ELSE 'g' END AS side, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE / 10000.0 AS km, l_returnflag <> 'N' AS bidirectional, l_returnflag,
 CASE split_part(any_value(p_type), ' ', 1) {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _H.items())} END AS type FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_partkey, p_brand, p_size, l_returnflag, l_linestatus"""


def _two_sided(spark, sf):
    line = table(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum(F.col("l_quantity")).alias("q"))
    return rounded(tags.two_sided_lengths(line.select((F.col("l_partkey") % 50).alias("zone_d"), (F.col("l_suppkey") % 50).alias("zone_g"), F.col("q").alias("km_d"), (F.col("q") * 2).alias("km_g"))))


def _routes(spark, sf):
    net = F.element_at(F.array(*[F.lit(x) for x in ("lcn", "rcn", "ncn", "icn", "other")]), (F.col("l_linenumber") % 5 + 1).cast("int"))
    members = table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("way"), net.alias("network"))
    return tags.route_ranks(members, table(spark, sf, "part").select(F.col("p_partkey").alias("way")))


def _way_totals(spark, sf):
    pieces = _pieces(spark, sf)
    ways = table(spark, sf, "part").select(F.col("p_partkey").alias("way"), (F.col("p_retailprice") / 100).alias("km"))
    return rounded(tags.way_totals(pieces, ways), 6)


def _families(spark, sf):
    return rounded(tags.family_shares(_pieces(spark, sf), tags.family_of(F.col("type")), "km"))


def _key_usage(spark, sf):
    maps = _roads(spark, sf).select(F.map_filter(F.create_map(*[x for k in ("highway", "bicycle", "access", "cycleway") for x in (F.lit(k), F.col(k))]), lambda k, v: v.isNotNull()).alias("tags"))
    return tags.key_usage(maps)


def _fold(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", C.fold_of(F.col("o_orderkey")).alias("fold"))


def _points(df, key, lat="lat", lon="lon"):
    return (F.lit(42.0) + (F.col(key) % 800) / 100.0).alias(lat), (F.lit(-4.0) + ((F.col(key) * 7) % 1100) / 100.0).alias(lon)


def _nearest(spark, sf):
    customer = table(spark, sf, "customer")
    points = customer.select(F.col("c_custkey").alias("id"), *_points(customer, "c_custkey"))
    supplier = table(spark, sf, "supplier")
    sites = supplier.select(F.col("s_suppkey").alias("site"), *_points(supplier, "s_suppkey", "slat", "slon"))
    return rounded(spatial.nearest_on_sphere(points, sites), 3)


def _components(spark, sf):
    nation = table(spark, sf, "nation")
    nodes = nation.select(F.col("n_nationkey").alias("node"))
    edges = nation.where("n_nationkey % 3 <> 0").select(F.col("n_nationkey").alias("a"), F.col("n_regionkey").alias("b"))
    return spatial.components(nodes, edges)


def _squares(spark, sf):
    """A grid of unit squares of 1000 m, one a nation."""
    i, j = F.col("n_nationkey") % 5, F.floor(F.col("n_nationkey") / 5)
    corner = lambda a, b: F.struct(((i + a) * 1000.0).alias("x"), ((j + b) * 1000.0).alias("y"))
    return table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("polygon"), F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1)).alias("ring"))


def _in_polygon(spark, sf):
    points = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), ((F.col("c_custkey") * 37) % 5500 + 0.5).cast("double").alias("x"), ((F.col("c_custkey") * 91) % 5200 + 0.5).cast("double").alias("y"))
    return spatial.points_in_polygons(points, _squares(spark, sf), 1500.0)


def _clip(spark, sf):
    k = F.col("s_suppkey")
    segments = table(spark, sf, "supplier").select(k.alias("line"), ((k * 37) % 5000 + 0.5).cast("double").alias("ax"), ((k * 91) % 5000 + 0.25).cast("double").alias("ay"), ((k * 53) % 5000 + 0.5).cast("double").alias("bx"), ((k * 91) % 5000 + 0.25).cast("double").alias("by"))
    return rounded(spatial.clip_lengths(segments, _squares(spark, sf), 1500.0), 4)


_CLIP_SQL = """SELECT line, polygon, round(length_m::DOUBLE, 4) AS length_m, round(length_m / nullif(abs(bx - ax), 0), 4) AS part FROM (
 SELECT s_suppkey AS line, n_nationkey::BIGINT AS polygon, ax, bx, greatest(0, least(greatest(ax, bx), (n_nationkey % 5 + 1) * 1000.0) - greatest(least(ax, bx), (n_nationkey % 5) * 1000.0)) AS length_m
 FROM (SELECT s_suppkey, (s_suppkey * 37) % 5000 + 0.5 AS ax, (s_suppkey * 53) % 5000 + 0.5 AS bx, (s_suppkey * 91) % 5000 + 0.25 AS y FROM supplier) JOIN nation ON n_nationkey // 5 = floor(y / 1000)) WHERE length_m > 0.01"""


def _area(spark, sf):
    lat, lon = F.lit(44.0) + F.col("n_nationkey") / 10.0, F.col("n_nationkey") / 5.0
    corner = lambda a, b: C.lambert93(lat + a * 0.1, lon + b * 0.1)
    ring = F.array(corner(0, 0), corner(0, 1), corner(1, 1), corner(1, 0))
    made = table(spark, sf, "nation").select("n_nationkey", ring.alias("ring")).withColumn("c", C.ring_centroid(F.col("ring")))
    return rounded(made.select("n_nationkey", (C.ring_area(F.col("ring")) / 1e6).alias("area_km2"), F.col("ring")[0]["x"].alias("x0"), F.col("ring")[0]["y"].alias("y0"), F.col("c.x").alias("cx"), F.col("c.y").alias("cy")), 3)


_L93 = lambda lat, lon: (
    f"(700000.0 + 11754255.4261 * exp(-0.7256077650532670 * (ln(tan(pi() / 4 + radians({lat}) / 2)) - 0.0818191910428158 / 2 * ln((1 + 0.0818191910428158 * sin(radians({lat}))) / (1 - 0.0818191910428158 * sin(radians({lat})))))) * sin(0.7256077650532670 * radians({lon} - 3.0)))",
    f"(12655612.0499 - 11754255.4261 * exp(-0.7256077650532670 * (ln(tan(pi() / 4 + radians({lat}) / 2)) - 0.0818191910428158 / 2 * ln((1 + 0.0818191910428158 * sin(radians({lat}))) / (1 - 0.0818191910428158 * sin(radians({lat})))))) * cos(0.7256077650532670 * radians({lon} - 3.0)))",
)


def _area_sql() -> str:
    corners = [(0, 0), (0, 1), (1, 1), (1, 0)]
    points = [_L93(f"(44.0 + n_nationkey / 10.0 + {a} * 0.1)", f"(n_nationkey / 5.0 + {b} * 0.1)") for a, b in corners]
    inner = ", ".join(f"{x} AS x{i}, {y} AS y{i}" for i, (x, y) in enumerate(points))
    w = [f"(x{i} * y{(i + 1) % 4} - x{(i + 1) % 4} * y{i})" for i in range(4)]
    mx, my = [" + ".join(f"{w[i]} * ({v}{i} + {v}{(i + 1) % 4})" for i in range(4)) for v in "xy"]
    return f"SELECT n_nationkey, round(abs({' + '.join(w)}) / 2 / 1e6, 3) AS area_km2, round(x0, 3) AS x0, round(y0, 3) AS y0, round(({mx}) / (3 * ({' + '.join(w)})), 3) AS cx, round(({my}) / (3 * ({' + '.join(w)})), 3) AS cy FROM (SELECT n_nationkey, {inner} FROM nation)"


def _zonal(spark, sf):
    cells = table(spark, sf, "customer").select(F.col("c_nationkey").alias("zone"), F.col("c_acctbal").alias("value"))
    return rounded(spatial.zonal_statistics(cells), 4)


def _training(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    rows = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).where("c_acctbal > 0").dropna(subset=["c_mktsegment"])
    return rounded(S.inverse_frequency(rows.select("c_custkey", "c_nationkey", F.col("n_regionkey").alias("label"), "c_acctbal"), "c_nationkey"), 9)


def _headcount(spark, sf):
    c = table(spark, sf, "customer")
    out = c.groupBy(F.col("c_mktsegment").alias("cluster")).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("c_nationkey").alias("n_zones"))
    return out.withColumn("rare", F.col("n_zones") < 10)


def _inclusion(spark, sf):
    labels, docs = table(spark, sf, "labels"), table(spark, sf, "documents").select("doc_id", "n_chars")
    return rounded(tags.confusion(labels.join(docs, "doc_id"), F.col("quality") == 1, F.col("n_chars") >= 500), 9)


def _lookup(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size", kind().alias("kind"))
    return tags.lookup_baseline(part, ["p_brand", "p_size"], "kind", C.fold_of(F.col("p_partkey")) != 0, "NONE").select("p_partkey", "kind", "guess")


def _markers(spark, sf):
    c = table(spark, sf, "customer")
    at = c.select("c_custkey", "c_nationkey", *_points(c, "c_custkey"))
    return at.groupBy(F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon")).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"))), ",").alias("nations"))


def _derived(spark, sf):
    c = table(spark, sf, "customer")
    coast, height = F.when(F.col("c_custkey") % 4 != 0, F.col("c_custkey") % 60), F.col("c_nationkey") * 20
    out = c.select("c_custkey", F.try_divide("c_acctbal", F.col("c_nationkey")).alias("density"), F.log1p(F.abs("c_acctbal")).alias("log_balance"), F.coalesce(coast < 20, F.lit(False)).cast("int").alias("near_coast"), (height > 200).cast("int").alias("mountainous"), F.bround(F.abs("c_acctbal") / 50, 0).alias("half_even"))
    return rounded(out, 9)


def _box(spark, sf):
    c = table(spark, sf, "supplier")
    at = c.select("s_suppkey", *_points(c, "s_suppkey")).withColumn("b", C.bbox_around(F.col("lat"), F.col("lon"), 15.0))
    return rounded(at.select("s_suppkey", "b.south", "b.west", "b.north", "b.east", C.chord_km(C.unit_vector(F.col("lat"), F.col("lon")), C.unit_vector(F.lit(46.0), F.lit(2.0))).alias("km")), 6)


def _lines(spark, sf):
    """Length and middle point of each customer's line through its orders' points."""
    o = table(spark, sf, "orders")
    p = F.struct((F.lit(42.0) + (F.col("o_orderkey") % 800) / 100.0).alias("lat"), (F.lit(-4.0) + (F.col("o_orderkey") * 7 % 1100) / 100.0).alias("lon"))
    lines = o.groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", p.alias("p")))), lambda x: x["p"]).alias("points"))
    mid = C.middle_point(F.col("points"))
    return rounded(lines.select("o_custkey", F.size("points").alias("n_points"), C.polyline_length_m(F.col("points")).alias("metres"), mid["lat"].alias("lat"), mid["lon"].alias("lon")), 3)


def _cities(spark, sf):
    codes = table(spark, sf, "supplier").select(C.pad_code((F.col("s_suppkey") * 7 + 69300), 5).alias("zone")).distinct()
    return assembly.expand_cities(codes, assembly.city_members(assembly.DISTRICT_CITIES, spark))


def _top(spark, sf):
    line = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(-F.col("l_quantity"))).alias("gap"))
    return S.top_n(line, [F.desc("gap"), F.asc("l_partkey")], 20)


def _standard(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return rounded(profiles.standardised(c, ["c_acctbal"]), 6)


def _road_spread(spark, sf):
    k = F.col("id")
    at = ((k * 37) % 3000).cast("double")
    roads = C.road_status(_roads(spark, sf)).select(k, F.concat(F.lit("Street, "), (k % 40).cast("string")).alias("name"), "highway", "status", at.alias("x0"), (at + 20).alias("x1"), at.alias("y0"), (at + 20).alias("y1"))
    return spatial.propagate_status(roads, 100.0).select("id", "name", "status")


def queries():
    return {
        "hourly_site_sum": lambda s, d: S.site_hours(flow_hours(s, d)).where("value is null or value > 0"),
        "profile_daily": lambda s, d: rounded(profiles.daily(site_series(s, d)), 9),
        "profile_weekly": lambda s, d: rounded(profiles.weekly(site_series(s, d)).where("mean > 0"), 9),
        "profile_annual": lambda s, d: rounded(profiles.annual(site_series(s, d), start()), 9),
        "profile_spectral": _spectral,
        "profile_flat_round_trip": _flat,
        "profile_norm_curve": _curve,
        "encode_decode_flow": _encode,
        "code_normalise": _codes,
        "tag_number": _tag_literals,
        "name_kind": _names,
        "rule_filter": lambda s, d: C.road_status(_roads(s, d)).select("id", "status"),
        "road_status_spread": _road_spread,
        "vocab_spec": lambda s, d: tags.vocabulary(_long_tags(s, d)),
        "vocab_recode": _recode,
        "principal_type": _principal,
        "effective_length": lambda s, d: rounded(tags.effective_lengths(_pieces(s, d)), 6),
        "two_sided_lengths": _two_sided,
        "route_ranks": _routes,
        "way_totals": _way_totals,
        "family_shares": _families,
        "run_statistics": lambda s, d: rounded(tags.run_statistics(_pieces(s, d)), 4),
        "key_usage": _key_usage,
        "fold_hash": _fold,
        "haversine_nearest": _nearest,
        "bbox_and_chord": _box,
        "polyline_length": _lines,
        "connected_components": _components,
        "point_in_polygon": _in_polygon,
        "clip_length": _clip,
        "lambert93_area": _area,
        "zonal_statistics": _zonal,
        "latest_per_key": lambda s, d: S.latest_per_key(table(s, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"), ["o_custkey"], ["o_orderdate", "o_orderkey"]),
        "first_per_key": lambda s, d: S.first_per_key(table(s, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"), ["o_custkey"], ["o_orderdate", "o_orderkey"]),
        "top_n_gap": _top,
        "training_set": _training,
        "cluster_headcount": _headcount,
        "inclusion_metrics": _inclusion,
        "lookup_baseline": _lookup,
        "marker_groups": _markers,
        "derived_columns": _derived,
        "city_expansion": _cities,
        "standardised": _standard,
        "integrity_report": Q.integrity_report,
    }


_FLOWS = """users AS (SELECT DISTINCT user_id AS site FROM events WHERE user_id IS NOT NULL),
counted AS (SELECT user_id AS site, floor(epoch(ts - TIMESTAMP '2024-01-01') / 3600)::INTEGER AS hour_idx, count(*) FILTER (WHERE event_type IN ('click', 'view')) AS f1, count(*) FILTER (WHERE event_type IN ('purchase', 'signup')) AS f2, count(*) FILTER (WHERE event_type = 'error') AS bad FROM events GROUP BY ALL),
series AS (SELECT site, h::INTEGER AS hour_idx, TIMESTAMP '2024-01-01' + h * INTERVAL 1 HOUR AS ts, CASE WHEN coalesce(bad, 0) = 0 THEN (coalesce(f1, 0) + coalesce(f2, 0))::DOUBLE END AS value FROM users CROSS JOIN range(0, 720) AS g(h) LEFT JOIN counted ON counted.site = users.site AND counted.hour_idx = h)""".replace("SELECT site, h::INTEGER", "SELECT users.site, h::INTEGER")


def _spectral_sql() -> str:
    """Energy of every frequency by its definition, its shares at the periods' nearest frequencies, and their entropy; put after _FLOWS."""
    bins = [min(range(HOURS // 2 + 1), key=lambda k, p=p: abs(k / HOURS - 1 / p)) for p in profiles.PERIODS]
    return f""", centred AS (SELECT site, hour_idx, coalesce(value, 0) - avg(coalesce(value, 0)) OVER (PARTITION BY site) AS v FROM series),
energy AS (SELECT site, k, pow(sum(v * cos(2 * pi() * k * hour_idx / {HOURS})), 2) + pow(sum(v * sin(2 * pi() * k * hour_idx / {HOURS})), 2) AS e FROM centred CROSS JOIN range(0, {HOURS // 2 + 1}) AS g(k) GROUP BY ALL),
shares AS (SELECT site, k, e / (sum(e) OVER (PARTITION BY site) + 1e-12) AS share FROM energy),
spectra AS (SELECT site, {', '.join(f"round(max(share) FILTER (WHERE k = {k}), 6) AS s{i}" for i, k in enumerate(bins))}, round(-sum(share * ln(share + 1e-12)), 6) AS s{len(bins)} FROM shares GROUP BY site)"""


def _flat_sql() -> str:
    blocks = (("d", profiles.DAY, 2, "hour(ts)::INTEGER"), ("h", profiles.WEEK, 3, "((isodow(ts) - 1) * 24 + hour(ts))::INTEGER"), ("y", profiles.YEAR, 2, "(hour_idx // 168)::INTEGER"))
    means = ", ".join(f"m{p} AS (SELECT site, {pos} AS pos, sum(coalesce(value, 0)) / count(*) AS mean FROM series WHERE {pos} < {n} GROUP BY ALL)" for p, n, _, pos in blocks)
    wide = ", ".join(f"w{p} AS (SELECT site, {', '.join(f'round(coalesce(max(mean) FILTER (WHERE pos = {i}), 0), 6) AS {p}{i:0{w}d}' for i in range(n))} FROM m{p} GROUP BY site)" for p, n, w, _ in blocks)
    return f"WITH {_FLOWS}{_spectral_sql()}, {means}, {wide} SELECT * FROM wd JOIN wh USING (site) JOIN wy USING (site) JOIN spectra USING (site)"


def oracle_sql():
    means = lambda pos, size: f"WITH {_FLOWS} SELECT site, {pos} AS pos, round(sum(coalesce(value, 0)) / count(*), 9) AS mean FROM series WHERE {pos} < {size} GROUP BY ALL"
    hav = "2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin((radians({b}) - radians({a})) / 2), 2) + cos(radians({a})) * cos(radians({b})) * pow(sin((radians({d}) - radians({c})) / 2), 2))))"
    part_kind = "split_part(p_type, ' ', 1)"
    eff = "sum(CASE WHEN {c} THEN km * CASE WHEN bidirectional THEN 2.0 ELSE 1.0 END ELSE 0 END)"
    raw = "CASE p_partkey % 5 WHEN 0 THEN p_size || ' mph' WHEN 1 THEN p_size || ',5 m' WHEN 2 THEN 'fr:urban' WHEN 3 THEN 'zone ' || p_size ELSE 'walk' END"
    rank = " ".join(f"WHEN '{h}' THEN {i + 1}" for i, h in enumerate(tags.HIERARCHY))
    best = lambda order: f"SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate {order}, o_orderkey {order}) = 1"
    kinds = " ".join(f"WHEN regexp_matches(lower(n), '{p}') THEN {k}" for k, p in C.NAME_KINDS)
    rules = " ".join(f"WHEN {c} THEN '{s}'" for s, c in C.ROAD_RULES)
    some = f"({spatial.LOCAL_ROADS[1:-1]}, {spatial.COLLECTOR_ROADS[1:-1]})"
    fits = f"q.highway = r.highway OR 'cycleway' IN (q.highway, r.highway) OR q.highway IN {some} AND r.highway IN {some}"
    families = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in tags.FAMILIES.items())
    return {
        "hourly_site_sum": f"WITH {_FLOWS} SELECT site, hour_idx, value FROM series WHERE value IS NULL OR value > 0",
        "profile_daily": means("hour(ts)::INTEGER", 24),
        "profile_weekly": "SELECT * FROM (" + means("((isodow(ts) - 1) * 24 + hour(ts))::INTEGER", 168) + ") WHERE mean > 0",
        "profile_annual": means("(hour_idx // 168)::INTEGER", 52),
        "profile_spectral": f"WITH {_FLOWS}{_spectral_sql()} SELECT * FROM spectra",
        "profile_flat_round_trip": _flat_sql(),
        "profile_norm_curve": f"WITH {_FLOWS}, means AS (SELECT site, hour(ts)::INTEGER AS pos, sum(coalesce(value, 0)) / count(*) AS mean FROM series GROUP BY ALL), normed AS (SELECT site, pos, mean / CASE WHEN sqrt(sum(mean * mean) OVER (PARTITION BY site)) > 1e-12 THEN sqrt(sum(mean * mean) OVER (PARTITION BY site)) ELSE 1.0 END AS value FROM means) SELECT (site % 4)::INTEGER AS cluster, pos, round(avg(value), 9) AS mean, round(stddev_pop(value), 9) AS deviation FROM normed GROUP BY ALL",
        "encode_decode_flow": "SELECT event_id, CASE WHEN event_type = 'error' OR value IS NULL THEN 65535 ELSE round_even(round_even(value, 2) * 100, 0)::INTEGER END AS code, CASE WHEN event_type = 'error' OR value IS NULL THEN NULL ELSE round_even(round_even(value, 2) * 100, 0)::INTEGER / 100.0 END AS decoded FROM events",
        "code_normalise": "SELECT c_custkey, lpad(c_nationkey::VARCHAR, 2, '0') AS department, CASE WHEN length(c_custkey::VARCHAR) >= 5 THEN c_custkey::VARCHAR ELSE lpad(c_custkey::VARCHAR, 5, '0') END AS code, trunc(c_acctbal)::BIGINT AS whole, c_mktsegment || '|' || c_nationkey AS parts FROM customer",
        "tag_number": f"SELECT p_partkey, round(CASE raw WHEN 'walk' THEN 7.0 WHEN 'fr:urban' THEN 50.0 ELSE try_cast(nullif(regexp_extract(replace(raw, ',', '.'), '^(-?[0-9]+(\\.[0-9]+)?)', 1), '') AS DOUBLE) * CASE WHEN contains(raw, 'mph') THEN 1.609 ELSE 1 END END, 6) AS number, try_cast(nullif(regexp_extract(raw, '([0-9]+)', 1), '') AS INTEGER) AS digits FROM (SELECT p_partkey, {raw} AS raw FROM part)",
        "name_kind": f"SELECT p_partkey, CASE WHEN coalesce(n, '') = '' THEN 0 {kinds} ELSE 6 END AS name_kind, CASE WHEN ref IS NULL THEN 0 WHEN regexp_matches(ref, '(?i)^(eurovelo|ev|v)\\s*[0-9]+') THEN 1 ELSE 2 END AS ref_kind, trim(regexp_replace(regexp_replace(lower(n), '[,.]+', '', 'g'), '\\s+', ' ', 'g')) AS street, coalesce(ref, n) AS first_present, (ref IS NOT NULL)::INTEGER + 1 + (p_brand IS NOT NULL)::INTEGER AS n_present FROM (SELECT p_partkey, p_brand, {_NAME_SQL} AS n, CASE p_partkey % 3 WHEN 0 THEN 'EV ' || p_size WHEN 1 THEN 'D' || p_size END AS ref FROM part)",
        "rule_filter": f"SELECT id, CASE {rules} ELSE '{C.UNCERTAIN}' END AS status FROM ({_CLEAN_SQL})",
        "road_status_spread": f"WITH r0 AS (SELECT id, 'Street, ' || id % 40 AS name, highway, CASE {rules} ELSE '{C.UNCERTAIN}' END AS status, ((id * 37) % 3000)::DOUBLE AS x0 FROM ({_CLEAN_SQL})), "
        + ", ".join(f"r{k} AS (SELECT r.id, r.name, r.highway, CASE WHEN r.status = '{C.UNCERTAIN}' AND r.highway NOT IN {C.FAST} AND EXISTS (SELECT 1 FROM r{k - 1} q WHERE q.name = r.name AND q.status = '{C.YES}' AND abs(q.x0 - r.x0) <= 25 AND ({fits})) THEN '{C.YES}' ELSE r.status END AS status, r.x0 FROM r{k - 1} r)" for k in (1, 2))
        + " SELECT id, name, status FROM r2",
        "vocab_spec": "SELECT key, value, n, rank FROM (SELECT key, value, count(*) AS n, row_number() OVER (PARTITION BY key ORDER BY count(*) DESC, value)::INTEGER AS rank FROM (SELECT 'brand' AS key, p_brand AS value FROM part UNION ALL SELECT 'type', p_type FROM part UNION ALL SELECT 'size', p_size::VARCHAR FROM part) GROUP BY key, value HAVING count(*) >= 20) WHERE rank <= 250",
        "vocab_recode": "SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'SMALL', 'PROMO') THEN p_type WHEN p_type IS NOT NULL THEN '(autre)' END AS p_type, CASE WHEN p_brand IN ('Brand#11', 'Brand#12', 'Brand#13') THEN p_brand WHEN p_brand IS NOT NULL THEN '(autre)' END AS p_brand FROM part",
        "principal_type": f"SELECT p_partkey, principal, principal NOT IN ('AUTRE', 'AUCUN', 'NON_RENSEIGNE') AS dedicated FROM (SELECT p_partkey, CASE WHEN CASE r {rank} END <= coalesce(CASE l {rank} END, 15) THEN r ELSE coalesce(l, 'NON_RENSEIGNE') END AS principal FROM (SELECT p_partkey, CASE {part_kind} {' '.join(chr(87) + f'HEN {chr(39)}{k}{chr(39)} THEN {chr(39)}{v}{chr(39)}' for k, v in _H.items())} END AS r, CASE p_size % 3 WHEN 0 THEN 'GOULOTTE' WHEN 1 THEN 'PISTE CYCLABLE' END AS l FROM part))",
        "effective_length": f"SELECT zone, {', '.join('round(' + eff.format(c=c) + ', 6) AS ' + n for c, n in (('side = ' + chr(39) + 'd' + chr(39), 'len_d'), ('side = ' + chr(39) + 'g' + chr(39), 'len_g'), ('side = ' + chr(39) + 'd' + chr(39) + ' AND type NOT IN (' + chr(39) + 'AUTRE' + chr(39) + ',' + chr(39) + 'AUCUN' + chr(39) + ')', 'len_d_dedicated'), ('side = ' + chr(39) + 'g' + chr(39) + ' AND type NOT IN (' + chr(39) + 'AUTRE' + chr(39) + ',' + chr(39) + 'AUCUN' + chr(39) + ')', 'len_g_dedicated')))} FROM ({_PIECES_SQL}) GROUP BY zone",
        "two_sided_lengths": "SELECT zone, sum(d) AS len_d, sum(g) AS len_g FROM (SELECT l_partkey % 50 AS zone, l_quantity AS d, 0.0 AS g FROM lineitem UNION ALL SELECT l_suppkey % 50, 0.0, l_quantity * 2 FROM lineitem) GROUP BY zone",
        "route_ranks": "SELECT p_partkey AS way, coalesce(max(CASE l_linenumber % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN 0 END), -1)::INTEGER AS rank, count(l_partkey) AS n_routes FROM part LEFT JOIN lineitem ON l_partkey = p_partkey AND l_quantity > 45 GROUP BY p_partkey",
        "way_totals": f"SELECT p_partkey AS way, round(coalesce(km, 0), 6) AS inside_km, coalesce(n, 0) AS n_zones, round(greatest(p_retailprice / 100 - coalesce(km, 0), 0), 6) AS outside_km FROM part LEFT JOIN (SELECT way, sum(km) AS km, count(DISTINCT zone) AS n FROM ({_PIECES_SQL}) GROUP BY way) ON way = p_partkey",
        "family_shares": f"SELECT family, count(*) AS n, round(sum(km), 4) AS km, round(sum(km) / sum(sum(km)) OVER (), 4) AS share FROM (SELECT *, CASE type {families} END AS family FROM ({_PIECES_SQL})) WHERE family IS NOT NULL GROUP BY family",
        "run_statistics": f"SELECT count(*) AS n_candidates, count(*) FILTER (WHERE km > 0) AS n_kept, round(sum(km), 4) AS km, count(DISTINCT zone) AS n_zones FROM ({_PIECES_SQL})",
        "key_usage": f"WITH r AS ({_ROADS_SQL}) " + " UNION ALL ".join(f"SELECT '{k}' AS key, count({k}) AS n FROM r" for k in ("highway", "bicycle", "access", "cycleway")),
        "fold_hash": "SELECT o_orderkey, ((o_orderkey::HUGEINT * 2654435761 % 18446744073709551616) // 128 % 5)::INTEGER AS fold FROM orders",
        "haversine_nearest": f"SELECT id, site, round(metres, 3) AS metres FROM (SELECT c_custkey AS id, s_suppkey AS site, round({hav.format(a='42.0 + (c_custkey % 800) / 100.0', b='42.0 + (s_suppkey % 800) / 100.0', c='-4.0 + (c_custkey * 7 % 1100) / 100.0', d='-4.0 + (s_suppkey * 7 % 1100) / 100.0')}, 6) AS metres FROM customer CROSS JOIN supplier) QUALIFY row_number() OVER (PARTITION BY id ORDER BY metres, site) = 1",
        "bbox_and_chord": "SELECT s_suppkey, round(lat - 15 / 111.0, 6) AS south, round(lon - 15 / (111.0 * cos(radians(lat))), 6) AS west, round(lat + 15 / 111.0, 6) AS north, round(lon + 15 / (111.0 * cos(radians(lat))), 6) AS east, round(2 * 6371.0 * asin(least(1.0, sqrt(pow(cos(radians(lat)) * cos(radians(lon)) - cos(radians(46.0)) * cos(radians(2.0)), 2) + pow(cos(radians(lat)) * sin(radians(lon)) - cos(radians(46.0)) * sin(radians(2.0)), 2) + pow(sin(radians(lat)) - sin(radians(46.0)), 2)) / 2)), 6) AS km FROM (SELECT s_suppkey, 42.0 + (s_suppkey % 800) / 100.0 AS lat, -4.0 + (s_suppkey * 7 % 1100) / 100.0 AS lon FROM supplier)",
        "polyline_length": f"WITH p AS (SELECT o_custkey, o_orderkey, 42.0 + (o_orderkey % 800) / 100.0 AS y1, -4.0 + (o_orderkey * 7 % 1100) / 100.0 AS x1, row_number() OVER w AS i, lead(42.0 + (o_orderkey % 800) / 100.0) OVER w AS y2, lead(-4.0 + (o_orderkey * 7 % 1100) / 100.0) OVER w AS x2, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)) SELECT o_custkey, count(*)::INTEGER AS n_points, round(CASE WHEN count(*) >= 2 THEN sum({hav.format(a='y1', b='y2', c='x1', d='x2')}) FILTER (WHERE y2 IS NOT NULL) END, 3) AS metres, round(max(CASE WHEN n >= 2 AND i = n // 2 + 1 THEN y1 END), 3) AS lat, round(max(CASE WHEN n >= 2 AND i = n // 2 + 1 THEN x1 END), 3) AS lon FROM p GROUP BY o_custkey",
        "connected_components": "WITH RECURSIVE e AS (SELECT n_nationkey AS a, n_regionkey AS b FROM nation WHERE n_nationkey % 3 <> 0 UNION SELECT n_regionkey, n_nationkey FROM nation WHERE n_nationkey % 3 <> 0), r AS (SELECT n_nationkey AS node, n_nationkey AS seen FROM nation UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen) SELECT node, min(seen) AS component FROM r GROUP BY node",
        "point_in_polygon": "SELECT id, x, y, CASE WHEN x < 5000 AND y < 5000 THEN (floor(x / 1000) + 5 * floor(y / 1000))::BIGINT END AS polygon FROM (SELECT c_custkey AS id, ((c_custkey * 37) % 5500 + 0.5)::DOUBLE AS x, ((c_custkey * 91) % 5200 + 0.5)::DOUBLE AS y FROM customer)",
        "clip_length": _CLIP_SQL,
        "lambert93_area": _area_sql(),
        "zonal_statistics": "SELECT c_nationkey AS zone, round(min(c_acctbal), 4) AS min, round(max(c_acctbal), 4) AS max, round(avg(c_acctbal), 4) AS mean, round(median(c_acctbal), 4) AS median, round(stddev_pop(c_acctbal), 4) AS std, round(max(c_acctbal) - min(c_acctbal), 4) AS range, count(c_acctbal) AS count FROM customer GROUP BY 1",
        "latest_per_key": best("DESC"),
        "first_per_key": best("ASC"),
        "top_n_gap": "SELECT l_partkey, sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE -l_quantity END) AS gap FROM lineitem GROUP BY 1 ORDER BY gap DESC, l_partkey LIMIT 20",
        "training_set": "SELECT c_custkey, c_nationkey, n_regionkey AS label, round(c_acctbal, 9) AS c_acctbal, round(1.0 / count(*) OVER (PARTITION BY c_nationkey), 9) AS weight FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0 AND c_mktsegment IS NOT NULL",
        "cluster_headcount": "SELECT c_mktsegment AS cluster, count(*) AS n_rows, count(DISTINCT c_nationkey) AS n_zones, count(DISTINCT c_nationkey) < 10 AS rare FROM customer GROUP BY 1",
        "inclusion_metrics": "SELECT tp, fp, fn, tn, round(tp / greatest(tp + fp, 1), 9) AS precision, round(tp / greatest(tp + fn, 1), 9) AS recall, round(coalesce(2 * (tp / greatest(tp + fp, 1)) * (tp / greatest(tp + fn, 1)) / nullif(tp / greatest(tp + fp, 1) + tp / greatest(tp + fn, 1), 0), 0), 9) AS f1 FROM (SELECT count(*) FILTER (WHERE quality = 1 AND n_chars >= 500) AS tp, count(*) FILTER (WHERE quality <> 1 AND n_chars >= 500) AS fp, count(*) FILTER (WHERE quality = 1 AND n_chars < 500) AS fn, count(*) FILTER (WHERE quality <> 1 AND n_chars < 500) AS tn FROM labels JOIN documents USING (doc_id))",
        "lookup_baseline": f"WITH p AS (SELECT p_partkey, p_brand, p_size, {part_kind} AS kind, (p_partkey::HUGEINT * 2654435761 % 18446744073709551616) // 128 % 5 AS fold FROM part), m AS (SELECT p_brand, p_size, kind AS guess FROM p WHERE fold <> 0 GROUP BY p_brand, p_size, kind QUALIFY row_number() OVER (PARTITION BY p_brand, p_size ORDER BY count(*) DESC, kind) = 1) SELECT p_partkey, kind, coalesce(guess, 'NONE') AS guess FROM p LEFT JOIN m USING (p_brand, p_size) WHERE fold = 0",
        "marker_groups": "SELECT round(42.0 + (c_custkey % 800) / 100.0, 6) AS lat, round(-4.0 + (c_custkey * 7 % 1100) / 100.0, 6) AS lon, count(*) AS n, array_to_string(list_sort(list(DISTINCT lpad(c_nationkey::VARCHAR, 2, '0'))), ',') AS nations FROM customer GROUP BY 1, 2",
        "derived_columns": "SELECT c_custkey, round(c_acctbal / nullif(c_nationkey, 0), 9) AS density, round(ln(1 + abs(c_acctbal)), 9) AS log_balance, coalesce(CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 60 END < 20, false)::INTEGER AS near_coast, (c_nationkey * 20 > 200)::INTEGER AS mountainous, round_even(abs(c_acctbal) / 50, 0) AS half_even FROM customer",
        "city_expansion": "WITH codes AS (SELECT DISTINCT (s_suppkey * 7 + 69300)::VARCHAR AS zone FROM supplier), m AS (" + " UNION ALL ".join(f"SELECT any_code, district FROM (SELECT unnest({[*d, *p]}) AS any_code), (SELECT unnest({d}) AS district)" for d, p in assembly.DISTRICT_CITIES) + ") SELECT zone FROM codes UNION SELECT district FROM m JOIN codes ON any_code = zone",
        "standardised": "SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal FROM customer",
        "integrity_report": Q.INTEGRITY_SQL,
    }
