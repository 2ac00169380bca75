"""Queries of readers, joins over zones, geometry and tag features, with their SQL."""

from __future__ import annotations

import struct
import zlib
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroad.functions import scalars as C
from tallyroad.operators import assembly, checks, indicators, sensors, spatial, tags
from tallyroad.sources import fixtures as X
from tallyroad.sources import binary, readers
from tallyroad.sources.fixtures import table
from tallyroad.sources.scratch import scratch_path


def _written(spark: SparkSession, df: DataFrame, kind: str, **options: str) -> str:
    """Write a table in another format to the shared scratch folder, for a reader to read."""
    path = scratch_path(spark, f"{uuid4().hex}.{kind}")
    df.write.format(kind).options(**options).save(path)
    return path


# ---- readers


def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Codes written with leading zeros to a semicolon-separated file stay text when read."""
    c = table(spark, sf, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("code"), "c_mktsegment", "c_acctbal")
    path = _written(spark, c, "csv", header="true", sep=";")
    read = readers.csv(spark, path, spark.createDataFrame([], "code string, c_mktsegment string, c_acctbal double").schema, ";")
    return read.select("code", "c_mktsegment", F.round("c_acctbal", 6).alias("c_acctbal"))


def geometry_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of orders as binary geometry in Parquet, read back by the export reader."""
    orders = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 997).cast("double").alias("x"), (F.col("o_custkey") % 991).cast("double").alias("y"))

    def encode(batches):
        for batch in batches:
            lines = [readers.to_wkb_line([(x, y), (x + 3.0, y + 4.0), (x + 3.0, y + 4.0 + k % 5)]) for k, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.binary())], names=["o_orderkey", "geometry"])

    path = _written(spark, orders.mapInArrow(encode, "o_orderkey long, geometry binary"), "parquet")
    points = F.col("parts")[0]
    step = F.zip_with(F.slice(points, 2, 100), F.slice(points, F.lit(1), F.size(points) - 1), lambda b, a: F.sqrt(F.pow(b["x"] - a["x"], 2) + F.pow(b["y"] - a["y"], 2)))
    return readers.export(spark, path).select("o_orderkey", F.size(points).cast("long").alias("n_points"), F.round(F.aggregate(step, F.lit(0.0), lambda a, x: a + x), 6).alias("length"))


def geojson_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as one feature collection, read back as properties and coordinates."""
    s = table(spark, sf, "supplier")
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("s_suppkey").cast("string").alias("code"), F.col("s_nationkey").cast("string").alias("area")).alias("properties"), F.struct(F.lit("Point").alias("type"), F.array((F.col("s_suppkey") % 90).cast("double"), (F.col("s_suppkey") % 45).cast("double")).alias("coordinates")).alias("geometry"))
    collection = s.agg(F.collect_list(feature).alias("features"))  # one document by its format, and suppliers are few
    path = _written(spark, collection.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features"))), "text")
    read = readers.geojson(spark, path)
    return read.select(read["properties"]["code"].cast("long").alias("s_suppkey"), read["properties"]["area"].alias("area"), "kind", F.from_json("coordinates", "array<double>")[0].alias("x"))


def lengths_by_source(spark: SparkSession, sf: str) -> DataFrame:
    """Fresh lengths for the years that have them, reference lengths for the others and for one scenario."""
    reference = assembly.unpivot_lengths(X.lengths_wide(spark, sf))
    fresh = reference.withColumns({"len_d": F.col("len_d") * 2, "len_g": F.col("len_g") + 1})
    out = readers.lengths_with_fallback(fresh, reference, (1996, 1999))
    return out.select("year", "zone", "scenario", F.round("len_d", 6).alias("len_d"), F.round("len_g", 6).alias("len_g"))


def lines_of_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Ways with node references joined to positions; references without a node are skipped."""
    ways = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("way")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda r: r["l_partkey"]).alias("refs"))
    nodes = table(spark, sf, "part").where("p_partkey % 5 <> 0").select(F.col("p_partkey").alias("node"), (F.col("p_partkey") % 360 - 180).cast("double").alias("lon"), (F.col("p_partkey") % 160 - 80).cast("double").alias("lat"))
    lines = readers.lines_from_nodes(ways, nodes)
    return lines.select("way", F.size("points").cast("long").alias("n_points"), F.col("points")[0]["lat"].alias("first_lat"), F.element_at("points", -1)["lon"].alias("last_lon"))


def cycle_route_members(spark: SparkSession, sf: str) -> DataFrame:
    """Members of route relations: orders are relations, their line items members."""
    member = F.struct(F.when(F.col("l_linenumber") % 3 == 0, "node").otherwise("way").alias("_type"), F.col("l_partkey").alias("_ref"), F.lit("").alias("_role"))
    orders = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(member).alias("member"))
    tags_of = F.create_map(F.lit("type"), F.lit("route"), F.lit("route"), F.when(F.col("l_orderkey") % 4 == 0, "hiking").otherwise("bicycle"), F.lit("network"), F.concat(F.lit("n"), (F.col("l_orderkey") % 6).cast("string")))
    return readers.route_members(orders.select(F.col("l_orderkey").alias("relation"), "member", tags_of.alias("tags")))


def _message(*parts: tuple[int, int | bytes]) -> bytes:
    """A protocol-buffer message of (number, value) fields."""

    def number(n: int) -> bytes:
        out = b""
        while n >= 128:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    return b"".join(number(k << 3) + number(v) if isinstance(v, int) else number(k << 3 | 2) + number(len(v)) + v for k, v in parts)


def _extract(ids: list[int]) -> bytes:
    """A packed map extract with a node at each id, and a way from it to the two next ones, on a path or a road."""
    run = lambda values: b"".join(_message((0, (s << 1) ^ (s >> 63)))[1:] for s in (b - a for a, b in zip([0, *values[:-1]], values, strict=True)))
    table = _message(*[(1, x) for x in (b"", b"highway", b"path", b"road")])
    dense = _message((1, run(ids)), (8, run([i % 80 * 10**7 for i in ids])), (9, run([i % 170 * 10**7 for i in ids])))
    ways = [(3, _message((1, i), (2, b"\x01"), (3, b"\x02" if i % 3 == 0 else b"\x03"), (8, run([i, i + 1, i + 2])))) for i in ids]
    out = b""
    for kind, block in ((b"OSMHeader", b""), (b"OSMData", _message((1, table), (2, _message((2, dense))))), (b"OSMData", _message((1, table), (2, _message(*ways))))):
        body = _message((2, len(block)), (3, zlib.compress(block)))
        header = _message((1, kind), (3, len(body)))
        out += struct.pack(">I", len(header)) + header + body
    return out


def packed_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Paths of a packed map extract with the positions of the nodes it has."""
    ids = [r[0] for r in table(spark, sf, "supplier").select("s_suppkey").orderBy("s_suppkey").toLocalIterator()]  # the fixture is one file
    path = scratch_path(spark, f"{uuid4().hex}.osm.pbf")
    binary.write_file(spark, path, _extract(ids))
    found = binary.osm_pbf(spark, path)
    lines = readers.lines_from_nodes(found["ways"].where("tags['highway'] = 'path'"), found["nodes"])
    return lines.select("way", F.size("points").cast("long").alias("n_points"), F.round(F.col("points")[0]["lat"], 6).alias("lat"), F.round(F.element_at("points", -1)["lon"], 6).alias("lon"))


def package_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A layer of lines written to a geometry package and read again."""
    s = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("area"), F.col("s_suppkey").cast("double").alias("x"))

    def encode(batches):
        for batch in batches:
            lines = [readers.to_wkb_line([(x, 0.0), (x + 3.0, 4.0)]) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lines, pa.binary())], names=[*batch.schema.names, "geometry"])

    path = scratch_path(spark, f"{uuid4().hex}.gpkg")
    binary.write_geopackage(s.mapInArrow(encode, "s_suppkey long, area string, x double, geometry binary"), path, "lines")
    read = binary.geopackage(spark, path, "lines", {"s_suppkey": "long", "area": "string", "x": "double"})
    point = lambda k: F.col("parts")[0][k]
    return read.select("s_suppkey", "area", (point(1)["x"] - point(0)["x"]).alias("dx"), point(1)["y"].alias("y"))


def packed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly series of users packed as nested records and read again."""
    e = table(spark, sf, "events").where("user_id is not null").select(F.col("user_id").alias("site"), F.lit(2024).alias("year"), F.hour("ts").alias("hour_idx"), F.lit(1).alias("flow"), F.when(F.col("event_type") != "error", (F.col("event_id") % 10) / 4).alias("value"))
    series = sensors.nested_records(e).select("site", F.explode("values").alias("year", "values"))
    path = scratch_path(spark, f"{uuid4().hex}.msgpack")
    binary.write_packed_series(series, path)
    known = F.filter("values", lambda x: x.isNotNull())
    return binary.packed_series(spark, path).select("site", "year", F.size("values").cast("long").alias("n_hours"), F.size(known).cast("long").alias("n_known"), F.round(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


def _tile(column: int, row: int, values: list[list[int]]) -> bytes:
    """A one-band raster tile of 16-bit numbers in one strip, at a corner of the mosaic."""
    height, width = len(values), len(values[0])
    data = struct.pack(f"<{height * width}h", *[v for line in values for v in line])
    scale, tie = struct.pack("<3d", 10, 10, 0), struct.pack("<6d", 0, 0, 0, column * width * 10.0, -row * height * 10.0, 0)
    entries = [(256, 3, 1, width), (257, 3, 1, height), (258, 3, 1, 16), (259, 3, 1, 1), (273, 4, 1, 8), (277, 3, 1, 1), (279, 4, 1, len(data)), (339, 3, 1, 2), (33550, 12, 3, 8 + len(data)), (33922, 12, 6, 8 + len(data) + 24), (42113, 2, 3, int.from_bytes(b"-1\0", "little"))]
    return struct.pack("<2sHI", b"II", 42, 8 + len(data) + 72) + data + scale + tie + struct.pack("<H", len(entries)) + b"".join(struct.pack("<HHII", *e) for e in entries) + b"\0" * 4


def raster_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics by zone of a mosaic of raster tiles."""
    folder = scratch_path(spark, f"{uuid4().hex}-tiles")
    for k in range(4):  # the cells are given by a rule, so that SQL knows them
        binary.write_file(spark, f"{folder}/{k}.tif", _tile(k % 2, k // 2, [[-1 if (i * j + k) % 7 == 0 else (i * 31 + j * 17 + k * 101) % 1000 for i in range(30)] for j in range(20)]))
    cells = binary.raster_cells(spark, folder)
    zone = (F.floor(F.col("x") / 150) + 10 * F.floor(-F.col("y") / 100)).alias("zone")
    out = spatial.zonal_statistics(cells.select(zone, "value"))
    return out.select("zone", "count", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "median", "std", "range")])


# ---- zones


def wide_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Zones with counts, prices and nothing where a part has no row; counts filled, rates left missing, one city overridden."""
    zone, part = X.zone_of().alias("zone"), table(spark, sf, "part")
    counts = part.where("p_size > 10").groupBy(zone).agg(F.count(F.lit(1)).alias("nb_large"))
    rates = part.where("p_retailprice > 1000").groupBy(zone).agg(F.round(F.avg("p_retailprice"), 6).alias("nb_taux_price"))
    wide = assembly.wide_zones(X.zones(spark, sf), [counts, rates])
    return assembly.override(assembly.fill_counts(wide, ("nb_",)), "zone", ["Brand#11/01", "Brand#12/02"], {"department": "city"})


def mainland_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Customers whose padded area is a mainland department."""
    c = table(spark, sf, "customer").select("c_custkey", F.lpad(((F.col("c_custkey") * 7) % 120).cast("string"), 2, "0").alias("department"))
    return assembly.mainland(c)


def densest_members(spark: SparkSession, sf: str) -> DataFrame:
    """The densest customer of each nation, core ones first."""
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("grp"), F.col("c_custkey").alias("code"), (F.col("c_custkey") % 3 == 0).alias("core"), F.col("c_acctbal").alias("density"))
    return sensors.densest_member(c.where("density is not null"))


def nested_series(spark: SparkSession, sf: str) -> DataFrame:
    """Per-site maps from year to values and to flows, taken apart again."""
    e = table(spark, sf, "events").where("user_id is not null").select(F.col("user_id").alias("site"), F.when(F.col("event_type") == "click", 1).otherwise(2).alias("flow"), F.lit(2024).alias("year"), F.hour("ts").alias("hour_idx"), F.when(F.col("event_type") != "error", F.col("event_id") % 10).cast("double").alias("value"))
    records = sensors.nested_records(e)
    years = records.select("site", F.explode("values").alias("year", "series"), F.col("flows"))
    known = F.filter("series", lambda x: x.isNotNull())
    return years.select("site", "year", F.size("series").cast("long").alias("n_hours"), F.size(known).cast("long").alias("n_known"), F.aggregate(known, F.lit(0.0), lambda a, x: a + x).alias("total"), F.array_join(F.col("flows")[F.col("year")], ",").alias("flows"))


def bottom_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    """The twenty parts with the least price, the smaller key of equals (the limit is the report's)."""
    return sensors.top_n(table(spark, sf, "part").select("p_partkey", "p_retailprice"), [F.asc("p_retailprice"), F.asc("p_partkey")], 20)


def zone_differences(spark: SparkSession, sf: str) -> DataFrame:
    """Zones of expensive parts and zones of large parts: which only one side has."""
    part = table(spark, sf, "part").withColumn("zone", X.zone_of())
    return checks.differences(part.where("p_retailprice > 1500"), part.where("p_size > 25"), ["zone"])


def pivot_total(spark: SparkSession, sf: str) -> DataFrame:
    """Lengths by year and a cluster of parts, with the sum of the clusters."""
    rows = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"), (F.col("l_partkey") % 5).cast("int").alias("cluster"), F.col("l_quantity").cast("decimal(18,2)").alias("quantity"))
    return indicators.with_total(indicators.pivot_by_cluster(rows, "quantity"))


# ---- geometry


def _squares(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as squares of three sizes on a grid."""
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("polygon"), ((F.col("s_suppkey") * 37) % 500).cast("double").alias("x"), ((F.col("s_suppkey") * 91) % 400).cast("double").alias("y"), (F.lit(2.0) + (F.col("s_suppkey") % 3) * 9).alias("side"))
    corner = lambda dx, dy: F.struct((F.col("x") + F.col("side") * dx).alias("x"), (F.col("y") + F.col("side") * dy).alias("y"))
    return s.select("polygon", F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1)).alias("ring"), F.pow("side", F.lit(2)).alias("area"))


_SQUARES_SQL = "sq AS (SELECT s_suppkey AS polygon, ((s_suppkey * 37) % 500)::DOUBLE AS x, ((s_suppkey * 91) % 400)::DOUBLE AS y, 2.0 + (s_suppkey % 3) * 9 AS side FROM supplier)"


def containing_polygons(spark: SparkSession, sf: str) -> DataFrame:
    """Polygons that hold a smaller one."""
    return spatial.containers(_squares(spark, sf), 20.0)


def touching_polygons(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of polygons that meet."""
    return spatial.touching(_squares(spark, sf), 20.0)


def isolated_centres(spark: SparkSession, sf: str) -> DataFrame:
    """Customers that touch no base and lie far from every supplier."""
    points = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), ((F.col("c_custkey") * 53) % 5000).cast("double").alias("x"), ((F.col("c_custkey") * 29) % 5000).cast("double").alias("y"))
    bases = table(spark, sf, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("polygon"), ((F.col("s_suppkey") * 71) % 5000).cast("double").alias("x"), ((F.col("s_suppkey") * 17) % 5000).cast("double").alias("y"))
    edges = table(spark, sf, "customer").select(F.col("c_custkey").alias("a"), F.col("c_nationkey").cast("long").alias("b"))
    return spatial.isolated(points, bases, edges, 400.0, 100.0).select("id")


def water_distance(spark: SparkSession, sf: str) -> DataFrame:
    """Distance of customers to the nearest river, canal and coast segment."""
    points = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), ((F.col("c_custkey") * 53) % 900).cast("double").alias("x"), ((F.col("c_custkey") * 29) % 700).cast("double").alias("y"))
    tags_of = F.create_map(F.lit("waterway"), F.when(F.col("s_suppkey") % 3 == 0, "river").when(F.col("s_suppkey") % 3 == 1, "canal").otherwise("dock"))
    lines = table(spark, sf, "supplier").select(C.water_kind(tags_of).alias("kind"), ((F.col("s_suppkey") * 71) % 900).cast("double").alias("ax"), ((F.col("s_suppkey") * 17) % 700).cast("double").alias("ay"))
    out = spatial.line_distances(points, lines.withColumns({"bx": F.col("ax") + 30, "by": F.col("ay") + 40}), ["river", "canal", "coastline"], size=50.0)
    return out.select("id", *[F.round(f"dist_{k}", 6).alias(f"dist_{k}") for k in ("river", "canal", "coastline")])


# ---- tags


def tag_features(spark: SparkSession, sf: str) -> DataFrame:
    """Feature rows from a map of tags."""
    k = F.col("p_partkey")
    some = F.map_filter(
        F.create_map(
            F.lit("highway"), F.when(k % 3 == 0, "path").when(k % 3 == 1, "track"), F.lit("maxspeed"), F.when(k % 4 == 0, "20 mph").when(k % 4 == 1, "30"), F.lit("cycleway"), F.when(k % 5 == 0, "lane").when(k % 5 == 1, "odd"), F.lit("cycleway:both"), F.when(k % 7 == 0, "track")
        ),
        lambda _, v: v.isNotNull(),
    )
    vocab = {"highway": ["path"], "cycleway": ["lane"], "cycleway:both": ["track"], "maxspeed": ["20 mph", "30"]}
    out = tags.feature_row(table(spark, sf, "part").select("p_partkey", some.alias("tags")), ["highway", "maxspeed", "cycleway", "cycleway:both"], vocab)
    return out.select("p_partkey", "highway", "cycleway__both", F.round("maxspeed_num", 6).alias("maxspeed_num"), "cw_right_eff", "cw_left_eff", F.col("n_cycle_keys").cast("long").alias("n_cycle_keys"))


def lane_directions(spark: SparkSession, sf: str) -> DataFrame:
    """Direction factors of several spellings, summed by zone."""
    spelt = F.when(F.col("p_partkey") % 4 == 0, " Bidirectionnel ").when(F.col("p_partkey") % 4 == 1, "2 SENS").when(F.col("p_partkey") % 4 == 2, "unidirectionnel")
    return table(spark, sf, "part").groupBy(X.zone_of().alias("zone")).agg(F.sum(C.direction_factor(spelt)).alias("lanes"))


def node_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Where each way's nodes begin in one long list of nodes: orders are ways, line items their nodes."""
    ways = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("way")).agg(F.count(F.lit(1)).alias("n"))
    return tags.offsets(ways, "way", "n")


def parameter_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Free parameters of every covariance model for the cluster counts and dimensions of nations (k = 2 + nation % 4, p = 10 + nation)."""
    from tallyroad.operators.learning import MODELS, n_parameters

    nations = [r[0] for r in table(spark, sf, "nation").select("n_nationkey").orderBy("n_nationkey").collect()]  # 25 rows
    return spark.createDataFrame([(n, m, float(n_parameters(m, 2 + n % 4, 10 + n))) for n in nations for m in MODELS], "nation long, model string, parameters double")


def queries():
    made = (csv_scan, geometry_scan, geojson_scan, lengths_by_source, lines_of_nodes, cycle_route_members, packed_extract, package_scan, packed_records, raster_statistics, wide_zones, mainland_zones, densest_members, nested_series, bottom_suppliers, zone_differences, pivot_total)
    made += (containing_polygons, touching_polygons, isolated_centres, water_distance, tag_features, lane_directions, node_offsets, parameter_counts)
    return {f.__name__: f for f in made}


def oracle_sql():
    zone = "p_brand || '/' || lpad(p_size::VARCHAR, 2, '0')"
    segment = "sqrt(pow(x - (ax + t * 30), 2) + pow(y - (ay + t * 40), 2))"
    long = " UNION ALL ".join(f"SELECT year, zone, '{s}' AS scenario, len_d_{s} AS d, len_g_{s} AS g FROM lengths" for s in X.SCENARIOS)
    sums = ", ".join(f"sum(CASE WHEN {cut} AND l_linestatus = '{status}' THEN l_extendedprice::DECIMAL(18,2) ELSE 0 END)::DOUBLE / 10000.0 AS len_{side}_{s}" for side, status in (("d", "F"), ("g", "O")) for s, cut in (("PARTIAL", "l_returnflag = 'N'"), ("ALL", "true"), ("DEDICATED", "l_returnflag IN ('A', 'R')")))
    return {
        "csv_scan": "SELECT lpad(c_custkey::VARCHAR, 8, '0') AS code, c_mktsegment, round(c_acctbal, 6) AS c_acctbal FROM customer",
        "geometry_scan": "SELECT o_orderkey, 3::BIGINT AS n_points, round(5.0 + o_orderkey % 5, 6) AS length FROM orders",
        "geojson_scan": "SELECT s_suppkey, s_nationkey::VARCHAR AS area, 'Point' AS kind, (s_suppkey % 90)::DOUBLE AS x FROM supplier",
        "lengths_by_source": f"WITH lengths AS (SELECT year(l_shipdate)::INTEGER AS year, {zone} AS zone, {sums} FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) SELECT year, zone, scenario, round(CASE WHEN year IN (1996, 1999) AND scenario <> 'PARTIAL' THEN d * 2 ELSE d END, 6) AS len_d, round(CASE WHEN year IN (1996, 1999) AND scenario <> 'PARTIAL' THEN g + 1 ELSE g END, 6) AS len_g FROM ({long})",
        "lines_of_nodes": "SELECT l_orderkey AS way, count(*) AS n_points, arg_min((l_partkey % 160 - 80)::DOUBLE, (l_linenumber, rn)) AS first_lat, arg_max((l_partkey % 360 - 180)::DOUBLE, (l_linenumber, rn)) AS last_lon FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_partkey AS rn FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_partkey % 5 <> 0) GROUP BY 1 HAVING count(*) >= 2",
        "cycle_route_members": "SELECT l_partkey AS way, 'n' || l_orderkey % 6 AS network FROM lineitem WHERE l_linenumber % 3 <> 0 AND l_orderkey % 4 <> 0",
        "packed_extract": "WITH n AS (SELECT s_suppkey AS k FROM supplier), w AS (SELECT n.k AS way, r, r.r + n.k AS node FROM n CROSS JOIN range(0, 3) AS r(r) WHERE n.k % 3 = 0) SELECT way, count(*) AS n_points, round(arg_min(node % 80, node)::DOUBLE, 6) AS lat, round(arg_max(node % 170, node)::DOUBLE, 6) AS lon FROM w JOIN n ON n.k = node GROUP BY way HAVING count(*) >= 2",
        "package_scan": "SELECT s_suppkey, s_nationkey::VARCHAR AS area, 3.0::DOUBLE AS dx, 4.0::DOUBLE AS y FROM supplier",
        "packed_records": "WITH h AS (SELECT user_id AS site, hour(ts) AS hour_idx, CASE WHEN count(*) FILTER (WHERE event_type = 'error') = 0 THEN round_even(sum((event_id % 10) / 4.0), 2) END AS value FROM events WHERE user_id IS NOT NULL GROUP BY ALL) SELECT site, 2024 AS year, count(*) AS n_hours, count(value) AS n_known, round(coalesce(sum(value), 0), 6) AS total FROM h GROUP BY site",
        "raster_statistics": "WITH c AS (SELECT (k % 2 * 300 + i * 10 + 5) AS x, (k // 2 * 200 + j * 10 + 5) AS y, CASE WHEN (i * j + k) % 7 <> 0 THEN ((i * 31 + j * 17 + k * 101) % 1000)::DOUBLE END AS v FROM range(0, 4) AS t(k), range(0, 30) AS a(i), range(0, 20) AS b(j)) SELECT (x // 150 + 10 * (y // 100))::BIGINT AS zone, count(v) AS count, round(min(v), 6) AS min, round(max(v), 6) AS max, round(avg(v), 6) AS mean, round(median(v), 6) AS median, round(stddev_pop(v), 6) AS std, round(max(v) - min(v), 6) AS range FROM c WHERE v IS NOT NULL GROUP BY 1",
        "wide_zones": f"WITH z AS (SELECT {zone} AS zone, min(p_brand) AS department, (min(p_size) % 4)::INTEGER AS fallback FROM part GROUP BY 1), c AS (SELECT {zone} AS zone, count(*) AS nb_large FROM part WHERE p_size > 10 GROUP BY 1), r AS (SELECT {zone} AS zone, round(avg(p_retailprice), 6) AS nb_taux_price FROM part WHERE p_retailprice > 1000 GROUP BY 1) SELECT zone, CASE WHEN zone IN ('Brand#11/01', 'Brand#12/02') THEN 'city' ELSE department END AS department, fallback, coalesce(nb_large, 0) AS nb_large, nb_taux_price FROM z LEFT JOIN c USING (zone) LEFT JOIN r USING (zone)",
        "mainland_zones": "SELECT c_custkey, lpad((c_custkey * 7 % 120)::VARCHAR, 2, '0') AS department FROM customer WHERE lpad((c_custkey * 7 % 120)::VARCHAR, 2, '0') BETWEEN '01' AND '95'",
        "densest_members": "SELECT c_nationkey AS grp, c_custkey AS code FROM customer WHERE c_acctbal IS NOT NULL QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY (c_custkey % 3 = 0) DESC, c_acctbal DESC, c_custkey) = 1",
        "nested_series": "WITH h AS (SELECT user_id AS site, hour(ts) AS hour_idx, CASE WHEN count(*) FILTER (WHERE event_type = 'error') = 0 THEN sum(event_id % 10)::DOUBLE END AS value FROM events WHERE user_id IS NOT NULL GROUP BY ALL), f AS (SELECT user_id AS site, string_agg(DISTINCT flow::VARCHAR, ',' ORDER BY flow::VARCHAR) AS flows FROM (SELECT user_id, CASE WHEN event_type = 'click' THEN 1 ELSE 2 END AS flow FROM events WHERE user_id IS NOT NULL) GROUP BY 1) SELECT site, 2024 AS year, count(*) AS n_hours, count(value) AS n_known, coalesce(sum(value), 0) AS total, any_value(flows) AS flows FROM h JOIN f USING (site) GROUP BY site",
        "bottom_suppliers": "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice, p_partkey LIMIT 20",
        "zone_differences": f"WITH a AS (SELECT DISTINCT {zone} AS zone FROM part WHERE p_retailprice > 1500), b AS (SELECT DISTINCT {zone} AS zone FROM part WHERE p_size > 25) SELECT zone, 'a' AS only_in FROM a WHERE zone NOT IN (SELECT zone FROM b) UNION ALL SELECT zone, 'b' FROM b WHERE zone NOT IN (SELECT zone FROM a)",
        "pivot_total": "SELECT year(l_shipdate)::INTEGER AS year, " + ", ".join(f"sum(l_quantity::DECIMAL(18,2)) FILTER (WHERE l_partkey % 5 = {c}) AS cluster_{c}" for c in range(4)) + ", sum(l_quantity::DECIMAL(18,2)) FILTER (WHERE l_partkey % 5 < 4) AS total FROM lineitem GROUP BY 1",
        "containing_polygons": f"WITH {_SQUARES_SQL} SELECT DISTINCT o.polygon FROM sq o JOIN sq i ON o.polygon <> i.polygon AND o.side > i.side AND i.x >= o.x AND i.x + i.side <= o.x + o.side AND i.y >= o.y AND i.y + i.side <= o.y + o.side",
        "touching_polygons": f"WITH {_SQUARES_SQL} SELECT a.polygon AS a, b.polygon AS b FROM sq a JOIN sq b ON a.polygon < b.polygon AND a.x <= b.x + b.side AND b.x <= a.x + a.side AND a.y <= b.y + b.side AND b.y <= a.y + a.side",
        "isolated_centres": "WITH p AS (SELECT c_custkey AS id, c_nationkey, ((c_custkey * 53) % 5000)::DOUBLE AS x, ((c_custkey * 29) % 5000)::DOUBLE AS y FROM customer), b AS (SELECT s_suppkey AS polygon, ((s_suppkey * 71) % 5000)::DOUBLE AS x, ((s_suppkey * 17) % 5000)::DOUBLE AS y FROM supplier WHERE s_suppkey % 2 = 0), e AS (SELECT id AS a, c_nationkey AS b FROM p UNION SELECT c_nationkey, id FROM p) SELECT id FROM p WHERE NOT EXISTS (SELECT 1 FROM e JOIN b ON e.b = b.polygon WHERE e.a = p.id) AND NOT EXISTS (SELECT 1 FROM b WHERE sqrt(pow(p.x - b.x, 2) + pow(p.y - b.y, 2)) <= 400)",
        "water_distance": f"WITH p AS (SELECT c_custkey AS id, ((c_custkey * 53) % 900)::DOUBLE AS x, ((c_custkey * 29) % 700)::DOUBLE AS y FROM customer), l AS (SELECT s_suppkey % 3 AS k, ((s_suppkey * 71) % 900)::DOUBLE AS ax, ((s_suppkey * 17) % 700)::DOUBLE AS ay FROM supplier), d AS (SELECT id, k, min({segment}) AS d FROM (SELECT id, x, y, k, ax, ay, greatest(0.0, least(1.0, ((x - ax) * 30 + (y - ay) * 40) / 2500)) AS t FROM p CROSS JOIN l) GROUP BY ALL) SELECT id, " + ", ".join(f"round(min(d) FILTER (WHERE k = {k}), 6) AS dist_{n}" for k, n in ((0, "river"), (1, "canal"), (2, "coastline"))) + " FROM d GROUP BY id",
        "tag_features": "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'path' WHEN 1 THEN '(autre)' END AS highway, CASE WHEN p_partkey % 7 = 0 THEN 'track' END AS cycleway__both, round(CASE p_partkey % 4 WHEN 0 THEN 32.18::DOUBLE WHEN 1 THEN 30::DOUBLE END, 6) AS maxspeed_num, CASE WHEN p_partkey % 7 = 0 THEN 'track' WHEN p_partkey % 5 = 0 THEN 'lane' WHEN p_partkey % 5 = 1 THEN '(autre)' END AS cw_right_eff, CASE WHEN p_partkey % 7 = 0 THEN 'track' WHEN p_partkey % 5 = 0 THEN 'lane' WHEN p_partkey % 5 = 1 THEN '(autre)' END AS cw_left_eff, ((p_partkey % 7 = 0)::INTEGER + (p_partkey % 5 < 2)::INTEGER)::BIGINT AS n_cycle_keys FROM part",
        "node_offsets": "SELECT way, n, (sum(n) OVER (ORDER BY way) - n)::BIGINT AS offset FROM (SELECT l_orderkey AS way, count(*) AS n FROM lineitem GROUP BY 1)",
        "parameter_counts": "WITH b AS (SELECT n_nationkey AS nation, 2 + n_nationkey % 4 AS k, 10 + n_nationkey AS p FROM nation), m AS (SELECT unnest(['DkBk', 'DkB', 'DBk', 'DB', 'AkjBk', 'AkjB', 'AkBk', 'AkB', 'AjBk', 'AjB', 'ABk', 'AB']) AS model) SELECT nation, model, ((k - 1) + k * (k - 1) + (k - 1) * (p - k / 2.0) + CASE WHEN model = 'ABk' THEN k + 1 ELSE CASE regexp_extract(model, '^(Dk|D|Akj|Ak|Aj|A)B', 1) WHEN 'Dk' THEN k * k * (k - 1) // 2 WHEN 'D' THEN k * (k - 1) // 2 WHEN 'Akj' THEN k * (k - 1) WHEN 'Ak' THEN k WHEN 'Aj' THEN k - 1 ELSE 1 END + CASE WHEN model LIKE '%Bk' THEN k ELSE 1 END END)::DOUBLE AS parameters FROM b CROSS JOIN m",
        "lane_directions": f"SELECT {zone} AS zone, sum(CASE WHEN p_partkey % 4 < 2 THEN 2.0 ELSE 1.0 END::DOUBLE) AS lanes FROM part GROUP BY 1",
    }
