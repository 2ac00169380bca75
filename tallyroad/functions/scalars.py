"""Column functions: codes, numbers in text, tags, hashes, distances, projections."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_M, EARTH_KM = 6371008.8, 6371.0
YEAR_HOURS = 8760


def pad_code(code: Column, width: int) -> Column:
    """Trimmed code, zero-filled on the left; longer codes stay whole."""
    text = F.regexp_replace(F.trim(code.cast("string")), r"\.0$", "")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def to_double(text: Column, default: float = 0.0) -> Column:
    """Number with a decimal point or comma, or the default."""
    return F.coalesce(F.regexp_replace(F.trim(text), ",", ".").try_cast("double"), F.lit(default))


def to_int(text: Column, default: int = 0) -> Column:
    """Number truncated to an integer, or the default."""
    number = F.regexp_replace(F.trim(text), ",", ".").try_cast("double")
    return F.coalesce(F.when(number.isNotNull(), F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))), F.lit(default)).cast("long")


def split_clean(text: Column, separator: str = "/") -> Column:
    """Trimmed, non-empty parts of a separated text."""
    return F.filter(F.transform(F.split(text, f"\\Q{separator}\\E"), lambda x: F.trim(x)), lambda x: x != "")


def encode_flow(value: Column) -> Column:
    """Hundredths as an integer, 65535 for a missing value."""
    return F.when(value.isNull(), F.lit(65535)).otherwise(F.bround(value * 100, 0).cast("int"))


def decode_flow(code: Column) -> Column:
    return F.when(code != 65535, code / F.lit(100.0))


#: Named speeds in km/h, and miles an hour in km/h.
NAMED_SPEEDS = {"fr:urban": 50.0, "urban": 50.0, "fr:rural": 80.0, "rural": 80.0, "fr:motorway": 130.0, "walk": 7.0, "fr:walk": 7.0}
MPH = 1.609


def tag_number(value: Column) -> Column:
    """Number at the start of a tag: named speeds, decimal commas, miles an hour in km/h; null without a number."""
    text = F.lower(value)
    number = F.regexp_replace(F.regexp_extract(value, r"^\s*(-?\d+(?:[.,]\d+)?)", 1), ",", ".").try_cast("double")
    named = F.element_at(F.create_map(*[F.lit(x) for kv in NAMED_SPEEDS.items() for x in kv]), text)
    return F.coalesce(named, F.when(F.contains(text, F.lit("mph")), number * MPH).otherwise(number))


def first_digits(value: Column) -> Column:
    """First run of digits anywhere in a text, as an integer."""
    return F.regexp_extract(value, r"(\d+)", 1).try_cast("int")


#: Kinds of names in the order tried, with the words that tell them; 6 for other names, 0 for none.
NAME_KINDS = (
    (1, r"voie[ -]verte|greenway"),
    (2, r"v[eé]lo\s*route|eurovelo|v[eé]loroute|tour de france"),
    (3, r"v[eé]lo|cyclab|cycliste|cycle"),
    (4, r"canal|halage|berge|digue|quai|rivi[eè]re|fleuve"),
    (5, r"chemin|sentier|all[eé]e|passage|sente|piste|traverse"),
)
OTHER_NAME = 6


def kind_of_name(name: Column, kinds: tuple[tuple[int, str], ...] = NAME_KINDS) -> Column:
    """Code of the first kind whose words a name has."""
    text = F.lower(name)
    out = F.when(F.coalesce(name, F.lit("")) == "", 0)
    for code, pattern in kinds:
        out = out.when(text.rlike(pattern), code)
    return out.otherwise(OTHER_NAME)


def kind_of_reference(ref: Column) -> Column:
    """1 for references of cycle routes, 2 for others, 0 for none."""
    return F.when(F.coalesce(ref, F.lit("")) == "", 0).when(F.trim(ref).rlike(r"(?i)^(eurovelo|ev|v)\s*\d+"), 1).otherwise(2)


def street_name(name: Column) -> Column:
    """Lower case, without commas and full stops, single blanks; null if nothing is left."""
    text = F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), "[,.]+", ""), r"\s+", " "))
    return F.when(text != "", text)


def recode(value: Column, vocabulary: list[str], other: str = "(autre)") -> Column:
    """Values outside a frozen vocabulary become ``other``; null stays null."""
    return F.when(value.isNull(), F.lit(None).cast("string")).when(value.isin(vocabulary), value).otherwise(other)


def count_present(*columns: Column) -> Column:
    return reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in columns])


def principal_type(right: Column, left: Column, hierarchy: list[str]) -> Column:
    """The better of two sides' types by rank in a hierarchy; types it doesn't name rank as its last one."""
    levels = F.array(*[F.lit(h) for h in hierarchy])
    rank = lambda c: F.coalesce(F.nullif(F.array_position(levels, c), F.lit(0)), F.lit(len(hierarchy)))
    return F.get(levels, (F.least(rank(right), rank(left)) - 1).cast("int"))


#: Spellings of lanes open in both directions.
BOTH_WAYS = ["bidirectionnel", "bidirectional", "bi-directionnel", "2 sens", "double sens"]


def direction_factor(direction: Column, alpha: float = 2.0) -> Column:
    """``alpha`` for lanes open in both directions, however that is spelt, else 1."""
    return F.when(F.lower(F.trim(direction)).isin(BOTH_WAYS), F.lit(alpha)).otherwise(F.lit(1.0))


def fold_of(key: Column, folds: int = 5) -> Column:
    """Fold by multiplicative hashing in 64-bit wrap-around arithmetic."""
    product = key.cast("decimal(20,0)") * F.lit(2654435761).cast("decimal(10,0)")
    wrapped = F.pmod(product, F.lit("18446744073709551616").cast("decimal(20,0)"))
    return F.pmod(F.floor(wrapped / F.lit(128).cast("decimal(10,0)")), F.lit(folds).cast("decimal(10,0)")).cast("int")


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_M) -> Column:
    a = F.pow(F.sin((F.radians(lat2) - F.radians(lat1)) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def unit_vector(lat: Column, lon: Column) -> Column:
    """Point on the unit sphere as a struct of x, y and z."""
    return F.struct((F.cos(F.radians(lat)) * F.cos(F.radians(lon))).alias("x"), (F.cos(F.radians(lat)) * F.sin(F.radians(lon))).alias("y"), F.sin(F.radians(lat)).alias("z"))


def chord_km(a: Column, b: Column) -> Column:
    """Distance on the sphere from the chord between two unit vectors."""
    chord = F.sqrt(F.pow(a["x"] - b["x"], 2) + F.pow(a["y"] - b["y"], 2) + F.pow(a["z"] - b["z"], 2))
    return 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), chord / 2))


def bbox_around(lat: Column, lon: Column, radius_km: Column | float) -> Column:
    """Box around a point, 111 km to a degree, as a struct of south, west, north and east."""
    r = radius_km if isinstance(radius_km, Column) else F.lit(radius_km)
    dy, dx = r / 111.0, r / (F.lit(111.0) * F.cos(F.radians(lat)))
    return F.struct((lat - dy).alias("south"), (lon - dx).alias("west"), (lat + dy).alias("north"), (lon + dx).alias("east"))


def ratio(a: Column, b: Column) -> Column:
    """Zero-safe ratio: 0 where it is undefined."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def hour_of_week(ts: Column) -> Column:
    return F.weekday(ts) * 24 + F.hour(ts)


def week_index(ts: Column, start: Column) -> Column:
    return F.floor(F.datediff(ts, start) / 7).cast("int")


#: Fixed values of the conformal conic projection of mainland France: eccentricity, exponent, constant, origin.
_E, _N, _C, _X0, _Y0, _LON0 = 0.0818191910428158, 0.7256077650532670, 11754255.4261, 700000.0, 12655612.0499, 3.0


def lambert93(lat: Column, lon: Column) -> Column:
    """Projected metres as a struct of x and y."""
    s = F.sin(F.radians(lat))
    iso = F.log(F.tan(F.lit(0.7853981633974483) + F.radians(lat) / 2)) - F.lit(_E / 2) * F.log((1 + F.lit(_E) * s) / (1 - F.lit(_E) * s))
    r, angle = F.lit(_C) * F.exp(F.lit(-_N) * iso), F.lit(_N) * F.radians(lon - _LON0)
    return F.struct((F.lit(_X0) + r * F.sin(angle)).alias("x"), (F.lit(_Y0) - r * F.cos(angle)).alias("y"))


def ring_area(ring: Column) -> Column:
    """Shoelace area of an open or closed ring of (x, y) structs."""
    n = F.size(ring)
    terms = F.transform(ring, lambda p, i: p["x"] * F.get(ring, F.pmod(i + 1, n))["y"] - F.get(ring, F.pmod(i + 1, n))["x"] * p["y"])
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)) / 2


def ring_centroid(ring: Column) -> Column:
    """Area-weighted centroid of a ring as a struct of x and y; null for a ring without area."""
    n = F.size(ring)
    nxt = lambda i: F.get(ring, F.pmod(i + 1, n))
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    parts = F.transform(ring, lambda p, i: F.struct((p["x"] * nxt(i)["y"] - nxt(i)["x"] * p["y"]).alias("w"), (p["x"] + nxt(i)["x"]).alias("x"), (p["y"] + nxt(i)["y"]).alias("y")))
    return F.aggregate(
        parts,
        zero,
        lambda s, t: F.struct((s["a"] + t["w"]).alias("a"), (s["x"] + t["w"] * t["x"]).alias("x"), (s["y"] + t["w"] * t["y"]).alias("y")),
        lambda s: F.struct(F.try_divide(s["x"], 3 * s["a"]).alias("x"), F.try_divide(s["y"], 3 * s["a"]).alias("y")),
    )


def polyline_length_m(points: Column) -> Column:
    """Length of a line of (lat, lon) structs; null for fewer than two points."""
    steps = F.zip_with(F.slice(points, 1, F.size(points) - 1), F.slice(points, 2, F.size(points)), lambda a, b: haversine_m(a["lat"], a["lon"], b["lat"], b["lon"]))
    return F.when(F.size(points) >= 2, F.aggregate(steps, F.lit(0.0), lambda a, b: a + b))


def middle_point(points: Column) -> Column:
    """Element n // 2 of a line; null for fewer than two points."""
    return F.when(F.size(points) >= 2, F.get(points, F.floor(F.size(points) / 2).cast("int")))


#: Tag values and limits of the road rules.
FAST = "('motorway', 'motorway_link', 'trunk', 'trunk_link')"
PROTECTED = "('track', 'separate', 'opposite_track')"
PAINTED = "('lane', 'shared_lane', 'advisory', 'exclusive', 'link', 'opposite_lane')"
ROUGH = "('unpaved', 'gravel', 'dirt', 'ground', 'grass', 'sand', 'cobblestone', 'sett')"
_OPEN = "bicycle in ('yes', 'designated')"
NO, YES, UNCERTAIN = "non_cyclable", "cyclable", "incertain"
#: Road rules in order, negative ones first, as (status, SQL condition on cleaned tags and the number ``speed``).
ROAD_RULES = (
    (NO, "bicycle = 'no'"),
    (NO, "access = 'no' and bicycle not in ('yes', 'designated', 'permissive')"),
    (NO, f"highway in {FAST} and cycleway not in {PROTECTED} and not {_OPEN}"),
    (NO, f"speed > 50 and cycleway not in {PROTECTED} and cycleway <> 'lane' and not {_OPEN}"),
    (NO, f"surface in {ROUGH} and cycleway not in {PROTECTED} and not {_OPEN}"),
    (NO, f"cycleway in {PAINTED} and speed > 70"),
    (YES, "highway in ('cycleway', 'living_street')"),
    (YES, f"highway in ('pedestrian', 'path') and {_OPEN}"),
    (YES, f"cycleway in {PROTECTED} and coalesce(speed, 0) <= 50"),
    (YES, f"cycleway in {PAINTED} and speed <= 30"),
    (YES, f"cycleway in {PAINTED} and speed <= 50 and surface in ('asphalt', 'concrete', 'paved')"),
    (YES, f"cycleway in {PAINTED} and speed is null and highway in ('residential', 'service', 'unclassified')"),
    (YES, "bicycle = 'designated'"),
)
_TAGS = ("highway", "cycleway", "bicycle", "access", "surface")


def road_status(roads: DataFrame, rules: tuple[tuple[str, str], ...] = ROAD_RULES) -> DataFrame:
    """Add ``status`` to rows with the tags highway, cycleway, bicycle, access, surface and maxspeed: the first rule that holds, else uncertain."""
    clean = F.struct(*[F.lower(F.trim(F.coalesce(c, F.lit("")))).alias(c) for c in _TAGS], first_digits(F.col("maxspeed")).alias("speed"))
    names = re.compile(rf"\b({'|'.join(_TAGS)}|speed)\b(?!')")
    case = " ".join(f"when {names.sub(r'clean_tags.\1', condition)} then '{status}'" for status, condition in rules)
    return roads.withColumn("clean_tags", clean).withColumn("status", F.expr(f"case {case} else '{UNCERTAIN}' end")).drop("clean_tags")


def trimmed_mean(values: Column, trim: Column, least: int = 5) -> Column:
    """Trimmed mean of an array: under ``least`` values their median, 0 for none; else the mean of the values
    between the linear quantiles ``trim`` and 1 - ``trim``, both included."""
    ordered = F.array_sort(values)

    def quantile(s: Column, p: Column) -> Column:
        at = p * (F.size(s) - 1)
        low = F.floor(at).cast("int")
        a, b = F.get(s, low), F.get(s, F.least(low + 1, F.size(s) - 1))
        return a + (b - a) * (at - low)

    def mean(s: Column) -> Column:
        # the bounds are bound to a variable, so that they are made once and not for every value
        bounds = F.array(F.struct(quantile(s, trim).alias("low"), quantile(s, 1 - trim).alias("high")))
        kept = F.transform(bounds, lambda b: F.filter(s, lambda x: (x >= b["low"]) & (x <= b["high"])))
        return F.transform(kept, lambda k: F.coalesce(F.try_divide(F.aggregate(k, F.lit(0.0), lambda a, b: a + b), F.size(k)), F.lit(0.0)))[0]

    one = F.transform(F.array(ordered), lambda s: F.when(F.size(s) == 0, 0.0).when(F.size(s) < least, quantile(s, F.lit(0.5))).otherwise(mean(s)))
    return one[0]


def water_kind(tags: Column) -> Column:
    """Kind of a water line from a map of tags: river or canal by its waterway, else coastline."""
    way = F.element_at(tags, F.lit("waterway"))
    return F.when(way.isin("river", "canal"), way).otherwise("coastline")
