"""Spatial operators as cell equi-joins with an exact test behind.

Geometries are arrays of (x, y) structs in metres. A polygon's cells are exploded once and
a point or segment joins on its own cells, so no join compares all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import product
from math import radians

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroad.functions.scalars import EARTH_M, UNCERTAIN, YES, street_name
from tallyroad.sources.scratch import materialize, shared_dir


def _ends(ring: str, axis: str) -> tuple[Column, Column]:
    values = F.transform(ring, lambda p: p[axis])
    return F.array_min(values), F.array_max(values)


def cells_of(ring: str, size: float) -> Column:
    """Cells that a ring's box touches, as structs of i and j."""
    (x0, x1), (y0, y1) = _ends(ring, "x"), _ends(ring, "y")
    at = lambda v: F.floor(v / size).cast("int")
    return F.flatten(F.transform(F.sequence(at(x0), at(x1)), lambda i: F.transform(F.sequence(at(y0), at(y1)), lambda j: F.struct(i.alias("i"), j.alias("j")))))


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd test: lower and left edges count as inside."""
    n = F.size(ring)
    crossing = F.transform(
        ring,
        lambda a, i: F.transform(F.array(F.get(ring, F.pmod(i + 1, n))), lambda b: ((a["y"] <= y) != (b["y"] <= y)) & (x < (b["x"] - a["x"]) * F.try_divide(y - a["y"], b["y"] - a["y"]) + a["x"]))[0],
    )
    return F.size(F.filter(crossing, lambda c: F.coalesce(c, F.lit(False)))) % 2 == 1


def points_in_polygons(points: DataFrame, polygons: DataFrame, size: float) -> DataFrame:
    """First polygon (by id) that holds each point, null for none. ``points``: id, x, y; ``polygons``: polygon, ring."""
    cells = polygons.select("polygon", "ring", F.explode(cells_of("ring", size)).alias("cell"))
    placed = points.withColumn("cell", F.struct(F.floor(F.col("x") / size).cast("int").alias("i"), F.floor(F.col("y") / size).cast("int").alias("j")))
    hits = placed.join(cells, "cell").where(contains(F.col("ring"), F.col("x"), F.col("y"))).groupBy("id").agg(F.min("polygon").alias("polygon"))
    return points.join(hits, "id", "left").select("id", "x", "y", "polygon")


def polygon_or_nearest(points: DataFrame, polygons: DataFrame, centres: DataFrame, size: float) -> DataFrame:
    """As before, and the nearest centre's polygon where no polygon holds the point. ``centres``: polygon, x, y."""
    found = points_in_polygons(points, polygons, size)
    lost = nearest(found.where("polygon is null").select("id", "x", "y"), centres, size)
    return found.join(lost.select("id", F.col("polygon").alias("near")), "id", "left").select("id", "x", "y", F.coalesce("polygon", "near").alias("polygon"))


#: Children of a cell along an axis, most cells of the coarsest level, and most cells that are broadcast (their number is counted first).
FANOUT, TOP_CELLS, BROADCAST_CELLS = 4, 64, 10_000
#: Entries that share a cell on average when cells are narrow enough, most entries a site for that, and how often cells are halved at most.
CROWD, SPREAD, HALVINGS = 4, 16, 16


def _cell_at(axes: list[str], prefix: str, size: float) -> Column:
    return F.struct(*[F.floor(F.col(prefix + a) / size).cast("long").alias(a) for a in axes])


def _fitted(sites: DataFrame, cells: Callable[[float], Column], size: float) -> float:
    """``size``, halved until an entry shares its cell with CROWD entries on average (itself included), as long as sites have no more than SPREAD cells each.

    ``cells`` gives a site's cells of a size as an array. No result depends on the size of cells, only the pairs that are looked at.
    """
    n, fits = sites.count(), size
    for _ in range(HALVINGS + 1):
        held = sites.select(F.explode(cells(size)).alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        entries, met = held.agg(F.sum("n"), F.sum(F.col("n") * F.col("n"))).first()
        if not entries or entries > SPREAD * n:
            break
        fits, size = size, size / 2
        if met <= CROWD * entries:
            break
    return fits


def _by_place(points: DataFrame, axes: list[str], search: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``search`` finds for each place, by ``id``, for every point there: points of one place are searched once."""
    place = F.struct(*axes)
    places = materialize(points.select(*axes).distinct().select(place.alias("id"), *axes), "places")
    return points.select("id", place.alias("place")).join(search(places).withColumnRenamed("id", "place"), "place").drop("place")


def _closest(points: DataFrame, placed: DataFrame, axes: list[str], size: float, distance: Column, straight: Column, slack: float) -> DataFrame:
    """(id, site, distance): site of least (distance, site) for each point; ``distance`` must fall as ``straight``, the one between the axes, falls.

    ``points``: id and axes; ``placed``: site, a point of it (axes with an ``s`` before) and ``cell``, one row for each cell
    of ``size`` that it may touch, and what the distances read. Points with a site no farther than ``size`` find it in the cells around their own. The others go down a pyramid of occupied cells: a cell is left out when its
    box lies farther away than some site does that is known already, and every level is written, so neither the plan nor
    a point's cells grow. ``slack`` keeps what rounding may have put a little too far away.
    """
    gap = lambda other: F.sqrt(sum((F.pow(F.col(a) - other(a), 2) for a in axes), F.lit(0.0)))
    pick = F.min(F.struct(distance.alias("distance"), "site", straight.alias("gap"))).alias("best")
    own = _cell_at(axes, "", size)
    ring = F.array(*[F.struct(*[(own[a] + d).alias(a) for a, d in zip(axes, moves, strict=True)]) for moves in product((-1, 0, 1), repeat=len(axes))])
    best = points.withColumn("cell", F.explode(ring)).join(placed, "cell").groupBy("id").agg(pick)
    done = materialize(best.where(F.col("best.gap") + slack <= size).select("id", "best.site", "best.distance"), "near")
    left = materialize(points.join(done.select("id"), "id", "left_anti"), "far-points")
    if left.isEmpty():
        return done
    first = F.min(F.struct("site", *[F.col(f"s{a}").alias(a) for a in axes])).alias("rep")
    levels = [materialize(placed.groupBy("cell").agg(first), "cells")]
    counts = [levels[0].count()]
    while counts[-1] > TOP_CELLS:
        up = F.struct(*[F.floor(F.col("cell")[a] / FANOUT).cast("long").alias(a) for a in axes])
        levels.append(materialize(levels[-1].groupBy(up.alias("cell")).agg(F.min("rep").alias("rep")), "cells"))
        counts.append(levels[-1].count())
    if not counts[0]:
        return done
    # at most TOP_CELLS rows
    top = F.array(*[F.struct(*[F.lit(r["cell"][a]).cast("long").alias(a) for a in axes], *[F.lit(float(r["rep"][a])).alias(f"r{a}") for a in axes]) for r in levels[-1].collect()])

    def box(cell: Column, level: int) -> Column:
        width = size * FANOUT**level
        beyond = [F.greatest(cell[a] * width - F.col(a), F.col(a) - (cell[a] + 1) * width, F.lit(0.0)) for a in axes]
        return F.sqrt(sum((F.pow(v, 2) for v in beyond), F.lit(0.0)))

    # the coarsest cells are left out within each row
    found = left.withColumn("known", F.array_min(F.transform(top, lambda c: gap(lambda a: c[f"r{a}"]))))
    found = found.withColumn("cell", F.explode(F.filter(top, lambda c: box(c, len(levels) - 1) <= F.col("known") + slack)))
    kept = materialize(found.select("id", *axes, F.struct(*[F.col("cell")[a].alias(a) for a in axes]).alias("cell")), "far-cells")
    for level in range(len(levels) - 2, -1, -1):
        below = levels[level].select(F.struct(*[F.floor(F.col("cell")[a] / FANOUT).cast("long").alias(a) for a in axes]).alias("parent"), F.col("cell").alias("child"), "rep")
        below = F.broadcast(below) if counts[level] <= BROADCAST_CELLS else below
        found = kept.join(below, kept["cell"] == below["parent"]).select("id", *axes, F.col("child").alias("cell"), "rep")
        known = F.min(gap(lambda a: F.col("rep")[a])).over(Window.partitionBy("id"))
        kept = materialize(found.withColumn("box", box(F.col("cell"), level)).withColumn("known", known).where(F.col("box") <= F.col("known") + slack).select("id", *axes, "cell"), "far-cells")
    far = kept.join(placed, "cell").groupBy("id").agg(pick).select("id", "best.site", "best.distance")
    return done.unionByName(far)


def nearest(points: DataFrame, sites: DataFrame, size: float) -> DataFrame:
    """(id, polygon, distance): nearest site of each point, the smaller id of equals. ``points``: id, x, y; ``sites``: polygon, x, y. Without sites there are no rows."""
    distance = F.sqrt(F.pow(F.col("x") - F.col("sx"), 2) + F.pow(F.col("y") - F.col("sy"), 2))
    alone = materialize(sites.groupBy(F.col("x").alias("sx"), F.col("y").alias("sy")).agg(F.min("polygon").alias("site")), "sites")
    width = _fitted(alone, lambda w: F.array(_cell_at(["x", "y"], "s", w)), size)
    placed = alone.withColumn("cell", _cell_at(["x", "y"], "s", width))
    found = _by_place(points, ["x", "y"], lambda places: _closest(places, placed, ["x", "y"], width, distance, distance, 1e-9 * size))
    return _least_of(found).select("id", F.col("site").alias("polygon"), "distance")


def _least_of(found: DataFrame) -> DataFrame:
    """One row for each id, should it stand at several places."""
    return found.groupBy("id").agg(F.min(F.struct("distance", "site")).alias("best")).select("id", "best.site", "best.distance")


def nearest_on_sphere(points: DataFrame, sites: DataFrame, degrees: float = 2.0) -> DataFrame:
    """(id, site, metres): nearest site by great-circle distance, the smaller id of equals, anywhere on the globe.

    ``points``: id, lat, lon; ``sites``: site, slat, slon. Cells are cubes around the unit sphere, where straight
    distances grow with great-circle ones; ``degrees`` is their width.
    """
    axes = ["x", "y", "z"]

    def vectors(df: DataFrame, lat: str, lon: str, prefix: str) -> DataFrame:
        a, b = F.radians(lat), F.radians(lon)
        return df.withColumns({f"{prefix}x": F.cos(a) * F.cos(b), f"{prefix}y": F.cos(a) * F.sin(b), f"{prefix}z": F.sin(a)})

    # straight distances are good to about 1e-16, which the rounding to a micrometre may turn into an equal one
    straight = F.sqrt(sum((F.pow(F.col(a) - F.col(f"s{a}"), 2) for a in axes), F.lit(0.0)))
    metres = F.round(2 * EARTH_M * F.asin(F.least(straight / 2, F.lit(1.0))), 6)
    alone = materialize(vectors(sites.groupBy("slat", "slon").agg(F.min("site").alias("site")), "slat", "slon", "s"), "sites")
    width = _fitted(alone, lambda w: F.array(_cell_at(axes, "s", w)), radians(degrees))
    placed = alone.withColumn("cell", _cell_at(axes, "s", width))
    search = lambda places: _closest(vectors(places, "lat", "lon", "").select("id", *axes), placed, axes, width, metres, straight, 1e-11)
    return _least_of(_by_place(points, ["lat", "lon"], search)).select("id", "site", F.col("distance").alias("metres"))


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance of a point to a segment."""
    t = F.coalesce(F.try_divide((px - ax) * (bx - ax) + (py - ay) * (by - ay), F.pow(bx - ax, 2) + F.pow(by - ay, 2)), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return F.sqrt(F.pow(px - (ax + t * (bx - ax)), 2) + F.pow(py - (ay + t * (by - ay)), 2))


def inside_lengths(segments: np.ndarray, rings: list[np.ndarray], edges_at_once: int = 1 << 20) -> np.ndarray:
    """Length of each segment (ax, ay, bx, by) inside a polygon: parts between crossings whose middle lies inside by even-odd count."""
    p = np.concatenate(rings)
    q = np.concatenate([np.roll(r, -1, axis=0) for r in rings])
    out, step = np.empty(len(segments)), max(1, edges_at_once // len(p))
    for low in range(0, len(segments), step):
        ax, ay, bx, by = (segments[low : low + step, k][:, None] for k in range(4))
        d = (bx - ax) * (q[:, 1] - p[:, 1]) - (by - ay) * (q[:, 0] - p[:, 0])
        with np.errstate(divide="ignore", invalid="ignore"):
            t = ((p[:, 0] - ax) * (q[:, 1] - p[:, 1]) - (p[:, 1] - ay) * (q[:, 0] - p[:, 0])) / d
            u = ((p[:, 0] - ax) * (by - ay) - (p[:, 1] - ay) * (bx - ax)) / d
            t = np.where((d != 0) & (t > 0) & (t < 1) & (u >= 0) & (u <= 1), t, 1.0)
        cuts = np.sort(np.hstack([np.zeros((len(t), 1)), t, np.ones((len(t), 1))]), axis=1)
        cuts = cuts[:, : int((cuts < 1).sum(axis=1).max(initial=1)) + 1]
        total = np.zeros(len(t))
        for k in range(cuts.shape[1] - 1):  # parts of all segments at once
            mid = (cuts[:, k + 1] + cuts[:, k])[:, None] / 2
            x, y = ax + mid * (bx - ax), ay + mid * (by - ay)
            crosses = (p[:, 1] <= y) != (q[:, 1] <= y)
            with np.errstate(divide="ignore", invalid="ignore"):
                at = p[:, 0] + (y - p[:, 1]) * (q[:, 0] - p[:, 0]) / (q[:, 1] - p[:, 1])
            inside = (crosses & (x < at)).sum(axis=1) % 2 == 1
            total += np.where(inside, cuts[:, k + 1] - cuts[:, k], 0.0)
        out[low : low + step] = total * np.hypot(bx - ax, by - ay)[:, 0]
    return out


def clip_lengths(segments: DataFrame, polygons: DataFrame, size: float, least_m: float = 0.01) -> DataFrame:
    """(line, polygon, length_m, part): length of each line inside each polygon; pieces of ``least_m`` or less are dropped.

    ``segments``: line, ax, ay, bx, by; ``polygons``: polygon, ring. Holes are further rows of the same polygon. Segments
    of a batch are clipped together polygon by polygon.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            polygon = batch.column("polygon").to_numpy(zero_copy_only=False)
            ends = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("ax", "ay", "bx", "by")], axis=1)
            order = np.argsort(polygon, kind="stable")
            values = np.empty(len(order))
            for rows in np.split(order, np.flatnonzero(np.diff(polygon[order])) + 1):
                rings = [np.array([(p["x"], p["y"]) for p in ring]) for ring in batch.column("rings")[int(rows[0])].as_py()]
                values[rows] = inside_lengths(ends[rows], rings)
            yield pa.RecordBatch.from_arrays([batch.column("line"), batch.column("polygon"), pa.array(values, pa.float64())], names=["line", "polygon", "length_m"])

    whole = polygons.groupBy("polygon").agg(F.collect_list("ring").alias("rings"))
    cells = polygons.select("polygon", F.explode(cells_of("ring", size)).alias("cell")).distinct()
    box = F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")))
    numbered = segments.withColumn("__box", box)
    met = numbered.select("line", "ax", "ay", "bx", "by", F.explode(cells_of("__box", size)).alias("cell")).join(cells, "cell").select("line", "ax", "ay", "bx", "by", "polygon").distinct()
    parts = met.join(whole, "polygon").mapInArrow(run, "line long, polygon long, length_m double").groupBy("line", "polygon").agg(F.sum("length_m").alias("length_m"))
    lines = segments.groupBy("line").agg(F.sum(F.sqrt(F.pow(F.col("bx") - F.col("ax"), 2) + F.pow(F.col("by") - F.col("ay"), 2))).alias("total_m"))
    return parts.where(F.col("length_m") > least_m).join(lines, "line").select("line", "polygon", "length_m", F.try_divide("length_m", F.col("total_m")).alias("part"))


def containers(polygons: DataFrame, size: float) -> DataFrame:
    """Polygons that hold another polygon's centre and box and are larger: to be dropped. ``polygons``: polygon, ring, area."""
    (x0, x1), (y0, y1) = _ends("ring", "x"), _ends("ring", "y")
    boxed = polygons.select("polygon", "ring", "area", x0.alias("x0"), x1.alias("x1"), y0.alias("y0"), y1.alias("y1"))
    inner = boxed.withColumn("cell", F.struct(F.floor((F.col("x0") + F.col("x1")) / 2 / size).cast("int").alias("i"), F.floor((F.col("y0") + F.col("y1")) / 2 / size).cast("int").alias("j")))
    o = boxed.withColumn("cell", F.explode(cells_of("ring", size))).toDF("outer", "outer_ring", "outer_area", "bx0", "bx1", "by0", "by1", "cell")
    held = (F.col("outer") != F.col("polygon")) & (F.col("outer_area") > F.col("area")) & (F.col("x0") >= F.col("bx0")) & (F.col("x1") <= F.col("bx1")) & (F.col("y0") >= F.col("by0")) & (F.col("y1") <= F.col("by1"))
    return inner.join(o, "cell").where(held & contains(F.col("outer_ring"), (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2)).select(F.col("outer").alias("polygon")).distinct()


def touching(polygons: DataFrame, size: float) -> DataFrame:
    """Pairs (a < b) of polygons whose boxes meet in a common cell and overlap: edges of the contact graph."""
    (x0, x1), (y0, y1) = _ends("ring", "x"), _ends("ring", "y")
    boxed = polygons.select("polygon", x0.alias("x0"), x1.alias("x1"), y0.alias("y0"), y1.alias("y1"), F.explode(cells_of("ring", size)).alias("cell"))
    b = boxed.toDF("b", "bx0", "bx1", "by0", "by1", "cell")
    return boxed.join(b, "cell").where("polygon < b and x0 <= bx1 and bx0 <= x1 and y0 <= by1 and by0 <= y1").select(F.col("polygon").alias("a"), "b").distinct()


def components(nodes: DataFrame, edges: DataFrame, checkpoint: bool = True) -> DataFrame:
    """(node, component): the least node each can reach. Labels spread over edges and jump to their label's label each round."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    labels = nodes.select("node", F.col("node").alias("component"))
    spark = nodes.sparkSession
    if checkpoint and not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    both = both.checkpoint() if checkpoint else both
    while True:
        near = both.join(labels, both["a"] == labels["node"]).groupBy(F.col("b").alias("node")).agg(F.min("component").alias("least"))
        spread = labels.join(near, "node", "left").select("node", F.least("component", F.coalesce("least", "component")).alias("component"))
        heads = spread.select(F.col("node").alias("head"), F.col("component").alias("next"))
        jumped = spread.join(heads, spread["component"] == heads["head"], "left").select("node", F.least("component", F.coalesce("next", "component")).alias("component"))
        new = jumped.checkpoint() if checkpoint else jumped
        if not new.join(labels.withColumnRenamed("component", "before"), "node").where("component != before").head(1):
            return new
        labels = new


def isolated(candidates: DataFrame, bases: DataFrame, edges: DataFrame, least_m: float, size: float) -> DataFrame:
    """Candidates (id, x, y) that touch no base and lie farther than ``least_m`` from every base's centre (polygon, x, y)."""
    linked = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(bases.select(F.col("polygon").alias("b")), "b", "left_semi").select(F.col("a").alias("id"))
    free = candidates.join(linked, "id", "left_anti")
    far = nearest(free, bases, size).where(F.col("distance") <= least_m).select("id")
    return free.join(far, "id", "left_anti")


def zonal_statistics(cells: DataFrame) -> DataFrame:
    """Minimum, maximum, mean, median, deviation, range and number of the values of each zone's cells. ``cells``: zone, value."""
    v = F.col("value")
    return cells.where(v.isNotNull()).groupBy("zone").agg(F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.percentile(v, F.lit(0.5)).alias("median"), F.stddev_pop(v).alias("std"), (F.max(v) - F.min(v)).alias("range"), F.count(v).alias("count"))


#: Road kinds that may belong to one route.
LOCAL_ROADS = "('residential', 'service', 'unclassified', 'living_street')"
COLLECTOR_ROADS = "('tertiary', 'tertiary_link', 'secondary', 'secondary_link')"
FAST_ROADS = ["motorway", "motorway_link", "trunk", "trunk_link"]


def propagate_status(roads: DataFrame, size: float, reach: float = 5.0, rounds: int = 2) -> DataFrame:
    """Uncertain roads become cyclable beside a cyclable road of the same name and a kind that fits, whose box meets theirs widened by ``reach``.

    ``roads``: id, name, highway, status, x0, x1, y0, y1. Rounds are synchronous; names are compared cleaned.
    """
    near = lambda grow: F.explode(F.flatten(F.transform(F.sequence(F.floor((F.col("x0") - grow) / size).cast("int"), F.floor((F.col("x1") + grow) / size).cast("int")), lambda i: F.transform(F.sequence(F.floor((F.col("y0") - grow) / size).cast("int"), F.floor((F.col("y1") + grow) / size).cast("int")), lambda j: F.struct(i.alias("i"), j.alias("j"))))))
    out = roads.withColumn("street", street_name(F.col("name"))).withColumn("kind", F.lower(F.coalesce("highway", F.lit(""))))
    fits = F.expr(f"kind = k or 'cycleway' in (kind, k) or (kind in {LOCAL_ROADS} or kind in {COLLECTOR_ROADS}) and (k in {LOCAL_ROADS} or k in {COLLECTOR_ROADS})")
    for _ in range(rounds):
        todo = out.where((F.col("status") == UNCERTAIN) & F.col("street").isNotNull() & ~F.col("kind").isin(FAST_ROADS)).select("id", "street", "kind", "x0", "x1", "y0", "y1", near(reach).alias("cell"))
        sure = out.where((F.col("status") == YES) & F.col("street").isNotNull()).select("street", F.col("kind").alias("k"), F.col("x0").alias("sx0"), F.col("x1").alias("sx1"), F.col("y0").alias("sy0"), F.col("y1").alias("sy1"), near(0.0).alias("cell"))
        meets = (F.col("x0") - reach <= F.col("sx1")) & (F.col("sx0") <= F.col("x1") + reach) & (F.col("y0") - reach <= F.col("sy1")) & (F.col("sy0") <= F.col("y1") + reach)
        found = todo.join(sure, ["street", "cell"]).where(meets & fits).select("id").distinct().withColumn("found", F.lit(True))
        out = out.join(found, "id", "left").withColumn("status", F.when(F.col("found"), YES).otherwise(F.col("status"))).drop("found")
    return out.select(*roads.columns)


def line_distances(points: DataFrame, segments: DataFrame, kinds: list[str], reach: float | None = None, size: float = 1000.0) -> DataFrame:
    """Distance of each point to the nearest line of each kind, one column a kind; null for a kind without lines and, where ``reach`` is given, beyond it.

    ``points``: id, x, y; ``segments``: kind, ax, ay, bx, by. Segments are entered in the cells of their box and searched as
    sites are, with their first end as the point that is known of them.
    """
    box = F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")))
    d = segment_distance(*[F.col(c) for c in ("x", "y", "ax", "ay", "bx", "by")])

    def search(places: DataFrame) -> DataFrame:
        out = places.select("id")
        for kind in kinds:
            lines = segments.where(F.col("kind") == kind).select("ax", "ay", "bx", "by").distinct()
            lines = materialize(lines.select(F.xxhash64("ax", "ay", "bx", "by").alias("site"), F.col("ax").alias("sx"), F.col("ay").alias("sy"), "ax", "ay", "bx", "by").withColumn("box", box), "lines")
            cells = lambda w: F.transform(cells_of("box", w), lambda c: F.struct(c["i"].cast("long").alias("x"), c["j"].cast("long").alias("y")))
            width = reach or _fitted(lines, cells, size)
            placed = lines.withColumn("cell", F.explode(cells(width))).drop("box")
            if reach is None:
                found = _closest(places, placed, ["x", "y"], width, d, d, 1e-9 * size).select("id", F.col("distance").alias(f"dist_{kind}"))
            else:
                ring = F.array(*[F.struct((F.floor(F.col("x") / width) + i).alias("x"), (F.floor(F.col("y") / width) + j).alias("y")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
                found = places.withColumn("cell", F.explode(ring)).join(placed, "cell").groupBy("id").agg(F.min(d).alias(f"dist_{kind}")).where(F.col(f"dist_{kind}") <= reach)
            out = out.join(found, "id", "left")
        return out

    return _by_place(points, ["x", "y"], search).select("id", *[f"dist_{k}" for k in kinds])


def sample_cells(points: DataFrame, grid: DataFrame, size: float, nodata: float = -9999.0) -> DataFrame:
    """Value of the grid cell under each point; no-data cells are null. ``grid``: i, j, value with cells of ``size``."""
    placed = points.withColumn("i", F.floor(F.col("x") / size).cast("int")).withColumn("j", F.floor(F.col("y") / size).cast("int"))
    return placed.join(grid, ["i", "j"], "left").select(*points.columns, F.when(F.col("value") != nodata, F.col("value")).alias("value"))


def _simplified(points: list[tuple[float, float]], tolerance: float) -> list[tuple[float, float]]:
    keep, todo = {0, len(points) - 1}, [(0, len(points) - 1)]
    xy = np.array(points, float).reshape(-1, 2)
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        d = xy[b] - xy[a]
        rel = xy[a + 1 : b] - xy[a]
        length = np.hypot(*d)
        far = np.abs(d[0] * rel[:, 1] - d[1] * rel[:, 0]) / length if length else np.hypot(rel[:, 0], rel[:, 1])
        k = int(far.argmax())
        if far[k] > tolerance:
            keep.add(a + 1 + k)
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return [points[i] for i in sorted(keep)]


def simplify(df: DataFrame, column: str, tolerance: float) -> DataFrame:
    """Lines of (x, y) structs without points nearer than ``tolerance`` to the line that is left, for drawing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(column)
            lines = [None if v is None else [{"x": x, "y": y} for x, y in (_simplified([(p["x"], p["y"]) for p in v], tolerance) if len(v) > 2 else [(p["x"], p["y"]) for p in v])] for v in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(lines, pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(run, df.schema)
