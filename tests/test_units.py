"""Properties and small cases of the operators."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyroad.functions import scalars as C
from tallyroad.operators import assembly, checks, estimation, learning, profiles, robustness, spatial, tags
from tallyroad.operators import sensors as S
from tallyroad.plans import models
from tallyroad.sources import readers, writers
from tests_env import SF


def one(spark, column, schema="x string", *values):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(column).collect()]


def test_scalar_cases(spark):
    x = F.col("x")
    assert one(spark, C.pad_code(x, 5), "x string", "1004", " 1004.0 ", "123456") == ["01004", "01004", "123456"]
    assert one(spark, C.tag_number(x), "x string", "30 mph", "2,5 m", "fr:urban", "fast", None) == [pytest.approx(48.27), 2.5, 50.0, None, None]
    assert one(spark, C.first_digits(x), "x string", "zone 30 km", "none") == [30, None]
    assert one(spark, C.to_int(x), "x string", "3,9", "-3.9", "x") == [3, -3, 0]
    assert one(spark, C.split_clean(x), "x string", "a / / b") == [["a", "b"]]
    assert one(spark, C.kind_of_name(x), "x string", "Voie Verte du Sud", "Rue X", None, "Quai Y") == [1, 6, 0, 4]
    assert one(spark, C.kind_of_reference(x), "x string", "EV 6", "D12", None) == [1, 2, 0]
    assert one(spark, C.street_name(x), "x string", "  Rue,  du. Pont ", ",.") == ["rue du pont", None]
    assert one(spark, C.direction_factor(x), "x string", " Bidirectionnel ", "one way") == [2.0, 1.0]


def test_encode_round_trip(spark):
    df = spark.createDataFrame([(0.0,), (12.34,), (700.5,), (None,)], "v double")
    got = df.select(C.decode_flow(C.encode_flow(F.col("v")))).collect()
    assert [r[0] for r in got] == [0.0, 12.34, 700.5, None]


def test_fold_wraps_like_unsigned(spark):
    keys = [1, 7, 2**40 + 3, 2**62 + 11]
    want = [((k * 2654435761) % 2**64 // 128) % 5 for k in keys]
    assert one(spark, C.fold_of(F.col("x")), "x long", *keys) == want


def numpy_trim(v, r):
    v = np.asarray(v, float)
    if len(v) < 5:
        return float(np.median(v)) if len(v) else 0.0
    low, high = np.quantile(v, [r, 1 - r])
    return float(v[(v >= low) & (v <= high)].mean())


def test_trimmed_mean(spark):
    rng = np.random.default_rng(1)
    rows = [(0, rng.random(n).tolist()) for n in (0, 1, 4, 5, 9, 40)] + [(3, rng.random(17).tolist())]
    df = spark.createDataFrame(rows, "cluster int, v array<double>")
    got = [r[0] for r in df.select(C.trimmed_mean(F.col("v"), estimation.trims())).collect()]
    assert got == pytest.approx([numpy_trim(v, estimation.TRIMS[c]) for c, v in rows])
    long = spark.createDataFrame([(i, c, x) for i, (c, v) in enumerate(rows) for x in v], "g int, cluster int, rate double")
    rates = {r["g"]: r["rate"] for r in estimation.trimmed_rates(long, ["g", "cluster"]).collect()}
    assert [rates.get(i, 0.0) for i in range(len(rows))] == pytest.approx([numpy_trim(v, estimation.TRIMS[c]) for c, v in rows], abs=1e-6)


def test_leave_one_out_by_ranks(spark):
    """Errors of every trim against leaving out one rate after the other, with ties, few rates and a lone one."""
    rng = np.random.default_rng(2)
    rates = {0: rng.random(30).round(1), 1: rng.random(6).round(1), 2: rng.random(4).round(1), 3: np.array([0.5])}
    rows = [(2020 + i % 3, f"z{c}-{i}", c, 1, 2.0, 2.0 * float(v) + 1e-3) for c, vs in rates.items() for i, v in enumerate(vs)]
    observed = spark.createDataFrame(rows, "year int, zone string, cluster int, instrumented int, length_km double, km_obs double")
    grid = (0.0, 0.1, 0.2, 0.34, 0.48)
    got = {(r["cluster"], r["trim"]): (r["n"], r["error"]) for r in robustness.loocv_errors(observed, grid).collect()}
    assert len(got) == 4 * len(grid) and all(got[3, t] == (1, None) for t in grid)
    for c in (0, 1, 2):
        v = np.array([round(km / 2.0, 6) for _, _, k, _, _, km in rows if k == c])
        for trim in grid:
            errors = []
            for i in range(len(v)):
                o = np.delete(v, i)
                low, high = np.quantile(o, [trim, 1 - trim]) if len(o) >= 5 else (o.min(), o.max())
                k = o[(o >= low - 1e-12) & (o <= high + 1e-12)]
                errors.append(abs((k.mean() if len(k) else o.mean()) - v[i]))
            assert got[c, trim] == (len(v), pytest.approx(np.median(errors), abs=1e-9))


def test_bootstrap_ships_no_frame_for_each_draw(spark):
    """A frame's rates are copied once for DRAWS_A_COPY draws, and draws use every index about as often."""
    rows = [(2020, f"z{i}", 0, 1, 1.0, float(i + 1)) for i in range(40)]
    observed = spark.createDataFrame(rows, "year int, zone string, cluster int, instrumented int, length_km double, km_obs double")
    draws = robustness.bootstrap_national(observed, 1000)
    plan = draws._jdf.queryExecution().optimizedPlan().toString()
    # read from the top: draws are made behind the shuffle of the copies
    assert plan.index("MapInArrow") < plan.index("RepartitionByExpression") < plan.index("explode(")
    assert draws.count() == 1000 and draws.select("draw").distinct().count() == 1000
    counts = np.bincount(robustness.draw_indexes(20201, np.arange(2000), 40).ravel(), minlength=40)
    assert len(counts) == 40 and 1800 < counts.min() and counts.max() < 2200


def test_trimmed_means_of_rows():
    rng = np.random.default_rng(3)
    for n in (0, 1, 4, 5, 30):
        rows = rng.random((6, n)).round(1)
        for trim in (0.0, 0.34, 0.48):
            want = []
            for v in rows:
                kept = v[(v >= np.quantile(v, trim) - 1e-12) & (v <= np.quantile(v, 1 - trim) + 1e-12)] if n >= 5 else v
                want.append(0.0 if n == 0 else np.median(v) if n < 5 else kept.mean())
            assert robustness.trimmed_means(rows, trim) == pytest.approx(want)


def test_golden_identities():
    """Extrapolation identity on published figures: observed plus rate on the unobserved length."""
    obs, rate, total, seen = 1.0e9, 52_000.0, 60_000.0, 10_000.0
    assert obs + rate * max(total - seen, 0) == 1.0e9 + 52_000.0 * 50_000.0


def test_missing_flow_makes_the_hour_missing(spark):
    rows = [(1, 1, 0, 2.0), (1, 2, 0, 3.0), (1, 1, 1, None), (1, 2, 1, 4.0), (1, 1, 2, 5.0)]
    got = {r["hour_idx"]: r["value"] for r in S.site_hours(spark.createDataFrame(rows, "site long, flow int, hour_idx int, value double")).collect()}
    assert got == {0: 5.0, 1: None}


def test_constant_series_profiles(spark):
    rows = [(1, h, 3.0) for h in range(336)]
    df = spark.createDataFrame(rows, "site long, hour_idx int, value double").withColumn("ts", F.timestamp_add("HOUR", F.col("hour_idx"), F.lit("2024-01-01").cast("timestamp_ntz")))
    assert {r["mean"] for r in profiles.daily(df).collect()} == {3.0}
    assert profiles.spectral_features(np.full(100, 2.0)) == pytest.approx([0.0] * 5)
    wave = profiles.spectral_features(np.sin(np.arange(24 * 50) * 2 * np.pi / 24))
    assert wave[1] > 0.99 and wave[4] < 0.1


def test_city_expansion(spark):
    members = assembly.city_members(assembly.DISTRICT_CITIES, spark)
    got = {r[0] for r in assembly.expand_cities(spark.createDataFrame([("75056",), ("01004",)], "zone string"), members).collect()}
    assert len(got) == 22 and {"75101", "75120", "01004", "75056"} <= got


def test_vintage_rule(spark):
    pop = spark.createDataFrame([(1995, 1, 10.0), (1999, 1, 20.0)], "vintage int, area int, population double")
    got = {r["year"]: (r["vintage"], r["rule"]) for r in assembly.population_used(pop, (1994, 1995, 1997, 2001), (1995, 1999)).collect()}
    assert got == {1994: (1995, assembly.LATER), 1995: (1995, assembly.EXACT), 1997: (1999, assembly.LATER), 2001: (1999, assembly.EARLIER)}


def test_tie_goes_to_the_smaller_cluster(spark):
    detail = spark.createDataFrame([(1, "z", 2, 5.0), (1, "z", 1, 5.0), (1, "z", None, 50.0)], "year int, zone string, cluster int, qta double")
    assert assembly.cluster_votes(detail).collect()[0]["vote"] == 1


def test_clip_shares_add_up(spark):
    square = lambda i: (i, [{"x": float(x), "y": float(y)} for x, y in ((i * 10, 0), (i * 10 + 10, 0), (i * 10 + 10, 10), (i * 10, 10))])
    polygons = spark.createDataFrame([square(0), square(1)], "polygon long, ring array<struct<x:double,y:double>>")
    lines = spark.createDataFrame([(1, 2.0, 5.0, 18.0, 5.0), (2, 5.0, 5.0, 5.0, 30.0)], "line long, ax double, ay double, bx double, by double")
    got = {(r["line"], r["polygon"]): round(r["length_m"], 6) for r in spatial.clip_lengths(lines, polygons, 7.0).collect()}
    assert got == {(1, 0): 8.0, (1, 1): 8.0, (2, 0): 5.0}
    hole = [np.array([[0, 0], [10, 0], [10, 10], [0, 10]], float), np.array([[4, 0], [6, 0], [6, 10], [4, 10]], float)]
    assert spatial.inside_lengths(np.array([[0.0, 5, 10, 5], [0, -1, 0.5, -1], [5, -5, 5, 20]]), hole) == pytest.approx([8.0, 0.0, 0.0])
    rng = np.random.default_rng(6)
    some = rng.uniform(-2, 12, (50, 4))
    assert spatial.inside_lengths(some, hole, 16) == pytest.approx(spatial.inside_lengths(some, hole))
    t = (np.arange(4000) + 0.5) / 4000
    for (ax, ay, bx, by), got in zip(some, spatial.inside_lengths(some, hole), strict=True):
        x, y = ax + t * (bx - ax), ay + t * (by - ay)
        inside = (x > 0) & (x < 10) & (y > 0) & (y < 10) & ~((x > 4) & (x < 6))
        assert got == pytest.approx(np.hypot(bx - ax, by - ay) * inside.mean(), abs=0.02)


def test_nearest_is_exact(spark):
    rng = np.random.default_rng(3)
    p, s = rng.random((40, 2)) * 100, np.vstack([rng.random((5, 2)) * 100, [[1000.0, 1000.0]]])
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(p)], "id long, x double, y double")
    sites = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(s)], "polygon long, x double, y double")
    got = {r["id"]: r["polygon"] for r in spatial.nearest(points, sites, 3.0).collect()}
    assert got == {i: int(((s - q) ** 2).sum(axis=1).argmin()) for i, q in enumerate(p)}
    assert spatial.nearest(points, sites.where("false"), 3.0).count() == 0 and spatial.nearest(points.where("false"), sites, 3.0).count() == 0


def test_nearest_of_far_clusters(spark, monkeypatch):
    """Points far from all sites descend to few cells: not every pair is made, and ties go to the smaller id."""
    monkeypatch.setattr(spatial, "BROADCAST_CELLS", 20)
    rng = np.random.default_rng(7)
    p, s = rng.random((60, 2)) * 50 - 20_000, rng.random((400, 2)) * 300
    s = np.vstack([s, s[:50]])  # equal places
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(p)] + [(99, None, 1.0)], "id long, x double, y double")
    sites = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(s)], "polygon long, x double, y double")
    pairs = []
    plain = spatial.materialize
    monkeypatch.setattr(spatial, "materialize", lambda df, label: pairs.append((label, (out := plain(df, label)).count())) or out)
    out = spatial.nearest(points, sites, 4.0)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 2
    got = {r["id"]: (r["polygon"], r["distance"]) for r in out.collect()}
    for i, q in enumerate(p):
        d = np.sqrt(((s - q) ** 2).sum(axis=1))
        assert got[i] == (int(d.argmin()), pytest.approx(d.min()))
    assert 99 not in got
    assert max(n for label, n in pairs if label == "far-cells") < 60 * 64


def searched(monkeypatch):
    """Rows of points, and most entries of a cell, of every search from now on."""
    seen, plain = [], spatial._closest
    monkeypatch.setattr(spatial, "_closest", lambda points, placed, *more: seen.append((points.count(), placed.groupBy("cell").count().agg(F.max("count")).first()[0])) or plain(points, placed, *more))
    return seen


def test_places_are_searched_once(spark, monkeypatch):
    """Points and sites of one place meet once, and sites that crowd a cell get narrower ones; every point is answered."""
    seen = searched(monkeypatch)
    points = spark.range(600).selectExpr("id", "45.0 + id % 6 / 10.0 as lat", "2.0D as lon")
    sites = spark.range(900).selectExpr("id + 7 as site", "45.01 + id % 300 / 200.0 as slat", "2.0D as slon")
    got = {r["id"]: r["site"] for r in spatial.nearest_on_sphere(points.withColumn("lat", F.col("lat").cast("double")), sites.withColumn("slat", F.col("slat").cast("double"))).collect()}
    assert got == {i: 7 + int(np.abs(45.01 + np.arange(300) / 200 - 45 - i % 6 / 10).argmin()) for i in range(600)}
    assert seen[0][0] == 6 and seen[0][1] <= 2 * spatial.CROWD


def test_nearest_on_sphere_everywhere(spark):
    rng = np.random.default_rng(8)
    p, s = (np.stack([np.degrees(np.arcsin(rng.uniform(-1, 1, n))), rng.uniform(-180, 180, n)], axis=1) for n in (50, 30))
    p[0], s[0] = (10.0, 179.9), (10.0, -179.9)  # across the antimeridian
    points = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(p)], "id long, lat double, lon double")
    sites = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(s)], "site long, slat double, slon double")
    got = {r["id"]: (r["site"], r["metres"]) for r in spatial.nearest_on_sphere(points, sites).collect()}
    for i, (a, b) in enumerate(np.radians(p)):
        lat, lon = np.radians(s).T
        d = 2 * 6371008.8 * np.arcsin(np.sqrt(np.sin((lat - a) / 2) ** 2 + np.cos(a) * np.cos(lat) * np.sin((lon - b) / 2) ** 2))
        assert got[i] == (int(d.argmin()), pytest.approx(d.min(), abs=1e-3))


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from tallyroad.sources import scratch

    unset = SimpleNamespace(get=lambda *_: None, set=lambda *_: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_dir(SimpleNamespace(conf=unset, sparkContext=SimpleNamespace(master="spark://host:7077")))
    assert scratch.shared_dir(SimpleNamespace(conf=unset, sparkContext=SimpleNamespace(master="local[4]"))).startswith("file:")


def test_components_chain(spark):
    nodes = spark.createDataFrame([(i,) for i in range(12)], "node long")
    edges = spark.createDataFrame([(i, i + 1) for i in range(8)], "a long, b long")
    got = {r["node"]: r["component"] for r in spatial.components(nodes, edges).collect()}
    assert got == {i: 0 if i <= 8 else i for i in range(12)}


def test_containers_and_touching(spark):
    box = lambda i, a, b: (i, [{"x": float(x), "y": float(y)} for x, y in ((a, a), (b, a), (b, b), (a, b))], float((b - a) ** 2))
    df = spark.createDataFrame([box(1, 0, 10), box(2, 2, 4), box(3, 20, 30)], "polygon long, ring array<struct<x:double,y:double>>, area double")
    assert [r[0] for r in spatial.containers(df, 5.0).collect()] == [1]
    assert [(r["a"], r["b"]) for r in spatial.touching(df, 5.0).collect()] == [(1, 2)]


def test_splines():
    b = learning.spline_values(np.linspace(0, 1, 50), 12)
    assert np.allclose(b.sum(axis=1), 1)
    g = learning.gram(12)
    x = np.linspace(0, 1, 20001)
    v = learning.spline_values(x, 12)
    assert np.allclose(g, (v.T * np.gradient(x)) @ v, atol=1e-4)
    line = 2 + 3 * np.linspace(0, 1, 24)
    assert np.allclose(learning.spline_values(np.linspace(0, 1, 24), 12) @ (learning.smoother(24, 12) @ line), line)


def test_parameter_counts():
    counts = {"DkBk": 3 + 12 + 3 * 16 + 24 + 4, "AkBk": 3 + 12 + 48 + 8, "AB": 3 + 12 + 48 + 2, "ABk": 3 + 12 + 48 + 5, "AkjB": 3 + 12 + 48 + 12 + 1}
    assert {m: learning.n_parameters(m, 4, 18) for m in counts} == counts


def test_mixture_finds_groups(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = np.array([[5, 0, 0, 0], [0, 5, 0, 0], [0, 0, 5, 0]])
    rows = [(int(i), (centres[i % 3] + rng.normal(0, 0.3, 4)).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "site long, coefs array<double>").repartition(3)
    mixture = learning.fit_mixture(df, np.eye(4), 3, "AkBk", seed=3)
    got = {r["site"]: r["cluster"] for r in learning.assign(df, mixture).collect()}
    assert len({(i % 3, got[i]) for i in range(120)}) == 3
    again = learning.fit_mixture(df.repartition(7), np.eye(4), 3, "AkBk", seed=3)
    assert again.bic == mixture.bic and (again.means == mixture.means).all()  # sums in a fixed order
    monkeypatch.setattr(learning, "BLOCK_ROWS", 10)
    assert learning.fit_mixture(df, np.eye(4), 3, "AkBk", seed=3).bic == pytest.approx(mixture.bic)


def test_mixture_start_never_collapses(spark):
    """An outlier of its own, or rows that are all alike, give a result for every model."""
    rng = np.random.default_rng(4)
    far = [(i, (rng.normal(0, 1, 4) + (100 if i == 5 else 0)).tolist()) for i in range(15)]
    same = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(15)]
    for rows in (far, same):
        df = spark.createDataFrame(rows, "site long, coefs array<double>")
        fits = learning.fit_mixtures(df, np.eye(4), [(2, "AkBk", 1), (3, "DkBk", 1), (2, "AB", 1)], maxit=6)
        for m in fits:
            assert np.isfinite(m.means).all() and m.shares.min() > 0 and m.shares.sum() == pytest.approx(1)
        assert learning.assign(df, fits[0]).count() == 15
    with pytest.raises(ValueError, match="fewer than two rows"):
        learning.fit_mixture(df.limit(3), np.eye(4), 2)


def test_random_parameters_and_balanced_accuracy(spark):
    drawn = learning.drawn_parameters()
    assert len(drawn) == 40 and len({tuple(d.values()) for d in drawn}) == 40 and learning.drawn_parameters(1000, space={"a": (1, 2), "b": (3,)}) in ([{"a": 1, "b": 3}, {"a": 2, "b": 3}], [{"a": 2, "b": 3}, {"a": 1, "b": 3}])
    df = spark.createDataFrame([(0.0, 0.0)] * 3 + [(0.0, 1.0)] + [(1.0, 1.0)], "label double, prediction double")
    assert learning.BalancedAccuracy("label").evaluate(df) == pytest.approx((0.75 + 1.0) / 2)


def test_attribute_models_and_report(spark):
    """Parameters of the tuned target are shared; metrics and baselines against counting by hand."""
    rows = [(i, float(i % 2), float(i % 5), i % 5, "ab"[i % 2], "xyz"[i % 3], "k" + str(i % 2), 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, f double, g double, fold int, easy string, hard string, key string, w double")
    models, chosen = learning.fit_attributes(df, ["f", "g"], ["easy", "hard"], ["easy"], [{"maxDepth": 2}, {"maxDepth": 3}], "w", trees=3)
    assert chosen["hard"] == chosen["easy"]
    scored = df.join(learning.score_attributes(models, df, ["id"]), "id")
    report = {r["target"]: r for r in learning.attribute_report(scored, {"easy": ["key"], "hard": ["key"]})}
    test = [r for r in scored.where("fold = 0").collect()]
    for t in ("easy", "hard"):
        real, guess = [r[t] for r in test], [r[f"pred_{t}"] for r in test]
        right = np.mean([a == b for a, b in zip(real, guess, strict=True)])
        assert report[t]["n_holdout"] == 40 and report[t]["n_train"] == 120 and report[t]["accuracy"] == pytest.approx(right)
        assert report[t]["balanced_accuracy"] == pytest.approx(np.mean([np.mean([g == c for a, g in zip(real, guess, strict=True) if a == c]) for c in set(real)]))
    assert report["easy"]["accuracy"] == report["easy"]["baseline_lookup"] == 1.0 and report["easy"]["cohen_kappa"] == 1.0 and report["easy"]["baseline_majority"] == 0.5


def test_mixture_search_refits(spark):
    rng = np.random.default_rng(4)
    centres = np.array([[5, 0, 0, 0], [0, 5, 0, 0]])
    df = spark.createDataFrame([(i, (centres[i % 2] + rng.normal(0, 0.3, 4)).tolist()) for i in range(60)], "site long, coefs array<double>")
    found = learning.search(df, np.eye(4), (2, 3), ("AkBk", "AB"), (1,), maxit=3, refit=2)
    assert len(found) == 4 and found[0]["k"] == 2 and [x["bic"] for x in found] == sorted((x["bic"] for x in found), reverse=True)


def test_vocabulary_and_lookup(spark):
    t = spark.createDataFrame([("k", "a")] * 3 + [("k", "b")] * 2 + [("k", None)], "key string, value string")
    assert [(r["value"], r["n"]) for r in tags.vocabulary(t, 3, 5).collect()] == [("a", 3)]
    df = spark.createDataFrame([(1, "x", "p"), (2, "x", "p"), (3, "x", "q"), (4, "x", "q"), (5, "y", "q")], "i int, k string, v string")
    got = {r["i"]: r["guess"] for r in tags.lookup_baseline(df, ["k"], "v", F.col("i") <= 3, "none").collect()}
    assert got == {4: "p", 5: "none"}


def test_constraints(spark):
    df = spark.createDataFrame([(1, 2), (1, None), (3, -1)], "k int, v int")
    got = {r["constraint"]: r["n_bad"] for r in checks.violations(df, "t", (("positive", "v > 0"),), "k").collect()}
    assert got == {"positive": 2, "unique": 1}
    with pytest.raises(ValueError, match="positive"):
        checks.require(df, (("positive", "v > 0"),))


def test_workbook_round_trip(spark, tmp_path):
    book = writers.Workbook()
    book.table("Figures", spark.createDataFrame([("a", 1.5), ("b & c", None)], "name string, value double"))
    book.figure("Other", "total", 3)
    path = str(tmp_path / "book.xlsx")
    book.save(path)
    got = readers.excel(spark, path, ["name", "value"], "Figures").where("name is not null").collect()
    assert [(r["name"], r["value"]) for r in got] == [("a", "1.5"), ("b & c", None)]


def test_wide_counter_sheet(spark, tmp_path):
    book = writers.Workbook()
    book.sheets["flows"] = [["h", 10, 10], ["h", 1, 2], ["h", "in", "out"], ["00:00", 4, 5], ["01:00", None, 6]]
    path = str(tmp_path / "flows.xlsx")
    book.save(path)
    got = {(r["flow"], r["hour_idx"]): r["value"] for r in readers.counter_workbook(spark, path, 2024).collect()}
    assert got == {(1, 0): 4.0, (2, 0): 5.0, (1, 1): None, (2, 1): 6.0}


def test_geometry_and_extract(spark, tmp_path):
    raw = readers.to_wkb_line([(1.0, 2.0), (3.0, 4.0)])
    assert readers.wkb_points(raw) == [[(1.0, 2.0), (3.0, 4.0)]]
    df = readers.decode_wkb(spark.createDataFrame([(1, bytearray(raw)), (2, None)], "id int, geometry binary"))
    assert [r["parts"] is None for r in df.orderBy("id").collect()] == [False, True]
    path = tmp_path / "m.osm"
    path.write_text('<osm><node id="1" lat="45" lon="3"/><node id="2" lat="45.1" lon="3"/><way id="7"><nd ref="1"/><nd ref="2"/><nd ref="9"/><tag k="highway" v="cycleway"/></way><relation id="5"><member type="way" ref="7" role=""/><tag k="type" v="route"/><tag k="route" v="bicycle"/><tag k="network" v="ncn"/></relation></osm>')
    parts = readers.osm_xml(spark, str(path))
    lines = readers.lines_from_nodes(parts["ways"], parts["nodes"])
    assert lines.select(F.size("points")).first()[0] == 2
    ranks = tags.route_ranks(readers.route_members(parts["relations"]), parts["ways"].select("way"))
    assert (ranks.first()["rank"], ranks.first()["n_routes"]) == (3, 1)


def test_geojson(spark, tmp_path):
    path = tmp_path / "z.geojson"
    path.write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"code":"01004"},"geometry":{"type":"LineString","coordinates":[[1,2],[3,4]]}},{"type":"Feature","properties":{"code":"x"},"geometry":null}]}')
    assert [r["properties"]["code"] for r in readers.export(spark, str(path)).collect()] == ["01004"]


def test_step_is_skipped_when_done(spark, tmp_path):
    path, calls = str(tmp_path / "t"), []

    def build():
        calls.append(1)
        return spark.range(3)

    assert writers.step(spark, path, build).count() == 3
    assert writers.step(spark, path, build).count() == 3
    assert len(calls) == 1
    assert writers.step(spark, path, build, force=True).count() == 3 and len(calls) == 2


def test_lengths_fall_back_by_year(spark):
    ref = spark.createDataFrame([(y, s, "z", 1.0) for y in (1, 2) for s in ("PARTIAL", "ALL")], "year int, scenario string, zone string, len double")
    fresh = spark.createDataFrame([(2, "PARTIAL", "z", 9.0), (2, "ALL", "z", 9.0)], ref.schema)
    got = {(r["year"], r["scenario"]): r["len"] for r in readers.lengths_with_fallback(fresh, ref, (2,)).collect()}
    assert got == {(1, "PARTIAL"): 1.0, (1, "ALL"): 1.0, (2, "PARTIAL"): 1.0, (2, "ALL"): 9.0}


def test_stream_of_events(spark, tmp_path):
    from tallyroad.streaming import hourly
    from tests_env import SF

    src = str(tmp_path / "in")
    spark.read.parquet(f"{SF}/events.parquet").repartition(2).write.parquet(src)
    query = hourly.append_hours(hourly.hourly_counts(hourly.read_events(spark, src, 10)), str(tmp_path / "out"), str(tmp_path / "ck"))
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0


def test_best_threshold(spark):
    rows = [(1, 0.9), (1, 0.8), (0, 0.7), (1, 0.6), (0, 0.1)]
    best = learning.best_threshold(spark.createDataFrame(rows, "y int, p double"), "y", "p").first()
    assert best["threshold"] == 0.6 and best["f1"] == pytest.approx(6 / 7)


def test_map_and_chart(spark, tmp_path):
    ring = [{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}, {"x": 1.0, "y": 1.0}]
    df = spark.createDataFrame([("a", ring)], "name string, ring array<struct<x:double,y:double>>")
    writers.map_html(writers.geojson_text(df, "ring", ["name"]), str(tmp_path / "m.html"), "Zones")
    assert "<path" in (tmp_path / "m.html").read_text()
    assert writers.bars_svg([("1", 2.0)], "t").count("<rect") == 1


def test_csv_codes(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_bytes("\ufeffcode;n\n01004;3\n2A004;\n".encode())
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    df = readers.csv(spark, str(path), StructType([StructField("code", StringType()), StructField("n", IntegerType())]), ";")
    assert [tuple(r) for r in df.collect()] == [("01004", 3), ("2A004", None)]
    writers.csv(df, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 2


def test_json_file(tmp_path):
    writers.json_file({"a": [1, "é"]}, str(tmp_path / "x.json"))
    assert readers.json_file(str(tmp_path / "x.json")) == {"a": [1, "é"]}


def test_download_resumes(tmp_path):
    source = tmp_path / "source.bin"
    source.write_bytes(bytes(range(256)) * 20)
    got = readers.download(source.as_uri(), str(tmp_path / "got.bin"))
    assert got.read_bytes() == source.read_bytes() and not (tmp_path / "got.bin.part").exists()
    assert readers.download("file:///nowhere", str(got)) == got  # already there
    with pytest.raises(OSError):
        readers.download((tmp_path / "none").as_uri(), str(tmp_path / "no.bin"), attempts=2)


def test_mainland(spark):
    df = spark.createDataFrame([("01",), ("95",), ("2A",), ("974",), (None,)], "department string")
    assert [r[0] for r in assembly.mainland(df).collect()] == ["01", "95"]


def test_fill_counts(spark):
    df = spark.createDataFrame([(None, None, None)], "cyc_n int, cyc_taux double, other int")
    assert tuple(assembly.fill_counts(df, ("cyc_",)).first()) == (0, None, None)


def test_override(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")
    assert [r["v"] for r in assembly.override(df, "k", ["a"], {"v": "z"}).orderBy("k").collect()] == ["z", "y"]


def test_wide_zones(spark):
    zones = spark.createDataFrame([("a",), ("b",)], "zone string")
    out = assembly.wide_zones(zones, [spark.createDataFrame([("a", 1)], "zone string, p int"), spark.createDataFrame([("b", 2)], "zone string, q int")])
    assert {tuple(r) for r in out.collect()} == {("a", 1, None), ("b", None, 2)}


def test_nested_records(spark):
    rows = [(1, 5, 2020, 1, 2.0), (1, 5, 2020, 0, 1.0), (1, 6, 2020, 0, 4.0), (1, 6, 2020, 1, None), (1, 5, 2021, 0, 3.0)]
    r = S.nested_records(spark.createDataFrame(rows, "site long, flow long, year int, hour_idx int, value double")).first()
    assert r["values"] == {2020: [5.0, None], 2021: [3.0]} and r["flows"] == {2020: [5, 6], 2021: [5]}


def test_densest_member(spark):
    rows = [(1, "a", False, 9.0), (1, "b", True, 2.0), (1, "c", True, 2.0), (2, "d", False, 1.0)]
    got = {r["grp"]: r["code"] for r in S.densest_member(spark.createDataFrame(rows, "grp int, code string, core boolean, density double")).collect()}
    assert got == {1: "b", 2: "d"}


def test_bottom_n(spark):
    assert [r[0] for r in S.top_n(spark.createDataFrame([(3,), (1,), (2,)], "v int"), [F.asc("v")], 2).collect()] == [1, 2]


def test_differences(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert {tuple(r) for r in checks.differences(a, b, ["k"]).collect()} == {(1, "a"), (3, "b")}


def test_feature_row(spark):
    df = spark.createDataFrame([(1, {"highway": "path", "maxspeed": "20 mph", "cycleway": "lane", "cycleway:both": "track"}), (2, {"highway": "odd"})], "way int, tags map<string,string>")
    a, b = tags.feature_row(df, ["highway", "maxspeed", "cycleway", "cycleway:both"], {"highway": ["path"], "cycleway": ["lane"], "cycleway:both": ["track"], "maxspeed": ["20 mph"]}).orderBy("way").collect()
    assert (a["highway"], a["cycleway__both"], round(a["maxspeed_num"], 2), a["cw_right_eff"], a["n_cycle_keys"]) == ("path", "track", 32.18, "track", 2)
    assert (b["highway"], b["maxspeed_num"], b["cw_left_eff"], b["n_cycle_keys"]) == ("(autre)", None, None, 0)


def test_road_rules(spark):
    cols = "highway string, cycleway string, bicycle string, access string, surface string, maxspeed string"
    cases = [
        (("residential", None, None, None, None, None), C.UNCERTAIN),
        (("Cycleway ", None, None, None, None, None), C.YES),
        (("cycleway", None, "no", None, None, None), C.NO),
        (("residential", None, "permissive", "no", None, None), C.UNCERTAIN),
        (("trunk", "track", None, None, None, "50"), C.YES),
        (("trunk", None, None, None, None, None), C.NO),
        (("primary", "lane", None, None, None, "70"), C.UNCERTAIN),
        (("primary", "lane", None, None, None, "80"), C.NO),
        (("primary", "lane", None, None, "asphalt", "50"), C.YES),
        (("service", "shared_lane", None, None, None, None), C.YES),
        (("path", None, "yes", None, "gravel", None), C.YES),
        (("path", None, None, None, "gravel", None), C.NO),
        (("primary", None, "designated", None, None, "90"), C.YES),
    ]
    got = C.road_status(spark.createDataFrame([c for c, _ in cases], cols)).collect()
    assert [r["status"] for r in got] == [want for _, want in cases]


def test_water_distances(spark):
    kinds = spark.createDataFrame([({"waterway": "canal"},), ({"waterway": "stream"},), ({"natural": "coastline"},), ({"a": "b"},)], "t map<string,string>")
    assert [r[0] for r in kinds.select(C.water_kind(F.col("t"))).collect()] == ["canal", "coastline", "coastline", "coastline"]
    points = spark.createDataFrame([(1, 0.0, 5.0), (2, 100.0, 100.0)], "id long, x double, y double")
    segments = spark.createDataFrame([("river", -10.0, 0.0, 10.0, 0.0), ("canal", 0.0, 8.0, 0.0, 30.0)], "kind string, ax double, ay double, bx double, by double")
    got = {r["id"]: (r["dist_river"], r["dist_canal"]) for r in spatial.line_distances(points, segments, ["river", "canal"], 20.0).collect()}
    assert got == {1: (5.0, 3.0), 2: (None, None)}


def test_water_distances_without_limit(spark):
    rng = np.random.default_rng(4)
    p, s = rng.random((30, 2)) * 100, rng.random((6, 4)) * 100
    s[5] = [4000.0, 4000.0, 4100.0, 4300.0]
    kinds = ["river", "river", "river", "canal", "canal", "coast"]
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(p)], "id long, x double, y double")
    segments = spark.createDataFrame([(k, *map(float, r)) for k, r in zip(kinds, s, strict=True)], "kind string, ax double, ay double, bx double, by double")
    a, b = s[None, :, :2], s[None, :, 2:]
    t = np.clip(((p[:, None] - a) * (b - a)).sum(axis=2) / ((b - a) ** 2).sum(axis=2), 0, 1)
    d = np.sqrt(((p[:, None] - a - t[..., None] * (b - a)) ** 2).sum(axis=2))
    for r in spatial.line_distances(points, segments, ["river", "canal", "coast", "lake"], size=3.0).collect():
        assert [r["dist_river"], r["dist_canal"], r["dist_coast"]] == pytest.approx([d[r["id"], :3].min(), d[r["id"], 3:5].min(), d[r["id"], 5]])
        assert r["dist_lake"] is None


def test_water_places_are_searched_once(spark, monkeypatch):
    """Points of one place and equal lines meet once; every row is answered, one without an id too."""
    seen = searched(monkeypatch)
    points = spark.createDataFrame([(i if i else None, float(i % 5), 3.0) for i in range(300)], "id long, x double, y double")
    segments = spark.createDataFrame([("river", float(i % 4), 0.0, float(i % 4), 1.0) for i in range(200)], "kind string, ax double, ay double, bx double, by double")
    got = sorted((r["id"] or 0, r["dist_river"]) for r in spatial.line_distances(points, segments, ["river"], size=50.0).collect())
    assert got == [(i, 2.0 if i % 5 < 4 else 5.0**0.5) for i in range(300)]
    assert seen == [(5, seen[0][1])] and seen[0][1] <= 4


def test_isolated_centres(spark):
    candidates = spark.createDataFrame([(1, 0.0, 0.0), (2, 50.0, 0.0), (3, 500.0, 0.0)], "id long, x double, y double")
    bases = spark.createDataFrame([(9, 40.0, 0.0)], "polygon long, x double, y double")
    edges = spark.createDataFrame([(1, 9)], "a long, b long")
    assert [r["id"] for r in spatial.isolated(candidates, bases, edges, 100.0, 30.0).collect()] == [3]


def test_sample_cells(spark):
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, 15.0, 5.0), (3, 99.0, 0.0)], "id long, x double, y double")
    grid = spark.createDataFrame([(0, 0, 7.5), (1, 0, -9999.0)], "i int, j int, value double")
    assert {r["id"]: r["value"] for r in spatial.sample_cells(points, grid, 10.0).collect()} == {1: 7.5, 2: None, 3: None}


def test_simplify(spark):
    line = [{"x": float(x), "y": y} for x, y in ((0, 0.0), (1, 0.01), (2, 0.0), (3, 5.0), (4, 0.0))]
    got = spatial.simplify(spark.createDataFrame([(1, line)], "id int, line array<struct<x:double,y:double>>"), "line", 0.1).first()
    assert [p["x"] for p in got["line"]] == [0.0, 2.0, 3.0, 4.0]


def test_polygon_or_nearest(spark):
    ring = [{"x": float(x), "y": float(y)} for x, y in ((0, 0), (10, 0), (10, 10), (0, 10))]
    polygons = spark.createDataFrame([(7, ring)], "polygon long, ring array<struct<x:double,y:double>>")
    centres = spark.createDataFrame([(7, 5.0, 5.0), (8, 100.0, 0.0)], "polygon long, x double, y double")
    points = spark.createDataFrame([(1, 3.0, 3.0), (2, 80.0, 0.0)], "id long, x double, y double")
    assert {r["id"]: r["polygon"] for r in spatial.polygon_or_nearest(points, polygons, centres, 6.0).collect()} == {1: 7, 2: 8}


def test_mixture_is_saved(tmp_path):
    m = learning.Mixture("AkBk", np.eye(2, 3), np.array([0.5, 0.5]), np.eye(3, 1), [np.eye(1), np.eye(1)], np.array([0.1, 0.2]), -1.0, -2.0, -3.0, -4.0)
    learning.save_mixture(m, str(tmp_path), "01_a")
    learning.save_mixture(m, str(tmp_path), "01_b")
    again = learning.load_mixture(learning.latest_model(str(tmp_path)))
    y = np.random.default_rng(1).random((4, 3))
    assert np.allclose(again.log_densities(y), m.log_densities(y)) and again.icl == -4.0
    assert learning.latest_model(str(tmp_path)).name == "01_b"


def test_one_hot(spark):
    df, names = learning.one_hot(spark.createDataFrame([("a",), ("z",), (None,)], "k string"), "k", ["a", "b"])
    assert [tuple(r[n] for n in names) for r in df.collect()] == [(1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]


def test_report_workbook(spark, tmp_path):
    from tallyroad.operators import indicators
    from tallyroad.plans import report

    wide = spark.createDataFrame([(1, 1.0, None, 2.0, 3.0)], "year int, cluster_0 double, cluster_1 double, cluster_2 double, cluster_3 double")
    totals = indicators.with_total(wide)
    assert totals.first()["total"] == 6.0
    growth = spark.createDataFrame([("1 -> 2", 0, 1.1, 1.0, 1.2)], "transition string, cluster int, ratio_median double, low_95 double, high_95 double")
    assert {r["part"] for r in indicators.growth_table(growth, growth.drop("cluster")).collect()} == {"0", "all"}
    book = report.workbook({"By cluster": ("Flow by cluster", totals)}, {"sensors": 3}, ["A note"])
    book.save(str(tmp_path / "r.xlsx"))
    assert readers.excel(spark, str(tmp_path / "r.xlsx"), ["year", "total"], "By cluster", header=1).first()["total"] == "6.0"
    assert report.quality_text({"b": {"f1": 0.5}, "a": {"f1": 1}}) == "a: f1 1.0000\nb: f1 0.5000"
    assert report.missing_modules() == [] and report.missing_modules(("no_such_module",)) == ["no_such_module"]
    order = []
    done = report.run_steps(spark, str(tmp_path), [("a", lambda d: (order.append("a"), spark.range(2))[1]), ("b", lambda d: (order.append("b"), d["a"].selectExpr("id + 1 as id"))[1])])
    assert order == ["a", "b"] and sorted(r[0] for r in done["b"].collect()) == [1, 2]


def test_snapshot(spark):
    from tallyroad.plans import report

    ring = [{"x": float(x), "y": float(y)} for x, y in ((0, 0), (1000, 0), (1000, 1000), (0, 1000))]
    polygons = spark.createDataFrame([(7, ring)], "polygon long, ring array<struct<x:double,y:double>>")
    ways = spark.createDataFrame([(1, 0.9, "bidirectionnel", "PISTE CYCLABLE", 2.0), (2, 0.1, "one way", "AUTRE", 1.0), (3, 0.01, "one way", "AUTRE", 1.0)], "way long, p double, direction string, type string, km double")
    segments = spark.createDataFrame([(1, -500.0, 5.0, 500.0, 5.0), (2, 0.0, 9.0, 9.0, 9.0)], "line long, ax double, ay double, bx double, by double")
    lengths, record = report.snapshot(ways, segments, polygons, 600.0)
    assert lengths.first()["len_d"] == pytest.approx(1.0) and lengths.first()["len_d_dedicated"] == pytest.approx(1.0)
    assert (record["n_candidates"], record["n_kept"], record["n_zones"]) == (2, 1, 1) and record["km"] == pytest.approx(0.5)


def test_models_cover_all_rows(spark):
    """Every part gets its attributes; every customer a class by the model of all rows and one by a model that hasn't seen its nation."""
    parts = {r[0] for r in models.table(spark, SF, "part").select("p_partkey").collect()}
    got = models.attribute_models(spark, SF).collect()
    assert sorted(r["p_partkey"] for r in got) == sorted(parts) and {r["fold"] for r in got} == set(range(5))
    customers = models.forest_predict(spark, SF).collect()
    assert len(customers) == models.table(spark, SF, "customer").count() == len({r["c_custkey"] for r in customers})
    assert {r["extrapolated"] for r in customers} == {0} and all(r["out_of_fold"] for r in customers)


def test_charts(spark):
    """Every chart is well-formed, draws its points where their values lie, and leaves gaps for missing ones."""
    from xml.etree import ElementTree

    from tallyroad.sources import charts

    years = spark.createDataFrame([(2019, 1.0, 4.0, 4.0, 10, 5), (2020, 2.0, 6.0, None, 12, 5), (2021, 3.0, 8.0, 5.0, 15, 5)], "year int, km_obs_bn double, km_ext_bn double, km_panel_ext_bn double, n_sensors long, n_panel long")
    interval = spark.createDataFrame([(2019, 3e9, 5e9), (2020, 5e9, 7e9), (2021, 7e9, 9e9)], "year int, low_95 double, high_95 double")
    detail = spark.createDataFrame([(2021, "a <b>", 3.0), (2021, "c", 6.0), (2020, "d", 1.0)], "year int, cluster_name string, rate double")
    curve = spark.createDataFrame([(1, p, 0.1 * p, 0.2) for p in range(24)], "cluster int, pos int, mean double, deviation double")
    made = {
        "national": charts.national(years), "interval": charts.with_interval(years, interval), "panel": charts.standard_and_panel(years), "index": charts.index_100(years, {"km_obs_bn": "observed", "n_sensors": "sensors"}, "Index"),
        "rates": charts.rates(detail, 2021), "profile": charts.profile(curve, 1, "Cluster 1", "hour"), "none": charts.national(years.where("false")),
    }
    tag = "{http://www.w3.org/2000/svg}"
    drawn = {k: ElementTree.fromstring(v) for k, v in made.items()}
    line = [tuple(map(float, p.split(","))) for p in drawn["national"].findall(f"{tag}polyline")[0].get("points").split()]
    assert len(line) == 3 and line[0][0] < line[1][0] < line[2][0] and line[0][1] > line[1][1] > line[2][1]
    assert line[0][1] - line[1][1] == pytest.approx(line[1][1] - line[2][1], abs=0.2)
    assert len(drawn["panel"].findall(f"{tag}polyline")) == 3  # the panel's gap parts its line
    assert len(drawn["interval"].findall(f"{tag}polygon")) == len(drawn["profile"].findall(f"{tag}polygon")) == 1
    assert "all (15 sensors in 2021)" in made["panel"] and "a &lt;b&gt;" in made["rates"] and "300" in made["index"]
    widths = [float(r.get("width")) for r in drawn["rates"].findall(f"{tag}rect")]
    assert widths[0] == pytest.approx(2 * widths[1], abs=0.2)


def test_zone_map_pixels(spark):
    """Zones are filled by category, north on top; a hole between them stays white."""
    import struct
    import zlib

    from tallyroad.sources import charts

    square = lambda x, y: [{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + 10, y), (x + 10, y + 10), (x, y + 10))]
    zones = spark.createDataFrame([(square(0, 0), "a"), (square(20, 0), "b"), (square(0, 10), "new")], "ring array<struct<x:double,y:double>>, category string")
    raw = charts.zone_map(zones, {"a": "#ff0000", "b": "#0000ff"}, width=30)
    assert raw[:8] == b"\x89PNG\r\n\x1a\n" and struct.unpack(">II", raw[16:24]) == (30, 20)
    size = struct.unpack(">I", raw[33:37])[0]
    pixels = np.frombuffer(zlib.decompress(raw[41 : 41 + size]), np.uint8).reshape(20, 91)[:, 1:].reshape(20, 30, 3)
    assert pixels[15, 5].tolist() == [255, 0, 0] and pixels[15, 25].tolist() == [0, 0, 255] and pixels[15, 15].tolist() == [255] * 3
    assert pixels[5, 5].tolist() == [0xE2] * 3 and pixels[5, 25].tolist() == [255] * 3
    assert charts.zone_map(zones.where("false"), {}).startswith(b"\x89PNG")


def test_dated_snapshot(tmp_path):
    (tmp_path / "remote").mkdir()
    (tmp_path / "remote" / "france-250101.osm.pbf").write_bytes(b"extract")
    template = f"file://{tmp_path}/remote/france-{{date}}.osm.pbf"
    path = readers.dated_snapshot(template, "250101", str(tmp_path / "here"))
    assert path.read_bytes() == b"extract" and path.parent.name == "here"
    (tmp_path / "remote" / "france-250101.osm.pbf").unlink()
    assert readers.dated_snapshot(template, "250101", str(tmp_path / "here")) == path  # not fetched again
    with pytest.raises(ValueError, match="YYMMDD"):
        readers.dated_snapshot(template, "2025-01-01", str(tmp_path))
