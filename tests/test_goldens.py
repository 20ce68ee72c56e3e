"""Hand-worked results on small cell tables, units and samples."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamgrid.functions import scalars as S
from loamgrid.operators import blocks as BL
from loamgrid.operators import cells as C
from loamgrid.operators import change as CH
from loamgrid.operators import classify as K
from loamgrid.operators import quality as Q
from loamgrid.operators import ranking as RK
from loamgrid.operators import regrid as R
from loamgrid.operators import resampling as RS
from loamgrid.operators import score as SC
from loamgrid.operators import services as SV
from loamgrid.operators import stats as ST
from loamgrid.operators import zonal as Z
from loamgrid.sources import tables as T
from loamgrid.streaming.zonal import class_counts_stream

GRID = {"a": 30.0, "c": 500000.0, "e": -30.0, "f": 3700000.0, "width": 2, "height": 2}


def cells(spark, matrix, **extra):
    rows = [(i, j, float(v)) for i, r in enumerate(matrix) for j, v in enumerate(r) if v is not None]
    df = spark.createDataFrame(rows, "row long, col long, value double")
    return df.withColumns({k: F.lit(v) for k, v in extra.items()}) if extra else df


def grid_of(df, value="value"):
    return {(r["row"], r["col"]): r[value] for r in df.collect()}


def test_accuracy(spark):
    s = spark.createDataFrame([("1", "1"), ("1", "1"), ("1", "2"), ("2", "2"), ("2", "2"), ("2", "1"), (None, "1"), ("", "2")], "reference string, prediction string")
    counts = CH.confusion(s)
    r = CH.accuracy_report(counts).first()
    assert r["n"] == 6 and math.isclose(r["overall_accuracy"], 2 / 3) and math.isclose(r["macro_iou"], 0.5)
    assert all(math.isclose(m["f1"], 2 / 3) for m in CH.class_metrics(counts).collect())


def test_accuracy_sampled_from_layer(spark):
    pts = spark.createDataFrame([(1, 500015.0, 3699985.0), (2, 500045.0, 3699985.0), (1, 0.0, 0.0)], "reference int, x double, y double")
    out = C.sample_at_points(pts, cells(spark, [[1, 2], [2, 1]]), GRID).collect()
    assert sorted((r["inside"], r["value"]) for r in out if r["inside"]) == [(True, 1.0), (True, 2.0)]
    assert [r["value"] for r in out if not r["inside"]] == [None]


def test_figure_of_merit_without_change_is_one(spark):
    s = spark.createDataFrame([(1, 1, 1), (2, 2, 2)], "baseline int, observed int, predicted int")
    assert CH.figure_of_merit(s).first()["figure_of_merit"] == 1.0
    s = spark.createDataFrame([(1, 2, 2), (1, 2, 2), (1, 2, 3), (1, 1, 1)], "baseline int, observed int, predicted int")
    assert math.isclose(CH.figure_of_merit(s).first()["figure_of_merit"], 2 / 3)


def test_consistency(spark):
    stack = C.stack_layers({"a": cells(spark, [[10, 20], [30, 40]]), "b": cells(spark, [[10, 20], [30, 40.05]])})
    r = CH.layer_consistency(stack, "a", "b", 0.001).first()
    assert r["passed"] and math.isclose(r["relative_difference"], 0.05 / 100.05)


def test_transitions_keep_common_cells(spark):
    t = CH.transition_matrix(cells(spark, [[1, 2], [3, None]]), cells(spark, [[1, 1], [9, 2]]), CH.class_table(spark, CH.STANDARD_6), 0.09)
    assert {(r["source_code"], r["target_code"]): r["pixel_count"] for r in t.collect()} == {(1, 1): 1, (2, 1): 1}


def test_depth_to_volume_and_mean(spark):
    c = cells(spark, [[100, 100], [100, 100]], layer="y")
    assert math.isclose(Z.raster_statistics(c, ["layer"], "depth_mm_to_m3", 900.0).first()["total"], 360.0)
    assert Z.raster_statistics(c, ["layer"], "mean", 900.0).first()["total"] == 100.0


def test_empty_layer_is_an_error(spark):
    c = cells(spark, [[-9999, -9999]], layer="y")
    with pytest.raises(ValueError, match="no valid pixels"):
        Z.require_values(Z.raster_statistics(c, ["layer"], "sum", 900.0, -9999), c.select("layer").distinct(), ["layer"])


def test_baseline_series(spark):
    t = spark.createDataFrame([("carbon", 2010, 10.0), ("carbon", 2020, 14.0), ("habitat", 2010, 0.5), ("habitat", 2020, 0.7)], "service string, year int, total double")
    out = {(r["service"], r["year"]): (r["change"], r["change_pct"]) for r in Z.baseline_series(t).collect()}
    assert out["carbon", 2020][0] == 4.0 and math.isclose(out["habitat", 2020][1], 40.0)
    with pytest.raises(ValueError):
        Z.baseline_series(t.unionByName(t))


def test_grid_units(spark):
    out = Z.grid_units(cells(spark, [[1] * 4] * 4), 2, "sum", 100.0).collect()
    assert sorted(r["unit_id"] for r in out) == ["r00000_c00000", "r00000_c00001", "r00001_c00000", "r00001_c00001"] and {r["total"] for r in out} == {4.0}


def test_majority_and_bounded_fill(spark):
    m = [[1] * 3 + [2] * 3] * 3 + [[3] * 3 + [4] * 3] * 3
    assert grid_of(R.majority_regrid(cells(spark, m), 3.0)) == {(0, 0): 1, (0, 1): 2, (1, 0): 3, (1, 1): 4}
    fill = C.nearest_fill(cells(spark, [[1, 1], [1, 1]]).filter("row = 0 AND col = 1"), cells(spark, [[2, None]]), 45.0, 30.0)
    assert grid_of(fill) == {(0, 1): 2.0}
    assert C.nearest_fill(cells(spark, [[None, None, None, 1]]), cells(spark, [[2, None]]), 45.0, 30.0).count() == 0


def test_distance_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    src = rng.random((13, 11)) < 0.06
    src[5, 5] = True
    df = spark.createDataFrame([(i, j, bool(src[i, j])) for i in range(13) for j in range(11)], "row long, col long, is_source boolean")
    at = np.argwhere(src)
    got = grid_of(R.distance_to_sources(df, 10.0), "distance")
    assert all(math.isclose(d, 10 * math.sqrt(((at - k) ** 2).sum(1).min()), abs_tol=1e-9) for k, d in got.items())


def test_slope_of_a_plane(spark):
    out = R.slope_aspect(cells(spark, [[30.0 * j for j in range(4)] for _ in range(4)]), 30.0).collect()
    assert len(out) == 4 and all(math.isclose(r["slope"], 45.0) and math.isclose(r["aspect"], 270.0) for r in out)
    assert {r["aspect"] for r in R.slope_aspect(cells(spark, [[1.0] * 3] * 3), 30.0).collect()} == {-1.0}


def test_polygon_hole(spark):
    p = lambda *xy: [{"x": float(x), "y": float(y)} for x, y in xy]
    rings = [p((0, 0), (4, 0), (4, 4), (0, 4)), p((1, 1), (3, 1), (3, 3), (1, 3))]
    f = spark.createDataFrame([(1, rings)], "feature_id int, rings array<array<struct<x:double,y:double>>>")
    got = C.cells_in_polygons(cells(spark, [[1] * 5] * 5), f, F.col("col") + 0.5, F.col("row") + 0.5, 2.0)
    assert set(grid_of(got)) == {(i, j) for i in range(4) for j in range(4)} - {(1, 1), (1, 2), (2, 1), (2, 2)}


def test_subsidence_carbon(spark):
    row = (1000.0, 10.0, 2.0, 5.0, 3.0, 20.0)
    s = spark.createDataFrame([row, (-1.0, *row[1:])], ", ".join(f"{c} double" for c in SV.WATER_INPUTS))
    assert sorted(((r["valid"], r["composite_t_c"]) for r in SV.composite_carbon(s).collect()), key=str) == [(False, None), (True, pytest.approx(70.01))]
    one = spark.range(1).select(SV.replaced_total(F.lit(1000.0), F.lit(100.0), F.lit(200.0)).alias("a"), SV.replaced_total(F.lit(1.0), F.lit(2.0), F.lit(0.0)).alias("b")).first()
    assert one["a"] == 1100.0 and one["b"] is None
    depth = cells(spark, [[1.0] * 10] * 10, site="s").withColumnRenamed("value", "depth")
    assert Z.depth_metrics(depth, ["site"], 900.0).first()["volume_m3"] == 90000.0
    got = SV.subsidence_water_carbon(depth, ["site"], 900.0, 1000.0, 10.0, 100.0, 0.5).first()
    assert got["vegetation_ha"] == 0 and math.isclose(got["composite_t_c"], 90 + 900)


def test_scores_and_weights(spark):
    m = [[1, 2, 2], [0.5, 1, 1], [0.5, 1, 1]]
    e = spark.createDataFrame([("p", i, j, float(m[i][j])) for i in range(3) for j in range(3)], "panel_id string, i int, j int, v double")
    assert SC.ahp_problems(e).count() == 0
    w = SC.ahp_weights(e).orderBy("i").collect()
    assert [round(r["weight"], 9) for r in w] == [0.5, 0.25, 0.25] and abs(w[0]["cr"]) < 1e-9
    assert SC.ahp_problems(e.withColumn("v", F.when((F.col("i") == 0) & (F.col("j") == 1), 9.0).otherwise(F.col("v")))).count() == 1
    u = spark.createDataFrame([("A", "ND", 100.0, 30.0, 0.7, 1.0), ("B", "EP", 50.0, 60.0, 0.9, 1.0)], "unit_id string, scenario string, c double, w double, h double, k double")
    crit = [{"field": f, "direction": "benefit", "weight": x} for f, x in (("c", 0.4), ("w", 0.3), ("h", 0.3))]
    assert {r["unit_id"]: round(r["score"], 9) for r in SC.score_units(u, crit).collect()} == {"A": 0.4, "B": 0.6}
    assert {r["norm_k"] for r in SC.score_units(u, [{"field": "k", "direction": "benefit", "weight": 1}]).collect()} == {0.5}


def test_comparison_and_calibration(spark):
    s = spark.createDataFrame([("ND", "a", 1.0), ("ND", "b", 2.0), ("UD", "a", 2.0), ("UD", "b", 4.0)], "scenario string, unit_id string, score double")
    r = {x["scenario"]: x for x in SC.compare_scenarios(s, "ND").collect()}["UD"]
    assert (r["paired"], r["mean"], r["paired_mean_delta"], r["delta"]) == (2, 3.0, 1.5, 1.5)
    c = spark.createDataFrame([(1, 90.0), (2, 100.0), (3, 110.0)], "line int, modeled double")
    assert [x["line"] for x in SC.calibrate(c, 100.0).filter("selected").collect()] == [2]


def test_geodetector(spark):
    rows = [(0.2, "water", "low", "wet"), (0.3, "water", "low", "dry"), (0.7, "forest", "high", "wet"), (0.8, "forest", "high", "dry")]
    s = spark.createDataFrame(rows, "t double, lulc string, slope string, precip string")
    q = {r["factor"]: r["q"] for r in ST.factor_detector(s, "t", ["lulc", "slope", "precip"]).collect()}
    assert math.isclose(q["lulc"], 0.961538, abs_tol=1e-6) and math.isclose(q["precip"], 0.038462, abs_tol=1e-6)
    kinds = {(r["factor_a"], r["factor_b"]): r["interaction"] for r in ST.interaction_detector(s, "t", ["lulc", "slope", "precip"]).collect()}
    assert kinds["lulc", "slope"] == "weaken_or_non_enhance" and kinds["lulc", "precip"] == "independent"


def test_permutation_and_bootstrap(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=40)
    y = x + rng.normal(size=40) * 0.4
    u = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], "u long, x double, y double")
    ranked = ST.average_ranks(ST.average_ranks(u, "x", "ra"), "y", "rb")
    ra, rb = x.argsort().argsort() + 1, y.argsort().argsort() + 1
    rho = np.corrcoef(ra, rb)[0, 1]
    t = ST.permutation_test(ranked, "u", "ra", "rb", 99).first()
    assert math.isclose(t["observed"], abs(rho)) and t["p_value"] == 0.01
    b = ST.bootstrap_interval(u, "u", "x", "y", 99).first()
    assert b["low"] < rho < b["high"] and b["high"] - b["low"] < 0.5


def test_dealt_values_keep_their_margins_and_moments(monkeypatch):
    rng = np.random.default_rng(2)
    pool, sizes = np.array([5, 0, 9, 1, 6]), [4, 0, 10, 7]
    left, sums = np.tile(pool, (20_000, 1)), []
    for n in sizes:
        got = RS.deal(rng, left, n)
        assert (got.sum(axis=1) == n).all() and (got >= 0).all() and (got <= left).all()
        left = left - got
        sums.append(got)
    assert not left.any()
    mean, var = 10 * pool / 21, 10 * pool / 21 * (1 - pool / 21) * 11 / 20
    assert np.allclose(sums[2].mean(axis=0), mean, atol=0.05) and np.allclose(sums[2].var(axis=0), var, atol=0.06)
    monkeypatch.setattr(RS, "LARGE", 10)  # the normal form keeps within bounds and has the same moments
    near = RS.hypergeometric(rng, np.full(20_000, 600), np.full(20_000, 400), np.full(20_000, 250))
    assert abs(near.mean() - 150) < 0.5 and abs(near.var() - 250 * 0.6 * 0.4 * 750 / 999) < 2
    totals = [3, 8, 0, 6, 4]
    parts = [RS.share_of_chunk([7, 1], np.tile(pool, (50, 1)), totals, c) for c in range(5)]
    assert (sum(parts) == pool).all() and all((x.sum(axis=1) == n).all() for x, n in zip(parts, totals, strict=True))


def test_permutation_p_against_all_rows(spark):
    """p of slices against whole permutations by numpy, with more rows than slices."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=1500)
    y = 0.03 * x + rng.normal(size=1500)
    ra, rb = (v.argsort().argsort() + 1.0 for v in (x, y))
    rho = abs(np.corrcoef(ra, rb)[0, 1])
    want = np.mean([abs(np.corrcoef(ra, rng.permutation(rb))[0, 1]) >= rho for _ in range(4000)])
    u = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(ra, rb, strict=True))] + [(5000, None, 1.0)], "u long, ra double, rb double")
    got = ST.permutation_test(u, "u", "ra", "rb", 3000).first()
    assert got["n"] == 1500 and math.isclose(got["observed"], rho) and abs(got["p_value"] - want) < 0.03
    b = ST.bootstrap_interval(u, "u", "ra", "rb", 999).first()
    boot = []
    ranks = lambda v: (lambda o: (np.cumsum(np.bincount(o)) - (np.bincount(o) - 1) / 2)[o])(np.unique(v, return_inverse=True)[1])
    for _ in range(600):
        k = rng.integers(0, 1500, 1500)
        boot.append(np.corrcoef(ranks(ra[k]), ranks(rb[k]))[0, 1])
    assert b["resamples"] == 999 and abs(b["low"] - np.quantile(boot, 0.025)) < 0.01 and abs(b["high"] - np.quantile(boot, 0.975)) < 0.01
    assert ST.permutation_test(u.limit(2), "u", "ra", "rb", 9).first()["p_value"] is None


def test_factor_tests_against_numpy(spark, monkeypatch):
    rng = np.random.default_rng(9)
    n = 900
    f = np.stack((rng.integers(0, 3, n), rng.integers(0, 4, n), rng.integers(0, 2, n)), axis=1)
    t = rng.gamma(2.0, 50.0, n) + 9.0 * (f[:, 0] == 1)
    names = ["fa", "fb", "fc"]
    s = spark.createDataFrame([(float(v), *map(str, k)) for v, k in zip(t, f.tolist(), strict=True)], "t double, fa string, fb string, fc string")
    q = lambda v, k: 1 - sum(((v[k == h] - v[k == h].mean()) ** 2).sum() for h in np.unique(k)) / ((v - v.mean()) ** 2).sum()
    keys = {("fa", None): f[:, 0], ("fb", None): f[:, 1], ("fc", None): f[:, 2], ("fa", "fb"): f[:, 0] * 9 + f[:, 1], ("fa", "fc"): f[:, 0] * 9 + f[:, 2], ("fb", "fc"): f[:, 1] * 9 + f[:, 2]}
    for chunk in (128, 5):  # all strata in one task, then over several chunks
        monkeypatch.setattr(RS, "CHUNK", chunk)
        got = {(r["factor_a"], r["factor_b"]): r for r in ST.factor_tests(s, "t", names, 1998).collect()}
        assert got.keys() == keys.keys() and all((r["interaction"] is None) == (k[1] is None) and r["analysis"] == ("factor" if k[1] is None else "interaction") for k, r in got.items())
        for k, strata in keys.items():
            own = q(t, strata)
            want = np.mean([q(rng.permutation(t), strata) >= own for _ in range(1500)])
            assert math.isclose(got[k]["q"], own, abs_tol=1e-9) and abs(got[k]["p_value"] - want) < 0.045
    kinds = {(r["factor_a"], r["factor_b"]): r["interaction"] for r in ST.interaction_detector(s, "t", names).collect()}
    assert kinds == {k: r["interaction"] for k, r in got.items() if k[1]}
    assert {r["p_value"] for r in ST.factor_tests(s, "t", ["fa"], 0).collect()} == {None}
    for bad in (s.withColumn("t", F.lit(2.0)), s.withColumn("fa", F.lit(" "))):
        with pytest.raises(ValueError):
            ST.factor_tests(bad, "t", ["fa"], 9)


def test_maximum_likelihood_matches_numpy(spark):
    rng = np.random.default_rng(5)
    data = [(c, rng.normal(c, 1 + c / 2, 2).tolist()) for c in (0, 1, 2) for _ in range(30)] + [(9, [0.0, 0.0])]
    df = spark.createDataFrame([(i, c, b) for i, (c, b) in enumerate(data)], "id int, class int, bands array<double>")
    assert K.gaussian_models(df, 2)[1] == [9]
    fits = {c: (np.mean([b for k, b in data if k == c], 0), np.cov(np.array([b for k, b in data if k == c]).T)) for c in (0, 1, 2)}
    best = lambda b: max(fits, key=lambda c: -0.5 * np.linalg.slogdet(fits[c][1])[1] - 0.5 * (b - fits[c][0]) @ np.linalg.inv(fits[c][1]) @ (b - fits[c][0]))
    assert all(r["predicted"] == best(np.array(r["bands"])) for r in K.maximum_likelihood(df, df, 2).collect())


def test_patches_reach_the_edge_and_blend_back(spark):
    layers = spark.createDataFrame([("a", 10, 3), ("b", 11, 4)], "layer_id string, height long, width long")
    starts = defaultdict(set)
    for r in K.patch_grid(layers, 4, 3).collect():
        starts[r["layer_id"]].add((r["patch_row"], r["patch_col"]))
    assert starts == {"a": {(0, 0), (3, 0), (6, 0)}, "b": {(0, 0), (3, 0), (6, 0), (7, 0)}}
    one = spark.createDataFrame([("b", i, j, 1 + (i + j) % 2) for i in range(11) for j in range(4)], "layer_id string, row long, col long, class long")
    cut = K.cut_patches(one, layers.filter("layer_id = 'b'"), 4, 3)
    assert cut.count() == 4 * 16
    back = {(r["row"], r["col"]): (r["class"], r["confidence"]) for r in K.blend_predictions(cut.withColumn("p", F.lit(0.75)), 4, 0.5).collect()}
    assert set(back) == {(i, j) for i in range(11) for j in range(4)} and all(c == 1 + (i + j) % 2 and math.isclose(p, 0.75) for (i, j), (c, p) in back.items())


def test_sensors_and_drivers(spark):
    names = ["Landsat 8 OLI", "sentinel-2 msi", " LANDSAT_5 ", "landsat8", "Sentinel_2", "L8", "S2", "GF-1", "", None]
    got = {r["sensor"]: (r["profile"], r["classified_resampling"], r["rejected"]) for r in S.sensor_profiles(spark.createDataFrame([(n,) for n in names], "sensor string")).collect()}
    assert [got[n][0] for n in names] == ["landsat_8_oli", "sentinel_2_msi", "landsat_5_tm", "landsat_8_oli", "sentinel_2_msi"] + [None] * 5
    assert all(got[n][1:] == ("nearest", False) for n in names[:5]) and all(got[n][2] for n in names[5:])
    kinds = {"landform": "categorical", "zoning": "categorical", "protected_area": "categorical", "ecological_redline": "categorical", "lulc": "continuous", "landuse": "continuous", "Aspect ": "circular", "aspect_class": "categorical", "rock_type": "categorical", "slope": "continuous"}
    d = spark.createDataFrame([(n, m) for n in kinds for m in (None, "nearest", "BILINEAR", "majority")], "name string, method string").withColumn("kind", S.driver_type(F.col("name")))
    rows = d.withColumn("ok", S.resampling_allowed(F.col("kind"), F.col("method"))).collect()
    assert all(r["kind"] == kinds[r["name"]] for r in rows)
    assert all(r["ok"] == (r["method"] is None or r["method"].lower() in {"categorical": ("majority", "nearest"), "continuous": ("bilinear",), "circular": ("nearest",)}[r["kind"]]) for r in rows)


def test_layer_preflight(spark):
    """A layer with more codes than a profile lists is reported, whether they are whole numbers or not."""
    many = spark.range(6000).select(F.lit("halves").alias("layer_id"), (F.col("id") + 0.5).alias("value")).unionByName(spark.range(6000).select(F.lit("whole"), F.col("id").cast("double")).toDF("layer_id", "value"))
    few = spark.createDataFrame([("good", 1.0), ("good", 2.0), ("depth", -0.5), ("odd", 1.0), ("odd", 9.0)], "layer_id string, value double")
    facts = "layer_id string, kind string, crs string, width long, height long, a double, b double, c double, d double, e double, f double, nodata double, must_align boolean, allowed_codes array<double>"
    row = lambda name, kind, b=0.0, nodata=0.0: (name, kind, "EPSG:32650", 4, 4, 30.0, b, 0.0, 0.0, -30.0, 0.0, nodata, True, [1.0, 2.0])
    layers = spark.createDataFrame([row("halves", "lulc"), row("whole", "lulc"), row("good", "lulc"), row("depth", "subsidence_depth"), row("odd", "lulc", 0.01, 2.0)], facts)
    got = defaultdict(set)
    for r in Q.layer_violations(Z.layer_profile(many.unionByName(few), ["layer_id"]), layers, "good", ("H85", " h85")).collect():
        got[r["subject"]].add(r["rule"])
    assert got == {"halves": {"integer_codes", "codes_listed"}, "whole": {"codes_listed"}, "depth": {"negative_depth"}, "odd": {"known_codes", "nodata_is_class", "aligned"}}
    assert {r["rule"] for r in Q.layer_violations(Z.layer_profile(few, ["layer_id"]), layers, "none", ("H85", None)).filter("subject IN ('none', 'table')").collect()} == {"master", "datum_declared"}


def test_evidence_gate(spark):
    ok = '{"precision": 1, "recall": 0.5, "f1": 0.6, "iou": 0.5}'
    seeds = '"classes": {"1": {"f1": 0.5, "iou": 0.5}}, "seed_metrics": '
    bodies = [
        ("lulc", "wrapped", '{"metrics": {"oa": 0.8, "f1": 0.7, "iou": 0.6, "classes": {"1": %s}}}' % ok, "completed"), ("lulc", "root", '{"oa": 0.8, "f1": 0.7, "iou": 0.6, "classes": {"1": %s}}' % ok, "completed"),
        ("lulc", "no classes", '{"oa": 0.8, "f1": 0.7, "iou": 0.6}', "failed"), ("lulc", "a class without IoU", '{"oa": 0.8, "f1": 0.7, "iou": 0.6, "classes": {"1": {"precision": 1, "recall": 1, "f1": 1}}}', "failed"),
        ("lulc", "above one", '{"oa": 1.8, "f1": 0.7, "iou": 0.6, "classes": {"1": %s}}' % ok, "failed"), ("lulc", "absent", "{}", "failed"),
        ("plus", "two seeds", '{"fom": 0, %s [{"fom": 0.2}, {"fom": 0.3}]}' % seeds, "completed"), ("plus", "one seed", '{"fom": 0.2, %s [{"fom": 0.2}]}' % seeds, "pending_validation"), ("plus", "one seed and no figure", '{%s [{"fom": 0.2}]}' % seeds, "failed"),
        ("plus", "a seed without figure", '{"fom": 0.2, %s [{"fom": 0.2}, {}]}' % seeds, "failed"), ("plus", "absent", None, "pending_validation"),
        ("invest", "close", '{"workflow_total_t_c": 5120, "independent_total_t_c": 5121}', "completed"), ("invest", "far", '{"carbon": {"workflow_total_t_c": 5120, "independent_total_t_c": 5321}}', "failed"), ("invest", "one total", '{"workflow_total_t_c": 5120}', "pending_validation"),
        ("invest", "model", '{"workflow_total_t_c": 1, "independent_total_t_c": 1, "models": {"awy": {"scenarios": {"ND": {"status": "completed", "outputs": ["a"], "units": {"y": "mm"}}}}}}', "completed"),
        ("invest", "model without units", '{"workflow_total_t_c": 1, "independent_total_t_c": 1, "models": {"awy": {"status": "completed", "outputs": ["a"], "units": {"y": "Undeclared"}}}}', "failed"),
        ("ecosystem", "good", '{"normalised_ranges": {"c": [0, 1]}, "method": "ahp", "ahp_consistency_ratio": 0.1, "sensitivity": {"available": true, "maximum_rank_shift": 0}}', "completed"),
        ("ecosystem", "turned range", '{"normalised_ranges": {"c": [1, 0]}, "sensitivity": {"available": true, "maximum_rank_shift": 0}}', "failed"), ("ecosystem", "no sensitivity", '{"normalised_ranges": {"c": [0, 1]}}', "failed"),
        ("subsidence_water", "classify", '{"mode": "classify_only", "water_code": 5, "water_cell_count": 3, "water_area_m2": 2700}', "completed"), ("subsidence_water", "no mode", '{"water_volume_m3": 1}', "failed"),
        ("subsidence_water", "volume", '{"mode": "estimate_volume", "water_volume_m3": 0}', "completed"), ("subsidence_water", "carbon missing", '{"mode": "composite_subsidence_water_carbon", "water_volume_m3": 1}', "failed"),
    ]
    df = spark.createDataFrame([(f"{s}: {n}", s, b) for s, n, b, _ in bodies] + [("two", "lulc", bodies[0][2]), ("two", "plus", bodies[7][2])], "project string, section string, body string")
    got = {(r["project"], r["section"]): r for r in Q.evidence_gate(df).collect()}
    for s, n, _, want in bodies:
        assert got[f"{s}: {n}", s]["status"] == want, n
    assert got["two", "lulc"]["status"] == "completed" and got["two", "lulc"]["gate"] == "pending_validation"
    need = {r["section"]: r["status"] for r in Q.evidence_gate(df.filter("project = 'two'"), ["lulc", "invest"]).collect()}
    assert need == {"lulc": "completed", "invest": "pending_validation"}


def test_slices_give_exact_ranks(spark, monkeypatch):
    monkeypatch.setattr(RK, "RANK_SLICES", 7)
    rng = np.random.default_rng(2)
    v = rng.integers(0, 40, 400).astype(float)
    df = spark.createDataFrame([(i, f"g{i % 3}" if i % 3 else None, float(x), float((i * 37 % 401 + 1) / 402)) for i, x in enumerate(v)], "u long, g string, v double, p double")
    assert np.allclose(RK.quantiles(df, "v", [0, 0.02, 0.25, 0.5, 0.98, 1]), np.quantile(v, [0, 0.02, 0.25, 0.5, 0.98, 1]))
    counts = df.groupBy("g", F.col("v").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    groups = {(f"g{k}" if k else None): np.arange(400) % 3 == k for k in range(3)}
    assert {r["g"]: r["m"] for r in RK.medians(counts, ["g"], "m").collect()} == {g: np.median(v[m]) for g, m in groups.items()}
    for r in RK.ordinal(df, ["g"], "v", ["u"], "place", descending=True).collect():
        own = sorted((-v[i], i) for i in np.flatnonzero(groups[r["g"]]))
        assert own[r["place"] - 1] == (-r["v"], r["u"])
    p = np.array([(i * 37 % 401 + 1) / 402 for i in range(400)])
    order = np.argsort(p)
    q = np.minimum(1, np.minimum.accumulate((p[order] * 400 / np.arange(1, 401))[::-1])[::-1])
    got = {r["u"]: r["adjusted"] for r in ST.benjamini_hochberg(df.select("u", F.col("p").alias("p_value"))).collect()}
    assert all(math.isclose(got[int(i)], x) for i, x in zip(order, q, strict=True))


def test_neighbours_across_tiles(spark, monkeypatch):
    monkeypatch.setattr(BL, "TILE", 4)
    rng = np.random.default_rng(4)
    have = rng.random((17, 15)) < 0.2
    val = rng.integers(1, 9, have.shape).astype(float)
    sources = spark.createDataFrame([(int(i), int(j), float(val[i, j])) for i, j in np.argwhere(have)], "row long, col long, value double")
    every = spark.createDataFrame([(i, j) for i in range(17) for j in range(15)], "row long, col long")
    near = {(i, j): sorted(((i - r) ** 2 + (j - c) ** 2, r, c) for r, c in np.argwhere(have) if (i - r) ** 2 + (j - c) ** 2 <= 9) for i in range(17) for j in range(15)}
    assert grid_of(BL.nearest(every, sources, 3.0)) == {k: val[n[0][1:]] for k, n in near.items() if n}
    idw = lambda n: n[0][0] == 0 and val[n[0][1:]] or sum(val[r, c] / d for d, r, c in n) / sum(1 / d for d, _, _ in n)
    got = grid_of(BL.weighted(every, sources, 3.0, 5, 2.0))
    assert got.keys() == {k for k, n in near.items() if n} and all(math.isclose(x, idw(near[k][:5])) for k, x in got.items())
    got = grid_of(BL.mean_decay(every, sources, 3.0, lambda d: 1 - d), "influence")
    assert got.keys() == {k for k, n in near.items() if n} and all(math.isclose(x, np.mean([1 - math.sqrt(d) / 3 for d, _, _ in near[k]]), abs_tol=1e-9) for k, x in got.items())


def test_polygons_that_meet(spark):
    p = lambda *xy: [{"x": float(x), "y": float(y)} for x, y in xy]
    square = lambda x, y, d: [p((x, y), (x + d, y), (x + d, y + d), (x, y + d))]
    shape = "feature_id long, rings array<array<struct<x:double,y:double>>>"
    left = spark.createDataFrame([(1, square(0, 0, 10)), (2, square(20, 20, 2))], shape)
    right = spark.createDataFrame([(11, square(9, 9, 5)), (12, square(3, 3, 1)), (13, square(15, 0, 2)), (14, square(10, 4, 1)), (15, square(18, 18, 9)), (16, [p((-5, 5), (15, 6), (15, 7))])], shape)
    assert {tuple(r) for r in C.polygons_that_meet(left, right, 4.0).collect()} == {(1, 11), (1, 12), (1, 14), (1, 16), (2, 15)}
    got = {r["c"]: r["ok"] for r in spark.createDataFrame([("[1, 2.5]",), ("[[1e2,-3],[4,5]]",), ("[1e999, 2]",), ("[]",), ("[1,]",), ('["a", 1]',), ("null",), (None,), ("[[1,2],[]]",)], "c string").withColumn("ok", Q.finite_coordinates(F.col("c"))).collect()}
    assert {k for k, ok in got.items() if ok} == {"[1, 2.5]", "[[1e2,-3],[4,5]]"}


def test_criteria_are_checked(spark):
    u = spark.createDataFrame([("A", 1.0, 2.0), ("B", 5.0, 9.0)], "unit_id string, c double, w double")
    crit = [{"field": "c", "direction": "benefit", "weight": 1}, {"field": "w", "weight": 3}]
    got = {r["unit_id"]: r for r in SC.score_units(u, crit, {"c": (0, 4)}).collect()}
    assert got["B"]["norm_c"] == 1.0 and got["B"]["clipped_c"] and not got["B"]["clipped_w"] and got["B"]["clipped"] == 1 and got["A"]["value_c"] == 1.0 and math.isclose(got["A"]["score"], 0.0625)
    for bad, why in ((u.unionByName(u.withColumn("c", F.lit(None).cast("double"))), "no finite"), (u.withColumn("w", F.lit(math.nan)), "no finite"), (u.filter("false"), "no rows")):
        with pytest.raises(ValueError, match=why):
            SC.score_units(bad, crit)
    with pytest.raises(ValueError, match="in order"):
        SC.score_units(u, crit, {"c": (4, 4)})
    m = lambda x: spark.createDataFrame([("p", i, j, v) for i, r in enumerate(x) for j, v in enumerate(r)], "panel_id string, i int, j int, v double")
    assert math.isclose({r["unit_id"]: r["score"] for r in SC.score_by_ahp(u, crit, m([[1.0, 1 / 3], [3.0, 1.0]]), "p").collect()}["B"], 1.0)
    three = [*crit, {"field": "c", "weight": 1}]
    for matrix, why in (([[1.0, 9.0, 1 / 9], [1 / 9, 1.0, 9.0], [9.0, 1 / 9, 1.0]], "exceeds"), ([[1.0, 2.0, 1.0], [2.0, 1.0, 1.0], [1.0, 1.0, 1.0]], "reciprocal")):
        with pytest.raises(ValueError, match=why):
            SC.score_by_ahp(u, three, m(matrix), "p")


def test_sample_coverage(spark):
    df = spark.createDataFrame([("1", "training", "[0]"), ("1", "training", "[1]"), ("2", "validation", "[1]"), (" ", "training", None), ("2", "test", "[2]")], "class string, role string, geometry string")
    got = {(r["subject"], r["rule"]): (r["severity"], r["n"]) for r in Q.sample_violations(df, ["1", "2", "3"], 2, 10.0, training_only=True).collect()}
    assert got == {("table", "blank_class"): ("error", 1), ("3", "missing_class"): ("error", 1), ("table", "crs"): ("error", 1), ("table", "geometry"): ("error", 1), ("table", "overlap"): ("error", 1), ("validation", "other_role"): ("error", 1), ("test", "other_role"): ("error", 1)}
    assert [tuple(r) for r in Q.sample_violations(df.drop("class")).collect()] == [("table", "class_field", "error", 1)]
    none = {r["rule"]: r["severity"] for r in Q.sample_violations(df.filter("false").drop("geometry", "role")).collect()}
    assert none == {"no_samples": "error", "two_classes": "error", "crs": "warning", "role_field": "warning"}


def test_coverage_and_contracts(spark):
    pools = spark.createDataFrame([(1,), (2,), (3,)], "lucode int")
    c = C.code_coverage(cells(spark, [[1, 2], [1, 2]]), pools)
    assert [(r["code"], r["status"]) for r in c.collect()] == [(3, "extra")]
    t = spark.createDataFrame([(1, 1.0, 1.0, 1.0, 0.0)], "lucode int, c_above double, c_below double, c_soil double, c_dead double")
    assert Q.carbon_table_violations(t).count() == 0
    assert [r["rule"] for r in Q.carbon_table_violations(t.filter("false")).collect()] == ["empty"]


def test_file_scans(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfunit_id,v\na,1\nb,x\n")
    assert T.read_csv(spark, str(tmp_path / "a.csv"), ["unit_id", "v"]).columns == ["unit_id", "v"]
    with pytest.raises(ValueError, match="lacks"):
        T.read_csv(spark, str(tmp_path / "a.csv"), ["w"])
    with pytest.raises(ValueError, match="no finite"):
        T.read_csv(spark, str(tmp_path / "a.csv"), ["v"], ["v"])
    (tmp_path / "w.dat").write_text("# x y w\n\n0 0 -1000\n30, 0, -2000\n1 2\n0 0 5\n")
    good, bad = T.read_depth_points(spark, str(tmp_path / "w.dat"))
    assert sorted(r["value"] for r in good.collect()) == [1.0, 2.0]
    assert sorted(r["reason"] for r in bad.collect()) == ["negative depth", "too few fields"]
    (tmp_path / "roi.xml").write_text('<R><Region name="water"><GeometryDef><Polygon><P>1</P></Polygon><Polygon><P>2</P></Polygon></GeometryDef></Region><Region><GeometryDef><Polygon><P>1</P></Polygon></GeometryDef></Region><Region name=" "><GeometryDef><Polygon><P>1</P></Polygon></GeometryDef></Region></R>')
    assert sorted((r["class"], r["count"]) for r in T.read_roi_xml(spark, str(tmp_path / "roi.xml")).groupBy("class").count().collect()) == [("unnamed_region_1", 1), ("unnamed_region_2", 1), ("water", 2)]
    (tmp_path / "f.geojson").write_text('{"crs":{"properties":{"name":"EPSG:32650"}},"features":[{"properties":{"class_id":1},"geometry":{"type":"Point","coordinates":[1,2]}}]}')
    g = T.read_geojson(spark, str(tmp_path / "f.geojson")).first()
    assert g["props"]["class_id"] == "1" and g["geom_type"] == "Point" and g["crs"] == "EPSG:32650"


def test_inventory_and_evidence(spark, tmp_path):
    import hashlib

    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "accuracy_final.json").write_text('{"overall_accuracy": 0.9}')
    (tmp_path / "accuracy.json").write_text("{}")
    inv = T.file_inventory(spark, str(tmp_path))
    assert {r["sha256"] for r in inv.collect()} == {hashlib.sha256(b).hexdigest() for b in (b"{}", b'{"overall_accuracy": 0.9}')}
    assert T.directory_digest(inv, str(tmp_path)).first()["files"] == 2
    e = T.assemble_evidence(spark, str(tmp_path), {"lulc": ["_final.json$", "accuracy"]})
    assert e.first()["body"].startswith('{"overall')


def test_stream_counts(spark, tmp_path):
    cells(spark, [[1, 2], [2, None]], layer_id="y").select("layer_id", "row", "col", "value").write.parquet(str(tmp_path / "in"))
    q = class_counts_stream(spark, str(tmp_path / "in")).writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert {r["value"]: r["count"] for r in spark.table("counts").collect()} == {1.0: 1, 2.0: 2}
