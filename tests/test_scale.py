"""Operators whose work must not follow a reach, a tie or a file's shape, against brute force."""

import hashlib
import json
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamgrid.functions import scalars as S
from loamgrid.operators import blocks as BL
from loamgrid.operators import classify as K
from loamgrid.operators import quality as Q
from loamgrid.operators import ranking as RK
from loamgrid.operators import regrid as R
from loamgrid.operators import score as SC
from loamgrid.operators import stats as ST
from loamgrid.plans import registry
from loamgrid.sources import tables as T


def test_nearest_source_by_feature_transform(monkeypatch):
    r = np.random.default_rng(1)
    for _ in range(150):
        monkeypatch.setattr(BL, "CELLS", int(r.choice([1, 60, 500_000])))
        h, w = r.integers(1, 25, 2)
        at = r.permutation(h * w)[: r.integers(1, max(2, h * w // 3))]
        sr, sc = at // w + 7, at % w - 3
        t = r.permutation(1600)[: r.integers(1, 150)]
        tr, tc = t // 40, t % 40 - 10
        d2, number = BL.nearest_in(tr, tc, sr, sc)
        for k in range(len(t)):
            assert (d2[k], sr[number[k]], sc[number[k]]) == min(((tr[k] - a) ** 2 + (tc[k] - b) ** 2, a, b) for a, b in zip(sr, sc, strict=True))


def test_work_does_not_follow_the_reach():
    r = np.random.default_rng(2)
    t = r.permutation(128 * 128)[:10_000]
    spent = {}
    for reach in (50, 333):
        far = np.array([127 + reach])
        began = time.process_time()
        for _ in range(3):
            BL.nearest_in(t // 128, t % 128, far, far)
            crowd = BL.Crowd(far, far)
            assert crowd.inside(t // 128, t % 128, np.full(len(t), reach)).sum() <= len(t)
        spent[reach] = time.process_time() - began
    assert spent[333] < 2 * spent[50] + 0.2


def test_interpolation_of_far_and_crowded_sources(spark, monkeypatch):
    """Sources far away, in one crowd and on the cell itself; tiles of 16, small arrays."""
    monkeypatch.setattr(BL, "CELLS", 400)
    r = np.random.default_rng(3)
    at = {(int(a), int(b)) for a, b in r.integers(0, 12, (70, 2))} | {(45, 3), (3, 50), (44, 44), (45, 44)}
    have = {p: float(r.integers(1, 9)) for p in at}
    sources = spark.createDataFrame([(*p, v) for p, v in have.items()], "row long, col long, value double")
    targets = spark.createDataFrame([(i, j) for i in range(0, 60, 3) for j in range(0, 60, 4)], "row long, col long")
    got = {(x["row"], x["col"]): x["value"] for x in BL.weighted(targets, sources, 21.5, 6, 2.0).collect()}
    want = {}
    for i in range(0, 60, 3):
        for j in range(0, 60, 4):
            near = sorted(((i - a) ** 2 + (j - b) ** 2, a, b) for a, b in have if (i - a) ** 2 + (j - b) ** 2 <= 21.5**2)[:6]
            if near:
                want[i, j] = have[near[0][1:]] if near[0][0] == 0 else sum(have[a, b] / d for d, a, b in near) / sum(1 / d for d, _, _ in near)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)


def test_wide_row_with_one_source():
    at = np.array([5])
    began = time.time()
    least = BL.row_minima(np.zeros((64, 1), np.int64), np.broadcast_to(at, (64, 1)), at, 100_000, 0, 100_000)
    assert (least[7] // 100_000 == (np.arange(100_000) - 5) ** 2).all() and time.time() - began < 20


def test_distances_without_sources_and_with_holes(spark):
    r = np.random.default_rng(5)
    cells = [(i, j, bool(r.random() < 0.02)) for i in range(40) for j in range(300) if r.random() < 0.8]
    df = spark.createDataFrame(cells, "row long, col long, is_source boolean")
    src = [(i, j) for i, j, s in cells if s]
    got = {(x["row"], x["col"]): x["distance"] for x in R.distance_to_sources(df, 2.0, 7).collect()}
    # gaps are taken in columns that have cells there, so compare where the source's column has the row
    have = {(i, j) for i, j, _ in cells}
    for (i, j), d in got.items():
        best = min((math.hypot(i - a, j - b) for a, b in src if (i, b) in have), default=None)
        assert d is None if best is None else math.isclose(d, 2.0 * best)
    assert {x["distance"] for x in R.distance_to_sources(df.withColumn("is_source", F.lit(False)), 2.0).collect()} == {None}


def test_hot_ties_are_dealt_over_slices(spark, monkeypatch):
    monkeypatch.setattr(RK, "SLICE_ROWS", 500)
    df = spark.range(8000).select(F.col("id").alias("unit_id"), F.when(F.col("id") % 10 == 3, F.col("id") % 7).otherwise(5).cast("double").alias("score"), (F.col("id") % 2).alias("variant"))
    at = RK.order_cuts(df.withColumn("_sort", -F.col("score")), ["_sort", "unit_id"], 8000)
    assert len(at) == 15
    sizes = [x["count"] for x in df.withColumn("_sort", -F.col("score")).withColumn("s", RK.slice_by(df.withColumn("_sort", -F.col("score")), ["_sort", "unit_id"], at)).groupBy("s").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1500  # nine of ten rows have one score
    got = {x["unit_id"]: x["rank"] for x in SC.ordinal_ranks(df).collect()}
    rows = [(x["variant"], -x["score"], x["unit_id"]) for x in df.collect()]
    for v in (0, 1):
        assert [got[u] for _, _, u in sorted(x for x in rows if x[0] == v)] == list(range(1, 4001))
    flat = ST.benjamini_hochberg(df.select("unit_id", F.lit(0.5).alias("p_value"))).collect()
    assert {x["adjusted"] for x in flat} == {0.5}


def test_affine_round_trip(spark):
    grid = {"a": 4.0, "b": 3.0, "c": 7.0, "d": 3.0, "e": -4.0, "f": 900.0, "width": 9, "height": 8}
    cells = R.grid_cells(spark, grid)
    placed = cells.select(F.col("row").alias("r"), F.col("col").alias("c"), S.centre_x(F.col("col"), F.col("row"), grid).alias("x"), S.centre_y(F.col("col"), F.col("row"), grid).alias("y"))
    out = S.with_cell_index(placed, grid).collect()
    assert len(out) == 72 and all(x["inside"] and (x["r"], x["c"]) == (x["row"], x["col"]) for x in out)
    with pytest.raises(ValueError):
        S.to_grid(F.lit(1.0), F.lit(1.0), {"a": 1.0, "b": 2.0, "c": 0.0, "d": 1.0, "e": 2.0, "f": 0.0})


def cells_of(spark, matrix):
    return spark.createDataFrame([(i, j, float(v)) for i, row in enumerate(matrix) for j, v in enumerate(row) if v is not None], "row long, col long, value double")


def test_majority_onto_a_master_grid(spark):
    source = {"a": 10.0, "c": 0.0, "e": -10.0, "f": 0.0}
    m = [[1, 1, 2], [1, 2, 2], [3, 3, 2]]
    whole = lambda **k: {(x["row"], x["col"]): x["value"] for x in R.majority_to_grid(cells_of(spark, m), source, {"width": 9, "height": 9, **k}).collect()}
    assert whole(a=30.0, c=0.0, e=-30.0, f=0.0) == {(0, 0): 2.0}
    assert whole(a=15.0, c=0.0, e=-15.0, f=0.0) == {(0, 0): 1.0, (0, 1): 2.0, (1, 0): 3.0, (1, 1): 2.0}
    assert whole(a=5.0, c=0.0, e=-5.0, f=0.0) == {(i, j): float(m[i // 2][j // 2]) for i in range(6) for j in range(6)}
    half = whole(a=10.0, c=5.0, e=-10.0, f=-5.0)
    assert half[0, 0] == 1.0 and half[0, 1] == 2.0 and half[1, 0] == 3.0 and len(half) == 9
    up = whole(a=30.0, c=0.0, e=30.0, f=-30.0)  # rows from below
    assert up == {(0, 0): 2.0}
    turned = whole(a=0.0, b=30.0, c=0.0, d=-30.0, e=0.0, f=0.0)  # rows run to the right, columns down
    assert turned == {(0, 0): 2.0}


def test_continuous_onto_a_turned_grid(spark):
    """A plane is reproduced by bilinear and cubic weights wherever all neighbours are there."""
    source = {"a": 10.0, "c": 100.0, "e": -10.0, "f": 200.0}
    plane = lambda x, y: 2 * x - 3 * y + 5
    cells = [(i, j, plane(100 + 10 * (j + 0.5), 200 - 10 * (i + 0.5))) for i in range(20) for j in range(20)]
    df = spark.createDataFrame(cells, "row long, col long, value double")
    master = {"a": 8.0, "b": 5.0, "c": 140.0, "d": 5.0, "e": -8.0, "f": 130.0, "width": 6, "height": 6}
    for method in ("bilinear", "cubic"):
        got = R.continuous_to_grid(df, source, master, method).collect()
        assert len(got) == 36
        for r in got:
            x, y = 8 * (r["col"] + 0.5) + 5 * (r["row"] + 0.5) + 140, 5 * (r["col"] + 0.5) - 8 * (r["row"] + 0.5) + 130
            assert math.isclose(r["value"], plane(x, y), abs_tol=1e-6)


def test_influence_times_intensity(spark, monkeypatch):
    monkeypatch.setattr(BL, "TILE", 4)
    r = np.random.default_rng(6)
    src = [(int(i), int(j), float(r.random())) for i, j in {tuple(x) for x in r.integers(0, 14, (30, 2)).tolist()}]
    df = spark.createDataFrame(src, "row long, col long, intensity double")
    every = spark.createDataFrame([(i, j) for i in range(14) for j in range(14)], "row long, col long")
    got = {(x["row"], x["col"]): x["influence"] for x in BL.mean_decay(every, df, 3.0, lambda d: 1 - d, "intensity").collect()}
    for i in range(14):
        for j in range(14):
            near = [(math.hypot(i - a, j - b), y) for a, b, y in src if math.hypot(i - a, j - b) <= 3]
            assert ((i, j) in got) == bool(near)
            if near:
                assert math.isclose(got[i, j], sum(y * (1 - d / 3) for d, y in near) / len(near), abs_tol=1e-9)


def test_scorer_gets_whole_patches(spark):
    cells = spark.createDataFrame([("a", i, j, float(10 * i + j)) for i in range(6) for j in range(5) if (i, j) != (2, 2)], "layer_id string, row long, col long, v double")
    layers = spark.createDataFrame([("a", 6, 5)], "layer_id string, height long, width long")

    def scorer(tensor):
        full = np.nan_to_num(tensor[0], nan=-1.0)
        return np.stack((np.full((4, 4), float(np.isnan(tensor[0]).sum())), full))

    out = K.score_patches(K.cut_patches(cells, layers, 4, 2), scorer, 4, ["v"], [7, 9], ["layer_id"]).collect()
    patches = {(0, 0), (0, 1), (2, 0), (2, 1)}
    assert {(r["patch_row"], r["patch_col"]) for r in out} == patches and len(out) == 2 * (16 * 4 - 4)
    for r in out:
        assert r["p"] == (1.0 if r["class"] == 7 else 10 * (r["patch_row"] + r["i"]) + r["patch_col"] + r["j"])
    with pytest.raises(Exception, match="the scorer gave"):
        K.score_patches(K.cut_patches(cells, layers, 4, 2), lambda t: t, 4, ["v"], [7, 9], ["layer_id"]).collect()


def geojson(features, first="type", crs_last=False):
    out = []
    for k, (props, geometry) in enumerate(features):
        parts = {"type": '"type": "Feature"', "id": f'"id":{k}'}
        head = {"type": [parts["type"]], "id": [parts["id"], parts["type"]], "props": []}[first]
        tail = [f'"properties":{json.dumps(props, ensure_ascii=False)}', f'"geometry":{json.dumps(geometry)}'] + ([parts["type"]] if first == "props" else [])
        out.append("{" + ",".join(head + tail) + "}")
    crs = '"crs":{"type":"name","properties":{"name":"EPSG:4326"}}'
    return '{"type":"FeatureCollection",' + ("" if crs_last else crs + ",") + '"features": [' + ", ".join(out) + "]" + ("," + crs if crs_last else "") + "}"


def test_one_line_of_features_is_read_by_many_tasks(spark, tmp_path):
    r = np.random.default_rng(7)
    features = [({"name": f"é {k} {{}} ] \\ \"", "note": f"x{k}" * int(r.integers(1, 40))}, {"type": "Point", "coordinates": [k, -k]}) for k in range(6000)]
    for name, text in (("a", geojson(features)), ("b", geojson(features[:70], "id", True)), ("c", geojson([]))):
        (tmp_path / f"{name}.geojson").write_text(text, encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        for name in "abc":
            path = str(tmp_path / f"{name}.geojson")
            got = sorted(map(tuple, T.read_features(spark, path).select("feature_id", F.to_json("props"), "geom_type", "coordinates", "crs").collect()))
            want = sorted(map(tuple, T.read_geojson(spark, path).select("feature_id", F.to_json("props"), "geom_type", F.replace("coordinates", F.lit(" ")), "crs").filter("feature_id IS NOT NULL").collect()))
            assert got == want and len(got) == {"a": 6000, "b": 70, "c": 0}[name]
        assert spark.read.option("lineSep", '"Feature"').text(str(tmp_path / "a.geojson")).rdd.getNumPartitions() > 8
        for k, text in enumerate((geojson(features[:9], "props"), geojson([({"kind": "Feature"}, {"type": "Point", "coordinates": [1, 2]})] * 3))):
            (tmp_path / f"bad{k}.geojson").write_text(text, encoding="utf-8")
            with pytest.raises(Exception, match="does not begin with its type"):
                T.read_features(spark, str(tmp_path / f"bad{k}.geojson")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_digest_of_a_nested_tree(spark, tmp_path):
    root = tmp_path / "tree"
    for name, body in (("b.txt", b"1"), ("a/z.bin", bytes(range(256)) * 9), ("a/b/c.txt", b""), ("a.txt", b"x" * 5000), ("a-b/y", b"\0"), ("a/b.txt", b"q")):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(body)
    digest, total = hashlib.sha256(), 0
    for child in sorted(p for p in root.rglob("*") if p.is_file()):
        digest.update(child.relative_to(root).as_posix().encode() + hashlib.sha256(child.read_bytes()).hexdigest().encode())
        total += child.stat().st_size
    out = T.directory_digest(T.file_inventory(spark, str(root)), str(root)).first()
    assert (out["sha256"], out["files"], out["bytes"]) == (digest.hexdigest(), 6, total)


def test_a_fixed_reference_needs_all_bounds(spark):
    u = spark.createDataFrame([("A", 1.0, 2.0), ("B", 5.0, 9.0)], "unit_id string, c double, w double")
    crit = [{"field": "c", "weight": 1}, {"field": "w", "weight": 3}]
    with pytest.raises(ValueError, match="fixed reference"):
        SC.score_units(u, crit, {"c": (0, 4)}, fixed=True)
    assert SC.score_units(u, crit, {"c": (0, 4), "w": (0, 10)}, fixed=True).count() == 2


def test_tolerance_and_models_of_the_evidence(spark):
    totals = '"workflow_total_t_c": 100.0, "independent_total_t_c": 100.01'
    bodies = {
        "plain": f"{{{totals}}}", "wide": f'{{{totals}, "relative_tolerance": 0.5}}', "text": f'{{{totals}, "relative_tolerance": "x"}}', "null": f'{{{totals}, "relative_tolerance": null}}',
        "inner": f'{{"carbon": {{{totals}, "relative_tolerance": []}}}}', "outer": f'{{"carbon": {{{totals}}}, "relative_tolerance": "x"}}', "list": f'{{{totals}, "models": [1]}}', "none": f'{{{totals}, "models": null}}', "object": f'{{{totals}, "models": {{"carbon": {{}}}}}}',
    }
    df = spark.createDataFrame([(k, "invest", v) for k, v in bodies.items()], "project string, section string, body string")
    got = {r["project"]: r["status"] for r in Q.evidence_gate(df).collect()}
    assert got == {k: "failed" if k in ("text", "null", "inner", "list") else "completed" for k in bodies}


def test_master_grid_work_follows_the_cells(spark):
    """Three cells on a master grid of 4e13 cells: only the targets near them are looked at."""
    source, df = {"a": 10.0, "c": 0.0, "e": -10.0, "f": 0.0}, spark.createDataFrame([(5, 5, 1.0), (9, 9_999_990, 2.0), (9_999_990, 3, 3.0)], "row long, col long, value double")
    wide = {"a": 15.0, "c": 5.0, "e": -15.0, "f": -5.0, "width": 6_666_667, "height": 6_666_667}
    got = {(r["row"], r["col"]): r["value"] for r in R.continuous_to_grid(df, source, wide).collect()}
    want = {}
    for r, c, v in ((5, 5, 1.0), (9, 9_999_990, 2.0), (9_999_990, 3, 3.0)):
        near = lambda k: [t for t in range(max(0, int(k / 1.5) - 3), int(k / 1.5) + 4) if abs(1.5 * t + 0.75 - k) < 1]
        want |= {(i, j): v for i in near(r) for j in near(c)}
    assert got.keys() == want.keys() and all(math.isclose(got[k], v) for k, v in want.items())
    turned = wide | {"a": 12.0, "b": 5.0, "d": 5.0, "e": -12.0, "c": 2.0, "f": -2.0}
    for r in R.continuous_to_grid(df, source, turned, "nearest").collect():
        x, y = 12 * (r["col"] + 0.5) + 5 * (r["row"] + 0.5) + 2, 5 * (r["col"] + 0.5) - 12 * (r["row"] + 0.5) - 2
        assert {(5, 5): 1.0, (9, 9_999_990): 2.0, (9_999_990, 3): 3.0}[int(-y // 10), int(x // 10)] == r["value"]


def test_patches_of_a_huge_layer_follow_its_cells(spark):
    """A layer of 4e14 cells with three of them filled, and small layers against the listed grid."""
    layers = spark.createDataFrame([("a", 20_000_000, 20_000_001), ("b", 11, 4), ("c", 3, 2), ("d", 10, 9)], "layer_id string, height long, width long")
    far = [("a", 0, 0), ("a", 19_999_999, 20_000_000), ("a", 7_000_003, 4)]
    small = [(k, i, j) for k, h, w in (("b", 11, 4), ("c", 3, 2), ("d", 10, 9)) for i in range(h) for j in range(w)]
    cells = spark.createDataFrame(far + small, "layer_id string, row long, col long")
    for patch, stride in ((4, 3), (4, 4), (3, 5), (8, 2)):
        want = {("a", *p, r, c) for k, r, c in far for p in [(y, x) for y in near(r, 20_000_000, patch, stride) for x in near(c, 20_000_001, patch, stride)]}
        for p in K.patch_grid(layers.filter("layer_id <> 'a'"), patch, stride).collect():
            want |= {(*p, i, j) for k, i, j in small if k == p["layer_id"] and 0 <= i - p["patch_row"] < patch and 0 <= j - p["patch_col"] < patch}
        got = [(x["layer_id"], x["patch_row"], x["patch_col"], x["row"], x["col"]) for x in K.cut_patches(cells, layers, patch, stride).collect()]
        assert sorted(got) == sorted(want)


def near(at, size, patch, stride):
    last = size - patch
    return {s for s in range(at // stride * stride - 4 * patch // stride * stride, at + 1, stride) if 0 <= s <= last and at - s < patch} | ({last} if last <= at else set())


def test_patches_of_one_block_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 6)
    cells = spark.createDataFrame([("a", i, j, float(100 * i + j)) for i in range(0, 23, 2) for j in range(0, 19, 3)], "layer_id string, row long, col long, v double")
    layers = spark.createDataFrame([("a", 23, 19)], "layer_id string, height long, width long")
    sums = lambda t: np.full((1, 4, 4), np.nansum(t))
    cut = K.cut_patches(cells, layers, 4, 2)
    want = {(r["patch_row"], r["patch_col"]): r["s"] for r in cut.groupBy("patch_row", "patch_col").agg(F.sum("v").alias("s")).collect()}
    got = K.score_patches(cut, sums, 4, ["v"], [1], ["layer_id"]).collect()
    assert len(got) == cut.count() and all(r["p"] == want[r["patch_row"], r["patch_col"]] for r in got)


def test_layers_predicted_in_one_pass(spark, monkeypatch):
    """Blocks of a few cells, patches over their edges and those of the layers, a model that looks at whole patches: as cutting, scoring and blending one after the other."""
    r = np.random.default_rng(15)
    sizes = [("a", 23, 40), ("b", 3, 9), ("c", 8, 8), ("d", 50, 17)]
    cells = [(n, i, j, float(r.integers(0, 9)), float(r.random())) for n, h, w in sizes for i in range(h) for j in range(w) if r.random() < 0.4] + [("b", 30, 2, 1.0, 1.0), ("e", 1, 1, 1.0, 1.0)]
    cells = spark.createDataFrame(cells, "layer_id string, row int, col int, u double, v double").repartition(3)
    layers = spark.createDataFrame(sizes, "layer_id string, height int, width int")

    def model(tensor):  # bands first, the patch's rows and columns last, patches between if there are many
        seen, filled = ~np.isnan(tensor[0]), np.nan_to_num(tensor)
        whole = (filled[1].sum(axis=(-2, -1)) / seen.sum(axis=(-2, -1)))[..., None, None]
        p = np.stack([filled[0] + 1, 4 * filled[1] + 2, 6 * whole + 0 * filled[0]])
        return p / p.sum(axis=0)

    for patch, stride, block in ((8, 4, 11), (5, 3, 16), (4, 6, 9), (7, 1, 256)):
        monkeypatch.setattr(K, "BLOCK", block)
        one = K.blend_predictions(K.score_patches(K.cut_patches(cells, layers, patch, stride), model, patch, ["u", "v"], [2, 5, 7], ["layer_id"]), patch, 0.5, ["layer_id"])
        want = {(x["layer_id"], x["row"], x["col"]): x for x in one.collect()}
        out = K.predict_layers(cells, layers, model, patch, stride, ["u", "v"], [2, 5, 7], 0.5)
        assert out.dtypes == one.dtypes and out.columns == one.columns
        got = {(x["layer_id"], x["row"], x["col"]): x for x in out.collect()}
        assert got.keys() == want.keys() and len(got) == out.count()
        assert all(got[k]["class"] == want[k]["class"] and math.isclose(got[k]["confidence"], want[k]["confidence"]) and got[k]["low_confidence"] == want[k]["low_confidence"] for k in want)
        assert out._jdf.queryExecution().toString().count("RepartitionByExpression") <= 3 and "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert K.predict_layers(cells.filter("false"), layers, model, 8, 4, ["u", "v"], [2, 5, 7], 0.5).count() == 0
    with pytest.raises(Exception, match="the scorer gave"):
        K.predict_layers(cells, layers, lambda t: t, 8, 4, ["u", "v"], [2, 5, 7], 0.5).collect()


def test_scored_patches_go_to_no_second_shuffle(spark):
    """After the cells are made, one shuffle, and no aggregate over cells times patches times classes."""
    plan = registry.queries()["f22_scored_patches"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Repartition") == 1 and plan.count("Aggregate") <= 3


def test_distance_over_a_grid(spark):
    r = np.random.default_rng(8)
    src = sorted({(int(a), int(b), int(c)) for a, b, c in zip(r.integers(0, 2, 60), r.integers(0, 50, 60), r.integers(0, 20, 60), strict=True)} | {(2, 3, 1)})
    df = spark.createDataFrame(src, "year int, row long, col long")
    for rows in (1, 7, 256):
        got = {(x["year"], x["row"], x["col"]): x["distance"] for x in R.grid_distance(df, 2.0, 50, 20, ["year"], rows).collect()}
        assert len(got) == 3 * 50 * 20
        for (y, i, j), d in got.items():
            assert math.isclose(d, 2 * min(math.hypot(i - b, j - c) for a, b, c in src if a == y))


def test_columns_that_are_nobodys_nearest_are_left_out(spark, monkeypatch):
    """A strip whose sources lie in one block, all other columns' far below: few columns go to the pass along its rows, and the distances are those of all."""
    r, passed, full = np.random.default_rng(9), [], BL.row_minima
    at = np.arange(600)
    near = (at >= 300) & (at < 330)
    gap = np.where(near, r.integers(0, 9, (16, 600)), 4000 + 10 * np.abs(at - 315) - np.arange(16)[:, None])
    for some in (at, np.flatnonzero(r.random(600) < 0.3)):
        own = gap[:, some]
        want = (own[:, :, None] ** 2 + (some[:, None] - at[None]) ** 2).min(axis=1)
        passed.clear()
        monkeypatch.setattr(R, "row_minima", lambda base, *a: passed.append(base.shape) or full(base, *a))
        assert (R.strip_minima(own, some, 600) == want).all()
        assert [rows for rows, _ in passed] == [1, 1, 16] and passed[-1][1] <= 40
    for _ in range(30):
        some = np.flatnonzero(r.random(80) < r.choice([0.05, 0.5])) if r.random() < 0.8 else np.array([7])
        some = some if len(some) else np.array([3])
        own = r.integers(0, r.choice([3, 30, 300]), (5, len(some)))
        assert (R.strip_minima(own, some, 80) == (own[:, :, None] ** 2 + (some[:, None] - np.arange(80)[None]) ** 2).min(axis=1)).all()
    df = spark.createDataFrame([(1, 3, 4), (1, 9, 0)], "year int, row long, col long")
    monkeypatch.setattr(R, "row_minima", full)
    got = {(x["row"], x["col"]): x["distance"] for x in R.grid_distance(df, 30.0, 12, 6, ["year"], digits=6).collect()}
    assert len(got) == 72 and all(d == round(30 * min(math.hypot(i - 3, j - 4), math.hypot(i - 9, j)), 6) for (i, j), d in got.items())


def test_surface_over_a_huge_grid(spark):
    """A scope of 1e14 cells with four observed ones: only cells near these are made, clipped at the grid's edge."""
    grid = {"a": 1.0, "b": 0.0, "c": 0.0, "d": 0.0, "e": -1.0, "f": 10_000_000.0, "width": 10_000_000, "height": 10_000_000}
    at = {(0, 0): 1.0, (9_999_999, 9_999_999): 2.0, (511, 512): 3.0, (513, 512): 4.0}
    points = spark.createDataFrame([(c + 0.5, 10_000_000.0 - r - 0.5, v) for (r, c), v in at.items()], "x double, y double, value double")
    got = {(x["row"], x["col"]): (x["value"], x["filled"]) for x in R.depth_surface(points, grid, (10_000_000, 10_000_000), 2.0).collect()}
    want = {}
    for r, c in at:
        for i in range(r - 2, r + 3):
            for j in range(c - 2, c + 3):
                if 0 <= i < 10_000_000 and 0 <= j < 10_000_000 and (i - r) ** 2 + (j - c) ** 2 <= 4:
                    d, near = min(((i - a) ** 2 + (j - b) ** 2, (a, b)) for a, b in at)
                    want[i, j] = (at[near], d > 0)
    assert got == want


def test_looks_and_transforms_agree(spark, monkeypatch):
    """Tiles of 8: places looked at one by one, and the transforms of long reaches and crowded tiles, with threats that overlap."""
    monkeypatch.setattr(BL, "TILE", 8)
    r = np.random.default_rng(9)
    rows = [(i, j, bool(r.random() < 0.6), float(r.random()) if r.random() < 0.2 else None, float(r.random()) if r.random() < 0.2 else None) for i in range(30) for j in range(26)]
    df = spark.createDataFrame(rows, "row long, col long, own boolean, a double, b double").withColumn("source", F.expr("a IS NOT NULL OR b IS NOT NULL"))
    one = df.withColumn("source", F.col("a").isNotNull()).withColumn("value", F.col("a"))
    kernels = {"a": (3.0, lambda d: 1 - d), "b": (2.2, lambda d: np.exp(-d))}
    found = []
    for limits in ((256, 4_000_000), (0, 0)):
        monkeypatch.setattr(BL, "PLACES", limits[0])
        monkeypatch.setattr(BL, "LOOKS", limits[1])
        parts = (BL.influences(df, kernels, ["row", "col"]), BL.nearest_of(one, 3.0), BL.weighted_of(one, 3.0, 4, 2.0))
        found.append([{(x["row"], x["col"]): x for x in p.collect()} for p in parts])
    for one, other in zip(*found, strict=True):
        assert one.keys() == other.keys() and len(one) > 300
        for k in one:
            assert all(x == y or math.isclose(x, y, abs_tol=1e-9) for x, y in zip(one[k], other[k], strict=True))


def test_equal_units_tie_whatever_the_order_of_their_rows(spark, tmp_path):
    """A second supplier sells the same items in another order: all its services are equal to the last bit (ranks and SQL depend on it)."""
    from loamgrid.plans import bindings as P

    r = np.random.default_rng(11)
    items = [(round(float(p), 2), float(q), round(float(d), 2)) for p, q, d in zip(r.random(3000) * 9e4, r.integers(1, 51, 3000), r.integers(0, 11, 3000) / 100, strict=True)]
    rows = [(k, *items[i]) for k in (1, 2) for i in (range(3000) if k == 1 else r.permutation(3000))]
    write = lambda name, data, shape: spark.createDataFrame(data, shape).write.parquet(f"{tmp_path}/{name}.parquet")
    write("lineitem", rows, "l_suppkey long, l_extendedprice double, l_quantity double, l_discount double")
    write("supplier", [(1, 0), (2, 0)], "s_suppkey long, s_nationkey long")
    write("nation", [(0, 0)], "n_nationkey long, n_regionkey long")
    write("region", [(0, "ASIA")], "r_regionkey long, r_name string")
    one, other = P.units(spark, str(tmp_path)).drop("unit_id").collect()
    assert one == other


def test_slopes_across_tiles_from_one_shuffle_of_the_cells(spark, monkeypatch):
    monkeypatch.setattr(BL, "TILE", 5)
    r = np.random.default_rng(12)
    z = r.random((2, 17, 14)) * 100
    gone = r.random(z.shape) < 0.03
    dem = spark.createDataFrame([(int(k), int(i), int(j), float(z[k, i, j])) for k, i, j in np.argwhere(~gone)], "year int, row long, col long, value double")
    out = R.slope_aspect(dem, 30.0, ["year"])
    got = {(x["year"], x["row"], x["col"]): x["slope"] for x in out.collect()}
    want = {}
    for k, i, j in np.argwhere(~gone).tolist():
        a = z[k, max(0, i - 1) : i + 2, max(0, j - 1) : j + 2]
        if a.size == 9 and not gone[k, i - 1 : i + 2, j - 1 : j + 2].any():
            dx, dy = ((a[:, 2] - a[:, 0]) @ [1, 2, 1]) / 240, ((a[2] - a[0]) @ [1, 2, 1]) / 240
            want[k, i, j] = math.degrees(math.atan(math.hypot(dx, dy)))
    assert got.keys() == want.keys() and all(math.isclose(got[k], v) for k, v in want.items())
    assert "Generate explode(array(struct" not in out._jdf.queryExecution().toString()


def test_majority_takes_one_shuffle_that_is_not_merged(spark):
    """Both aggregates of a majority run where one exchange by cell has dealt the rows, in a set number of tasks."""
    df = cells_of(spark, [[1, 1, 2], [1, 2, 2], [3, 3, 2]])
    source = {"a": 10.0, "c": 0.0, "e": -10.0, "f": 0.0}
    for out in (R.majority_regrid(df, 2.0), R.majority_to_grid(df, source, {"a": 15.0, "c": 0.0, "e": -15.0, "f": 0.0, "width": 9, "height": 9})):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan


def test_slices_of_units_come_from_one_scan(spark):
    from loamgrid.plans import registry

    plan = registry.queries()["g4_g5_union_of_units"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_targets_meet_their_neighbours_in_tiles(spark, monkeypatch):
    """Weights over several layers across the edges of tiles, with holes, targets without neighbours and null keys, as by brute force; no target is multiplied by its neighbours."""
    monkeypatch.setattr(R, "TILE", 4)
    r = np.random.default_rng(8)
    src = {(y, i, j): float(r.integers(1, 99)) for y, i, j in {tuple(x) for x in r.integers(0, [2, 20, 20], (260, 3)).tolist()}}
    targets = sorted({tuple(x) for x in r.integers(-2, 15, (120, 2)).tolist()})
    cells = [(*k, v) for k, v in src.items()] + [(0, None, 3, 1.0), (1, 2, 2, None)]
    cells = spark.createDataFrame([x for x in cells if x[3] is not None or (1, 2, 2) not in src], "year int, row long, col long, value double")
    t = spark.createDataFrame([*targets, (None, 1)], "row long, col long")
    far = lambda x: -0.5 * x**3 + 2.5 * x**2 - 4 * x + 2
    kernels = {"bilinear": lambda x: max(0.0, 1 - x), "cubic": lambda x: 1.5 * x**3 - 2.5 * x**2 + 1 if x <= 1 else far(x) if x < 2 else 0.0}
    for method, kernel in kernels.items():
        for ratio in (1.5, 0.5):
            out = R.continuous_regrid(cells, t, ratio, method, 0.05, ["year"])
            got, want = {(x["year"], x["row"], x["col"]): x["value"] for x in out.collect()}, {}
            for year in (0, 1):
                for i, j in targets:
                    w = {k: kernel(abs((i + 0.5) * ratio - 0.5 - k[1])) * kernel(abs((j + 0.5) * ratio - 0.5 - k[2])) for k in src if k[0] == year}
                    if abs(sum(w.values())) > 0.05:
                        want[year, i, j] = sum(src[k] * x for k, x in w.items()) / sum(w.values())
            assert got.keys() == want.keys() and all(math.isclose(got[k], v, rel_tol=1e-9) for k, v in want.items())
            assert "explode(array(" not in out._jdf.queryExecution().toString()
    one = R.continuous_regrid(cells.filter("year = 0").drop("year"), t, 1.5)
    assert {(x["row"], x["col"]) for x in one.collect()} == {(x["row"], x["col"]) for x in R.continuous_regrid(cells, t, 1.5, by=["year"]).collect() if x["year"] == 0}
