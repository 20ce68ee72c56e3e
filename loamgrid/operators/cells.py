"""Joins of cell tables, points, polygons and code tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamgrid.functions.scalars import with_cell_index
from loamgrid.operators.blocks import KEY, marked, nearest_of


def stack_layers(layers: dict[str, DataFrame], key: list[str] = KEY) -> DataFrame:
    """Inner join of layers on their cells; column ``value`` of each layer takes the layer's name.

    All joins share one key, so each layer is shuffled once.
    """
    out = None
    for name, df in layers.items():
        layer = df.select(*key, F.col("value").alias(name))
        out = layer if out is None else out.join(layer, key)
    return out


def stack_dates(cells: DataFrame, dates: dict[str, object], date: str = "year", key: list[str] = KEY) -> DataFrame:
    """As ``stack_layers``, for layers of one table that differ by ``date``: a column per name of ``dates``, of the cells that have a value at all of them. One scan and one shuffle, no join."""
    at = lambda d: F.max(F.when(F.col(date) == F.lit(d), F.col("value")))
    wide = cells.filter(F.col(date).isin(*dates.values())).groupBy(*key).agg(*[at(d).alias(name) for name, d in dates.items()])
    return wide.dropna(subset=list(dates))


def grid_mismatches(grids: DataFrame, reference: str, tolerance: float | None = None) -> DataFrame:
    """Fields in which a layer's grid differs from the reference layer's; no rows means aligned.

    ``grids``: one row per layer with ``layer_id, crs, width, height, a..f``. With a tolerance, transforms may differ by
    1e-10 of the value plus ``tolerance``.
    """
    exact = ["crs", "width", "height"]
    terms = ["a", "b", "c", "d", "e", "f"]
    ref = grids.filter(F.col("layer_id") == reference).select(*[F.col(c).alias(f"_{c}") for c in exact + terms])
    pairs = grids.filter(F.col("layer_id") != reference).join(F.broadcast(ref), F.lit(True), "left")  # one reference row
    same = {c: F.col(c).eqNullSafe(F.col(f"_{c}")) for c in exact}
    for c in terms:
        near = F.abs(F.col(c) - F.col(f"_{c}")) <= F.lit(1e-10) * F.abs(F.col(f"_{c}")) + F.lit(tolerance or 0.0)
        same[c] = F.col(c).eqNullSafe(F.col(f"_{c}")) if tolerance is None else F.coalesce(near, F.lit(False))
    bad = F.array(*[F.when(~ok, F.lit(c)) for c, ok in same.items()])
    return pairs.select("layer_id", F.explode(F.array_compact(bad)).alias("field"))


def require_aligned(grids: DataFrame, reference: str, tolerance: float | None = None) -> None:
    bad = grid_mismatches(grids, reference, tolerance).limit(10).collect()
    if bad:
        raise ValueError(f"grids differ from {reference}: " + ", ".join(f"{r.layer_id}.{r.field}" for r in bad))


def sample_at_points(points: DataFrame, cells: DataFrame, grid: dict[str, float]) -> DataFrame:
    """Add the cell's ``value`` to points; ``inside`` is false off the grid, the value is null there and on NoData."""
    indexed = with_cell_index(points, grid)
    layer = cells.select("row", "col", "value")
    return indexed.join(layer, KEY, "left").withColumn("value", F.when(F.col("inside"), F.col("value")))


def merge_supplement(base: DataFrame, extra: DataFrame, columns: list[str], order_col: str = "line") -> DataFrame:
    """Overwrite ``columns`` by a supplement's on (upper-cased trimmed scenario, trimmed unit); its last line wins."""
    key = lambda df: df.withColumn("scenario", F.upper(F.trim("scenario"))).withColumn("unit_id", F.trim("unit_id"))
    last = Window.partitionBy("scenario", "unit_id").orderBy(F.col(order_col).desc())
    one = key(extra).withColumn("_n", F.row_number().over(last)).filter("_n = 1")
    one = one.select("scenario", "unit_id", *[F.col(c).alias(f"_{c}") for c in columns])
    out = key(base).join(one, ["scenario", "unit_id"], "left")
    keep = [c for c in base.columns if c not in columns]
    return out.select(*keep, *[F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) for c in columns])


def code_coverage(used: DataFrame, table: DataFrame, used_col: str = "value", table_col: str = "lucode") -> DataFrame:
    """``code, status``: codes of the layer that the table lacks (missing) and codes only in the table (extra)."""
    u = used.select(F.col(used_col).cast("long").alias("code")).filter("code IS NOT NULL").distinct()
    t = table.select(F.col(table_col).cast("long").alias("code")).filter("code IS NOT NULL").distinct()
    missing = u.join(t, "code", "left_anti").withColumn("status", F.lit("missing"))
    return missing.unionByName(t.join(u, "code", "left_anti").withColumn("status", F.lit("extra")))


def nearest_fill(scope: DataFrame, observed: DataFrame, max_distance: float, pixel: float) -> DataFrame:
    """Cells of the scope with their own value, or else the nearest observed one within ``max_distance``.

    Ties go to the first sample in row-major order. ``filled`` tells borrowed values; cells that get none are left out.
    """
    return nearest_of(marked(scope.select(*KEY), observed, ["value"]), max_distance / pixel)


def polygon_edges(features: DataFrame, id_col: str = "feature_id") -> DataFrame:
    """``id, x1, y1, x2, y2`` of the rings in ``rings ARRAY<ARRAY<STRUCT<x, y>>>``; rings close themselves."""
    rings = features.select(F.col(id_col).alias("feature_id"), F.explode("rings").alias("ring"))
    closed = rings.withColumn("ring", F.concat("ring", F.slice("ring", 1, 1)))
    edges = F.explode(F.expr("transform(sequence(1, size(ring) - 1), i -> struct(ring[i - 1] as p, ring[i] as q))"))
    e = closed.select("feature_id", edges.alias("e"))
    return e.select("feature_id", F.col("e.p.x").alias("x1"), F.col("e.p.y").alias("y1"), F.col("e.q.x").alias("x2"), F.col("e.q.y").alias("y2"))


def cells_in_polygons(cells: DataFrame, features: DataFrame, x: Column, y: Column, band: float) -> DataFrame:
    """``feature_id`` and the cells whose centre lies inside by the even-odd rule (holes are rings).

    A ray to the right crosses an edge only inside the edge's height, so the edges of a feature are gathered by bands of height ``band``, and each band
    is laid over the square tiles between its outermost edges. Cells join on their tile, in x and y, and count crossings in the array that comes with it:
    nothing is shuffled after the join. Upper ends are open: a border shared by two polygons assigns each cell once.
    """
    edges = polygon_edges(features).filter("y1 <> y2")
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    edges = edges.withColumn("_band", F.explode(F.sequence(F.floor(low / band), F.floor(high / band))))
    bands = edges.groupBy("feature_id", "_band").agg(
        F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("_edges"), F.floor(F.min(F.least("x1", "x2")) / band).alias("_from"), F.floor(F.max(F.greatest("x1", "x2")) / band).alias("_to")
    )
    tiles = bands.withColumn("_tile", F.explode(F.sequence("_from", "_to"))).select("feature_id", "_band", "_tile", "_edges")
    placed = cells.withColumn("_x", x).withColumn("_y", y).withColumn("_band", F.floor(y / band)).withColumn("_tile", F.floor(x / band))

    def crosses(e: Column) -> Column:
        at = e["x1"] + (F.col("_y") - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])
        return ((e["y1"] <= F.col("_y")) != (e["y2"] <= F.col("_y"))) & (F.col("_x") < at)

    met = placed.join(tiles, ["_band", "_tile"])
    return met.filter(F.size(F.filter("_edges", crosses)) % 2 == 1).select("feature_id", *cells.columns)


def geometry_key(kind: Column, coordinates: Column) -> Column:
    """Canonical text of a geometry: compact JSON over a fixed struct."""
    return F.to_json(F.struct(kind.alias("type"), coordinates.alias("coordinates")))


def geometry_overlaps(train: DataFrame, check: DataFrame, key: str = "geometry_key") -> DataFrame:
    """Features of ``check`` whose geometry equals one of ``train``."""
    return check.join(train.select(key).distinct(), key, "left_semi")


def points_in_training(points: DataFrame, features: DataFrame, band: float) -> DataFrame:
    """Validation points (``x, y``) that fall in a training polygon, each once per polygon."""
    return cells_in_polygons(points, features, F.col("x"), F.col("y"), band)


def polygons_that_meet(left: DataFrame, right: DataFrame, band: float) -> DataFrame:
    """``left_id, right_id`` of polygons that share a point: edges that cross or touch, or one with a corner inside the other.

    Edges and corners meet on square tiles of width ``band``; only edges in one tile are held against each other.
    """
    cut = lambda a, b: F.explode(F.sequence(F.floor(F.least(a, b) / band), F.floor(F.greatest(a, b) / band)))
    tiled = lambda f: polygon_edges(f).withColumn("_i", cut("y1", "y2")).withColumn("_j", cut("x1", "x2"))
    p = tiled(left).withColumnRenamed("feature_id", "left_id")
    q = tiled(right).select(F.col("feature_id").alias("right_id"), *[F.col(c).alias(f"q{c}") for c in ("x1", "y1", "x2", "y2")], "_i", "_j")
    side = lambda ax, ay, bx, by, cx, cy: (F.col(bx) - F.col(ax)) * (F.col(cy) - F.col(ay)) - (F.col(by) - F.col(ay)) * (F.col(cx) - F.col(ax))
    one = side("x1", "y1", "x2", "y2", "qx1", "qy1") * side("x1", "y1", "x2", "y2", "qx2", "qy2")
    two = side("qx1", "qy1", "qx2", "qy2", "x1", "y1") * side("qx1", "qy1", "qx2", "qy2", "x2", "y2")
    apart = F.lit(False)
    for c in "xy":  # boxes that do not meet rule out edges on one line
        apart = apart | (F.greatest(f"{c}1", f"{c}2") < F.least(f"q{c}1", f"q{c}2")) | (F.greatest(f"q{c}1", f"q{c}2") < F.least(f"{c}1", f"{c}2"))
    touching = p.join(q, ["_i", "_j"]).filter((one <= 0) & (two <= 0) & ~apart).select("left_id", "right_id")
    corner = lambda f, name: f.select(F.col("feature_id").alias(name), F.explode("rings").alias("r")).select(name, F.explode("r").alias("p")).select(name, "p.x", "p.y")
    inner = points_in_training(corner(left, "left_id"), right, band).select("left_id", F.col("feature_id").alias("right_id"))
    outer = points_in_training(corner(right, "right_id"), left, band).select(F.col("feature_id").alias("left_id"), "right_id")
    return touching.unionByName(inner).unionByName(outer).distinct()
