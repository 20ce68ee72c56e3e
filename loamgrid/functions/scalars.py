"""Column expressions: validity, recodes, grid arithmetic, spectral indices, flags and depths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed class codes: standard six classes to the seven-class scheme, and native eight classes to the standard six.
STANDARD_TO_ENHANCED = {1: 2, 2: 3, 3: 4, 4: 5, 5: 6, 6: 7}
NATIVE_TO_STANDARD = {0: 6, 1: 3, 2: 4, 3: 5, 4: 2, 5: 2, 6: 2, 7: 1}


def finite(c: Column) -> Column:
    """Not null, not NaN and not infinite."""
    d = c.cast("double")
    return c.isNotNull() & ~F.isnan(d) & (F.abs(d) < float("inf"))


def valid(c: Column, nodata: Column | float | None = None) -> Column:
    """A cell that counts: finite and not the NoData value."""
    ok = finite(c)
    if nodata is None:
        return ok
    return ok & ~c.cast("double").eqNullSafe((nodata if isinstance(nodata, Column) else F.lit(nodata)).cast("double"))


def positive(c: Column) -> Column:
    """The value if it is finite and above zero, else null."""
    return F.when(finite(c) & (c > 0), c)


def recode(c: Column, codes: dict[int, int]) -> Column:
    """The code's counterpart; null for codes that have none."""
    return F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])[c]


def isclose(a: Column, b: Column, rel: float = 1e-9, abs_tol: float = 0.0) -> Column:
    return F.abs(a - b) <= F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_tol))


def centre_x(col: Column, row: Column, grid: dict[str, float]) -> Column:
    return F.lit(grid["a"]) * (col + 0.5) + F.lit(grid.get("b", 0.0)) * (row + 0.5) + F.lit(grid["c"])


def centre_y(col: Column, row: Column, grid: dict[str, float]) -> Column:
    return F.lit(grid.get("d", 0.0)) * (col + 0.5) + F.lit(grid["e"]) * (row + 0.5) + F.lit(grid["f"])


def to_grid(x: Column, y: Column, grid: dict[str, float]) -> tuple[Column, Column]:
    """Column and row of a point in cells from the grid's origin, by the inverse of all six terms of its transform."""
    b, d = grid.get("b", 0.0), grid.get("d", 0.0)
    if not b and not d:
        return (x - grid["c"]) / grid["a"], (y - grid["f"]) / grid["e"]
    det = grid["a"] * grid["e"] - b * d
    if not det:
        raise ValueError("the grid's transform has no inverse")
    right, up = x - grid["c"], y - grid["f"]
    return (right * grid["e"] - up * b) / det, (up * grid["a"] - right * d) / det


def with_cell_index(points: DataFrame, grid: dict[str, float], x: str = "x", y: str = "y") -> DataFrame:
    """Add ``row``, ``col`` and ``inside``; left <= x < right and bottom < y <= top, along the grid's own axes."""
    col, row = to_grid(F.col(x), F.col(y), grid)
    out = points.withColumn("col", F.floor(col).cast("long")).withColumn("row", F.floor(row).cast("long"))
    inside = F.col("col").between(0, int(grid["width"]) - 1) & F.col("row").between(0, int(grid["height"]) - 1)
    return out.withColumn("inside", F.coalesce(inside, F.lit(False)))


def systematic(step: int) -> Column:
    """Every ``step``-th row and column."""
    return (F.col("row") % step == 0) & (F.col("col") % step == 0)


def normalise_bands(bands: Column, scale: float, offset: float, mean: list[float], std: list[float]) -> Column:
    """``((x * scale + offset) - mean) / std`` band by band."""
    stats = F.array(*[F.struct(F.lit(float(m)).alias("m"), F.lit(float(s)).alias("s")) for m, s in zip(mean, std, strict=True)])
    return F.zip_with(bands, stats, lambda x, s: (x * scale + offset - s["m"]) / s["s"])


def _ratio(a: Column, b: Column) -> Column:
    return (a - b) / F.nullif(a + b, F.lit(0.0))


def spectral_indices(green: Column, red: Column, nir: Column, swir1: Column) -> dict[str, Column]:
    """Published band ratios; null on a zero denominator."""
    return {"ndvi": _ratio(nir, red), "ndwi": _ratio(green, nir), "mndwi": _ratio(green, swir1), "ndbi": _ratio(swir1, nir)}


def clear_by_bits(qa: Column, bits: list[int]) -> Column:
    """None of the flag bits is set."""
    return qa.bitwiseAND(F.lit(sum(1 << b for b in bits))) == 0


def clear_by_class(scene_class: Column, dropped: list[int]) -> Column:
    return ~scene_class.isin(*dropped)


#: Sensor names (lower case, underscores as spaces, runs of spaces squeezed) and the profile each stands for.
SENSOR_ALIASES = {
    "landsat5": "landsat_5_tm", "landsat 5": "landsat_5_tm", "landsat 5 tm": "landsat_5_tm",
    "landsat8": "landsat_8_oli", "landsat 8": "landsat_8_oli", "landsat 8 oli": "landsat_8_oli",
    "sentinel2": "sentinel_2_msi", "sentinel 2": "sentinel_2_msi", "sentinel-2": "sentinel_2_msi", "sentinel 2 msi": "sentinel_2_msi", "sentinel-2 msi": "sentinel_2_msi",
}
#: Profile, source bands in canonical order, native and grid resolution, resampling of reflectance and of classes, and the step to the grid.
SENSOR_PROFILES = [
    ("landsat_5_tm", ["SR_B1", "SR_B2", "SR_B3", "SR_B4", "SR_B5", "SR_B7"], 30, 30, "bilinear", "nearest", "not_required"),
    ("landsat_8_oli", ["SR_B2", "SR_B3", "SR_B4", "SR_B5", "SR_B6", "SR_B7"], 30, 30, "bilinear", "nearest", "not_required"),
    ("sentinel_2_msi", ["B2", "B3", "B4", "B8", "B11", "B12"], 10, 30, "bilinear", "nearest", "majority_10m_to_30m"),
]
_PROFILE_TYPE = "profile string, bands array<string>, resolution_m int, grid_m int, continuous_resampling string, classified_resampling string, to_grid string"


def sensor_key(name: Column) -> Column:
    """The profile that a sensor name stands for; null if unknown."""
    plain = F.trim(F.regexp_replace(F.lower(name), r"[\s_]+", " "))
    return F.create_map(*[F.lit(x) for kv in SENSOR_ALIASES.items() for x in kv])[plain]


def sensor_profiles(scenes: DataFrame, sensor_col: str = "sensor") -> DataFrame:
    """Add the profile of each scene's sensor and ``rejected`` for unknown ones."""
    profiles = scenes.sparkSession.createDataFrame(SENSOR_PROFILES, _PROFILE_TYPE)
    out = scenes.withColumn("_key", sensor_key(F.col(sensor_col)))
    out = out.join(F.broadcast(profiles), F.col("_key") == F.col("profile"), "left").drop("_key")  # three rows
    return out.withColumn("rejected", F.col("profile").isNull())


#: Names of categorical drivers, and the resampling that each type of driver allows, its default first.
CATEGORICAL_DRIVERS = ["soil", "soil_type", "geology", "lithology", "landform", "zoning", "protected_area", "administrative_zone", "ecological_redline"]
RESAMPLING = {"categorical": ["majority", "nearest"], "continuous": ["bilinear", "cubic"], "circular": ["nearest"]}


def _by_kind(values: dict) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v))])


def driver_type(name: Column) -> Column:
    """Aspect is circular; listed names and names that end in ``_class`` or ``_type`` are categorical; the rest is continuous."""
    n = F.lower(F.trim(name))
    listed = n.isin(*CATEGORICAL_DRIVERS) | n.endswith("_class") | n.endswith("_type")
    return F.when(n == "aspect", "circular").when(listed, "categorical").otherwise("continuous")


def default_resampling(kind: Column) -> Column:
    return _by_kind({k: v[0] for k, v in RESAMPLING.items()})[kind]


def resampling_allowed(kind: Column, method: Column) -> Column:
    """The method, or without one the type's default, is allowed for the type; an unknown type allows none."""
    used = F.lower(F.coalesce(F.nullif(method, F.lit("")), default_resampling(kind)))
    return F.coalesce(F.array_contains(_by_kind(RESAMPLING)[kind], used), F.lit(False))


def low_confidence(confidence: Column, threshold: float, nodata: int = 255) -> Column:
    """1 below the threshold, 0 for other valid cells, ``nodata`` for the rest."""
    return F.when(~finite(confidence), nodata).when(confidence < threshold, 1).otherwise(0)


def water_depth(dem: Column, subsidence: Column, level: Column) -> Column:
    """Depth below the water level after subsidence; null where the ground stays above it."""
    post = dem - subsidence
    return F.when(post < level, level - post)


def relative_change(value: Column, baseline: Column) -> Column:
    """Percent change on the larger of |baseline| and 1e-12."""
    return (value - baseline) / F.greatest(F.abs(baseline), F.lit(1e-12)) * 100
