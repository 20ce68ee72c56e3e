"""Carbon, water-yield, habitat and subsidence-water models on cell tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamgrid.functions.scalars import finite
from loamgrid.operators.blocks import influences, marked

POOLS = ["c_above", "c_below", "c_soil", "c_dead"]
DECAY_RATE = 2.99
HALF_SATURATION_POWER = 2.5


def carbon_storage(cells: DataFrame, pools: DataFrame, by: list[str], cell_ha: float) -> DataFrame:
    """Mg C per group: the class's pools (Mg C/ha) times the cells' area. The pools are one row per class code."""
    density = pools.select(F.col("lucode").alias("value"), sum((F.col(p) for p in POOLS[1:]), F.col(POOLS[0])).alias("density"))
    # counts per class first: the join then has a row per group and class
    counts = cells.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(density, "value").groupBy(*by).agg(F.sum(F.col("density") * F.col("n") * cell_ha).alias("carbon_mg"), F.sum("n").alias("cells"))


def water_yield_mm(precip: Column, et0: Column, kc: Column, root_depth: Column, rest_depth: Column, pawc: Column, vegetated: Column, z: float) -> Column:
    """Annual yield of a cell by the published Budyko curve.

    Plant-available water AWC = min(rest depth, root depth) * PAWC, w = Z * AWC / P + 1.25 (5 at most), PET = Kc * ET0,
    AET / P = 1 + PET / P - (1 + (PET / P)^w)^(1 / w); without vegetation AET = min(PET, P).
    """
    w = F.least(F.lit(5.0), F.lit(z) * F.least(rest_depth, root_depth) * pawc / precip + 1.25)
    ratio = kc * et0 / precip
    fraction = F.when(vegetated == 1, 1 + ratio - F.pow(1 + F.pow(ratio, w), 1 / w)).otherwise(F.least(ratio, F.lit(1.0)))
    return F.when(precip > 0, precip * (1 - fraction))


def water_yield(cells: DataFrame, biophysical: DataFrame, by: list[str], z: float, cell_area_m2: float) -> DataFrame:
    """m3 and mean mm per watershed; ``cells`` has ``lulc, precip, et0, rest_depth, pawc``."""
    table = biophysical.select(F.col("lucode").alias("lulc"), "root_depth", F.col("kc"), "lulc_veg")
    out = cells.join(F.broadcast(table), "lulc")  # one row per class code
    mm = water_yield_mm(F.col("precip"), F.col("et0"), F.col("kc"), F.col("root_depth"), F.col("rest_depth"), F.col("pawc"), F.col("lulc_veg"), z)
    return out.withColumn("mm", mm).groupBy(*by).agg((F.sum("mm") / 1000 * cell_area_m2).alias("yield_m3"), F.avg("mm").alias("mean_mm"), F.count("mm").alias("cells"))


def habitat_quality(cells: DataFrame, threat_cells: DataFrame, threats: DataFrame, sensitivity: DataFrame, pixel: float, k: float) -> DataFrame:
    """Degradation and quality of every cell.

    A threat's influence is the mean over its source cells in reach of intensity times decay, ``1 - d / max`` (linear) or
    ``exp(-2.99 d / max)``; the kernel is normalised by the number of source cells in reach. Degradation is the sum over threats
    of weight / all weights * influence * sensitivity; quality = habitat * (1 - D^2.5 / (D^2.5 + k^2.5)).
    ``cells``: row, col, lulc. ``threat_cells``: threat, row, col, and intensity (0 to 1) unless it is 1 everywhere. ``threats``: threat, max_dist, weight, decay.
    ``sensitivity``: lulc, threat, sensitivity, habitat.
    """
    names = [r["threat"] for r in threats.select("threat").collect()]  # one row per threat
    strength = F.coalesce(F.col("intensity").cast("double"), F.lit(0.0)) if "intensity" in threat_cells.columns else F.lit(1.0)
    wide = threat_cells.filter(F.col("threat").isin(*names)).withColumns({n: F.when(F.col("threat") == n, strength) for n in names})
    return habitat_of(marked(cells.select("row", "col", "lulc"), wide, names), threats, sensitivity, pixel, k)


def habitat_of(rows: DataFrame, threats: DataFrame, sensitivity: DataFrame, pixel: float, k: float) -> DataFrame:
    """``habitat_quality`` over one table: ``row, col, lulc``, ``own`` (a cell to be rated), ``source`` (a threat's cell) and a column per threat, its intensity there or null. One shuffle, all threats in one pass over the tiles.
    """
    listed = threats.select("threat", "max_dist", "weight", "decay").collect()  # one row per threat
    total = sum(r["weight"] for r in listed)
    kernels = {r["threat"]: (r["max_dist"] / pixel, (lambda d: 1 - d) if r["decay"] == "linear" else (lambda d: np.exp(-DECAY_RATE * d))) for r in listed}
    found = influences(rows, kernels, ["row", "col", "lulc"], alone=True)
    table = sensitivity.groupBy("lulc").agg(F.max("habitat").alias("habitat"), *[F.sum(F.when(F.col("threat") == t, F.col("sensitivity"))).alias(f"_s_{t}") for t in kernels])
    out = found.join(F.broadcast(table), "lulc")  # one row per class
    d = F.lit(0.0)
    for r in listed:
        d = d + F.coalesce(F.col(r["threat"]) * (r["weight"] / total) * F.col(f"_s_{r['threat']}"), F.lit(0.0))
    z = F.pow("degradation", F.lit(HALF_SATURATION_POWER))
    out = out.withColumn("degradation", d).select("lulc", "row", "col", "habitat", "degradation")
    return out.withColumn("quality", F.col("habitat") * (1 - z / (z + k**HALF_SATURATION_POWER)))


WATER_INPUTS = [
    "water_volume_m3", "water_carbon_density_g_c_m3", "aquatic_vegetation_area_ha", "aquatic_vegetation_carbon_density_t_c_ha",
    "bottom_sediment_area_ha", "bottom_sediment_carbon_density_t_c_ha",
]


def composite_carbon(sites: DataFrame) -> DataFrame:
    """t C in water, aquatic vegetation and sediment per site and year; ``valid`` is false if an input is missing, negative or not finite."""
    ok = F.lit(True)
    for c in WATER_INPUTS:
        ok = ok & F.coalesce(finite(F.col(c)) & (F.col(c) >= 0), F.lit(False))
    v, d, va, vd, sa, sd = WATER_INPUTS
    out = sites.withColumn("valid", ok)
    out = out.withColumn("water_t_c", F.when(F.col("valid"), F.col(v) * F.col(d) / 1e6)).withColumn("vegetation_t_c", F.when(F.col("valid"), F.col(va) * F.col(vd)))
    out = out.withColumn("sediment_t_c", F.when(F.col("valid"), F.col(sa) * F.col(sd)))
    return out.withColumn("composite_t_c", F.col("water_t_c") + F.col("vegetation_t_c") + F.col("sediment_t_c"))


def replaced_total(total: Column, model_water: Column, composite: Column) -> Column:
    """Model total with its water carbon replaced; null (a violation) if the water exceeds the total."""
    return F.when(model_water <= total, total - model_water + composite)


def subsidence_water_carbon(
    cells: DataFrame, by: list[str], cell_area_m2: float, water_g_m3: float, vegetation_t_ha: float, sediment_t_ha: float, depth_threshold: float
) -> DataFrame:
    """Depth cells to composite carbon in one pass: vegetation where the water is at most ``depth_threshold`` deep, sediment under all of it.

    ``cells`` has ``depth``; sites without positive depth come out with null carbon, which is an error to report.
    """
    d = F.when(finite(F.col("depth")) & (F.col("depth") > 0), F.col("depth"))
    ha = cell_area_m2 / 10000
    out = cells.groupBy(*by).agg(
        F.count(d).alias("wet_cells"), (F.sum(d) * cell_area_m2).alias("volume_m3"), (F.count(F.when(d <= depth_threshold, 1)) * ha).alias("vegetation_ha"), (F.count(d) * ha).alias("sediment_ha")
    )
    carbon = F.col("volume_m3") * water_g_m3 / 1e6 + F.col("vegetation_ha") * vegetation_t_ha + F.col("sediment_ha") * sediment_t_ha
    return out.withColumn("composite_t_c", F.when(F.col("wet_cells") > 0, carbon))
