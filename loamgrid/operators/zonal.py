"""Layer, grid and zone statistics, scenario-service tables and change series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamgrid.functions.scalars import finite, relative_change, valid
from loamgrid.operators.ranking import medians, quantiles

RULES = ("sum", "mean", "depth_mm_to_m3")
#: Distinct codes of a layer that a profile lists at most; more are only counted.
CODE_CAP = 4096


def by_rule(rule: str, value: Column, cell_area_m2: float) -> Column:
    """The layer's total under its aggregation rule."""
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule}")
    return {"sum": F.sum(value), "mean": F.avg(value), "depth_mm_to_m3": F.sum(value) / 1000 * cell_area_m2}[rule]


def raster_statistics(cells: DataFrame, by: list[str], rule: str, cell_area_m2: float, nodata: float | None = None) -> DataFrame:
    """Total under the rule, raw sum, mean, min, max, valid count and area of each layer; NoData and non-finite cells do not count."""
    v = F.col("value")
    return cells.filter(valid(v, nodata)).groupBy(*by).agg(
        by_rule(rule, v, cell_area_m2).alias("total"), F.sum(v).alias("raw_sum"), F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.count(F.lit(1)).alias("valid_count"), (F.count(F.lit(1)) * cell_area_m2).alias("valid_area_m2"),
    )


def require_values(statistics: DataFrame, layers: DataFrame, by: list[str]) -> DataFrame:
    """Statistics of all layers; a layer without a valid cell is an error, never zero."""
    empty = layers.join(statistics, by, "left_anti").limit(10).collect()
    if empty:
        raise ValueError(f"no valid pixels in {[tuple(r) for r in empty]}")
    return statistics


def grid_units(cells: DataFrame, block: int, rule: str, cell_area_m2: float, by: list[str] = []) -> DataFrame:
    """Totals of square blocks of ``block`` cells, unit ids ``r%05d_c%05d``; blocks without a valid cell have null."""
    br, bc = F.floor(F.col("row") / block), F.floor(F.col("col") / block)
    v = F.when(finite(F.col("value")), F.col("value"))
    out = cells.groupBy(*by, br.alias("unit_row"), bc.alias("unit_col")).agg(by_rule(rule, v, cell_area_m2).alias("total"))
    return out.withColumn("unit_id", F.format_string("r%05d_c%05d", "unit_row", "unit_col"))


def unit_geometry(units: DataFrame, grid: dict[str, float], block: int) -> DataFrame:
    """One GeoJSON feature per unit, cut at the grid's edge."""
    x = lambda c: F.lit(grid["c"]) + F.least(c * block, F.lit(int(grid["width"]))) * grid["a"]
    y = lambda r: F.lit(grid["f"]) + F.least(r * block, F.lit(int(grid["height"]))) * grid["e"]
    x1, x2, y1, y2 = x(F.col("unit_col")), x(F.col("unit_col") + 1), y(F.col("unit_row")), y(F.col("unit_row") + 1)
    ring = F.array(F.array(x1, y1), F.array(x2, y1), F.array(x2, y2), F.array(x1, y2), F.array(x1, y1))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct("unit_id").alias("properties"), geometry.alias("geometry"))
    return units.select("unit_id", F.to_json(feature).alias("feature"))


def scenario_services(layers: DataFrame, services: list[str], rules: dict[str, str], block: int | None, cell_area_m2: float) -> DataFrame:
    """Wide table of one row per scenario (and unit) with one column per service; rows that lack a service drop out."""
    v = F.when(finite(F.col("value")), F.col("value"))
    by = ["scenario"]
    cells = layers.withColumn("scenario", F.upper(F.trim("scenario")))
    if block:
        unit = F.format_string("r%05d_c%05d", F.floor(F.col("row") / block), F.floor(F.col("col") / block))
        cells, by = cells.withColumn("unit_id", unit), ["scenario", "unit_id"]
    aggs = []
    for s in sorted(services):
        aggs.append(by_rule(rules.get(s, "sum"), F.when(F.col("service") == s, v), cell_area_m2).alias(s))
    return cells.groupBy(*by).agg(*aggs).dropna(subset=services)


def zone_class_statistics(cells: DataFrame, by: list[str], cell_ha: float, digits: int = 6) -> DataFrame:
    """Valid pixels, area, mean, median, min and max of the positive values of each zone and class; empty zones have nulls.

    Cells of one zone and value are counted first; all figures come from these counts, the median by running counts over slices, so no zone is whole in one task.
    """
    v = F.when(finite(F.col("value")) & (F.col("value") > 0), F.col("value"))
    counts = cells.groupBy(*by, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    n = F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("_n"))), F.lit(0))
    out = counts.groupBy(*by).agg(
        n.alias("valid_pixels"), F.round(n * cell_ha, digits).alias("area_ha"), F.round(F.sum(F.col("_v") * F.col("_n")) / F.nullif(n, F.lit(0)), digits).alias("mean"),
        F.round(F.min("_v"), digits).alias("min"), F.round(F.max("_v"), digits).alias("max"),
    )
    middle = medians(counts.filter("_v IS NOT NULL"), by, "_median")
    same = [out[c].eqNullSafe(middle[c]) for c in by]
    joined = out.join(middle, same, "left") if by else out.join(F.broadcast(middle), F.lit(True), "left")
    return joined.select(*[out[c] for c in by], "valid_pixels", "area_ha", "mean", F.round("_median", digits).alias("median"), "min", "max")


def colour_range(cells: DataFrame) -> DataFrame:
    """Percentiles 2 and 98 of the finite values; minimum and maximum if they coincide."""
    v = F.col("value")
    rows = cells.filter(finite(v))
    low, high = quantiles(rows, "value", [0.02, 0.98]) or [None, None]
    bounds = rows.agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    flat = F.lit(low) >= F.lit(high)
    return bounds.select(F.when(flat, F.col("lo")).otherwise(F.lit(low)).cast("double").alias("low"), F.when(flat, F.col("hi")).otherwise(F.lit(high)).cast("double").alias("high"))


def distinct_codes(cells: DataFrame) -> DataFrame:
    return cells.select("value").filter("value IS NOT NULL").distinct()


def layer_profile(cells: DataFrame, by: list[str], cap: int = CODE_CAP) -> DataFrame:
    """Min, max, non-finite and fractional counts, number of distinct values and, if at most ``cap``, the values themselves (else null)."""
    v = F.col("value")
    ok = finite(v)
    stats = cells.groupBy(*by).agg(
        F.min(F.when(ok, v)).alias("min"), F.max(F.when(ok, v)).alias("max"),
        F.sum(F.when(v.isNotNull() & ~ok, 1).otherwise(0)).alias("non_finite"), F.sum(F.when(ok & (v != F.floor(v)), 1).otherwise(0)).alias("fractional"),
    )
    values = cells.filter(ok).select(*by, "value").distinct()
    counts = values.groupBy(*by).agg(F.count(F.lit(1)).alias("distinct"))
    stats = stats.join(counts, by, "left")
    few = values.join(counts.filter(F.col("distinct") <= cap).select(*by), by, "left_semi")
    return stats.join(few.groupBy(*by).agg(F.array_sort(F.collect_list("value")).alias("codes")), by, "left")


def code_evidence(cells: DataFrame, code: int, cell_area_m2: float) -> DataFrame:
    n = F.count(F.lit(1))
    return cells.filter(F.col("value") == code).agg(n.alias("count"), (n * cell_area_m2).alias("area_m2"))


def depth_metrics(cells: DataFrame, by: list[str], cell_area_m2: float) -> DataFrame:
    """Cells with positive depth, their sum, area and volume; zeros if there is none."""
    d = F.when(finite(F.col("depth")) & (F.col("depth") > 0), F.col("depth"))
    total = F.coalesce(F.sum(d), F.lit(0.0))
    return cells.groupBy(*by).agg(
        F.count(d).alias("wet_cells"), total.alias("depth_sum"), (F.count(d) * cell_area_m2 / 10000).alias("area_ha"), (total * cell_area_m2).alias("volume_m3"),
    )


def sample_counts(samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Samples and pixels per class, and samples per role."""
    per_class = samples.groupBy("class").agg(F.count(F.lit(1)).alias("samples"), F.coalesce(F.sum(F.col("pixels").try_cast("double")), F.lit(0.0)).alias("pixels"))
    return per_class, samples.groupBy("role").agg(F.count(F.lit(1)).alias("samples"))


def validation_counts(samples: DataFrame) -> DataFrame:
    """Samples per label and how many of them have coordinates that are no finite numbers."""
    bad = ~(F.coalesce(finite(F.col("x").try_cast("double")), F.lit(False)) & F.coalesce(finite(F.col("y").try_cast("double")), F.lit(False)))
    return samples.groupBy("label").agg(F.count(F.lit(1)).alias("samples"), F.sum(F.when(bad, 1).otherwise(0)).alias("invalid"))


def baseline_series(totals: DataFrame, service: str = "service") -> DataFrame:
    """Change of each year against the service's first year; a year given twice is an error."""
    twice = totals.groupBy(service, "year").count().filter("count > 1").limit(10).collect()
    if twice:
        raise ValueError(f"duplicate years: {[tuple(r)[:2] for r in twice]}")
    first = F.first("total").over(Window.partitionBy(service).orderBy("year"))
    out = totals.withColumn("baseline", first).withColumn("change", F.col("total") - F.col("baseline"))
    return out.withColumn("change_pct", relative_change(F.col("total"), F.col("baseline")))


def consecutive_periods(years: DataFrame) -> DataFrame:
    w = Window.orderBy("year")  # one row per year
    return years.select("year").distinct().withColumn("to_year", F.lead("year").over(w)).filter("to_year IS NOT NULL")
