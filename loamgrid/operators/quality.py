"""Contracts of parameter tables, layers, samples and evidence: one row per violation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamgrid.functions.scalars import finite
from loamgrid.operators.services import POOLS


def _rows(df: DataFrame, rules: dict[str, Column], subject: Column) -> DataFrame:
    """``subject, rule`` for every row and rule that does not hold (null counts as not holding)."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))
    return df.select(subject.cast("string").alias("subject"), F.explode(broken).alias("rule"))


def _repeated(df: DataFrame, keys: list[str], subject: Column, rule: str) -> DataFrame:
    return df.groupBy(*keys).count().filter("count > 1").select(subject.cast("string").alias("subject"), F.lit(rule).alias("rule"))


def missing_columns(df: DataFrame, needed: list[str]) -> list[str]:
    """Header check, regardless of case."""
    have = {c.strip().lower() for c in df.columns}
    return [c for c in needed if c.lower() not in have]


def _number(c: str) -> Column:
    return F.col(c).try_cast("double")


def carbon_table_violations(table: DataFrame) -> DataFrame:
    """Pools finite and not negative, codes integer and unique; an empty table is a violation."""
    code = _number("lucode")
    rules = {"integer_code": finite(code) & (code == F.floor(code))} | {f"{p}_not_negative": finite(_number(p)) & (_number(p) >= 0) for p in POOLS}
    empty = table.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(F.lit("table").alias("subject"), F.lit("empty").alias("rule"))
    return _rows(table, rules, F.col("lucode")).unionByName(_repeated(table, ["lucode"], F.col("lucode"), "unique_code")).unionByName(empty)


#: Requirements of a layer: a null, or a column that the table lacks, asks for nothing.
LAYER_REQUIREMENTS = {
    "require_metre": "boolean", "require_nodata": "boolean", "expected_cell": "double", "allowed_codes": "array<double>", "least_bands": "int", "expected_bands": "int",
    "expected_band_names": "array<string>", "expected_range": "array<double>", "expected_sensor": "string", "must_align": "boolean",
}
#: What is known of a layer beside its profile.
LAYER_FACTS = {
    "kind": "string", "crs": "string", "projected": "boolean", "unit": "string", "width": "long", "height": "long", "nodata": "double", "integer_type": "boolean", "bands": "int",
    "band_names": "array<string>", "sensor": "string", **{c: "double" for c in "abcdef"},
}
METRES = ["metre", "meter", "metres", "meters", "m"]


def _isclose(x: Column, y: Column, rel: float, absolute: Column | float) -> Column:
    return F.abs(x - y) <= F.greatest(F.lit(rel) * F.greatest(F.abs(x), F.abs(y)), absolute if isinstance(absolute, Column) else F.lit(absolute))


def layer_violations(
    profiles: DataFrame, layers: DataFrame, master: str | None = None, datums: tuple[str | None, str | None] | None = None, carbon: DataFrame | None = None, exact_codes: bool = False
) -> DataFrame:
    """``subject, rule, severity`` of the preflight of layers.

    ``profiles``: ``zonal.layer_profile`` by ``layer_id``. ``layers``: layer_id with LAYER_FACTS and LAYER_REQUIREMENTS. ``kind``: lulc, continuous,
    subsidence_depth or other. Layers that must align are held against ``master``; ``datums``: of the elevation model and of the water level, for volumes.
    ``carbon``: the carbon-density table, which has to be sound and to cover the codes of every land-cover layer (and, if ``exact_codes``, no others). A profile without its list of codes (too many to list) is a violation of a land-cover layer, not a pass.
    """
    types = LAYER_FACTS | LAYER_REQUIREMENTS
    own = {c.lower() for c in layers.columns}
    t = layers.withColumns({c: F.col(c).cast(k) if c in own else F.lit(None).cast(k) for c, k in types.items()}).select("layer_id", *types)
    same = ["crs", "width", "height", *"abcdef"]
    m = t.filter(F.col("layer_id") == F.lit(master)).select(*[F.col(c).alias(f"m_{c}") for c in same])  # one row
    t = t.join(F.broadcast(m), F.lit(True), "left").join(profiles, "layer_id", "left")
    asked = lambda c: F.coalesce(F.col(c), F.lit(False))
    unless = lambda c, ok: F.col(c).isNull() | F.coalesce(ok, F.lit(False))
    is_a = lambda kind: F.coalesce(F.col("kind") == kind, F.lit(False))
    cell = F.greatest(*[F.abs(F.col(p + c)) for p in ("", "m_") for c in "ae"], F.lit(1.0))
    slack = F.greatest(F.lit(1e-9), cell * 1e-8)
    aligned = F.col("crs").eqNullSafe(F.col("m_crs")) & (F.col("width") == F.col("m_width")) & (F.col("height") == F.col("m_height"))
    for c in "abcdef":
        aligned = aligned & _isclose(F.col(c), F.col(f"m_{c}"), 1e-10, slack)
    names = lambda c: F.transform(c, F.lower)
    low, high = F.get("expected_range", F.lit(0)), F.get("expected_range", F.lit(1))
    lulc, codes = is_a("lulc"), F.col("codes")
    rules = {
        "crs": F.col("crs").isNotNull() & (F.col("crs") != ""), "size": (F.col("width") > 0) & (F.col("height") > 0),
        "metre": ~asked("require_metre") | (asked("projected") & F.lower("unit").isin(*METRES)), "nodata_set": ~asked("require_nodata") | F.col("nodata").isNotNull(),
        "cell_size": unless("expected_cell", (F.col("expected_cell") > 0) & _isclose(F.abs("a"), F.col("expected_cell"), 1e-8, 1e-8) & _isclose(F.abs("e"), F.col("expected_cell"), 1e-8, 1e-8)),
        "non_finite": ~is_a("continuous") | (F.coalesce("non_finite", F.lit(0)) == 0), "integer_codes": ~lulc | (F.coalesce("integer_type", F.lit(True)) & (F.coalesce("fractional", F.lit(0)) == 0)),
        "codes_listed": ~lulc | codes.isNotNull() | F.col("min").isNull(), "known_codes": ~lulc | codes.isNull() | unless("allowed_codes", F.size(F.array_except(codes, "allowed_codes")) == 0),
        "nodata_is_class": ~lulc | ~F.coalesce(F.array_contains("allowed_codes", F.col("nodata")), F.lit(False)),
        "least_bands": unless("least_bands", F.coalesce("bands", F.lit(0)) >= F.col("least_bands")), "band_count": unless("expected_bands", F.coalesce("bands", F.lit(0)) == F.col("expected_bands")),
        "band_names": unless("expected_band_names", F.coalesce(F.size("band_names") <= 0, F.lit(True)) | (names("expected_band_names") == names("band_names"))),
        "range_given": unless("expected_range", (F.size("expected_range") == 2) & finite(low) & finite(high) & (low < high)),
        "value_range": F.col("expected_range").isNull() | F.col("min").isNull() | ~(low < high) | F.coalesce((F.col("min") >= low) & (F.col("max") <= high), F.lit(False)),
        "sensor": F.col("expected_sensor").isNull() | F.col("sensor").isNull() | (F.lower("expected_sensor") == F.lower("sensor")),
        "depth_known": ~is_a("subsidence_depth") | F.col("min").isNotNull(), "negative_depth": ~is_a("subsidence_depth") | F.coalesce(F.col("min") >= -1e-9, F.lit(True)),
        "aligned": ~asked("must_align") | F.coalesce(aligned, F.lit(False)),
    }
    out = _rows(t, rules, F.col("layer_id")).withColumn("severity", F.lit("error"))
    untagged = t.filter("expected_sensor IS NOT NULL AND sensor IS NULL").select(F.col("layer_id").alias("subject"), F.lit("sensor_tag").alias("rule"), F.lit("warning").alias("severity"))
    out = out.unionByName(untagged)
    whole = []
    if master is not None and m.isEmpty():
        whole.append((master, "master", "error"))
    if datums is not None:
        dem, water = ((x or "").strip().lower() for x in datums)
        whole += [("table", "datum_declared", "error")] if not dem or not water else [("table", "datum", "error")] if dem != water else []
    out = out.unionByName(layers.sparkSession.createDataFrame(whole, "subject string, rule string, severity string"))
    return out if carbon is None else out.unionByName(_carbon_coverage(t.filter(F.coalesce(lulc, F.lit(False))), carbon, exact_codes))


def _carbon_coverage(layers: DataFrame, carbon: DataFrame, exact: bool) -> DataFrame:
    """Violations of the carbon table itself, and of each land-cover layer against its codes: missing ones are errors, codes of the table only warnings unless ``exact``; a layer whose codes are not listed is a warning."""
    faults = carbon_table_violations(carbon).select(F.concat(F.lit("carbon density/"), F.col("subject").cast("string")).alias("subject"), "rule", F.lit("error").alias("severity"))
    have = carbon.agg(F.collect_set(_number("lucode")).alias("have"))  # a row with one code per class
    held = layers.join(F.broadcast(have), F.lit(True))
    missing, extra = (F.size(F.array_except(a, b)) > 0 for a, b in (("codes", "have"), ("have", "codes")))
    of = lambda rows, rule, severity: rows.select(F.col("layer_id").alias("subject"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"))
    known = held.filter("codes IS NOT NULL")
    out = of(known.filter(missing), "carbon_missing", "error").unionByName(of(known.filter(extra), "carbon_extra", "error" if exact else "warning"))
    return faults.unionByName(out).unionByName(of(held.filter("codes IS NULL"), "carbon_unknown", "warning"))


def finite_coordinates(coordinates: Column) -> Column:
    """The JSON text of nested coordinates has numbers only, all finite, and no empty list."""
    number = r"-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?"
    flat = F.regexp_replace(F.regexp_replace(coordinates, r"\s+", ""), number, "n")
    overflow = F.exists(F.regexp_extract_all(coordinates, F.lit(number), F.lit(0)), lambda x: ~finite(x.try_cast("double")))
    return F.coalesce(flat.rlike(r"^\[[\[\]n,]*\]$") & ~flat.rlike(r"\[\]|,,|\[,|,\]") & ~overflow, F.lit(False))


def vector_violations(features: DataFrame, require_crs: bool = True, types: list[str] = []) -> DataFrame:
    """``subject, rule, n`` of vector features ``geom_type, coordinates`` (JSON text)``, crs``: none at all, no CRS, other types, coordinates that are no finite numbers."""
    broken = F.array_compact(
        F.array(
            F.when(F.lit(require_crs) & F.coalesce(F.col("crs") == "", F.lit(True)), "crs"),
            F.when(~finite_coordinates(F.col("coordinates")), "coordinates"),
            F.when(F.lit(bool(types)) & ~F.coalesce(F.col("geom_type").isin(*types), F.lit(False)), "geometry_type") if types else F.lit(None).cast("string"),
        )
    )
    found = features.select(F.explode(broken).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    empty = features.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(F.lit("features").alias("rule"), "n")
    return found.unionByName(empty).select(F.lit("vector").alias("subject"), "rule", "n")


def threat_violations(threats: DataFrame, sensitivity: DataFrame, used: DataFrame) -> DataFrame:
    """Habitat tables: unique threats with positive reach and weight and a known decay, sensitivities and habitat within 0..1, a column per threat, all codes covered.

    ``sensitivity`` is long: lulc, threat, sensitivity, habitat. ``used``: value, the codes of the layer.
    """
    ok = {
        "max_dist": finite(_number("max_dist")) & (_number("max_dist") > 0), "weight": finite(_number("weight")) & (_number("weight") > 0), "decay": F.lower(F.trim("decay")).isin("linear", "exponential"),
    }
    out = _rows(threats, ok, F.col("threat")).unionByName(_repeated(threats, ["threat"], F.col("threat"), "unique_threat"))
    unit = lambda c: finite(_number(c)) & _number(c).between(0, 1)
    out = out.unionByName(_rows(sensitivity, {"sensitivity": unit("sensitivity"), "habitat": unit("habitat")}, F.concat_ws("/", "lulc", "threat")))
    lacking = threats.select("threat").distinct().join(sensitivity.select("threat").distinct(), "threat", "left_anti")
    out = out.unionByName(lacking.select(F.col("threat").alias("subject"), F.lit("threat_column").alias("rule")))
    codes = used.select(F.col("value").cast("long").alias("lulc")).distinct().join(sensitivity.select(F.col("lulc").cast("long").alias("lulc")).distinct(), "lulc", "left_anti")
    return out.unionByName(codes.select(F.col("lulc").cast("string").alias("subject"), F.lit("code_covered").alias("rule")))


BIOPHYSICAL = ["lucode", "root_depth", "kc", "lulc_veg"]


def biophysical_violations(table: DataFrame, z: float) -> DataFrame:
    """Needed columns regardless of case, finite values, vegetation flag 0 or 1, positive Z."""
    lacking = missing_columns(table, BIOPHYSICAL)
    spark = table.sparkSession
    fixed = [(c, "column") for c in lacking] + ([] if z > 0 else [("z", "positive")])
    out = spark.createDataFrame(fixed, "subject string, rule string")
    if lacking:
        return out
    rules = {"root_depth": finite(_number("root_depth")) & (_number("root_depth") >= 0), "kc": finite(_number("kc")) & (_number("kc") >= 0), "lulc_veg": _number("lulc_veg").isin(0.0, 1.0)}
    return out.unionByName(_rows(table, rules, F.col("lucode")))


def sample_violations(
    samples: DataFrame, expected: list[str] = [], least: int = 30, most_ratio: float = 10.0, training: str = "training", validation: str = "validation", training_only: bool = False
) -> DataFrame:
    """``subject, rule, severity, n`` of samples ``class``, with ``role``, ``crs``, ``geometry`` (JSON text or null) and ``pixels`` (text) where they have them.

    Errors: no samples, blank classes, expected classes that are missing, under two classes, a geometry table without CRS or with features that have no geometry,
    validation geometries that equal training ones, other roles where only training is allowed. Warnings: classes with fewer than ``least`` samples,
    imbalance above ``most_ratio``, pixel counts that are no numbers, no CRS beside samples without geometry, no samples of one of the two roles.
    """
    have = {c.lower() for c in samples.columns}
    if "class" not in have:
        return samples.sparkSession.createDataFrame([("table", "class_field", "error", 1)], "subject string, rule string, severity string, n long")
    text = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) if c in have else F.lit(None).cast("string")
    t = samples.select(text("class").alias("class"), text("role").alias("role"), text("crs").alias("crs"), text("geometry").alias("geometry"), F.col("pixels").cast("string").alias("pixels") if "pixels" in have else F.lit("0").alias("pixels"))
    vector = "geometry" in have
    row = lambda df, subject, rule, severity, n: df.select(subject.cast("string").alias("subject"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), n.cast("long").alias("n"))
    table, one = F.lit("table"), F.lit(1)
    labelled = F.col("class").isNotNull()
    n = lambda ok: F.count(F.when(ok, 1))
    facts = t.agg(
        F.count(F.lit(1)).alias("rows"), n(~labelled).alias("blank"), n(F.col("crs").isNotNull()).alias("crs"), n(F.col("geometry").isNull()).alias("shapeless"),
        n(labelled & ~F.coalesce(finite(F.col("pixels").try_cast("double")), F.lit(False))).alias("odd"),
        n(labelled & (F.col("role") == training)).alias("train"), n(labelled & (F.col("role") == validation)).alias("check"),
    )
    counts = t.filter(labelled).groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    spread = counts.agg(F.count(F.lit(1)).alias("k"), (F.max("n") / F.min("n")).alias("ratio"))
    want = samples.sparkSession.createDataFrame([(c.strip(),) for c in expected], "class string")
    parts = [
        row(facts.filter("rows = 0"), table, "no_samples", "error", one), row(facts.filter("blank > 0"), table, "blank_class", "error", F.col("blank")),
        row(facts.filter("rows > blank AND odd > 0"), table, "pixel_count", "warning", F.col("odd")), row(spread.filter("k < 2"), table, "two_classes", "error", F.col("k")),
        row(spread.filter(F.col("ratio") > most_ratio), table, "imbalance", "warning", one), row(counts.filter(F.col("n") < least), F.col("class"), "few_samples", "warning", F.col("n")),
        row(want.join(counts, "class", "left_anti"), F.col("class"), "missing_class", "error", one), row(facts.filter("crs = 0"), table, "crs", "error" if vector else "warning", one),
    ]
    if vector:
        parts.append(row(facts.filter("shapeless > 0"), table, "geometry", "error", F.col("shapeless")))
    if "role" not in have:
        parts.append(row(facts, table, "role_field", "warning", one))
    else:
        parts += [row(facts.filter("train = 0"), table, "no_training", "error" if training_only else "warning", one), row(facts.filter("`check` = 0"), table, "no_validation", "warning", one)]
        shapes = t.filter(labelled & F.col("geometry").isNotNull())
        trained = shapes.filter(F.col("role") == training).select("geometry").distinct()
        both = shapes.filter(F.col("role") == validation).join(trained, "geometry", "left_semi").agg(F.count(F.lit(1)).alias("n"))
        parts.append(row(both.filter("n > 0"), table, "overlap", "error", F.col("n")))
        if training_only:
            others = t.filter(labelled & (F.col("role") != training)).groupBy("role").agg(F.count(F.lit(1)).alias("n"))
            parts.append(row(others, F.col("role"), "other_role", "error", F.col("n")))
    return reduce(DataFrame.unionByName, parts)


def validation_violations(samples: DataFrame, labels: list[str], least: int) -> DataFrame:
    """Validation samples (label, x, y): unknown labels, coordinates that are no numbers, labels with too few samples."""
    n = samples.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(finite(_number("x")) & finite(_number("y")), 0).otherwise(1)).alias("bad"))
    rules = {"known_label": F.col("label").isin(*labels), "coordinates": F.col("bad") == 0, "enough": F.col("n") >= least}
    return _rows(n, rules, F.col("label"))


#: Sections of the evidence, in their order, and what is read of each report.
EVIDENCE_SECTIONS = ("lulc", "plus", "invest", "ecosystem", "subsidence_water")
_CLASS = "struct<precision: double, recall: double, f1: double, iou: double>"
_RUN = "status: string, outputs: array<string>, units: map<string, string>"
EVIDENCE_SCHEMA = (
    f"metrics struct<oa: double, f1: double, iou: double, classes: map<string, {_CLASS}>>, oa double, f1 double, iou double, classes map<string, {_CLASS}>, fom double, seed_metrics array<struct<fom: double>>, "
    "carbon struct<workflow_total_t_c: double, independent_total_t_c: double, relative_tolerance: double>, workflow_total_t_c double, independent_total_t_c double, relative_tolerance double, "
    f"models map<string, struct<{_RUN}, scenarios: map<string, struct<{_RUN}>>>>, normalised_ranges map<string, array<double>>, method string, ahp_consistency_ratio double, "
    "sensitivity struct<available: boolean, maximum_rank_shift: double>, mode string, water_code long, water_cell_count double, water_area_m2 double, water_volume_m3 double, subsidence_water_composite_carbon_t_c double"
)


def _unit(c: Column) -> Column:
    return F.coalesce(finite(c) & c.between(0, 1), F.lit(False))


def _not_negative(c: Column) -> Column:
    return F.coalesce(finite(c) & (c >= 0), F.lit(False))


def _every(mapped: Column, ok) -> Column:
    """A map that is there, is not empty and whose values all hold."""
    values = F.map_values(mapped)
    return F.coalesce((F.size(values) > 0) & F.forall(values, lambda v: F.coalesce(ok(v), F.lit(False))), F.lit(False))


def _run_holds(run: Column) -> Column:
    stated = lambda u: (F.trim(u) != "") & (F.lower(F.trim(u)) != "undeclared")
    outputs = (F.size(run["outputs"]) > 0) & F.forall(run["outputs"], lambda x: F.coalesce(x != "", F.lit(False)))
    return F.coalesce((run["status"] == "completed") & outputs, F.lit(False)) & _every(run["units"], stated)


def evidence_checks(reports: DataFrame) -> DataFrame:
    """``project, section, check, level`` of evidence ``project, section, body`` (JSON text): level 0 holds, 1 is pending, 2 fails.

    lulc: accuracy, F1, IoU and those of every class are finite and within 0..1. plus: figure of merit and every class likewise, and two seeds or more, each
    with its figure (too few are pending, unless something else fails). invest: both totals (else pending) within the tolerance, 0.001 unless given (a given one has to be a number); models, if any, an object, and every other model's runs completed, with outputs and
    declared units. ecosystem: ranges [min, max] within 0..1, an AHP ratio of at most 0.1 under that method, a sensitivity summary. subsidence_water: what its mode asks for.
    """
    e = F.from_json("body", EVIDENCE_SCHEMA)
    t = reports.withColumn("e", e).withColumn("absent", F.col("body").isNull() | F.regexp_replace("body", r"\s", "").isin("", "{}"))
    at = lambda f: F.col(f"e.{f}")
    wrapped = at("metrics").isNotNull()
    lulc = lambda f: F.when(wrapped, at(f"metrics.{f}")).otherwise(at(f))
    four = lambda v: _unit(v["precision"]) & _unit(v["recall"]) & _unit(v["f1"]) & _unit(v["iou"])
    in_carbon = at("carbon").isNotNull()
    invest = lambda f: F.when(in_carbon, at(f"carbon.{f}")).otherwise(at(f))
    has = lambda text, key: F.coalesce(F.array_contains(F.json_object_keys(text), key), F.lit(False))
    part = F.when(in_carbon, F.get_json_object("body", "$.carbon")).otherwise(F.col("body"))
    told, own = invest("workflow_total_t_c"), invest("independent_total_t_c")
    bound = F.when(has(part, "relative_tolerance"), invest("relative_tolerance")).otherwise(0.001)  # given but no number: null, which fails
    totals = F.coalesce(finite(told) & finite(own), F.lit(False))
    close = (bound >= 0) & (F.abs(told - own) / F.greatest(F.abs(own), F.lit(1e-12)) <= bound)
    runs = lambda m: F.when(m["scenarios"].isNotNull(), _every(m["scenarios"], _run_holds)).otherwise(_run_holds(m))
    given = F.get_json_object("body", "$.models")
    models = given.isNull() | F.json_object_keys(given).isNotNull() & F.forall(F.map_entries(at("models")), lambda x: (x["key"] == "carbon") | runs(x["value"]))
    ranges = _every(at("normalised_ranges"), lambda r: (F.size(r) == 2) & F.forall(r, _unit) & (F.get(r, F.lit(0)) <= F.get(r, F.lit(1))))
    ratio = F.coalesce(at("method") != "ahp", F.lit(True)) | F.coalesce(finite(at("ahp_consistency_ratio")) & (at("ahp_consistency_ratio") <= 0.1), F.lit(False))
    seeds, mode = at("seed_metrics"), at("mode")
    few = F.coalesce(F.size(seeds) < 2, F.lit(True))
    volume = _not_negative(at("water_volume_m3"))
    water = (
        F.when(mode == "classify_only", F.coalesce(at("water_code") >= 1, F.lit(False)) & _not_negative(at("water_cell_count")) & _not_negative(at("water_area_m2")))
        .when(mode == "estimate_volume", volume).when(mode == "composite_subsidence_water_carbon", volume & _not_negative(at("subsidence_water_composite_carbon_t_c"))).otherwise(False)
    )
    rule = lambda name, ok, pending=False: F.struct(F.lit(name).alias("check"), F.when(ok, 0).otherwise(1 if pending else 2).alias("level"))
    present = rule("evidence", ~F.col("absent"), True)
    checks = {
        "lulc": [rule("accuracy", _unit(lulc("oa"))), rule("f1", _unit(lulc("f1"))), rule("iou", _unit(lulc("iou"))), rule("classes", _every(lulc("classes"), four))],
        "plus": [present, rule("figure_of_merit", F.col("absent") | _unit(at("fom"))), rule("classes", F.col("absent") | _every(at("classes"), lambda v: _unit(v["f1"]) & _unit(v["iou"]))), rule("seeds", ~few, True), rule("seed_figures", few | F.forall(seeds, lambda x: _unit(x["fom"])))],
        "invest": [present, rule("totals", totals, True), rule("tolerance", ~totals | F.coalesce(close, F.lit(False))), rule("models", ~totals | F.coalesce(models, F.lit(False)))],
        "ecosystem": [present, rule("ranges", F.col("absent") | ranges), rule("consistency", F.col("absent") | ratio), rule("sensitivity", F.col("absent") | (F.coalesce(at("sensitivity.available"), F.lit(False)) & _not_negative(at("sensitivity.maximum_rank_shift"))))],
        "subsidence_water": [present, rule("mode", F.col("absent") | F.coalesce(water, F.lit(False)))],
    }
    picked = F.when(F.lit(False), F.array(present))
    for name, rules in checks.items():
        picked = picked.when(F.col("section") == name, F.array(*rules))
    return t.select("project", "section", F.explode(picked).alias("r")).select("project", "section", "r.check", "r.level")


def _status(level: Column) -> Column:
    return F.element_at(F.array(F.lit("completed"), F.lit("pending_validation"), F.lit("failed")), level + 1)


def evidence_gate(reports: DataFrame, required: list[str] | None = None) -> DataFrame:
    """``project, section, status, broken`` (checks that do not hold) and ``gate``, the project's status; failed outranks pending_validation, which outranks completed.

    ``required``: sections that every project has to report; by default those that it does report.
    """
    if required:
        names = reports.sparkSession.createDataFrame([(s,) for s in required], "section string")
        need = reports.select("project").distinct().join(F.broadcast(names), F.lit(True))  # five sections at most
        reports = need.join(reports.select("project", "section", "body"), ["project", "section"], "left")
    checks = evidence_checks(reports)
    bad = F.array_sort(F.collect_set(F.when(F.col("level") > 0, F.col("check"))))
    out = checks.groupBy("project", "section").agg(F.max("level").alias("level"), bad.alias("broken"))
    gate = F.max("level").over(Window.partitionBy("project"))
    return out.select("project", "section", _status(F.col("level")).alias("status"), "broken", _status(gate).alias("gate"))


def period_violations(periods: DataFrame) -> DataFrame:
    """Periods (project, position, year, validation_file): years within 1900..2200, ascending, unique; no validation file used twice."""
    w = Window.partitionBy("project").orderBy("position")
    t = periods.withColumn("_last", F.lag("year").over(w))
    rules = {"range": F.col("year").between(1900, 2200), "ascending": F.col("_last").isNull() | (F.col("year") > F.col("_last"))}
    out = _rows(t, rules, F.concat_ws("/", "project", "year"))
    out = out.unionByName(_repeated(periods, ["project", "year"], F.concat_ws("/", "project", "year"), "unique_year"))
    files = periods.filter("validation_file IS NOT NULL")
    return out.unionByName(_repeated(files, ["project", "validation_file"], F.concat_ws("/", "project", "validation_file"), "validation_file"))


def rule_warnings(services: DataFrame) -> DataFrame:
    """Services (project, service, rule): water yield or habitat quality added up by plain sum."""
    odd = F.col("service").isin("annual_water_yield", "habitat_quality") & (F.col("rule") == "sum")
    return services.filter(odd).select("project", "service", F.concat(F.col("service"), F.lit(" should not be aggregated by sum")).alias("warning"))
