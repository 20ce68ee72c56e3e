"""Class areas, transitions, accuracy, figure of merit and layer consistency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fixed class schemes.
STANDARD_6 = {1: "cropland", 2: "forest", 3: "grassland", 4: "water", 5: "built_up", 6: "bare_land"}
HIGH_WATER_7 = {1: "subsidence_water", 2: "cropland", 3: "forest", 4: "grassland", 5: "water", 6: "built_up", 7: "bare_land"}


def class_table(spark, scheme: dict[int, str]) -> DataFrame:
    return spark.createDataFrame(list(scheme.items()), "code int, name string")


def class_area(cells: DataFrame, cell_ha: float, by: list[str] = []) -> DataFrame:
    return cells.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("count")).withColumn("area_ha", F.col("count") * cell_ha)


def _named(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Inner join of both codes with their names: codes outside the scheme drop out."""
    old = F.broadcast(classes.select(F.col("code").alias("source_code"), F.col("name").alias("source")))  # a class scheme
    new = F.broadcast(classes.select(F.col("code").alias("target_code"), F.col("name").alias("target")))
    return pairs.join(old, "source_code").join(new, "target_code")


def transition_matrix(before: DataFrame, after: DataFrame, classes: DataFrame, cell_ha: float, key=("row", "col")) -> DataFrame:
    """``source_code, source, target_code, target, pixel_count, area_ha`` over the cells that both layers have."""
    both = before.select(*key, F.col("value").alias("source_code")).join(after.select(*key, F.col("value").alias("target_code")), list(key))
    return stack_transitions(both, "source_code", "target_code", classes, cell_ha)


def stack_transitions(stack: DataFrame, before: str, after: str, classes: DataFrame, cell_ha: float) -> DataFrame:
    """As ``transition_matrix``, from two columns of a stack (see ``cells.stack_dates``)."""
    both = stack.select(F.col(before).alias("source_code"), F.col(after).alias("target_code"))
    counts = both.groupBy("source_code", "target_code").agg(F.count(F.lit(1)).alias("pixel_count"))
    out = _named(counts.withColumn("area_ha", F.col("pixel_count") * cell_ha), classes)
    return out.select("source_code", "source", "target_code", "target", "pixel_count", "area_ha")


def period_transitions(cells: DataFrame, classes: DataFrame, cell_ha: float, key=("row", "col")) -> DataFrame:
    """Transitions of all consecutive years in one job: each cell's value beside its value in the next year that any cell has.

    One window over the cell's own years takes the place of a self-join; cells that miss the next year drop out.
    """
    years = cells.select("year").distinct()
    periods = years.withColumn("to_year", F.lead("year").over(Window.orderBy("year"))).filter("to_year IS NOT NULL")  # one row per year
    own = Window.partitionBy(*key).orderBy("year")
    pairs = cells.select(F.col("year").alias("from_year"), F.lead("year").over(own).alias("_next"), F.col("value").alias("source_code"), F.lead("value").over(own).alias("target_code"))
    both = pairs.join(F.broadcast(periods), (F.col("from_year") == F.col("year")) & (F.col("_next") == F.col("to_year")))
    counts = both.groupBy("from_year", "to_year", "source_code", "target_code").agg(F.count(F.lit(1)).alias("pixel_count"))
    out = _named(counts.withColumn("area_ha", F.col("pixel_count") * cell_ha), classes)
    return out.select("from_year", "to_year", "source_code", "source", "target_code", "target", "pixel_count", "area_ha")


def combine_layers(stack: DataFrame, layers: list[str], cell_ha: float) -> DataFrame:
    """Count and area of every co-occurring tuple of classes of a stack (see ``cells.stack_layers``)."""
    return stack.groupBy(*layers).agg(F.count(F.lit(1)).alias("count")).withColumn("area_ha", F.col("count") * cell_ha)


def node_totals(transitions: DataFrame, classes: DataFrame) -> DataFrame:
    """Outgoing and incoming area of every class of the scheme, 0 if absent."""
    sides = F.explode(
        F.array(
            F.struct(F.col("source_code").alias("code"), F.col("area_ha").alias("outgoing_ha"), F.lit(0.0).alias("incoming_ha")),
            F.struct(F.col("target_code").alias("code"), F.lit(0.0).alias("outgoing_ha"), F.col("area_ha").alias("incoming_ha")),
        )
    )
    sums = transitions.select(sides.alias("s")).groupBy("s.code").agg(F.sum("s.outgoing_ha").alias("outgoing_ha"), F.sum("s.incoming_ha").alias("incoming_ha"))
    return classes.join(sums, "code", "left").fillna(0.0, ["outgoing_ha", "incoming_ha"])


def confusion(samples: DataFrame, by: list[str] = []) -> DataFrame:
    """``by, reference, prediction, n``; rows with a null or blank label are left out."""
    ok = F.col("reference").isNotNull() & F.col("prediction").isNotNull()
    text = lambda c: F.trim(F.col(c).cast("string"))
    rows = samples.filter(ok).select(*by, text("reference").alias("reference"), text("prediction").alias("prediction"))
    return rows.filter("reference <> '' AND prediction <> ''").groupBy(*by, "reference", "prediction").agg(F.count(F.lit(1)).alias("n"))


def confusion_wide(counts: DataFrame, labels: list[str]) -> DataFrame:
    """One row per reference label, one column per predicted label, 0 where nothing fell."""
    return counts.groupBy("reference").pivot("prediction", labels).agg(F.sum("n")).fillna(0)


def class_metrics(counts: DataFrame, by: list[str] = []) -> DataFrame:
    """Precision, recall, F1, IoU and support per label of reference or prediction; 0 / 0 is 0."""
    sides = F.explode(
        F.array(
            F.struct(F.col("reference").alias("label"), F.col("n").alias("ref"), F.lit(0).cast("long").alias("pred"), F.when(F.col("reference") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp")),
            F.struct(F.col("prediction").alias("label"), F.lit(0).cast("long").alias("ref"), F.col("n").alias("pred"), F.lit(0).cast("long").alias("tp")),
        )
    )
    t = counts.select(*by, sides.alias("s")).groupBy(*by, "s.label").agg(F.sum("s.ref").alias("support"), F.sum("s.pred").alias("predicted"), F.sum("s.tp").alias("tp"))
    div = lambda a, b: F.coalesce(a / F.nullif(b.cast("double"), F.lit(0.0)), F.lit(0.0))
    t = t.withColumn("precision", div(F.col("tp"), F.col("predicted"))).withColumn("recall", div(F.col("tp"), F.col("support")))
    t = t.withColumn("f1", div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    t = t.withColumn("iou", div(F.col("tp"), F.col("support") + F.col("predicted") - F.col("tp")))
    return t.select(*by, "label", "precision", "recall", "f1", "iou", "support", "tp")


def accuracy_report(counts: DataFrame, by: list[str] = []) -> DataFrame:
    """Overall accuracy, macro F1 and macro IoU over the union of labels."""
    m = class_metrics(counts, by)
    return m.groupBy(*by).agg(
        F.sum("support").alias("n"),
        (F.sum("tp") / F.nullif(F.sum("support").cast("double"), F.lit(0.0))).alias("overall_accuracy"),
        F.avg("f1").alias("macro_f1"),
        F.avg("iou").alias("macro_iou"),
    )


def _merit(base: str, ref: str, pred: str) -> list:
    hit = (F.col(ref) != F.col(base)) & (F.col(pred) != F.col(base)) & (F.col(ref) == F.col(pred))
    union = (F.col(ref) != F.col(base)) | (F.col(pred) != F.col(base))
    n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
    return [n(hit).alias("hits"), n(union).alias("changed"), F.when(n(union) == 0, 1.0).otherwise(n(hit) / n(union)).alias("figure_of_merit")]


def figure_of_merit(stack: DataFrame, by: list[str] = []) -> DataFrame:
    """Correct change over observed or predicted change, on cells that all layers have; 1 if nothing changed anywhere.

    ``stack`` has ``baseline, observed, predicted``; for seeds, ``observed`` and ``predicted`` of the main run and of
    the seed are joined on the same cells first, so a seed counts where both are valid.
    """
    return stack.groupBy(*by).agg(*_merit("baseline", "observed", "predicted"))


def backcast_report(stack: DataFrame, by: list[str]) -> DataFrame:
    """Figure of merit of each backcast beside the accuracy of the predicted layer against the observed one, on the same cells."""
    samples = stack.select(*by, F.col("observed").alias("reference"), F.col("predicted").alias("prediction"))
    return figure_of_merit(stack, by).join(accuracy_report(confusion(samples, by), by), by)


def seed_spread(per_seed: DataFrame) -> DataFrame:
    """Mean and, with two seeds or more, population deviation of the seeds' figures of merit."""
    n = F.count(F.lit(1))
    return per_seed.agg(n.alias("seeds"), F.avg("figure_of_merit").alias("mean_fom"), F.when(n >= 2, F.stddev_pop("figure_of_merit")).alias("std_fom"))


def layer_consistency(stack: DataFrame, a: str, b: str, tolerance: float) -> DataFrame:
    """Totals of two layers on common cells, relative difference, RMSE, largest difference and verdict."""
    d = F.col(a) - F.col(b)
    out = stack.agg(
        F.count(F.lit(1)).alias("common"), F.sum(a).alias("total_a"), F.sum(b).alias("total_b"),
        F.sqrt(F.avg(d * d)).alias("rmse"), F.max(F.abs(d)).alias("max_abs_difference"),
    )
    rel = F.abs(F.col("total_a") - F.col("total_b")) / F.greatest(F.abs(F.col("total_b")), F.lit(1e-12))
    return out.withColumn("relative_difference", rel).withColumn("passed", rel <= tolerance)
