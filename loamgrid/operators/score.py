"""Min-max scores, AHP weights, weight sensitivity, scenario comparison and calibration."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamgrid.functions.scalars import finite
from loamgrid.operators.ranking import ordinal

#: Fixed random-index table of the consistency ratio, for orders 1 to 10.
RANDOM_INDEX = [0.0, 0.0, 0.58, 0.9, 1.12, 1.24, 1.32, 1.41, 1.45, 1.49]


def criterion_bounds(units: DataFrame, fields: list[str]) -> dict[str, tuple[float, float]]:
    """Minimum and maximum of every criterion from one aggregate (one row); values that are null or not finite are an error with their counts."""
    bad = lambda f: F.count(F.when(~F.coalesce(finite(F.col(f)), F.lit(False)), 1))
    row = units.agg(F.count(F.lit(1)).alias("rows"), *[x.alias(f"{k}_{f}") for f in fields for k, x in (("lo", F.min(f)), ("hi", F.max(f)), ("bad", bad(f)))]).first()
    if not row["rows"]:
        raise ValueError("criteria table has no rows")
    wrong = {f: row[f"bad_{f}"] for f in fields if row[f"bad_{f}"]}
    if wrong:
        raise ValueError(f"criteria with values that are no finite numbers: {wrong}")
    return {f: (float(row[f"lo_{f}"]), float(row[f"hi_{f}"])) for f in fields}


def normalised(value: Column, low: float, high: float, direction: str) -> Column:
    """Benefit (v - lo) / (hi - lo), cost (hi - v) / (hi - lo), not yet clipped; a constant criterion is 0.5."""
    if math.isclose(low, high):
        return F.lit(0.5)
    if direction not in ("benefit", "cost"):
        raise ValueError(f"direction {direction}")
    return (value - low) / (high - low) if direction == "benefit" else (high - value) / (high - low)


def score_units(units: DataFrame, criteria: list[dict], bounds: dict | None = None, fixed: bool = False) -> DataFrame:
    """Add ``value_<field>``, ``norm_<field>`` and ``clipped_<field>`` (out of fixed bounds) for every criterion, ``clipped`` (how many were) and ``score``.

    ``criteria``: field, direction, weight. Weights are normalised to sum 1. ``bounds``: fixed ones by field, finite and in order; other fields take those of the units, but where the reference is ``fixed`` every field needs bounds.
    """
    fields = [c["field"] for c in criteria]
    lacking = [f for f in fields if f not in (bounds or {})]
    if fixed and lacking:
        raise ValueError(f"a fixed reference needs bounds of {lacking}")
    total = float(sum(c["weight"] for c in criteria))
    if any(not math.isfinite(c["weight"]) or c["weight"] < 0 for c in criteria) or total <= 0:
        raise ValueError("weights must be finite, not negative and not all zero")
    for f, (low, high) in (bounds or {}).items():
        if not (math.isfinite(low) and math.isfinite(high) and low < high):
            raise ValueError(f"bounds of {f} must be finite and in order")
    limits = criterion_bounds(units, fields) | {f: (float(a), float(b)) for f, (a, b) in (bounds or {}).items()}
    out, clipped, score = units, F.lit(0), F.lit(0.0)
    for c in criteria:
        f = c["field"]
        raw = normalised(F.col(f), *limits[f], c.get("direction", "benefit"))
        clip = F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw))
        out = out.withColumn(f"value_{f}", F.col(f).cast("double")).withColumn(f"norm_{f}", clip).withColumn(f"clipped_{f}", raw != clip)
        clipped = clipped + F.col(f"clipped_{f}").cast("int")
        score = score + F.col(f"norm_{f}") * (c["weight"] / total)
    return out.withColumn("clipped", clipped).withColumn("score", score)


def score_by_ahp(units: DataFrame, criteria: list[dict], entries: DataFrame, panel, threshold: float = 0.1) -> DataFrame:
    """``score_units`` with the weights of one panel's judgement matrix (criterion i is row i); a faulty or inconsistent matrix is an error."""
    own = entries.filter(F.col("panel_id") == panel)
    problems = [r["problem"] for r in ahp_problems(own).limit(10).collect()]
    rows = [] if problems else ahp_weights(own, threshold).orderBy("i").collect()  # one row per criterion, ten at most
    if problems or len(rows) != len(criteria):
        raise ValueError(f"judgement matrix: {problems or 'not as many rows as criteria'}")
    if not rows[0]["consistent"]:
        raise ValueError(f"consistency ratio {rows[0]['cr']:.4f} exceeds {threshold}")
    return score_units(units, [c | {"weight": r["weight"]} for c, r in zip(criteria, rows, strict=True)])


def ahp_problems(entries: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """``panel_id, problem`` of matrices ``panel_id, i, j, v`` that are not square, positive, reciprocal or have no unit diagonal."""
    n = entries.groupBy("panel_id").agg((F.max(F.greatest("i", "j")) + 1).alias("n"), F.count(F.lit(1)).alias("cells"))
    shape = n.filter((F.col("cells") != F.col("n") * F.col("n")) | (F.col("n") > len(RANDOM_INDEX))).select("panel_id", F.lit("shape").alias("problem"))
    other = entries.select("panel_id", F.col("i").alias("j"), F.col("j").alias("i"), F.col("v").alias("t"))
    both = entries.join(other, ["panel_id", "i", "j"])
    bad = F.when(F.col("v") <= 0, "positive").when((F.col("i") == F.col("j")) & (F.abs(F.col("v") - 1) > tolerance), "diagonal")
    bad = bad.when(F.abs(F.col("v") * F.col("t") - 1) > tolerance, "reciprocal")
    return shape.unionByName(both.withColumn("problem", bad).filter("problem IS NOT NULL").select("panel_id", "problem").distinct())


def ahp_weights(entries: DataFrame, threshold: float = 0.1) -> DataFrame:
    """``panel_id, i, weight, lambda_max, ci, cr, consistent`` for every matrix, by power iteration within its group."""

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["i"].max()) + 1
        a = np.zeros((n, n))
        a[pdf["i"], pdf["j"]] = pdf["v"]
        w = np.full(n, 1 / n)
        for _ in range(1000):
            step = a @ w
            step /= step.sum()
            done = np.abs(step - w).max() < 1e-12
            w = step
            if done:
                break
        lam = float(np.mean(a @ w / w))
        ci = (lam - n) / (n - 1) if n > 2 else 0.0
        ri = RANDOM_INDEX[n - 1]
        cr = ci / ri if ri else 0.0
        return pd.DataFrame({"panel_id": pdf["panel_id"].iloc[0], "i": range(n), "weight": w, "lambda_max": lam, "ci": ci, "cr": cr, "consistent": cr <= threshold})

    kind = entries.schema["panel_id"].dataType.simpleString()
    return entries.groupBy("panel_id").applyInPandas(solve, f"panel_id {kind}, i int, weight double, lambda_max double, ci double, cr double, consistent boolean")


def ordinal_ranks(scores: DataFrame, by: list[str] = ["variant"]) -> DataFrame:
    """Add ``rank`` within ``by``: score from the top, then unit; by slices, so no variant is ranked in one task."""
    return ordinal(scores, by, "score", ["unit_id"], "rank", descending=True)


def weight_sensitivity(scored: DataFrame, criteria: list[dict], delta: float) -> DataFrame:
    """Per criterion and sign: mean and largest score change, units whose rank changes and the largest shift.

    ``scored`` comes from ``score_units``, with ``unit_id``. Two variants per criterion are laid over all units.
    """
    weights = [c["weight"] for c in criteria]
    variants = []
    for i, c in enumerate(criteria):
        for sign in (-1, 1):
            w = [x * (1 + sign * delta) if k == i else x for k, x in enumerate(weights)]
            variants.append((c["field"], sign, [x / sum(w) for x in w]))
    base = scored.withColumn("base_score", _weighted(criteria, F.array(*[F.lit(w / sum(weights)) for w in weights])))
    base = ordinal(base, [], "base_score", ["unit_id"], "base_rank", descending=True)
    table = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.lit(s).alias("sign"), F.array(*map(F.lit, w)).alias("w")) for f, s, w in variants]))
    rows = base.withColumn("v", table).select("unit_id", "base_score", "base_rank", F.col("v.field").alias("field"), F.col("v.sign").alias("sign"), _weighted(criteria, F.col("v.w")).alias("score"))
    j = ordinal_ranks(rows, ["field", "sign"])
    change, shift = F.abs(F.col("score") - F.col("base_score")), F.abs(F.col("rank") - F.col("base_rank"))
    return j.groupBy("field", "sign").agg(
        F.avg(change).alias("mean_change"), F.max(change).alias("max_change"), F.sum(F.when(shift > 0, 1).otherwise(0)).alias("rank_changes"), F.max(shift).alias("max_shift")
    )


def _weighted(criteria: list[dict], weights: Column) -> Column:
    """The sum of the normalised criteria by an array of weights."""
    out = F.lit(0.0)
    for i, c in enumerate(criteria):
        out = out + F.col(f"norm_{c['field']}") * weights[i]
    return out


def pair_with_reference(scores: DataFrame, reference: str) -> DataFrame:
    """Scores joined to the reference scenario's by unit; blank or repeated ids in a scenario are an error."""
    blank = F.col("unit_id").isNull() | (F.trim("unit_id") == "")
    bad = scores.filter(blank).select("scenario", "unit_id").unionByName(scores.groupBy("scenario", "unit_id").count().filter("count > 1").select("scenario", "unit_id")).limit(10).collect()
    if bad:
        raise ValueError(f"blank or repeated unit ids: {[tuple(r) for r in bad]}")
    ref = scores.filter(F.col("scenario") == reference).select("unit_id", F.col("score").alias("reference_score"))
    return scores.join(ref, "unit_id", "left")


def compare_scenarios(scores: DataFrame, reference: str) -> DataFrame:
    """Per scenario: units, mean, difference of means and paired mean difference to the reference, paired and unpaired counts."""
    pairs = pair_with_reference(scores, reference)
    d = F.col("score") - F.col("reference_score")
    out = pairs.groupBy("scenario").agg(
        F.count(F.lit(1)).alias("units"), F.avg("score").alias("mean"), F.avg(d).alias("paired_mean_delta"),
        F.count("reference_score").alias("paired"), F.sum(F.when(F.col("reference_score").isNull(), 1).otherwise(0)).alias("unpaired"),
    )
    ref = out.filter(F.col("scenario") == reference).select(F.col("mean").alias("_mean"))  # one row
    return out.join(F.broadcast(ref), F.lit(True), "left").withColumn("delta", F.col("mean") - F.col("_mean")).drop("_mean")


def calibrate(candidates: DataFrame, observed: float, by: list[str] = []) -> DataFrame:
    """Absolute error of every candidate; the smallest (first row on ties) is ``selected``. ``candidates``: line, modeled."""
    out = candidates.withColumn("abs_error", F.abs(F.col("modeled") - observed))
    best = out.groupBy(*by).agg(F.min(F.struct("abs_error", "line")).alias("_b"))
    out = out.join(best, by, "left") if by else out.join(F.broadcast(best), F.lit(True))  # without groups one row
    return out.withColumn("selected", (F.col("abs_error") == F.col("_b.abs_error")) & (F.col("line") == F.col("_b.line"))).drop("_b")
