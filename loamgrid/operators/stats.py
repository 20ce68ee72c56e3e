"""Ranks, Spearman trade-offs, permutation and bootstrap tests, quantile bins and GeoDetector."""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamgrid.functions.scalars import centre_x, centre_y, finite, systematic
from loamgrid.operators.cells import stack_layers
from loamgrid.operators.ranking import cuts, cuts_of, ordinal, quantiles, slice_of, smallest_from
from loamgrid.operators.resampling import SLICES, Joint, joints, permuted_correlations, resampled_rhos, stratum_sums


def average_ranks(rows: DataFrame, value: str, out: str = "rank", edges: list[float] | None = None) -> DataFrame:
    """Add the average rank of ``value`` (ties share the mean rank; values count as tied if equal to 12 decimals). ``edges`` cut the values into slices; by default they are taken from them."""
    tied = rows.withColumn("_v", F.round(F.col(value).cast("double"), 12))
    counts = tied.groupBy("_v").agg(F.count(F.lit(1)).alias("_n")).filter("_v IS NOT NULL")
    return tied.join(_ranks_of_counts(counts, [], cuts(counts, "_v") if edges is None else edges, out), "_v", "left").drop("_v")


def _ranks_of_counts(counts: DataFrame, by: list[str], edges: list[float], out: str) -> DataFrame:
    """``by, _v, out``: the average rank of each value within ``by``, from ``by, _v, _n`` with one row per distinct value.

    A window runs inside each slice and a prefix over the sums of the slices, so no window sees a whole table or replica.
    """
    counts = counts.withColumn("_slice", slice_of(F.col("_v"), edges))
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    sums = counts.groupBy(*by, "_slice").agg(F.sum("_n").alias("_s")).withColumn("_base", F.coalesce(F.sum("_s").over(before), F.lit(0)))
    within = Window.partitionBy(*by, "_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.drop("_s") if by else F.broadcast(sums.drop("_s"))  # without groups at most RANK_SLICES rows
    counts = counts.join(sums, [*by, "_slice"])
    return counts.select(*by, "_v", (F.col("_base") + F.coalesce(F.sum("_n").over(within), F.lit(0)) + (F.col("_n") + 1) / 2).alias(out))


def spearman(units: DataFrame, fields: list[str]) -> DataFrame:
    """``field_a, field_b, rho, n, relation`` for every pair of fields, from one aggregate over the ranked table."""
    ranked, edges = units, cuts_of(_tied(units, fields), fields)
    for f in fields:
        ranked = average_ranks(ranked, f, f"_rank_{f}", edges[f])
    pairs = list(combinations(fields, 2))
    row = ranked.agg(F.count(F.lit(1)).alias("n"), F.array(*[F.struct(F.lit(a).alias("field_a"), F.lit(b).alias("field_b"), F.corr(f"_rank_{a}", f"_rank_{b}").alias("rho")) for a, b in pairs]).alias("p"))
    out = row.select("n", F.explode("p").alias("p")).select("p.field_a", "p.field_b", F.when(~F.isnan("p.rho"), F.col("p.rho")).alias("rho"), "n")
    relation = F.when(F.col("rho").isNull(), "undefined").when(F.col("rho") > 0, "synergy").when(F.col("rho") < 0, "tradeoff").otherwise("neutral")
    return out.withColumn("relation", relation)


def _with_p(spark: SparkSession, joint: list[Joint], observed: DataFrame, permutations: int, seed: int) -> DataFrame:
    """``observed`` (one row per ``part``, with ``n`` and ``observed``) and its two-sided ``p_value``; null under three units or without variance."""
    r = permuted_correlations(spark, joint, permutations, seed).select("part", F.abs("r").alias("r"))
    hits = r.join(F.broadcast(observed), "part").groupBy(*observed.columns).agg(F.count(F.when(F.col("r") >= F.col("observed") - 1e-12, 1)).alias("_extreme"))
    p = F.when((F.col("n") >= 3) & ~F.isnan("observed"), (F.col("_extreme") + 1) / (permutations + 1))
    return hits.withColumn("p_value", p).drop("_extreme")


def permutation_test(ranked: DataFrame, unit: str, a: str, b: str, permutations: int = 999, seed: int = 42) -> DataFrame:
    """``n, observed, p_value``: two-sided p of the correlation of two rank columns, (extreme + 1) / (permutations + 1).

    The replicas deal the slices of one column anew (``resampling``); up to ``SLICES`` different ranks they are exact permutations of the units, which ``unit`` names.
    """
    both = ranked.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    observed = both.agg(F.abs(F.corr(a, b)).alias("observed"), F.count(unit).alias("n")).withColumn("part", F.lit(0))
    return _with_p(ranked.sparkSession, joints(both, [(a, b)]), observed, permutations, seed).select("n", "observed", "p_value")


def permutation_tests(units: DataFrame, fields: list[str], permutations: int = 999, seed: int = 42) -> DataFrame:
    """``field_a, field_b, n, observed, p_value`` of Spearman's rho for every pair of fields."""
    pairs = list(combinations(fields, 2))
    number = F.create_map(*[F.lit(x) for i, (a, b) in enumerate(pairs) for x in (f"{a}|{b}", i)])
    observed = spearman(units, fields).select(F.element_at(number, F.concat_ws("|", "field_a", "field_b")).alias("part"), "field_a", "field_b", "n", F.coalesce(F.abs("rho"), F.lit(float("nan"))).alias("observed"))
    return _with_p(units.sparkSession, joints(_tied(units, fields), pairs), observed, permutations, seed).drop("part")


def _tied(units: DataFrame, fields: list[str]) -> DataFrame:
    """The fields as ranking sees them: equal if equal to 12 decimals."""
    return units.select(*[F.round(F.col(f).cast("double"), 12).alias(f) for f in fields])


def bootstrap_intervals(units: DataFrame, fields: list[str], resamples: int = 999, seed: int = 42, level: float = 0.95) -> DataFrame:
    """``field_a, field_b, resamples, low, high``: percentile interval of Spearman's rho of every pair over resamples with replacement, re-ranked each; bounds at index int(q * (m - 1)).

    Units with a null in either field are left out. A resample is one multinomial over the joint slices (``resampling``).
    """
    pairs = list(combinations(fields, 2))
    rho = resampled_rhos(units.sparkSession, joints(_tied(units, fields), pairs), resamples, seed).filter("NOT isnan(rho)")
    s = rho.groupBy("part").agg(F.array_sort(F.collect_list("rho")).alias("s"))  # one number per resample
    at = lambda q: F.get("s", F.floor(F.lit(q) * (F.size("s") - 1)).cast("int"))
    name = lambda k: F.get(F.array(*[F.lit(p[k]) for p in pairs]), F.col("part"))
    return s.select(name(0).alias("field_a"), name(1).alias("field_b"), F.size("s").alias("resamples"), at((1 - level) / 2).alias("low"), at((1 + level) / 2).alias("high"))


def bootstrap_interval(units: DataFrame, unit: str, a: str, b: str, resamples: int = 999, seed: int = 42, level: float = 0.95) -> DataFrame:
    """``resamples, low, high`` of one pair; ``unit`` names the rows that are drawn."""
    return bootstrap_intervals(units.filter(F.col(unit).isNotNull()), [a, b], resamples, seed, level).select("resamples", "low", "high")


def benjamini_hochberg(tests: DataFrame, p: str = "p_value", by: list[str] = []) -> DataFrame:
    """Adjusted p: the running minimum from the largest p of p * m / rank; tests without a p have none."""
    some = tests.filter(F.col(p).isNotNull())
    m = some.groupBy(*by).agg(F.count(F.lit(1)).alias("_m"))
    m = m.select(*[F.col(c).alias(f"_of_{c}") for c in by], "_m")
    ranked = ordinal(some, by, p, [c for c in tests.columns if c != p], "_k")
    on = F.lit(True)
    for c in by:
        on = on & ranked[c].eqNullSafe(m[f"_of_{c}"])
    ranked = ranked.join(m if by else F.broadcast(m), on).select(*tests.columns, "_k", (F.col(p) * F.col("_m") / F.col("_k")).alias("_q"))
    out = smallest_from(ranked, by, "_k", "_q", "_least").withColumn("adjusted", F.least(F.lit(1.0), F.col("_least"))).select(*tests.columns, "adjusted")
    return out.unionByName(tests.filter(F.col(p).isNull()), allowMissingColumns=True)


def quantile_edges(rows: DataFrame, value: str, bins: int) -> list[float] | None:
    """Unique linear quantiles, or None if there are no more than ``bins`` distinct values."""
    if rows.select(value).distinct().limit(bins + 1).count() <= bins:
        return None
    return sorted(set(quantiles(rows, value, [i / bins for i in range(bins + 1)])))


def bin_label(value: Column, edges: list[float] | None) -> Column:
    """``Q{i}`` with i the number of edges up to the value, at most the last bin; without edges the value's text."""
    if edges is None:
        return value.cast("string")
    n = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= value))
    return F.concat(F.lit("Q"), F.least(F.lit(len(edges) - 1), n).cast("string"))


def _q(rows: DataFrame, by: list[str], target: str) -> DataFrame:
    """1 - sum N_h var_h / (N var), clamped to [0, 1], for rows ``by, stratum, target``."""
    h = rows.groupBy(*by, "stratum").agg(
        F.count(F.lit(1)).alias("n"), F.var_pop(target).alias("v"), F.sum(target).alias("s"), F.sum(F.col(target) * F.col(target)).alias("ss")
    )
    total = F.sum("ss") - F.sum("s") * F.sum("s") / F.sum("n")
    q = 1 - F.sum(F.col("n") * F.col("v")) / F.nullif(total, F.lit(0.0))
    return h.groupBy(*by).agg(F.greatest(F.lit(0.0), F.least(F.lit(1.0), q)).alias("q"), F.count(F.lit(1)).alias("strata"), F.sum("n").alias("n"))


def factor_detector(samples: DataFrame, target: str, factors: list[str]) -> DataFrame:
    """``factor, q, strata, n``. A target without variance gives a null q; blank strata are an error."""
    blank = samples.filter(" OR ".join(f"`{f}` IS NULL OR trim(`{f}`) = ''" for f in factors)).limit(1).collect()
    if blank:
        raise ValueError("blank stratum")
    long = samples.select(F.col(target).cast("double").alias(target), F.explode(F.array(*[F.struct(F.lit(f).alias("factor"), F.col(f).alias("stratum")) for f in factors])).alias("x"))
    return _q(long.select(target, "x.factor", "x.stratum"), ["factor"], target)


def interaction_detector(samples: DataFrame, target: str, factors: list[str]) -> DataFrame:
    """q of the joint strata of every pair of factors and its class against the single q's."""
    pairs = list(combinations(factors, 2))
    joint = F.explode(F.array(*[F.struct(F.lit(a).alias("factor_a"), F.lit(b).alias("factor_b"), F.concat_ws("|", F.col(a), F.col(b)).alias("stratum")) for a, b in pairs]))
    long = samples.select(F.col(target).cast("double").alias(target), joint.alias("x")).select(target, "x.*")
    qs = _q(long, ["factor_a", "factor_b"], target).withColumnRenamed("q", "q_joint")
    single = factor_detector(samples, target, factors)
    one = lambda s: single.select(F.col("factor").alias(f"factor_{s}"), F.col("q").alias(f"q_{s}"))
    out = qs.join(one("a"), "factor_a").join(one("b"), "factor_b")
    kind = interaction_kind(F.col("q_joint"), F.col("q_a"), F.col("q_b"))
    return out.select("factor_a", "factor_b", "q_a", "q_b", "q_joint", kind.alias("interaction"))


def interaction_kind(q: Column, q_a: Column, q_b: Column) -> Column:
    """The class of the q of joint strata against the q's of the two factors."""
    total = q_a + q_b
    return F.when(q <= F.greatest(q_a, q_b), "weaken_or_non_enhance").when(F.abs(q - total) <= 1e-9, "independent").when(q < total, "bi_factor_enhancement").otherwise("nonlinear_enhancement")


def factor_tests(samples: DataFrame, target: str, factors: list[str], permutations: int = 999, seed: int = 42, slices: int = SLICES) -> DataFrame:
    """``analysis, factor_a, factor_b, q, p_value, interaction`` of every factor and every pair's joint strata.

    p is one-sided: (replicas with q* >= q, + 1) / (permutations + 1), null without permutations. All tests share the replicas, which deal the target's slices anew to the joint strata
    of all factors; q* is taken of the target as its slices show it, q of the target itself. Blank strata and a target without variance are errors; rows without a target are left out.
    """
    if not factors or len(set(factors)) < len(factors):
        raise ValueError("one or more distinct factors")
    rows = samples.select(F.col(target).cast("double").alias("_t"), *factors).filter("_t IS NOT NULL")
    if rows.filter(" OR ".join(f"`{f}` IS NULL OR trim(`{f}`) = ''" for f in factors)).limit(1).count():
        raise ValueError("blank stratum")
    grouped = rows.groupBy(*factors, slice_of(F.col("_t"), cuts(rows, "_t", slices)).alias("_slice"))
    grouped = grouped.agg(F.count(F.lit(1)).alias("n"), F.sum("_t").alias("s"), F.sum(F.col("_t") * F.col("_t")).alias("ss")).persist()  # joint strata times slices, read four times
    try:
        held = sorted(grouped.groupBy("_slice").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")]).collect())  # at most ``slices`` rows
        n, total, squares = (sum(r[c] for r in held) for c in ("n", "s", "ss"))
        if not n or squares - total * total / n <= 1e-12 * squares:
            raise ValueError("the target has no variance")
        pool, sums = np.array([r["n"] for r in held], np.int64), np.array([r["s"] for r in held])
        means = sums / pool - total / n
        tests = [(f, None) for f in factors] + list(combinations(factors, 2))
        strata = [F.col(a).cast("string") if b is None else F.concat_ws("|", a, b) for a, b in tests]
        cells = grouped.groupBy(*factors).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        one = cells.select("n", "s", F.posexplode(F.array(*strata)).alias("test", "stratum")).groupBy("test", "stratum").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        clamp = lambda q: F.greatest(F.lit(0.0), F.least(F.lit(1.0), q))
        between = lambda mean: F.sum((F.col("s") / F.col("n") - mean) * (F.col("s") / F.col("n") - mean) * F.col("n"))
        q = one.groupBy("test").agg(clamp(between(total / n) / (squares - total * total / n)).alias("q"))
        hits = q.withColumn("extreme", F.lit(None).cast("long"))
        if permutations:
            dealt = stratum_sums(cells, strata, pool, means, permutations, seed)
            star = dealt.groupBy("test", "replica").agg(clamp(between(0.0) / F.lit(float(pool @ (means * means)))).alias("star"))
            hits = star.join(F.broadcast(q), "test").groupBy("test", "q").agg(F.count(F.when(F.col("star") >= F.col("q") - 1e-12, 1)).alias("extreme"))  # a row per test
        found = {r["test"]: r for r in hits.collect()}  # a row per test
    finally:
        grouped.unpersist()
    single = {f: found[i]["q"] for i, f in enumerate(factors)}
    out = [(a, b, found[i]["q"], None if found[i]["extreme"] is None else (found[i]["extreme"] + 1) / (permutations + 1), single[a], single.get(b)) for i, (a, b) in enumerate(tests)]
    out = samples.sparkSession.createDataFrame(out, "factor_a string, factor_b string, q double, p_value double, q_a double, q_b double")
    pair = F.col("factor_b").isNotNull()
    kind = F.when(pair, interaction_kind(F.col("q"), F.col("q_a"), F.col("q_b")))
    return out.select(F.when(pair, "interaction").otherwise("factor").alias("analysis"), "factor_a", "factor_b", "q", "p_value", kind.alias("interaction"))


def build_samples(target: DataFrame, factors: dict[str, DataFrame], step: int, grid: dict[str, float], bins: int) -> DataFrame:
    """Systematic cells with the target, centre coordinates, ``r{row}_c{col}`` ids and binned factors; NoData in any layer drops a cell."""
    layers = {"target": target} | factors
    clean = {k: v.filter(finite(F.col("value")) & systematic(step)) for k, v in layers.items()}
    s = stack_layers(clean)
    held = s.persist()  # two jobs a factor
    edges = {f: quantile_edges(held, f, bins) for f in factors}
    held.unpersist()
    out = s.select(
        F.format_string("r%d_c%d", F.col("row").cast("long"), F.col("col").cast("long")).alias("sample_id"), centre_x(F.col("col"), F.col("row"), grid).alias("x"), centre_y(F.col("col"), F.col("row"), grid).alias("y"),
        "target", *[bin_label(F.col(f), edges[f]).alias(f) for f in factors],
    )
    if out.limit(2).count() < 2:
        raise ValueError("fewer than two samples")
    return out
