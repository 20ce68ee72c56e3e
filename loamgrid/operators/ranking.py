"""Global ranks, quantiles and running minima by slices: sums per slice of the value, a prefix over the slices, a window inside each."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Slices of a ranking of distinct values.
RANK_SLICES = 200
#: Rows of a slice of an order, sampled rows per slice, and the most slices: beyond SLICE_ROWS * MOST_SLICES rows the slices grow.
SLICE_ROWS, SAMPLE_ROWS, MOST_SLICES = 50_000, 20, 2_000


def cuts_of(rows: DataFrame, values: list[str], slices: int = RANK_SLICES) -> dict[str, list[float]]:
    """Per value at most ``slices`` numbers that cut it into slices of about equal size, from one aggregate."""
    grid = [i / slices for i in range(1, slices)]
    found = rows.agg(*[F.percentile_approx(v, grid, 10_000).alias(v) for v in values]).first()
    return {v: sorted(set(found[v] or [])) for v in values}


def cuts(rows: DataFrame, value: str, slices: int = RANK_SLICES) -> list[float]:
    return cuts_of(rows, [value], slices)[value]


def slice_of(value: Column, at: list[float]) -> Column:
    """Number of the slice: how many cuts lie at or below the value."""
    return F.size(F.filter(F.array(*map(F.lit, at)), lambda c: c <= value)) if at else F.lit(0)


def counted_before(counts: DataFrame, by: list[str], value: str, amount: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over the rows of ``by`` with a smaller ``value``. One row per ``by`` and value."""
    sliced = counts.withColumn("_slice", slice_of(F.col(value), cuts(counts, value)))
    before = Window.partitionBy(*by, F.lit(0)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    sums = sliced.groupBy(*by, "_slice").agg(F.sum(amount).alias("_s")).withColumn("_base", F.coalesce(F.sum("_s").over(before), F.lit(0)))
    sums = sums.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_slice").alias("_at"), "_base")
    on = sliced["_slice"] == sums["_at"]
    for c in by:
        on = on & sliced[c].eqNullSafe(sums[f"_by_{c}"])
    within = Window.partitionBy(*by, "_slice").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    joined = sliced.join(sums if by else F.broadcast(sums), on)  # without groups RANK_SLICES rows at most
    return joined.select(*counts.columns, (F.col("_base") + F.coalesce(F.sum(amount).over(within), F.lit(0))).alias(out))


def quantiles(rows: DataFrame, value: str, probabilities: list[float]) -> list[float] | None:
    """Exact quantiles with linear interpolation, read off the counts of the distinct values; None without values."""
    counts = rows.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n")).persist()  # read three times
    try:
        return _at_places(counts, counts.agg(F.sum("_n")).first()[0], probabilities)
    finally:
        counts.unpersist()


def _at_places(counts: DataFrame, n: int | None, probabilities: list[float]) -> list[float] | None:
    if not n:
        return None
    places = [p * (n - 1) for p in probabilities]
    needed = sorted({int(f(x)) for x in places for f in (math.floor, math.ceil)})
    ranked = counted_before(counts, [], "_v", "_n", "_below")
    holds = F.exists(F.array(*[F.lit(i) for i in needed]), lambda i: (F.col("_below") <= i) & (i < F.col("_below") + F.col("_n")))
    found = ranked.filter(holds).collect()  # two rows per probability at most
    at = {i: r["_v"] for r in found for i in needed if r["_below"] <= i < r["_below"] + r["_n"]}
    return [at[math.floor(x)] + (at[math.ceil(x)] - at[math.floor(x)]) * (x - math.floor(x)) for x in places]


def medians(counts: DataFrame, by: list[str], out: str) -> DataFrame:
    """``by, out``: the median of every group from ``by, _v, _n``, one row per group and value."""
    total = counts.groupBy(*by).agg(F.sum("_n").alias("_total"))
    total = total.select(*[F.col(c).alias(f"_of_{c}") for c in by], "_total")
    ranked = counted_before(counts, by, "_v", "_n", "_below")
    on = F.lit(True)
    for c in by:
        on = on & ranked[c].eqNullSafe(total[f"_of_{c}"])
    j = ranked.join(total if by else F.broadcast(total), on)
    holds = lambda i: F.when((F.col("_below") <= i) & (i < F.col("_below") + F.col("_n")), F.col("_v"))
    low, high = F.expr("(_total - 1) div 2"), F.expr("_total div 2")
    return j.groupBy(*by).agg(((F.max(holds(low)) + F.max(holds(high))) / 2).alias(out))


def order_cuts(rows: DataFrame, keys: list[str], n: int) -> list[tuple]:
    """Keys of sampled rows that cut the order by all ``keys`` into slices of about ``SLICE_ROWS`` of the ``n`` rows: of one value too, where later keys tell its rows apart."""
    slices = min(MOST_SLICES, -(-n // SLICE_ROWS))
    if slices < 2:
        return []
    share = min(1.0, SAMPLE_ROWS * slices / n)
    order = Window.orderBy(*keys)  # of the sample: about SAMPLE_ROWS * MOST_SLICES rows at most
    sample = rows.select(*keys).sample(share, seed=5)
    placed = sample.withColumn("_p", F.ntile(slices).over(order)).groupBy("_p").agg(F.min(F.struct(*keys)).alias("_cut"))
    return sorted({(r["_p"], tuple(r["_cut"])) for r in placed.collect() if r["_p"] > 1})


def slice_by(rows: DataFrame, keys: list[str], at: list[tuple]) -> Column:
    """Number of the slice of each row, among cuts in the order of ``keys``: first over every 32nd cut, then over the 32 after it."""
    kinds = [rows.schema[k].dataType for k in keys]
    literal = lambda cut: F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(cut, kinds, strict=True))])
    cut_list = F.array(*[literal(c) for _, c in at])
    own = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    coarse = F.size(F.filter(F.array(*[literal(c) for _, c in at[::32]]), lambda c: c <= own))
    near = F.slice(cut_list, F.greatest(coarse - 1, F.lit(0)) * 32 + 1, 32)
    return F.greatest(coarse - 1, F.lit(0)) * 32 + F.size(F.filter(near, lambda c: c <= own))


def ordinal(rows: DataFrame, by: list[str], value: str, ties: list[str], out: str, descending: bool = False) -> DataFrame:
    """Add ``out``: the place from 1 of every row within ``by``, by value, then ``ties``.

    Slices follow the size and cut through equal values too, so ties of a value are dealt over as many tasks as other rows; only rows alike in all of ``ties`` stay together.
    """
    key = -F.col(value) if descending else F.col(value)
    keyed = rows.withColumn("_sort", key)
    at = order_cuts(keyed, ["_sort", *ties], rows.count())
    if not at:  # one slice
        return keyed.withColumn(out, F.row_number().over(Window.partitionBy(*by, F.lit(0)).orderBy("_sort", *ties)).cast("long")).drop("_sort")
    sliced = keyed.withColumn("_slice", slice_by(keyed, ["_sort", *ties], at))
    before = Window.partitionBy(*by, F.lit(0)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sliced.groupBy(*by, "_slice").agg(F.count(F.lit(1)).alias("_s")).withColumn("_base", F.coalesce(F.sum("_s").over(before), F.lit(0)))
    sums = sums.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_slice").alias("_at"), "_base")
    on = sliced["_slice"] == sums["_at"]
    for c in by:
        on = on & sliced[c].eqNullSafe(sums[f"_by_{c}"])
    within = F.row_number().over(Window.partitionBy(*by, "_slice").orderBy("_sort", *ties))
    return sliced.join(sums if by else F.broadcast(sums), on).select(*rows.columns, (F.col("_base") + within).alias(out))  # without groups a row per slice


def smallest_from(rows: DataFrame, by: list[str], place: str, value: str, out: str) -> DataFrame:
    """Add ``out``: the smallest ``value`` of the row and of all rows of ``by`` with a larger ``place``."""
    sliced = rows.withColumn("_slice", slice_of(F.col(place), cuts(rows, place)))
    after = Window.partitionBy(*by, F.lit(0)).orderBy("_slice").rowsBetween(1, Window.unboundedFollowing)
    least = sliced.groupBy(*by, "_slice").agg(F.min(value).alias("_s")).withColumn("_later", F.min("_s").over(after))
    least = least.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_slice").alias("_at"), "_later")
    on = sliced["_slice"] == least["_at"]
    for c in by:
        on = on & sliced[c].eqNullSafe(least[f"_by_{c}"])
    within = F.min(value).over(Window.partitionBy(*by, "_slice").orderBy(F.col(place).desc()))
    return sliced.join(least, on).select(*rows.columns, F.least(within, "_later").alias(out))
