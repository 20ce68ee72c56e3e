"""Permutation and bootstrap replicas from compressed tables: slices of values and how many rows they hold, never rows times replicas.

A value is cut into up to ``SLICES`` slices, and a slice stands for its rows by its mean. One aggregate gives the counts; after that the work no longer depends on the number of
rows. To deal n values anew to strata of fixed sizes is to draw, for each stratum, how many values of each slice it gets (multivariate hypergeometric), and to draw n rows with
replacement is one multinomial over the joint slices. With no more distinct values than slices this is the exact distribution; beyond, what the slices leave out is of the order of
1 / SLICES^2 of the variance. Replicas come in batches of fixed numbers and seeds, one task each, so results do not depend on the cluster, and a lost task repeats its own draws.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamgrid.operators.ranking import cuts_of, slice_of

#: Slices of a value: up to SLICES**2 joint counts of two values come to the driver.
SLICES = 128
#: Replicas that a task draws at once.
BATCH = 111
#: Strata that a task deals values to.
CHUNK = 128
#: From so many values on a hypergeometric number is drawn as the normal one of its mean and variance.
LARGE = 10**9


def hypergeometric(rng: np.random.Generator, good: np.ndarray, bad: np.ndarray, sample: np.ndarray) -> np.ndarray:
    """How many of ``sample`` values drawn without replacement are good; exact below ``LARGE`` values."""
    total = good + bad
    large = total >= LARGE
    if not large.any():
        return rng.hypergeometric(good, bad, sample)
    mean = sample * (good / total)
    spread = np.sqrt(np.maximum(mean * (bad / total) * ((total - sample) / np.maximum(total - 1, 1)), 0))
    near = np.clip(np.rint(mean + spread * rng.standard_normal(len(mean))).astype(np.int64), np.maximum(0, sample - bad), np.minimum(sample, good))
    few = ~large
    near[few] = rng.hypergeometric(good[few], bad[few], sample[few])
    return near


def deal(rng: np.random.Generator, pool: np.ndarray, size: int) -> np.ndarray:
    """Draw ``size`` values from each replica's pool (a row per replica, a column per slice): how many of each slice."""
    taken, left, rest = np.zeros_like(pool), np.full(len(pool), size), pool.sum(axis=1)
    for t in range(pool.shape[1]):
        rest = rest - pool[:, t]
        taken[:, t] = hypergeometric(rng, pool[:, t], rest, left)
        left = left - taken[:, t]
    return taken


def share_of_chunk(seed: list[int], pool: np.ndarray, totals: list[int], chunk: int) -> np.ndarray:
    """What of the pool falls to one chunk of strata: the chunks are halved again and again, and every task draws the same numbers on its way down."""
    low, high = 0, len(totals)
    while high - low > 1:
        mid = (low + high) // 2
        left = deal(np.random.default_rng([*seed, low, high]), pool, sum(totals[low:mid]))
        if chunk < mid:
            pool, high = left, mid
        else:
            pool, low = pool - left, mid
    return pool


def batches(spark: SparkSession, parts: int, replicas: int) -> DataFrame:
    """``part, batch``: a row and a partition per part and batch of replicas."""
    n = -(-replicas // BATCH)
    return spark.range(0, parts * n, 1, max(1, parts * n)).select(F.expr(f"id div {max(1, n)}").cast("int").alias("part"), (F.col("id") % max(1, n)).cast("int").alias("batch"))


class Joint:
    """Counts ``n`` of two values by the numbers ``s`` and ``t`` of their slices, in rising order of both values."""

    def __init__(self, s: list[int], t: list[int], n: list[int]):
        self.n = np.array(n, np.int64)
        self.s, self.t = (np.unique(np.array(x, np.int64), return_inverse=True)[1] for x in (s, t))
        self.counts_a, self.counts_b = (np.bincount(x, self.n).astype(np.int64) for x in (self.s, self.t))


def joints(rows: DataFrame, pairs: list[tuple[str, str]], slices: int = SLICES) -> list[Joint]:
    """The joint counts of each pair of columns, over rows that have both values; one job for all cuts and one for all counts."""
    fields = sorted({f for p in pairs for f in p})
    edges = cuts_of(rows.select(*[F.col(f).cast("double").alias(f) for f in fields]), fields, slices)
    at = {f: F.when(F.col(f).isNotNull(), slice_of(F.col(f).cast("double"), edges[f])) for f in fields}
    both = F.explode(F.array(*[F.struct(F.lit(i).alias("pair"), at[a].alias("s"), at[b].alias("t")) for i, (a, b) in enumerate(pairs)]))
    counts = rows.select(both.alias("x")).select("x.*").filter("s IS NOT NULL AND t IS NOT NULL").groupBy("pair", "s", "t").agg(F.count(F.lit(1)).alias("n"))
    held = sorted(counts.collect())  # slices**2 rows a pair at most
    return [Joint(*([r[c] for r in held if r["pair"] == i] for c in ("s", "t", "n"))) for i in range(len(pairs))]


def mid_ranks(counts: np.ndarray) -> np.ndarray:
    """The mean rank of each slice (and of each tied value), from counts by rising values in the last axis."""
    return counts.cumsum(axis=-1) - (counts - 1) / 2


def standardised(counts: np.ndarray) -> np.ndarray:
    """Mean ranks less their mean, with a sum of squares over the rows of one; NaN where all rows are tied."""
    off = mid_ranks(counts) - (counts.sum() + 1) / 2
    length = np.sqrt(counts @ (off * off))
    return off / length if length > 0 else np.full(len(counts), np.nan)


def permuted_correlations(spark: SparkSession, joint: list[Joint], replicas: int, seed: int) -> DataFrame:
    """``part, replica, r``: rank correlations of each pair with the second value dealt anew."""
    margins = [(j.counts_a, j.counts_b, standardised(j.counts_a), standardised(j.counts_b)) for j in joint]

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, batch in ((int(p), int(b)) for pdf in pdfs for p, b in zip(pdf["part"], pdf["batch"], strict=True)):
            counts_a, counts_b, a, b = margins[part]
            replica = np.arange(batch * BATCH, min((batch + 1) * BATCH, replicas))
            rng, pool, r = np.random.default_rng([seed, part, batch]), np.tile(counts_b, (len(replica), 1)), np.zeros(len(replica))
            for size, value in zip(counts_a.tolist(), a.tolist(), strict=True):
                taken = deal(rng, pool, size)
                pool -= taken
                r += value * (taken @ b)
            yield pd.DataFrame({"part": part, "replica": replica, "r": r})

    return batches(spark, len(joint), replicas).mapInPandas(run, "part int, replica long, r double")


def resampled_rhos(spark: SparkSession, joint: list[Joint], replicas: int, seed: int) -> DataFrame:
    """``part, replica, rho``: Spearman's rho of each pair over n rows drawn with replacement and ranked again; NaN where one value has no variance."""
    held = [(j.n, j.s, j.t, len(j.counts_a), len(j.counts_b)) for j in joint]

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, batch in ((int(p), int(b)) for pdf in pdfs for p, b in zip(pdf["part"], pdf["batch"], strict=True)):
            counts, s, t, n_s, n_t = held[part]
            n, by_t = int(counts.sum()), np.argsort(t, kind="stable")
            if not n:
                continue
            replica = np.arange(batch * BATCH, min((batch + 1) * BATCH, replicas))
            drawn = np.random.default_rng([seed, part, batch]).multinomial(n, counts / n, len(replica))
            a = np.add.reduceat(drawn, np.searchsorted(s, np.arange(n_s)), axis=1)
            b = np.add.reduceat(drawn[:, by_t], np.searchsorted(t[by_t], np.arange(n_t)), axis=1)
            ra, rb = mid_ranks(a) - (n + 1) / 2, mid_ranks(b) - (n + 1) / 2
            spread = np.sqrt((a * ra * ra).sum(axis=1) * (b * rb * rb).sum(axis=1))
            together = (drawn * ra[:, s] * rb[:, t]).sum(axis=1)
            yield pd.DataFrame({"part": part, "replica": replica, "rho": np.divide(together, spread, out=np.full(len(replica), np.nan), where=spread > 0)})

    return batches(spark, len(joint), replicas).mapInPandas(run, "part int, replica long, rho double")


def stratum_sums(cells: DataFrame, strata: list[Column], pool: np.ndarray, values: np.ndarray, replicas: int, seed: int) -> DataFrame:
    """``test, stratum, replica, n, s``: the sums over each stratum of values dealt anew to all rows, in the same replicas for every test.

    ``cells``: the finest strata, one row each, with their number of rows ``n``; ``strata``: the stratum of a cell in each test. ``pool``: how many values each slice holds; ``values``: their means.
    A task deals to a chunk of cells and adds up by stratum, so what is shuffled is strata times replicas.
    """
    chunks = max(1, -(-cells.count() // CHUNK))
    placed = cells.select(F.pmod(F.xxhash64(*strata), F.lit(chunks)).cast("int").alias("chunk"), "n", F.array(*strata).alias("strata"))
    found = {r["chunk"]: r["n"] for r in placed.groupBy("chunk").agg(F.sum("n").alias("n")).collect()}  # a row per CHUNK cells
    totals = [found.get(c, 0) for c in range(chunks)]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        chunk, batch = int(key[0]), int(key[1])
        pdf = pdf.sort_values("strata", key=lambda c: c.map(lambda x: "\x00".join(x)))
        replica = np.arange(batch * BATCH, min((batch + 1) * BATCH, replicas))
        own = share_of_chunk([seed, batch], np.tile(pool, (len(replica), 1)), totals, chunk)
        rng, sums, sizes = np.random.default_rng([seed, batch, chunk, 0, 0]), {}, {}
        for n, names in zip(pdf["n"].tolist(), pdf["strata"], strict=True):
            taken = deal(rng, own, n)
            own = own - taken
            got = taken @ values
            for k in enumerate(names):
                sums[k], sizes[k] = sums.get(k, 0) + got, sizes.get(k, 0) + n
        parts = [pd.DataFrame({"test": k[0], "stratum": k[1], "replica": replica, "n": sizes[k], "s": sums[k]}) for k in sums]
        return pd.concat(parts)

    dealt = placed.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(-(-replicas // BATCH) - 1))))
    dealt = dealt.groupBy("chunk", "batch").applyInPandas(run, "test int, stratum string, replica long, n long, s double")
    return dealt.groupBy("test", "stratum", "replica").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
