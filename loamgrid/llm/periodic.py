"""Periodic runs of words: stretches that repeat a few words over and over.

A run is a maximal stretch of words with smallest period q (words q apart are identical) of at least ``max(least, times * q)`` words. The search is an
online sparse diagonal DP. A diagonal is a lag; its match length counts the words up to now that equal the word one lag earlier. Each word increments the
lags that are active, and a lag whose word differs ends there and emits its run at once if the diagonal is long enough.

A word has many earlier occurrences, so only those that can belong to a run open a lag: where the g words that end here stood before, at a lag d of g/3 to g/2, for g growing
by half from 2 on. A run of smallest period q has some g of 2q to 3q words that match at lag q, and by the periodicity lemma these g words cannot have
stood nearer than q, so the latest earlier occurrence of the g words is the only one to look at, a lag opens with match length g exactly, and its lag is
the smallest period. No run is lost; a text of n words takes n log n time, also if it is one word over and over. The names of g words follow exactly from those of fewer
(a pair of overlapping names is sorted and numbered), and a place whose words stood nowhere else in the text leaves the search.

Null text and text without words have no runs and an empty collapsed text. Repeated rows give repeated results, rows of equal or null id stand for
themselves, an empty table gives an empty result, a text is searched whole whatever its length, other columns, whatever their names, are ignored.
Runs come by start, then period.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamgrid.llm.common import WS, fresh, map_texts, read_documents

#: A run has at least LEAST words and TIMES periods.
LEAST, TIMES = 6, 4
#: Texts are searched together up to so many words; a longer text goes alone.
TOGETHER = 200_000


def openings(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """``(place, lag, g)``, by place: the g words that end at the place stood before, for the last time one lag earlier.

    ``codes``: words as numbers, of several texts in a row whose numbers differ.
    """
    n, found = len(codes), []
    if not n:
        return found
    names = np.where(np.bincount(codes)[codes] > 1, codes, -1)
    g = 1
    while True:
        shift = max(1, g // 2)
        g += shift
        at = np.flatnonzero(names[shift:] >= 0) + shift
        at = at[names[at - shift] >= 0]
        key = names[at] * (int(names.max()) + 1) + names[at - shift]
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        same = key[1:] == key[:-1]
        if not same.any():
            break
        lag = at[1:] - at[:-1]
        hit = np.flatnonzero(same & (3 * lag >= g) & (2 * lag <= g))
        found.append(np.stack((at[1:][hit], lag[hit], np.full(len(hit), g))))
        alive = np.concatenate((same, [False])) | np.concatenate(([False], same))
        names = np.full(n, -1)
        names[at[alive]] = np.cumsum(np.concatenate(([True], ~same)))[alive]
    if not found:
        return []
    place, lag, g = np.concatenate(found, axis=1)
    order = np.lexsort((lag, place))
    place, lag, g = place[order], lag[order], g[order]
    by_lag = np.lexsort((place, lag))  # where a lag goes on from the place before, it is open already
    goes_on = np.zeros(len(place), bool)
    goes_on[by_lag[1:]] = (lag[by_lag[1:]] == lag[by_lag[:-1]]) & (place[by_lag[1:]] - place[by_lag[:-1]] <= 1)
    return list(zip(*(x[~goes_on].tolist() for x in (place, lag, g)), strict=True))


def diagonals(words: list, opened: list[tuple[int, int, int]], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of one text, in the order in which its diagonals end."""
    active: dict[int, int] = {}
    runs, n, k, i = [], len(words), 0, 0
    while k < len(opened) or active:
        if not active:
            i = opened[k][0]
        word = words[i]
        for lag in [lag for lag in active if words[i - lag] != word]:
            emit(runs, i, lag, active.pop(lag), least, times)
        for lag in active:
            active[lag] += 1
        while k < len(opened) and opened[k][0] == i:
            active.setdefault(opened[k][1], opened[k][2])
            k += 1
        i += 1
        if i == n:
            break
    for lag, matched in active.items():
        emit(runs, n, lag, matched, least, times)
    return runs


def emit(runs: list, end: int, lag: int, matched: int, least: int, times: int) -> None:
    if matched + lag >= max(least, times * lag):
        runs.append((end - matched - lag, matched + lag, lag))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0)])


def search(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, by start, then period."""
    codes, size = [], 0
    for words in texts:
        index: dict[bytes, int] = {}
        codes.append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words)) + size)
        size += len(index)
    opened = openings(np.concatenate(codes)) if codes else []
    out, k, base = [], 0, 0
    for words, own in zip(texts, codes, strict=True):
        first = k
        while k < len(opened) and opened[k][0] < base + len(words):
            k += 1
        out.append(sorted((s, q, n) for s, n, q in diagonals(own.tolist(), [(i - base, lag, g) for i, lag, g in opened[first:k]])) if k > first else [])
        base += len(words)
    return [[(s, n, q) for s, q, n in runs] for runs in out]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``runs`` (array of ``start, length, period``, in words from 0) and ``collapsed``, the text with every run cut to its first period."""

    def run(texts: list[str | None]):
        runs, collapsed, held, size = [], [], [], 0

        def flush() -> None:
            for words, own in zip(held, search(held), strict=True):
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                collapsed.append(collapse(words, own).decode("utf-8", "surrogatepass"))
            held.clear()

        for t in texts:
            words = (t or "").encode("utf-8", "surrogatepass").split()
            if held and size + len(words) > TOGETHER:
                flush()
                size = 0
            held.append(words)
            size += len(words)
        flush()
        return None, [runs, collapsed]

    span = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    columns = [("runs", "array<struct<start:bigint,length:bigint,period:bigint>>", pa.list_(span)), ("collapsed", "string", pa.string())]
    return map_texts(docs, id_col, text_col, columns, run, id_col)


def repeat_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Damage that plants runs: in a tenth of the texts (by CRC-32 of the decimal id; none without id) the words from some place on repeat those that follow it."""
    h, g, w, n, a, p = fresh(docs, "_h", "_g", "_words", "_n", "_a", "_p")
    own = docs.withColumn(h, F.crc32(F.col(id_col).cast("string").cast("binary"))).withColumn(g, F.floor(F.col(h) / 10))
    own = own.withColumn(w, F.when(F.col(h) % 10 == 0, F.filter(F.split(text_col, f"{WS}+"), lambda x: x != ""))).withColumn(n, F.nullif(F.size(w).cast("long"), F.lit(0).cast("long")))
    own = own.withColumn(a, F.col(g) % F.col(n)).withColumn(p, 1 + F.floor((F.col(n) - F.col(a)) / (3 + F.col(g) % 8)))
    source = lambda i: F.when(i < F.col(a), i).otherwise(F.col(a) + (i - F.col(a)) % F.col(p))
    tail = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col(n) - 1), lambda i: F.get(F.col(w), source(i).cast("int"))), " ")
    return own.withColumn(text_col, F.when(F.col(n) > 0, tail).otherwise(F.col(text_col))).select(*docs.columns)


def longest(runs: Column) -> Column:
    """The run of greatest length over period, compared exactly; ties go to the smallest start, then period; null without runs."""
    better = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]  # noqa: E731  runs come by start, then period
    return F.reduce(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(better(best, r), r).otherwise(best))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(repeat_tails(read_documents(spark, sf_dir).select("doc_id", "text"))).withColumn("top", longest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
