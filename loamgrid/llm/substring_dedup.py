"""Removing passages that repeat across documents, by line, sentence and chunk hashing.

Units are the lines of a text and the sentences of each line, of ``min_words`` words or more. Passages that keep neither line nor
sentence ends (verse, lists, code, text wrapped anew) are found by chunks: the words between places where a hash of two words is smaller than
at ``CUT_REACH`` places on either side, so that they fall alike wherever the passage stands. A unit is normalised (A-Z lower-cased, white space
squeezed) and hashed to 128 bits; digests are grouped globally, the earliest ranked occurrence stays, the others are repeats. Repeats that
touch or overlap form a run, and runs of ``min_run_words`` words or more are removed, so a short stock line alone in a clean document stays.
Positions in the original text (code points) are kept for every run.

Every row of the table is a document of its own, told apart by a row number that is written with its units: rows of equal or null id are not merged.
Occurrences rank by id (null last), then a hash of the text, then row and position; rows alike in id and text are interchangeable, so reruns agree.

Digests that many documents share take the broadcast path of ``attach_group``, so a line found in a third of all documents meets in no single
task; the runs of a document are merged in time linear in its units. A text of any length is one row, whole in a task. Null text is
empty; repeated rows are repeats of the first; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamgrid.llm.common import attach_group, map_texts, read_documents, staged

MIN_WORDS = 8
MIN_RUN_WORDS = 20
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
HALVES = struct.Struct("<qq")
#: A chunk begins where the hash of two words is the smallest within so many places before and after: every 11th place on average.
CUT_REACH = 5
PAIR = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)


def chunk_places(words: list[bytes]) -> list[int]:
    """Word numbers at which chunks begin or end; each depends on ``CUT_REACH`` words before and ``CUT_REACH + 1`` after it only."""
    if len(words) < 3:
        return []
    h = np.fromiter(map(crc32, words), np.uint64, len(words))
    pair = (h[:-1] * PAIR[0] ^ h[1:]) * PAIR[1]
    n = len(pair)
    padded = np.full(n + 2 * CUT_REACH, 2**64 - 1, np.uint64)
    padded[CUT_REACH : CUT_REACH + n] = pair
    least = np.ones(n, bool)
    for k in range(1, CUT_REACH + 1):
        least &= (pair < padded[CUT_REACH - k : CUT_REACH - k + n]) & (pair <= padded[CUT_REACH + k : CUT_REACH + k + n])
    return np.flatnonzero(least).tolist()


def word_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points at which the words ``[^\\x20\\x09-\\x0D]+`` start and end."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), "<u4")
    blank = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    return np.flatnonzero(blank[:-1] & ~blank[1:]), np.flatnonzero(~blank[:-1] & blank[1:])


def word_ranges(lines: list[list[bytes]], words: list[bytes], min_words: int) -> list[tuple[int, int]]:
    """Word ranges of the units: lines, their sentences, chunks; longest first where several begin."""
    ranges = set()
    i = 0
    for line in lines:
        j = i + len(line)
        if j - i >= min_words:
            ranges.add((i, j))
            at = i
            for k, word in enumerate(line, i + 1):
                if word[-1] in b".!?":
                    if k - at >= min_words:
                        ranges.add((at, k))
                    at = k
            if j - at >= min_words:
                ranges.add((at, j))
        i = j
    cuts = chunk_places(words)
    ranges.update(zip(cuts, cuts[1:], strict=False))
    return sorted(ranges, key=lambda r: (r[0], -r[1]))


def units_of(text: str | None, min_words: int = MIN_WORDS) -> list[tuple[int, int, int, int, int, int]]:
    """``(start, end, first word, word after the last, digest high, digest low)`` of each unit; occurrences of one digest do not overlap."""
    text = text or ""
    lines = [line.split() for line in text.encode("utf-8", "surrogatepass").translate(LOWER).split(b"\n")]
    words = [w for line in lines for w in line]
    if len(words) < min_words:
        return []
    starts, stops = (x.tolist() for x in word_places(text))
    out, ends = [], {}
    for i, j in word_ranges(lines, words, min_words):
        d = xxhash.xxh128_digest(b" ".join(words[i:j]), 7)
        if ends.get(d, 0) <= i:
            ends[d] = j
            out.append((starts[i], stops[j - 1], i, j, *HALVES.unpack(d)))
    return out


def unit_table(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """``row`` (its ``row.row`` number, ``row.id`` and a hash ``row.text`` of its text), ``start, end, first, last, high, low``.

    Every row of ``docs`` also gives a marker without digest, whose ``end`` and ``last`` are the numbers of its characters and words.
    """

    def run(texts: list[str | None]):
        rows, units = [], []
        for i, text in enumerate(texts):
            own = [(-1, len(text or ""), 0, len((text or "").encode("utf-8", "surrogatepass").split()), None, None), *units_of(text, min_words)]
            rows += [i] * len(own)
            units += own
        return rows, list(zip(*units, strict=True)) if units else [[]] * 6

    columns = [(c, "long", pa.int64()) for c in ("start", "end", "first", "last", "high", "low")]
    rank = [F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text"), F.monotonically_increasing_id().alias("row")]
    return map_texts(docs.select(F.struct(*rank).alias("_row"), F.col(text_col).alias("_body")), "_row", "_body", columns, run, "row")


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """All units with the row and position that keep them (null if they occur once), and the markers (see ``unit_table``)."""
    rows = staged(unit_table(docs, id_col, text_col, min_words), "units")
    units = rows.filter("high IS NOT NULL")
    groups = units.groupBy("high", "low").agg(F.min(F.struct("row", "start")).alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = staged(groups.select("high", "low", "n", F.col("kept.row.row").alias("keep_row"), F.col("kept.start").alias("keep_start")), "repeats")
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    slim = units.select(F.col("row.row").alias("row"), "start", "end", "first", "last", "high", "low")
    markers = rows.filter("high IS NULL").select("row.row", "row.id", F.col("end").alias("n_chars"), F.col("last").alias("n_words"))
    return attach_group(slim, groups, ["high", "low"], "n", ["keep_row", "keep_start"], F.struct("row", "start"), total), markers


def merge_runs(spans: list[tuple[int, int, int, int]], min_run_words: int) -> tuple[list[tuple[int, int]], int]:
    """Runs of touching or overlapping ``(first, last, start, end)`` with ``min_run_words`` words or more, and the number of spans in them."""
    runs: list[list[int]] = []
    for first, last, start, end in sorted(spans):
        if runs and first <= runs[-1][1]:
            own = runs[-1]
            if last > own[1]:
                own[1], own[3] = last, end
            own[4] += 1
        else:
            runs.append([first, last, start, end, 1])
    long = [r for r in runs if r[1] - r[0] >= min_run_words]
    return [(r[2], r[3]) for r in long], sum(r[4] for r in long)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_run_words: int = MIN_RUN_WORDS
) -> DataFrame:
    """One row per input row: id, ``n_chars, n_words, n_removed`` units, ``removed_chars`` and ``removed``, the spans taken out."""
    units, markers = repeated_units(docs, id_col, text_col, min_words)
    gone = units.filter((F.col("keep_row") != F.col("row")) | (F.col("keep_start") != F.col("start")))
    span = F.struct("first", "last", "start", "end")
    spans = gone.groupBy("row").agg(F.collect_list(span).alias("spans")).withColumnRenamed("row", "_row")
    joined = markers.join(spans, F.col("row") == F.col("_row"), "left").select("id", "n_chars", "n_words", "spans")
    kind = joined.schema["id"].dataType.simpleString()
    pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [merge_runs([tuple(s.values()) for s in x or []], min_run_words) for x in batch.column(3).to_pylist()]
            removed = [[{"start": a, "end": b} for a, b in runs] for runs, _ in found]
            chars = [sum(b - a for a, b in runs) for runs, _ in found]
            counts = pa.array([n for _, n in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], counts, pa.array(chars, pa.int64()), pa.array(removed, pa.list_(pair))], ["id", "n_chars", "n_words", "n_removed", "removed_chars", "removed"]
            )

    out = joined.mapInArrow(run, f"id {kind}, n_chars long, n_words long, n_removed long, removed_chars long, removed array<struct<start:bigint,end:bigint>>")
    return out.withColumnRenamed("id", id_col)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_documents(spark, sf_dir))
    show = F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return out.withColumn("removed", show)
