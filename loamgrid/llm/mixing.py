"""Mixing sources to target weights by weighted fair queueing (native DataFrame code).

Each source is a queue of its documents in a seeded shuffle, passed over ``max_passes`` times and cut into pieces of at most ``quantum`` words.
A piece's virtual finish time is the words its source has served when it ends, divided by the source's weight. The pieces of all
queues are range-sorted by finish time and truncated at the total budget: that cut alone decides what each source gives. A source that has
served ``max_passes`` times its words has no more pieces, so the others go on to a later finish time, by weight: its excess is reshared.
Targets (``source_targets``) say what an exact division would give; what is taken differs from them by about a piece at most.

Running totals are two-level: sums per key range, a prefix over those sums, and a window inside each range. There are no more ranges than rows
in one, so neither a hot source nor the global order meets in one task; sources are range-sorted in the same way. Pieces that cannot come
before the cut, however the others fall, are dealt over all ranges.

Null text counts as 0 words; null is a source of its own, the last; rows without id are shuffled by their text; rows alike in id, source and size
may change places, which does not change the result; a text of any length is only counted; an empty table gives an empty result; other
columns are ignored. Rows that are alike in everything and have no id share a key range, however many they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamgrid.llm.common import fresh, prefix_bits, read_documents, staged, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
QUANTUM = 256
SEED = 42
HASH_BITS = 60
#: Sources of one range; fewer are one range.
SOURCES_PER_RANGE = 100_000


def shuffle_key(id_col: str, text_col: str, seed: int) -> Column:
    """60 bits of the MD5 of ``id:seed``; the text's MD5 stands for a null id."""
    name = F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(F.concat_ws(":", name, F.lit(str(seed))).cast("binary")), 1, 15), 16, 10).cast("long")


def _running(df: DataFrame, group: list[str], slice_col: str, order: list, sums_of: dict[str, str]) -> DataFrame:
    """Add for each ``amount: out`` the sum of ``amount`` in earlier slices of ``group`` and earlier rows of the slice."""
    before = Window.partitionBy(*group).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(*group, slice_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*group, slice_col).agg(*[F.sum(a).alias(f"_s_{a}") for a in sums_of])
    sums = sums.select(
        *[F.col(g).alias(f"_g_{g}") for g in group], F.col(slice_col).alias("_g"), *[F.coalesce(F.sum(f"_s_{a}").over(before), F.lit(0)).alias(f"_b_{a}") for a in sums_of]
    )
    on = df[slice_col] == sums["_g"]
    for g in group:
        on = on & df[g].eqNullSafe(sums[f"_g_{g}"])
    joined = df.join(sums, on)
    return joined.select(*df.columns, *[(F.col(f"_b_{a}") + F.coalesce(F.sum(a).over(within), F.lit(0))).alias(out) for a, out in sums_of.items()])


def _ranged(df: DataFrame, n_rows: int, order: list, name: str) -> DataFrame:
    """``df`` with ``range``, the number of its partition in a global range sort, and ``one``, a constant to group all ranges by."""
    parts = -(-n_rows // SOURCES_PER_RANGE)
    dealt = df.repartitionByRange(parts, *order) if parts > 1 else df.coalesce(1)
    return staged(dealt.withColumns({"range": F.spark_partition_id(), "one": F.lit(0)}), name)


def _level(filled: DataFrame, budget: float) -> float:
    """The finish time at which sources of ``cap, weight`` (in order of ``ratio``, with sums of those before) have served ``budget`` words; inf if never."""
    level = (F.lit(float(budget)) - F.col("cap_before")) / (F.col("total_weight") - F.col("weight_before"))
    first = filled.withColumn("level", level).filter(F.col("ratio") >= F.col("level")).agg(F.min(F.struct("ratio", "place", "level")).alias("f")).first()["f"]
    return first["level"] if first else math.inf


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = PASSES, slack: int = 0) -> tuple[DataFrame, int, float, float]:
    """Per source ``source, source_size, weight, target``; the budget; the finish times of the budget, and of ``slack`` words more per source.

    ``share`` of all words go by weight, no source above ``cap`` times its own size. What a capped source cannot take is
    reshared by weight until none is above: with sources in order of cap / weight, the capped ones come first.
    """
    per = staged(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    n, words = per.agg(F.count(F.lit(1)), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    by_name = [F.col("source").isNull(), F.col("source")]
    per = _running(_ranged(per.withColumn("unit", F.lit(1)), n, by_name, "names"), ["one"], "range", by_name, {"unit": "place"}).drop("unit", "range", "one")
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(cap))).withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = [F.col("ratio"), F.col("place")]
    filled = staged(_running(_ranged(per, n, by_ratio, "ratios"), ["one"], "range", by_ratio, {"cap": "cap_before", "weight": "weight_before"}), "filled")
    total_weight = filled.agg(F.coalesce(F.sum("weight"), F.lit(0.0))).first()[0]
    filled = filled.withColumn("total_weight", F.lit(total_weight))
    budget = min(share, cap) * words
    level = _level(filled, budget)
    target = F.least("cap", F.col("weight") * F.lit(level)) if math.isfinite(level) else F.col("cap")
    return filled.select("source", "source_size", "weight", target.alias("target")), math.floor(budget), level, _level(filled, budget + (slack + 1) * n)


def fair_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights=WEIGHTS,
    share: float = SHARE,
    max_passes: int = PASSES,
    seed: int = SEED,
    rows_per_slice: int = 2_000,
    quantum: int | None = QUANTUM,
    row_col: str | None = None,
) -> DataFrame:
    """One row per piece that may come before the cut (and the first piece of every document).

    Columns: id, ``source, size, source_size, target, pass_no, piece_no, taken, place`` (words of the mix before it; null if
    nothing is taken) and ``row_key``, which tells rows of equal id apart (the number in ``row_col``, if given). ``quantum`` None: documents are
    pieces, and a piece that the budget cuts is left out.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), shuffle_key(id_col, text_col, seed).alias("u"),
        F.col(row_col).alias("row") if row_col else F.lit(0).cast("long").alias("row"),
    )
    rows = staged(rows, "sizes")
    n_rows, longest = rows.agg(F.count(F.lit(1)), F.coalesce(F.max("size"), F.lit(0))).first()
    targets, budget, level, latest = source_targets(rows, weights, share, max_passes, min(quantum or longest, longest))
    slices = prefix_bits(n_rows, max(rows_per_slice, math.isqrt(n_rows)))
    rows = rows.withColumn("slice", F.shiftright("u", HASH_BITS - slices))
    order = ["u", "id", "size", "row"]
    queued = _running(rows, ["source"], "slice", order, {"size": "ahead"})
    number = F.row_number().over(Window.partitionBy("source", "slice").orderBy(*order))
    queued = queued.withColumn("row_key", F.struct(F.lit(None).cast("string").alias("source"), F.lit(0).cast("long").alias("slice"), F.col("row").alias("n")) if row_col else F.struct("source", "slice", number.cast("long").alias("n")))
    t = targets.withColumnRenamed("source", "_src")
    queued = queued.join(t, queued["source"].eqNullSafe(t["_src"])).drop("_src")
    step = F.lit(quantum).cast("long") if quantum else F.greatest("size", F.lit(1).cast("long"))
    pieces = queued.withColumn("pass_no", F.explode(F.sequence(F.lit(0), F.lit(max_passes - 1)))).withColumn("base", F.col("ahead") + F.col("pass_no") * F.col("source_size"))
    pieces = pieces.withColumn("step", step).withColumn("piece_no", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.greatest("size", F.lit(1)) - 1) / F.col("step")))))
    pieces = pieces.withColumn("piece", F.greatest(F.lit(0).cast("long"), F.least(F.col("size") - F.col("piece_no") * F.col("step"), F.col("step"))))
    pieces = pieces.withColumn("finish", (F.col("base") + F.col("piece_no") * F.col("step") + F.col("piece")) / F.col("weight"))
    may = (F.col("piece") > 0) & (F.col("finish") <= F.lit(latest))
    pieces = pieces.withColumn("may", may).filter(F.col("may") | ((F.col("pass_no") == 0) & (F.col("piece_no") == 0)))
    pieces = pieces.withColumn("piece", F.when(F.col("may"), F.col("piece")).otherwise(F.lit(0).cast("long")))
    end = latest if math.isfinite(latest) else targets.agg(F.coalesce(F.max(F.col("source_size") * max_passes / F.col("weight")), F.lit(0.0))).first()[0]
    ranges = 1 << min(20, slices + 2)
    by_finish = F.least(F.floor(F.col("finish") / F.lit(max(end, 1e-9)) * ranges), F.lit(ranges - 1))
    pieces = pieces.withColumn("range", F.when(F.col("may"), by_finish).otherwise(F.pmod("u", F.lit(ranges)))).withColumn("one", F.lit(0))
    order = ["finish", F.col("source").asc_nulls_last(), "u", "id", "row_key", "pass_no", "piece_no"]
    placed = _running(pieces, ["one"], "range", order, {"piece": "place"})
    room = F.lit(budget) - F.col("place")
    part = F.greatest(F.lit(0).cast("long"), F.least("piece", room)) if quantum else F.when(F.col("piece") <= room, F.col("piece")).otherwise(F.lit(0).cast("long"))
    placed = placed.withColumn("taken", part)
    return placed.select(
        F.col("id").alias(id_col), "source", "size", "source_size", F.round("target", 6).alias("target"), "pass_no", "piece_no", "taken",
        F.when(F.col("taken") > 0, F.col("place")).alias("place"), "row_key",
    )


def words_taken(mix: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Sum the pieces of ``fair_mix``: one row per document with ``taken`` and the first ``place``."""
    return (
        mix.groupBy("row_key")
        .agg(
            *[F.first(c).alias(c) for c in (id_col, "size", "source_size", "target")],
            F.sum("taken").alias("taken"),
            F.min("place").alias("first_place"),
        )
        .drop("row_key")
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it as a whole document; rows are told apart by a number written with them."""
    row, own, passes, copy = fresh(docs, "_row", "_own", "_passes", "_copy")
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    mix = fair_mix(numbered, id_col, source_col, text_col, quantum=None, row_col=row).filter("taken > 0")
    times = mix.groupBy(F.col("row_key.n").alias(own)).agg(F.count(F.lit(1)).alias(passes))
    taken = numbered.join(times, F.col(row) == F.col(own))
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(passes)))).select(*docs.columns)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words_taken(fair_mix(read_documents(spark, sf_dir)))


OP1_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) || ':{SEED}'), 1, 15))::BIGINT AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
             source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS i,
        ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM r),
t AS (SELECT source, source_size, weight, least(cap, coalesce((SELECT arg_min(level, i) FROM l WHERE cap / weight >= level) * weight, cap)) AS target FROM l),
q AS (SELECT doc_id, size, u, source, coalesce(sum(size) OVER (PARTITION BY source ORDER BY u, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead FROM d),
k AS (SELECT *, unnest(range(0, greatest(size - 1, 0) // {QUANTUM} + 1)) AS piece_no FROM q),
p AS (SELECT k.*, pass_no, source_size, target, weight, least(size - piece_no * {QUANTUM}, {QUANTUM}) AS piece,
        ((ahead + pass_no * source_size + least(size, (piece_no + 1) * {QUANTUM}))::BIGINT)::DOUBLE / weight AS finish
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source CROSS JOIN (VALUES (0), (1)) v(pass_no)),
m AS (SELECT *, coalesce(sum(piece) OVER (ORDER BY finish, source NULLS LAST, u, doc_id, pass_no, piece_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place,
        (SELECT floor(sum(source_size) * 1.5)::BIGINT FROM s) AS budget FROM p),
c AS (SELECT *, greatest(0, least(piece, budget - place))::BIGINT AS part FROM m)
SELECT doc_id, any_value(size) AS size, any_value(source_size) AS source_size, round(any_value(target), 6) AS target,
       sum(part)::BIGINT AS taken, min(CASE WHEN part > 0 THEN place END)::BIGINT AS first_place
FROM c GROUP BY doc_id
"""
