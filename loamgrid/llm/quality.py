"""Quality rules with adaptive thresholds from mergeable quantile sketches (native DataFrame code).

Every document gets its metrics in one pass of column expressions. A sketch of a metric is a table of counts over
logarithmic bins: relative error ``(GAMMA - 1) / 2``, merged by adding counts, the same whatever the order. Sketches are
built per language and source, and merged upwards to languages and to the whole table, which stand in for groups
of fewer than ``min_docs`` values. A metric's threshold is the upper quartile of the group's sketch plus ``SPREAD`` times its quartile distance; nothing but
the sketch sets it. Where half of a group's values or more are zero, the quartiles are those of the others; where there are too few of these at every level, the metric has no
threshold. The thresholds are then joined to the documents.

Null text has no words and fails the base rule; null language or source is a group of its own; repeated rows count
each; a text of any length is measured whole; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamgrid.llm.common import WORD, attach_group, read_documents, staged

WINDOW_WORDS = 8
GAMMA = 1.02
SMALLEST = 1e-4
#: Punctuation and repeated words a word or character, capitals, length of words, repeated lines.
METRICS = ("punct_ratio", "stutter_ratio", "upper_ratio", "mean_chars", "dup_line_ratio")
SPREAD = 6.0
MIN_DOCS = 50
#: Group tables of at most this many rows are broadcast; larger ones are joined by shuffle, their largest groups apart.
BROADCAST_GROUPS = 20_000
#: ASCII characters that are no letters, digits or white space.
PUNCT = r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"


def _windows(words: str) -> Column:
    """A 64-bit hash of each 8-word window."""
    last = f"size({words}) - {WINDOW_WORDS - 1}"
    return F.expr(
        f"if({last} > 1, transform(sequence(1, {last}), i -> xxhash64(slice({words}, i, {WINDOW_WORDS}))), cast(array() as array<bigint>))"
    )


def _covered(windows: str) -> Column:
    """Words in windows that occur twice or more; sorting brings equal windows together."""
    return F.expr(f"""
      if(size(array_distinct({windows})) = size({windows}), 0L,
        aggregate(
          sort_array(flatten(transform(array(sort_array(transform({windows}, (h, i) -> struct(h, i)))),
            s -> filter(transform(sequence(0, size(s) - 1), p ->
                   if(get(s, p).h = get(s, p - 1).h or get(s, p).h = get(s, p + 1).h, get(s, p).i, -1)), x -> x >= 0)))),
          named_struct('n', 0L, 'last', -{WINDOW_WORDS}),
          (a, x) -> named_struct('n', a.n + least({WINDOW_WORDS}, x - a.last), 'last', x),
          a -> a.n))""")


def measure(docs: DataFrame, id_col: str = "doc_id", lang: str = "lang", source: str = "source", text_col: str = "text") -> DataFrame:
    """``id, lang, source`` and the counts of every whole text."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    out = slim.withColumn("words", F.regexp_extract_all("t", F.lit(WORD), F.lit(0)))
    out = out.withColumn("windows", _windows("words"))
    out = out.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)))
    out = out.withColumn("chars", F.length("t"))
    without = lambda pattern: (F.col("chars") - F.length(F.regexp_replace("t", pattern, ""))).cast("long")
    return out.select(
        "id", "lang", "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        without(r"[#*$%&|<>]+").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        _covered("windows").cast("long").alias("n_repeat_words"),
        without(r"[A-Z]+").alias("n_upper"),
        without(PUNCT).alias("n_punct"),
        F.size(F.filter("words", lambda x, i: x == F.get("words", i - 1))).cast("long").alias("n_stutters"),
    )


def with_ratios(measured: DataFrame) -> DataFrame:
    chars = F.greatest("word_chars", F.lit(1))
    words = F.greatest("n_words", F.lit(1))
    return measured.withColumns(
        {
            "punct_ratio": F.col("n_punct") / chars,
            "stutter_ratio": F.col("n_stutters") / words,
            "upper_ratio": F.col("n_upper") / chars,
            "mean_chars": F.col("word_chars") / words,
            "dup_line_ratio": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        }
    )


def sketch_bin(value: Column) -> Column:
    """Bin 0 holds values up to SMALLEST, bin i those up to SMALLEST * GAMMA**i. Rounding keeps bin edges the same on every engine."""
    bins = F.ceil(F.round(F.log(value / F.lit(SMALLEST)) / F.log(F.lit(GAMMA)), 6)).cast("int")
    return F.when(value <= SMALLEST, F.lit(0)).otherwise(bins)


def sketch_value(bin_no: Column) -> Column:
    return F.when(bin_no == 0, F.lit(0.0)).otherwise(F.lit(SMALLEST) * F.pow(F.lit(GAMMA), bin_no))


def group_sketches(rows: DataFrame, metrics: list[str], by: list[str]) -> DataFrame:
    """``by, metric, bin, n``: one sketch per group and metric."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), sketch_bin(F.col(m)).alias("bin")) for m in metrics]))
    return rows.select(*by, pairs.alias("p")).groupBy(*by, "p.metric", "p.bin").agg(F.count(F.lit(1)).alias("n"))


def sketch_quartiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """``by, metric, docs, used, q1, q3`` from sketches of any level; ``used`` values (all, or those that are not zero) have these quartiles."""
    up = Window.partitionBy(*by, "metric").orderBy("bin")
    whole = Window.partitionBy(*by, "metric")
    zeros = F.coalesce(F.sum(F.when(F.col("bin") == 0, F.col("n"))).over(whole), F.lit(0))
    rows = sketches.withColumn("docs", F.sum("n").over(whole)).withColumn("zeros", zeros).withColumn("upto", F.sum("n").over(up))
    rows = rows.withColumn("out", F.when(F.col("zeros") * 2 >= F.col("docs"), F.col("zeros")).otherwise(F.lit(0)))
    rows = rows.withColumn("used", F.col("docs") - F.col("out")).withColumn("upto", F.col("upto") - F.col("out"))
    first = lambda q: F.min(F.when((F.col("upto") > 0) & (F.col("upto") >= F.col("used") * q), F.col("bin")))
    out = rows.groupBy(*by, "metric").agg(F.max("docs").alias("docs"), F.max("used").alias("used"), first(0.25).alias("b1"), first(0.75).alias("b3"))
    return out.select(*by, "metric", "docs", "used", sketch_value(F.col("b1")).alias("q1"), sketch_value(F.col("b3")).alias("q3"))


def thresholds(rows: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, docs`` and one ``max_<metric>`` column per metric (null: no threshold), for every group of ``rows``."""
    metrics = list(METRICS)
    fine = staged(group_sketches(rows, metrics, ["lang", "source"]), "sketches")
    by_lang = fine.groupBy("lang", "metric", "bin").agg(F.sum("n").alias("n"))
    overall = by_lang.groupBy("metric", "bin").agg(F.sum("n").alias("n"))
    f = sketch_quartiles(fine, ["lang", "source"])
    g = sketch_quartiles(by_lang, ["lang"]).select(F.col("lang").alias("_l"), F.col("metric").alias("_m"), *[F.col(c).alias(f"l_{c}") for c in ("used", "q1", "q3")])
    h = sketch_quartiles(overall, []).select(F.col("metric").alias("_om"), *[F.col(c).alias(f"o_{c}") for c in ("used", "q1", "q3")])
    j = f.join(g, f["lang"].eqNullSafe(g["_l"]) & (f["metric"] == g["_m"])).join(F.broadcast(h), F.col("metric") == F.col("_om"))
    fence = lambda p: F.col(f"{p}q3") + F.lit(SPREAD) * (F.col(f"{p}q3") - F.col(f"{p}q1"))
    limit = F.when(F.col("used") >= min_docs, fence("")).when(F.col("l_used") >= min_docs, fence("l_")).when(F.col("o_used") >= min_docs, fence("o_"))
    j = j.withColumn("limit", limit)
    return j.groupBy("lang", "source").agg(F.max("docs").alias("docs"), *[F.max(F.when(F.col("metric") == m, F.col("limit"))).alias(f"max_{m}") for m in metrics])


def with_limits(rows: DataFrame, limits: DataFrame, broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """Join the thresholds of its group to every row."""
    names = [f"max_{m}" for m in METRICS]
    if limits.count() <= broadcast_groups:
        own = F.broadcast(limits.drop("docs").withColumnsRenamed({"lang": "_lang", "source": "_source"}))
        return rows.join(own, rows["lang"].eqNullSafe(own["_lang"]) & rows["source"].eqNullSafe(own["_source"]), "left").drop("_lang", "_source")
    text = lambda c: F.concat(F.when(F.col(c).isNull(), "-").otherwise("+"), F.coalesce(c, F.lit("")))
    keys = {"_g": F.xxhash64("lang", "source"), "_gl": text("lang"), "_gs": text("source")}
    total = limits.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]
    return attach_group(rows.withColumns(keys), limits.withColumns(keys), list(keys), "docs", names, F.col("id"), total).drop(*keys)


def judge(
    docs: DataFrame, id_col: str = "doc_id", lang: str = "lang", source: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS, broadcast_groups: int = BROADCAST_GROUPS
) -> DataFrame:
    """One row per input row: id, ``lang, source``, counts, metrics, the group's thresholds, ``base_failed`` and ``kept``."""
    rows = with_ratios(staged(measure(docs, id_col, lang, source, text_col), "metrics"))
    out = with_limits(rows, staged(thresholds(rows, min_docs), "limits"), broadcast_groups)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    within = F.lit(True)
    for m in METRICS:
        within = within & F.coalesce(F.col(m) <= F.col(f"max_{m}"), F.lit(True))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & within).withColumnRenamed("id", id_col)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _level(name: str, keys: str, source: str) -> str:
    """SQL of one level: counts, running counts, then the quartiles of all values or, if half are zero, of the others."""
    lead = f"{keys}, " if keys else ""
    value = lambda q: f"min(bin) FILTER (upto - skip > 0 AND upto - skip >= (docs - skip) * {q})"
    quartiles = ", ".join(f"CASE WHEN {value(q)} = 0 THEN 0 ELSE {SMALLEST} * pow({GAMMA}, {value(q)}) END AS {c}" for q, c in ((0.25, "q1"), (0.75, "q3")))
    return f"""
{name}_c AS (SELECT {lead}metric, bin, sum(n) AS n FROM {source} GROUP BY ALL),
{name}_u AS (SELECT *, sum(n) OVER (PARTITION BY {lead}metric ORDER BY bin) AS upto, sum(n) OVER w AS docs,
  coalesce(sum(n) FILTER (bin = 0) OVER w, 0) AS zeros FROM {name}_c WINDOW w AS (PARTITION BY {lead}metric)),
{name}_s AS (SELECT *, CASE WHEN zeros * 2 >= docs THEN zeros ELSE 0 END AS skip FROM {name}_u),
{name} AS (SELECT {lead}metric, max(docs - skip) AS used, {quartiles} FROM {name}_s GROUP BY ALL)"""


_LINES = "list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))"
OP8_SQL = rf"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, ws[i:i + 7] AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 9)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS k FROM g) WHERE k > 1),
cov AS (SELECT doc_id, sum(least(8, coalesce(i - prev, 8))) AS n FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM rep) GROUP BY doc_id),
m AS (SELECT w.doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
   (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
   (len({_LINES}) - len(list_distinct({_LINES})))::BIGINT AS n_dup_lines, len({_LINES})::BIGINT AS n_lines,
   coalesce(cov.n, 0)::BIGINT AS n_repeat_words, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
   length(t) - length(regexp_replace(t, '{PUNCT}', '', 'g')) AS n_punct,
   len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_stutters
  FROM w LEFT JOIN cov USING (doc_id)),
r AS (SELECT *, n_punct / greatest(word_chars, 1) AS punct_ratio, n_stutters / greatest(n_words, 1) AS stutter_ratio, n_upper / greatest(word_chars, 1) AS upper_ratio,
   word_chars / greatest(n_words, 1) AS mean_chars, n_dup_lines / greatest(n_lines, 1) AS dup_line_ratio FROM m),
b AS ({' UNION ALL '.join(f"SELECT doc_id, lang, source, '{x}' AS metric, {x} AS v FROM r" for x in METRICS)}),
z AS (SELECT *, CASE WHEN v <= {SMALLEST} THEN 0 ELSE ceil(round(ln(v / {SMALLEST}) / ln({GAMMA}), 6))::INT END AS bin FROM b),
c AS (SELECT lang, source, metric, bin, count(*) AS n FROM z GROUP BY ALL),
{_level('f', 'lang, source', 'c')},{_level('g2', 'lang', 'c')},{_level('o', '', 'c')},
p AS (SELECT f.lang, f.source, f.metric, CASE WHEN f.used >= {MIN_DOCS} THEN f.q3 + {SPREAD} * (f.q3 - f.q1)
   WHEN g2.used >= {MIN_DOCS} THEN g2.q3 + {SPREAD} * (g2.q3 - g2.q1) WHEN o.used >= {MIN_DOCS} THEN o.q3 + {SPREAD} * (o.q3 - o.q1) END AS most
  FROM f JOIN g2 ON f.lang IS NOT DISTINCT FROM g2.lang AND f.metric = g2.metric JOIN o ON f.metric = o.metric),
v AS (SELECT z.doc_id, bool_and(coalesce(z.v <= p.most, true)) AS ok
  FROM z JOIN p ON z.lang IS NOT DISTINCT FROM p.lang AND z.source IS NOT DISTINCT FROM p.source AND z.metric = p.metric GROUP BY z.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND ok AS kept
FROM r JOIN v USING (doc_id)
"""
