"""Exact duplicates through an extendible-hash index on shared files (native DataFrame code).

1. Every text, white-space runs squeezed to one space, gets a 64-bit key. The rows' keys are counted and the directory is laid out
   over key prefixes: a bucket that holds more than ``capacity`` rows splits, doubling the directory, until none is overfull.
2. The rows go to the task that owns their bucket, a range of keys. The owner compares the bytes of rows of equal key: equal ones become one
   entry (``keep_id``, the smallest id, and ``group_size``); different ones that collide on the key are chained. Keys with more rows than a bucket
   holds (of which there are fewer than buckets) are collapsed map-side first, so a text that a third of all rows share sends the owner a row per task.
   The index, without texts, is written to the shared folder.
3. Every row is looked up: key to slot, slot to bucket, bucket to the chain of its key, and along a chain of several entries by digest.

Null text counts as empty. A null id is kept as is and never wins over another id. Rows repeated with the same id and text
each get a result row, but only one of them is ``kept``. Texts of any length are compared whole. An empty table gives an empty result. Other columns of the
input, whatever their names, are ignored (``deduplicate`` passes them through; of rows alike in id and text any one stays).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamgrid.llm.common import attach_group, fresh, read_documents, staged

KEY_BITS = 64
#: Rows of a bucket, and the most buckets' worth of rows a directory is laid out for: with more rows, buckets are larger. So directories are
#: broadcast: at most 2**(bits + SPARE_BITS) slots.
CAPACITY = 1024
DIRECTORY_BITS = 13
SPARE_BITS = 3
KEY = F.xxhash64


def squeeze(text):
    """Each run of ``[\\x20\\x09-\\x0D]`` becomes one space; only runs that are not one space already are touched."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def _prefix(bits):
    """The first ``bits`` (a literal or a column) of the key, as a non-negative number."""
    if isinstance(bits, int):
        return F.lit(0).cast("long") if bits == 0 else F.shiftrightunsigned("key", KEY_BITS - bits)
    return F.expr(f"if({bits} = 0, 0L, shiftrightunsigned(key, {KEY_BITS} - {bits}))")


def bucket_directory(keys: DataFrame, n_rows: int, capacity: int) -> tuple[DataFrame, int]:
    """Slots of the directory: ``slot, depth, bucket``, and the directory's depth in bits. ``keys``: ``key`` and ``n``, its rows.

    Extendible hashing splits a bucket exactly when it holds more than ``capacity`` rows, so the final buckets are
    the shallowest prefixes that are not overfull. The rows are counted once per slot of the deepest directory;
    these counts are summed for every shallower depth, and each slot takes its shallowest prefix that fits.
    """
    depth = min(40, max(0, ((n_rows + capacity - 1) // capacity - 1).bit_length()) + SPARE_BITS)
    slots = keys.groupBy(_prefix(depth).alias("slot")).agg(F.sum("n").alias("n"))
    levels = slots.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth"))
    levels = levels.withColumn("bucket", F.expr(f"shiftright(slot, {depth} - depth)"))
    sums = levels.groupBy("depth", "bucket").agg(F.sum("n").alias("held"))
    fits = levels.join(sums, ["depth", "bucket"]).filter((F.col("held") <= capacity) | (F.col("depth") == depth))
    first = F.min(F.struct("depth", "bucket")).alias("b")
    return fits.groupBy("slot").agg(first).select("slot", "b.depth", "b.bucket"), depth


def with_bucket(rows: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """Add ``bucket_depth`` and ``bucket`` through the directory (of bounded size, see DIRECTORY_BITS)."""
    slots = directory.select(F.col("slot").alias("_slot"), F.col("depth").alias("bucket_depth"), "bucket")
    return rows.withColumn("_own_slot", _prefix(depth)).join(F.broadcast(slots), F.col("_own_slot") == F.col("_slot")).drop("_own_slot", "_slot")


def build_index(texts: DataFrame, hot: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """Index rows ``bucket_depth, bucket, key, chain, chained, text_sha256, keep_id, group_size``, on shared files.

    ``texts``: ``id, key, body``; ``hot``: keys (a bounded number) whose rows are collapsed before they travel.
    """
    marked = texts.join(F.broadcast(hot.select(F.col("key").alias("_hot"))), F.col("key") == F.col("_hot"), "left")
    single = marked.filter("_hot IS NULL").select("key", "body", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("rows"))
    many = marked.filter("_hot IS NOT NULL").groupBy("key", "body").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("rows"))
    sent = with_bucket(single.unionByName(many), directory, depth).repartition("bucket_depth", "bucket")
    # all of a bucket is in one task from here on: grouping by (key, body) compares bytes, the window chains what collides
    entries = sent.groupBy("bucket_depth", "bucket", "key", "body").agg(F.min("keep_id").alias("keep_id"), F.sum("rows").alias("group_size"))
    entries = entries.select("bucket_depth", "bucket", "key", F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size")
    chain = Window.partitionBy("bucket_depth", "bucket", "key")
    entries = entries.withColumn("chain", F.row_number().over(chain.orderBy("keep_id", "text_sha256"))).withColumn("chained", F.count(F.lit(1)).over(chain))
    return staged(entries, "index")


def find_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, directory_bits: int = DIRECTORY_BITS) -> DataFrame:
    """One row per input row: id, ``keep_id, group_size, kept, text_sha256`` and its place in the index, ``bucket_depth, bucket, chain``."""
    texts = docs.select(F.col(id_col).alias("id"), squeeze(F.col(text_col)).alias("body")).withColumn("key", KEY("body"))
    rows = texts.select("id", "key", F.sha2("body", 256).alias("text_sha256")).groupBy("id", "key", "text_sha256").agg(F.count(F.lit(1)).alias("rows"))
    rows = staged(rows, "rows")
    keys = staged(rows.groupBy("key").agg(F.sum("rows").alias("n")), "keys")
    total = keys.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    capacity = max(capacity, total >> directory_bits)
    hot = staged(keys.filter(F.col("n") > capacity), "hot")
    cold = keys.select("key", F.when(F.col("n") <= capacity, F.col("n")).otherwise(F.lit(1)).alias("n"))
    directory, depth = bucket_directory(cold, total, capacity)
    directory = staged(directory, "directory")
    index = build_index(texts, hot, directory, depth)
    probes = with_bucket(rows, directory, depth)
    alone = index.filter("chained = 1")
    found = attach_group(probes, alone, ["key", "bucket", "bucket_depth"], "group_size", ["chain", "keep_id", "group_size"], F.struct("id", "text_sha256"), total)
    chained = index.filter("chained > 1")
    if not chained.isEmpty():  # keys that collide: their chains are walked by digest
        place = ["bucket", "bucket_depth", "key", "text_sha256"]
        chained = chained.select(*[F.col(c).alias(f"_c_{c}") for c in (*place, "chain", "keep_id", "group_size")])
        lost = found.filter("chain IS NULL").drop("chain", "keep_id", "group_size")
        walked = lost.join(chained, [F.col(c) == F.col(f"_c_{c}") for c in place])
        walked = walked.select(*lost.columns, *[F.col(f"_c_{c}").alias(c) for c in ("chain", "keep_id", "group_size")])
        found = found.filter("chain IS NOT NULL").unionByName(walked)
    copies = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return copies.select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), "text_sha256", "bucket_depth", "bucket", "chain")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; of equal texts the row with the smallest id."""
    own, sha, keep_id = fresh(docs, "_own", "_sha", "_keep")
    keep = find_duplicates(docs, id_col, text_col).filter("kept").select(F.col(id_col).alias(keep_id), F.col("text_sha256").alias(sha))
    rows = docs.withColumn(own, F.sha2(squeeze(F.col(text_col)), 256))
    rows = rows.join(keep, rows[id_col].eqNullSafe(keep[keep_id]) & (rows[own] == keep[sha]), "left_semi")
    return rows.dropDuplicates([id_col, own]).drop(own)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_duplicates(read_documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP4_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM n WINDOW w AS (PARTITION BY body)
"""
