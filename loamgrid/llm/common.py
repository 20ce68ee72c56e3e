"""Shared helpers of the training-data operators: staged tables and skew-proof lookups."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java/RE2 class of the six white-space characters of every word rule here.
WS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: At most this many groups can each hold more than 1/HOT_GROUPS of all rows.
HOT_GROUPS = 4096


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table; where it has fewer partitions than the session has cores (a small table in one file), dealt over all cores."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cores = spark.sparkContext.defaultParallelism
    return docs.repartition(cores) if docs.rdd.getNumPartitions() < cores else docs


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for local sessions where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


#: Staged paths that still exist, in order of writing.
_staged: list[str] = []


def remove(spark: SparkSession, path: str) -> None:
    if path in _staged:
        _staged.remove(path)
    try:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # the session may have ended before the interpreter does
        return


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    return staged_at(df, name)[0]


def staged_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``staged``, with the path, for ``remove`` once nothing reads it any more."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/loamgrid-{name}-{uuid.uuid4().hex}"
    _staged.append(path)
    df.write.parquet(path)
    atexit.register(remove, spark, path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of the tables staged inside."""
    before, paths = set(_staged), []
    yield paths
    paths += [p for p in _staged if p not in before]


def discard(spark: SparkSession, paths: list[str], docs: DataFrame) -> None:
    """Remove staged tables that ``docs`` does not read."""
    read = docs.inputFiles() if paths else []
    for path in paths:
        if not any(f"/{path.rsplit('/', 1)[1]}/" in f for f in read):
            remove(spark, path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name, with as many underscores in front as set it apart from the columns of ``df`` (whatever their case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def attach_group(
    rows: DataFrame, groups: DataFrame, keys: list[str], size_col: str, values: list[str], scatter: Column, total: int
) -> DataFrame:
    """Left-join per-group ``values`` to ``rows`` without sending a hot group to one task.

    ``groups`` has one row per group with the number of ``rows`` it holds in ``size_col``. Groups of more than
    ``total / HOT_GROUPS`` rows number fewer than ``HOT_GROUPS``, so they are broadcast; the rest join by shuffle,
    where no key has more rows than that. Rows of hot groups are dealt over all partitions by ``scatter``.
    The first key must be a non-null long.
    """
    limit = total // HOT_GROUPS
    hot = groups.filter(F.col(size_col) > limit).select(
        *[F.col(k).alias(f"_hk_{k}") for k in keys], *[F.col(v).alias(f"_hv_{v}") for v in values]
    )
    cold = groups.filter(F.col(size_col) <= limit).select(
        *[F.col(k).alias(f"_ck_{k}") for k in keys], *[F.col(v).alias(f"_cv_{v}") for v in values]
    )
    is_hot = F.col(f"_hk_{keys[0]}").isNotNull()
    on_hot = [rows[k] == hot[f"_hk_{k}"] for k in keys]
    out = rows.join(F.broadcast(hot), on_hot, "left")
    out = out.withColumn("_place", F.when(is_hot, F.xxhash64(scatter)).otherwise(F.col(keys[0])))
    on = (F.col("_place") == F.col(f"_ck_{keys[0]}")) & ~is_hot
    for k in keys[1:]:
        on = on & (F.col(k) == F.col(f"_ck_{k}"))
    out = out.join(cold, on, "left")
    return out.select(*rows.columns, *[F.coalesce(f"_hv_{v}", f"_cv_{v}").alias(v) for v in values])


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in ``text``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def prefix_bits(n_rows: int, rows_per_slice: int) -> int:
    """Bits b such that 2**b slices hold about ``rows_per_slice`` rows each."""
    return max(0, (max(n_rows, 1) // rows_per_slice).bit_length())


def map_texts(docs: DataFrame, id_col: str, text_col: str, columns: list[tuple], fn, id_out: str = "id") -> DataFrame:
    """Apply ``fn`` to the texts of each Arrow batch, and carry the ids past it untouched (nulls and 64 bits stay exact).

    ``fn(texts)`` returns ``(rows, values)``: for each output row the number of its text (None: one row per text, in
    order), and a list of values per column. ``columns``: name, Spark type and Arrow type.
    """
    slim = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    names, types = [id_out, *[c[0] for c in columns]], [c[2] for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = fn(batch.column(1).to_pylist())
            ids = batch.column(0) if rows is None else batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(v, t) for v, t in zip(values, types, strict=True)]], names)

    kind = slim.schema["_id"].dataType.simpleString()
    return slim.mapInArrow(run, ", ".join([f"`{id_out}` {kind}", *[f"`{n}` {t}" for n, t, _ in columns]]))
