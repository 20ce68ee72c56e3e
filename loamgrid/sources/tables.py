"""Scans and sinks of tables, cell tables, point files, vectors, JSON evidence and file inventories."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loamgrid.functions.scalars import finite, valid

CELLS = T.StructType([T.StructField("layer_id", T.StringType()), T.StructField("row", T.LongType()), T.StructField("col", T.LongType()), T.StructField("value", T.DoubleType())])


def read_csv(spark: SparkSession, path: str, required: list[str], numeric: list[str] = []) -> DataFrame:
    """CSV with a header; a byte-order mark is dropped, required columns are checked, bad numbers are an error with counts."""
    raw = spark.read.option("header", True).csv(path)
    df = raw.toDF(*[c.lstrip("﻿").strip() for c in raw.columns])
    lacking = [c for c in required if c not in df.columns]
    if lacking:
        raise ValueError(f"{path} lacks {lacking}")
    if not numeric:
        return df
    number = lambda c: F.col(c).try_cast("double")
    bad = df.agg(*[F.sum(F.when(~F.coalesce(finite(number(c)), F.lit(False)), 1).otherwise(0)).alias(c) for c in numeric]).first()
    wrong = {c: bad[c] for c in numeric if bad[c]}
    if wrong:
        raise ValueError(f"{path} has values that are no finite numbers: {wrong}")
    return df.withColumns({c: number(c) for c in numeric})


def read_cells(spark: SparkSession, path: str, layers: list[str] | None = None, nodata: float | None = None) -> DataFrame:
    """Valid cells of a Parquet cell table; layers are a partition column, so others are not read."""
    df = spark.read.parquet(path)
    if layers is not None:
        df = df.filter(F.col("layer_id").isin(*layers))
    return df.filter(valid(F.col("value"), nodata))


def write_cells(cells: DataFrame, path: str, block: int = 256) -> None:
    """Cell table partitioned by layer and sorted by row block, so that joins and scans prune."""
    blocked = cells.withColumn("row_block", F.floor(F.col("row") / block))
    blocked.repartition("layer_id", "row_block").sortWithinPartitions("layer_id", "row_block", "row", "col").write.partitionBy("layer_id").parquet(path)


def read_depth_points(spark: SparkSession, path: str, x: int = 0, y: int = 1, w: int = 2, delimiter: str | None = None, to_metres: float = 0.001, flip: bool = True) -> tuple[DataFrame, DataFrame]:
    """Subsidence points ``file, line, x, y, value`` (depth in metres, positive down) and the rejected lines with reason.

    Blank lines and lines that start with ``#``, ``//`` or ``;`` are skipped; fields are split by the delimiter or by commas and spaces.
    """
    text = spark.read.text(path).select(F.input_file_name().alias("file"), F.trim("value").alias("line"))
    text = text.filter((F.col("line") != "") & ~F.col("line").rlike(r"^(#|//|;)"))
    pattern = r"[,\s]+" if delimiter is None else r"\Q" + delimiter + r"\E"
    parts = text.withColumn("p", F.split("line", pattern))
    num = lambda i: F.get("p", F.lit(i)).try_cast("double")
    out = parts.select("file", "line", num(x).alias("x"), num(y).alias("y"), (num(w) * to_metres * (-1 if flip else 1)).alias("value"), F.size("p").alias("fields"))
    why = F.when(F.col("fields") <= max(x, y, w), "too few fields").when(~(finite(F.col("x")) & finite(F.col("y")) & finite(F.col("value"))), "not a number").when(F.col("value") < 0, "negative depth")
    marked = out.withColumn("reason", why)
    return marked.filter("reason IS NULL").drop("reason", "fields"), marked.filter("reason IS NOT NULL").select("file", "line", "reason")


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """``feature_id, props, geom_type, coordinates`` (JSON text)``, crs`` of every feature."""
    schema = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>, crs struct<properties:struct<name:string>>"
    doc = spark.read.schema(schema).json(path, multiLine=True)
    f = doc.select(F.posexplode("features").alias("feature_id", "f"), F.col("crs.properties.name").alias("crs"))
    return f.select("feature_id", F.col("f.properties").alias("props"), F.col("f.geometry.type").alias("geom_type"), F.col("f.geometry.coordinates").alias("coordinates"), "crs")


#: What stands before the value of a feature's type: the feature's opening brace, and an id if there is one.
_FEATURE_HEAD = r'\{\s*(?:"id"\s*:\s*(?:"[^"]*"|[-+.0-9eE]+|null)\s*,\s*)?"type"\s*:\s*$'
_CRS = r'"crs"\s*:\s*\{[^}]*?"name"\s*:\s*"([^"]*)"'


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_geojson``, for documents of any size: one file is read by many tasks, also if it is a single line.

    The text is cut at the value ``"Feature"``, which every feature of RFC 7946 has once, so a row is what follows it up to the next feature's type. Features have to begin with their type, or with
    id and type, as writers put them; elsewhere the value makes the query fail rather than lose a feature, and ``read_geojson`` takes such a document whole. Features are numbered
    by file, from counts per block of the file and a window inside each.
    """
    rows = spark.read.option("lineSep", '"Feature"').text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    held = rows.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.max_by(F.regexp_extract("value", _CRS, 1), "_at").alias("_last"), F.min_by(F.regexp_extract("value", _CRS, 1), "_at").alias("_first")
    )  # a row per block
    before = Window.partitionBy("_file").orderBy("_block")
    whole = Window.partitionBy("_file")
    upto = F.coalesce(F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    crs = F.coalesce(F.nullif(F.min_by("_first", "_block").over(whole), F.lit("")), F.nullif(F.max_by("_last", "_block").over(whole), F.lit("")))
    held = held.select(F.col("_file").alias("_f"), F.col("_block").alias("_b"), upto.alias("_base"), F.sum("_n").over(whole).alias("_all"), crs.alias("crs"))
    numbered = rows.withColumn("_i", F.row_number().over(Window.partitionBy("_file", "_block").orderBy("_at")))
    numbered = numbered.join(held, (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b"))).withColumn("_k", F.col("_base") + F.col("_i") - 1)
    sound = (F.col("_k") == F.col("_all") - 1) | F.col("value").rlike(_FEATURE_HEAD)
    wrong = F.raise_error(F.concat(F.lit("a feature that does not begin with its type, in "), F.col("_file"))).cast("boolean")
    body = F.from_json(F.concat(F.lit('{"type":"Feature"'), "value"), "properties map<string,string>, geometry struct<type:string,coordinates:string>")  # what follows the feature is not read
    out = numbered.filter(F.when(sound, F.col("_k") > 0).otherwise(wrong)).withColumn("_body", body)
    return out.select((F.col("_k") - 1).cast("int").alias("feature_id"), F.col("_body.properties").alias("props"), F.col("_body.geometry.type").alias("geom_type"), F.col("_body.geometry.coordinates").alias("coordinates"), "crs")


def read_roi_xml(spark: SparkSession, path: str) -> DataFrame:
    """``class, feature_id``: one sample per polygon of each region; regions without a name are numbered."""
    schema = "_name string, GeometryDef struct<Polygon:array<string>>"
    regions = spark.read.format("xml").option("rowTag", "Region").schema(schema).load(path)
    placed = regions.withColumn("_file", F.input_file_name()).withColumn("_n", F.monotonically_increasing_id()).withColumn("_named", F.nullif(F.trim("_name"), F.lit("")))
    count = F.sum(F.when(F.col("_named").isNull(), 1)).over(Window.partitionBy("_file").orderBy("_n"))  # by the place in the file, however the file was split
    numbered = placed.withColumn("_place", count)
    name = F.coalesce("_named", F.concat(F.lit("unnamed_region_"), F.col("_place").cast("string")))
    return numbered.select(name.alias("class"), F.posexplode("GeometryDef.Polygon").alias("feature_id", "polygon")).drop("polygon")


def assemble_evidence(spark: SparkSession, folder: str, patterns: dict[str, list[str]], per_folder: bool = False) -> DataFrame:
    """``folder, section, file, body``: for each section the first file by pattern order, then by name, of the whole tree or of each of its folders.

    ``body`` goes to the evidence gate as it is.
    """
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(folder).select(F.input_file_name().alias("file"), F.col("value").alias("body"))
    files = files.withColumn("folder", F.regexp_replace("file", "/[^/]*$", "") if per_folder else F.lit(folder))
    rules = spark.createDataFrame([(s, i, p) for s, ps in patterns.items() for i, p in enumerate(ps)], "section string, priority int, pattern string")
    hits = files.join(F.broadcast(rules), F.expr("file rlike pattern"))
    first = Window.partitionBy("folder", "section").orderBy("priority", "file")
    return hits.withColumn("n", F.row_number().over(first)).filter("n = 1").select("folder", "section", "file", "body")


def write_result(df: DataFrame, path: str, columns: list[str], order: list[str] = [], fmt: str = "csv") -> None:
    """Result in a fixed column order, sorted only here."""
    out = df.select(*columns)
    writer = (out.orderBy(*order) if order else out).write
    writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path)


def write_sidecar(spark: SparkSession, path: str, metadata: dict) -> None:
    """One-line JSON beside a result: bounds, weights, row counts and the aggregation rule that was really used."""
    spark.createDataFrame([(json.dumps(metadata, sort_keys=True),)], "value string").coalesce(1).write.text(path)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """``path, bytes, sha256`` of every file of a tree. A file is one row of up to 2 GB, by its reader; empty files, which the reader passes by, come from its own listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    found = files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    listed = spark.createDataFrame([(unquote(p).replace("file:///", "file:/"),) for p in files.inputFiles()], "path string")
    return found.unionByName(listed.join(found, "path", "left_anti").select("path", F.lit(0).cast("long").alias("bytes"), F.lit(hashlib.sha256(b"").hexdigest()).alias("sha256")))


def directory_digest(inventory: DataFrame, root: str) -> DataFrame:
    """``sha256, files, bytes`` of a tree: SHA-256 over path and digest of every file, one after the other without separators, by the parts of their relative paths.

    Such a hash is sequential by nature: the sorted lines go through one task as a stream, of which it holds a batch at a time.
    """
    rel = F.col("path").substr(F.locate(root, F.col("path")) + len(root), F.length("path"))
    lines = inventory.select(F.regexp_replace(rel, "^/+", "").alias("rel"), "sha256", "bytes").repartition(1).sortWithinPartitions(F.replace("rel", F.lit("/"), F.lit("\0")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, files, total = hashlib.sha256(), 0, 0
        for batch in batches:
            for name, own, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                digest.update(name.encode("utf-8") + own.encode("ascii"))
                files, total = files + 1, total + size
        yield pa.RecordBatch.from_pydict({"sha256": [digest.hexdigest()], "files": pa.array([files], pa.int64()), "bytes": pa.array([total], pa.int64())})

    return lines.mapInArrow(run, "sha256 string, files long, bytes long")
