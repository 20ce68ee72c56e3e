"""Class areas kept up to date while cell files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamgrid.sources.tables import CELLS


def class_counts_stream(spark: SparkSession, path: str) -> DataFrame:
    """Streaming ``layer_id, value, count`` over Parquet cell files that land in ``path``."""
    return spark.readStream.schema(CELLS).parquet(path).filter("value IS NOT NULL").groupBy("layer_id", "value").agg(F.count(F.lit(1)).alias("count"))
