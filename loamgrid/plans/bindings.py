"""Test tables seen as cells, points, units, samples and parameter tables, in Spark and in SQL."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CELL_HA = 0.09
CELL_M2 = 900.0
#: Grid whose cells are 10 part keys by 5 supplier keys, for points x = supplier, y = part counted down from the top.
GRID = {"a": 5.0, "b": 0.0, "c": 0.0, "d": 0.0, "e": -10.0, "f": 1000.0, "width": 10, "height": 100}

#: The grid of that kind that spans the line items: ``w`` columns, and ``h`` rows down from ``top``, in rows above zero (key 0 lies below its row).
EXTENT_SQL = "gr AS (SELECT max(l_suppkey) // 5 + 1 AS w, max(l_partkey) // 10 + 1 AS top, max(l_partkey) // 10 + 2 AS h FROM lineitem)"
PLACED_SQL = """pt AS (SELECT floor(l_suppkey / 5)::BIGINT AS "col", floor((l_partkey - top * 10) / -10.0)::BIGINT AS "row", l_quantity AS v, year(l_shipdate) AS year, w, h FROM lineitem, gr)"""

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL if SQL can express it."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def dated_cells(spark: SparkSession, sf: str, value: str = "1 + sum(l_linenumber) % 7") -> DataFrame:
    """``year, row, col, value``: line items by year, part and supplier block."""
    keys = [F.year("l_shipdate").alias("year"), F.expr("l_partkey div 10").alias("row"), F.expr("l_suppkey div 5").alias("col")]
    return table(spark, sf, "lineitem").groupBy(*keys).agg(F.expr(value).alias("value"))


def dated_stack(spark: SparkSession, sf: str, layers: dict[str, str]) -> DataFrame:
    """Several layers of dated cells from one scan and one shuffle: ``year, row, col`` and a column per layer."""
    keys = [F.year("l_shipdate").alias("year"), F.expr("l_partkey div 10").alias("row"), F.expr("l_suppkey div 5").alias("col")]
    return table(spark, sf, "lineitem").groupBy(*keys).agg(*[F.expr(v).alias(k) for k, v in layers.items()])


def extent(spark: SparkSession, sf: str, share: int = 1) -> dict[str, float]:
    """The grid that spans the line items, or its upper left part: one ``share``-th of its columns and rows."""
    top = table(spark, sf, "lineitem").agg(F.expr("max(l_suppkey) div 5 + 1").alias("w"), F.expr("max(l_partkey) div 10 + 1").alias("h")).first()
    return GRID | {"f": top["h"] * 10.0, "width": top["w"] // share, "height": (top["h"] + 1) // share}


def stable(c, digits: int = 6):
    """Rounding that a last-bit difference of a sum cannot turn at a tie: ties lie off the edge."""
    return F.floor(c * 10.0**digits + 0.5001) / 10.0**digits


def stable_sql(expression: str, digits: int = 6) -> str:
    return f"floor(({expression}) * 1e{digits} + 0.5001::DOUBLE) / 1e{digits}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for files that a query writes and reads again: under ``spark.checkpoint.dir``, or a temporary one where that is unset and the session is local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(root or tempfile.mkdtemp(prefix='spark-')).rstrip('/')}/loamgrid-{name}-{uuid.uuid4().hex}"


def cells_sql(name: str = "cells", value: str = "(1 + sum(l_linenumber) % 7)::BIGINT") -> str:
    return f'{name} AS (SELECT year(l_shipdate) AS year, l_partkey // 10 AS "row", l_suppkey // 5 AS "col", {value} AS value FROM lineitem GROUP BY ALL)'


#: Cell values that any summation order gives alike: sums are rounded before the one division.
PRICE = "floor(round(sum(l_extendedprice), 2) / count(*))"
QUANTITY = "sum(l_quantity) / count(*)"
INDEX = "round(sum(l_discount), 2) * 10 / count(*)"


def year_of(cells: DataFrame, year: int) -> DataFrame:
    return cells.filter(F.col("year") == year).drop("year")


def points(spark: SparkSession, sf: str) -> DataFrame:
    """``x, y, value`` from line items."""
    return table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("double").alias("x"), F.col("l_partkey").cast("double").alias("y"), F.col("l_quantity").alias("value"))


UNITS_SQL = """units AS (SELECT l_suppkey AS unit_id, r_name AS scenario, sum(l_extendedprice) AS carbon, avg(l_quantity) AS water, avg(l_discount) AS habitat
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)"""


#: The same with sums that any order of addition gives alike, for ranks: units that are equal tie, and fall to their ids.
EXACT_UNITS_SQL = UNITS_SQL.replace("sum(l_extendedprice) AS carbon", "round(sum(l_extendedprice), 2) AS carbon").replace("avg(l_discount)", "round(sum(l_discount), 2) / count(*)")


def units(spark: SparkSession, sf: str, exact: bool = True) -> DataFrame:
    """One row per supplier: three services, and its region as scenario. If ``exact``, as ``EXACT_UNITS_SQL``: sums of amounts to the cent are rounded to it, so no order of addition shows; else as ``UNITS_SQL``."""
    carbon, habitat = F.sum("l_extendedprice"), F.avg("l_discount")
    if exact:
        carbon, habitat = F.round(carbon, 2), F.round(F.sum("l_discount"), 2) / F.count("l_discount")
    li = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("unit_id")).agg(carbon.alias("carbon"), F.avg("l_quantity").alias("water"), habitat.alias("habitat"))
    place = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    s = table(spark, sf, "supplier").join(F.broadcast(place), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 nations
    return li.join(s, F.col("unit_id") == F.col("s_suppkey")).select("unit_id", F.col("r_name").alias("scenario"), "carbon", "water", "habitat")


CRITERIA = [
    {"field": "carbon", "direction": "benefit", "weight": 0.5},
    {"field": "water", "direction": "cost", "weight": 0.25},
    {"field": "habitat", "direction": "benefit", "weight": 0.25},
]
SCORE_SQL = UNITS_SQL + """,
b AS (SELECT min(carbon) c0, max(carbon) c1, min(water) w0, max(water) w1, min(habitat) h0, max(habitat) h1 FROM units),
n AS (SELECT unit_id, scenario, (carbon - c0) / (c1 - c0) AS nc, (w1 - water) / (w1 - w0) AS nw, (habitat - h0) / (h1 - h0) AS nh FROM units, b),
scored AS (SELECT *, nc * 0.5 + nw * 0.25 + nh * 0.25 AS score FROM n)"""

#: lucode, c_above, c_below, c_soil, c_dead; root depth, Kc, vegetated; the seven-class scheme.
POOL_ROWS = [(1, 0.0, 0.0, 20.0, 0.0), (2, 3.0, 1.0, 90.0, 0.5), (3, 60.0, 15.0, 120.0, 5.0), (4, 4.0, 6.0, 100.0, 1.0), (5, 0.0, 0.0, 15.0, 0.0), (6, 1.0, 0.5, 60.0, 0.0), (7, 0.5, 0.2, 50.0, 0.0)]
BIO_ROWS = [(1, 1.0, 1.05, 0), (2, 700.0, 0.8, 1), (3, 3500.0, 1.0, 1), (4, 1000.0, 0.7, 1), (5, 1.0, 1.0, 0), (6, 200.0, 0.3, 0), (7, 300.0, 0.4, 1)]


def values(rows: list[tuple]) -> str:
    show = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else f"{x}::DOUBLE" if isinstance(x, float) else str(x)
    return "(VALUES " + ", ".join("(" + ", ".join(map(show, r)) + ")" for r in rows) + ")"


def pools(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(POOL_ROWS, "lucode long, c_above double, c_below double, c_soil double, c_dead double")


def biophysical(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BIO_ROWS, "lucode long, root_depth double, kc double, lulc_veg int")


PIXELS_SQL = "px AS (SELECT vec_id, label, embedding[1]::DOUBLE AS b1, embedding[2]::DOUBLE AS b2, embedding[3]::DOUBLE AS b3, embedding[4]::DOUBLE AS b4 FROM embeddings)"


def pixels(spark: SparkSession, sf: str) -> DataFrame:
    """``vec_id, class, bands``: the first four dimensions of the embeddings."""
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.col("label").alias("class"), F.expr("transform(slice(embedding, 1, 4), x -> cast(x as double))").alias("bands"))


#: Polygons: an L-shaped outline per nation, on the plane of (column, row) cell centres.
def polygons(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation")
    x, y = F.col("n_nationkey") % 5 * 4.0, F.floor(F.col("n_nationkey") / 5) * 40.0
    p = lambda dx, dy: F.struct((x + dx).cast("double").alias("x"), (y + dy).cast("double").alias("y"))
    ring = F.array(p(0.0, 0.0), p(3.0, 0.0), p(3.0, 20.0), p(2.0, 20.0), p(2.0, 30.0), p(0.0, 30.0))
    return n.select(F.col("n_nationkey").alias("feature_id"), F.array(ring).alias("rings"))


POLYGON_TEST = "(c.col + 0.5 >= n_nationkey % 5 * 4 AND c.row + 0.5 >= n_nationkey // 5 * 40 AND ((c.col + 0.5 < n_nationkey % 5 * 4 + 3 AND c.row + 0.5 < n_nationkey // 5 * 40 + 20) OR (c.col + 0.5 < n_nationkey % 5 * 4 + 2 AND c.row + 0.5 < n_nationkey // 5 * 40 + 30)))"

FACTORS = ["l_returnflag", "l_linestatus", "o_orderpriority"]
SAMPLES_SQL = "s AS (SELECT l_extendedprice AS t, l_returnflag, l_linestatus, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def factor_samples(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_returnflag", "l_linestatus")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_extendedprice").alias("t"), *FACTORS)
