"""The driver's tables read as annotation data, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]

#: Lines across the value range of the events.
LINES = [("l1", 0.0, 50.0, 100.0, 50.0), ("l2", 10.0, 0.0, 10.0, 100.0), ("l3", 0.0, 0.0, 40.0, 100.0)]

SQL = """
WITH images AS (
  SELECT o_orderkey AS image_key, CAST(640 + 160 * (o_orderkey % 8) AS BIGINT) AS width, CAST(480 + 120 * (o_custkey % 6) AS BIGINT) AS height FROM orders),
objects AS (
  SELECT l_orderkey AS image_key,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS BIGINT) AS obj_ord,
    l_returnflag AS name, CAST(l_linenumber % 7 = 0 AS INT) AS difficult, l_partkey % 500 + l_tax * 10 AS xmin, l_suppkey % 300 + l_discount * 5 AS ymin,
    l_partkey % 500 + l_tax * 10 + l_quantity * 3 - 6 AS xmax, l_suppkey % 300 + l_discount * 5 + l_linenumber * 20 AS ymax FROM lineitem),
categories AS (SELECT * FROM (VALUES ('A', 1), ('N', 2), ('R', 3)) t(name, category_id)),
files AS (SELECT doc_id, concat(source, '/', doc_id, '.jpg') AS path, text, length(text) AS length FROM documents),
tracks AS (SELECT 'c' AS camera_id, event_id AS seq, user_id AS pid, CAST(trunc(value) AS INT) AS mx, CAST(json_extract(props, '$.k') AS INT) AS my FROM events),
lines AS (SELECT 'c' AS camera_id, * FROM (VALUES (1, 'l1', 0.0::double, 50.0::double, 100.0::double, 50.0::double), (2, 'l2', 10, 0, 10, 100), (3, 'l3', 0, 0, 40, 100)) t(line_ord, line, ax, ay, bx, "by"))
"""


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return _read(spark, sf_dir, "orders").select(key.alias("image_key"), (640 + 160 * (key % 8)).cast("bigint").alias("width"), (480 + 120 * (F.col("o_custkey") % 6)).cast("bigint").alias("height"))


def objects(spark: SparkSession, sf_dir: str, ordered: bool = True) -> DataFrame:
    """ordered: with obj_ord, which costs a shuffle by image."""
    rows = _read(spark, sf_dir, "lineitem")
    x, y = F.col("l_partkey") % 500 + F.col("l_tax") * 10, F.col("l_suppkey") % 300 + F.col("l_discount") * 5
    place = [F.row_number().over(W.partitionBy("l_orderkey").orderBy(*ORDER)).cast("bigint").alias("obj_ord")] if ordered else []
    return rows.select(
        F.col("l_orderkey").alias("image_key"), *place, F.col("l_returnflag").alias("name"), (F.col("l_linenumber") % 7 == 0).cast("int").alias("difficult"),
        x.alias("xmin"), y.alias("ymin"), (x + F.col("l_quantity") * 3 - 6).alias("xmax"), (y + F.col("l_linenumber") * 20).alias("ymax"),
    )


def categories(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT * FROM VALUES ('A', 1L), ('N', 2L), ('R', 3L) AS t(name, category_id)")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("path"), "text", F.length("text").cast("bigint").alias("length"))


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").select(F.lit("c").alias("camera_id"), F.col("event_id").alias("seq"), F.col("user_id").alias("pid"), F.col("value").alias("cx"), F.get_json_object("props", "$.k").cast("double").alias("cy"))


def lines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("c", k, *line) for k, line in enumerate(LINES, 1)], "camera_id string, line_ord int, line string, ax double, ay double, bx double, by double")
