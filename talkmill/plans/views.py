"""Recordings made of the driver's tables: the same rows in Spark and, as SQL, in DuckDB.

events: a user is a recording, an event a word or span. conversations: a conversation
is a recording, a turn a segment. lineitem: an order is a recording, a line's number a
sampled frame and its values a box. embeddings: vectors of faces with known labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import micros

#: 2024-01-01, seconds; length of the events' month.
EPOCH, MONTH_S = 1_704_067_200, 2_592_000.0
WIDTH, HEIGHT = 1280, 720


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("turn") * 4.0
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("rec"), F.col("turn").alias("pos"), F.when(F.col("role") != "system", F.col("role")).alias("speaker"), start.alias("start"),
        (start + F.pmod(F.length("text"), F.lit(90)) / 10.0).alias("end"), "text", (F.pmod("turn", F.lit(3)) == 2).alias("flag"),
    )


SEGMENTS = """segments AS (
  SELECT conv_id AS rec, turn AS pos, CASE WHEN role <> 'system' THEN role END AS speaker, turn * 4.0::DOUBLE AS start,
         turn * 4.0::DOUBLE + (length(text) % 90) / 10.0::DOUBLE AS "end", text, turn % 3 = 2 AS flag
  FROM conversations)"""


def said(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words: rec, pos, speaker, start, end, flag."""
    start = micros("ts") / 1_000_000.0 - EPOCH
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("rec"), F.col("event_id").alias("pos"), F.when(F.pmod("event_id", F.lit(17)) != 0, F.col("event_type")).alias("speaker"), start.alias("start"),
        (start + F.col("value") * 60.0).alias("end"), (F.pmod(F.regexp_extract("props", r'"k": ([0-9]+)', 1).cast("int"), F.lit(2)) == 0).alias("flag"), "value",
    )


SAID = f"""said AS (
  SELECT user_id AS rec, event_id AS pos, CASE WHEN event_id % 17 <> 0 THEN event_type END AS speaker,
         epoch_us(ts) / 1000000.0::DOUBLE - {EPOCH} AS start, epoch_us(ts) / 1000000.0::DOUBLE - {EPOCH} + value * 60.0::DOUBLE AS "end",
         CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INT) % 2 = 0 AS flag, value
  FROM events)"""


def boxes(spark: SparkSession, sf_dir: str, every: int = 4) -> DataFrame:
    """Detections: rec, frame, det_pos, x1, y1, x2, y2, score, sim; dealt by recording, so what follows by recording is not dealt again."""
    line = table(spark, sf_dir, "lineitem").repartition("l_orderkey")
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    x, y = F.pmod("l_partkey", F.lit(60)).cast("double"), F.pmod("l_suppkey", F.lit(40)).cast("double")
    return line.select(
        F.col("l_orderkey").alias("rec"), ((F.col("l_linenumber") - 1) * every).cast("long").alias("frame"), (F.row_number().over(w) - 1).cast("long").alias("det_pos"), x.alias("x1"), y.alias("y1"),
        (x + 20 + F.col("l_quantity")).alias("x2"), (y + 30 + F.col("l_quantity")).alias("y2"), F.col("l_discount").alias("score"), F.when(F.col("l_returnflag") != "R", F.col("l_tax") * 10).alias("sim"),
    )


BOXES = """boxes AS (
  SELECT l_orderkey AS rec, CAST((l_linenumber - 1) * 4 AS BIGINT) AS frame,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) - 1 AS det_pos,
         CAST(l_partkey % 60 AS DOUBLE) AS x1, CAST(l_suppkey % 40 AS DOUBLE) AS y1,
         l_partkey % 60 + 20 + l_quantity AS x2, l_suppkey % 40 + 30 + l_quantity AS y2, l_discount AS score,
         CASE WHEN l_returnflag <> 'R' THEN l_tax * 10 END AS sim
  FROM lineitem)"""


def faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faces: rec, pos, embedding (double), label, is_uniform, box_area; ten recordings."""
    return table(spark, sf_dir, "embeddings").select(
        F.pmod("vec_id", F.lit(10)).alias("rec"), F.col("vec_id").alias("pos"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label"),
        (F.pmod("vec_id", F.lit(7)) != 0).alias("is_uniform"), (F.pmod("vec_id", F.lit(50)) * 10.0).alias("box_area"),
    )


FACES = """faces AS (
  SELECT vec_id % 10 AS rec, vec_id AS pos, embedding::DOUBLE[] AS embedding, label::BIGINT AS label, vec_id % 7 <> 0 AS is_uniform,
         (vec_id % 50) * 10.0::DOUBLE AS box_area FROM embeddings)"""


def media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media probes made of orders, with their customer as the reference."""
    order, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    key = F.col("o_orderkey")
    ref = customer.select(F.col("c_custkey").alias("o_custkey"), (F.abs("c_acctbal") * 60).cast("long").alias("ref_size"), (F.col("c_nationkey") * 100.0).alias("ref_duration"))
    rows = order.select(
        key.alias("rec"), "o_custkey", (F.pmod(key, F.lit(97)) != 0).alias("path_exists"), F.when(F.pmod(key, F.lit(89)) != 0, F.col("o_totalprice").cast("long")).alias("size"),
        (F.floor(F.col("o_totalprice") / 200) + F.pmod(key, F.lit(5)) / 2.0 - 1).cast("double").alias("duration"), (F.col("o_orderstatus") != "P").alias("has_video"), (F.pmod(key, F.lit(3)) != 0).alias("has_audio"),
        F.when(F.pmod(key, F.lit(11)) != 0, F.pmod(key, F.lit(13))).alias("n_frames"), (F.pmod(key, F.lit(4)) != 0).alias("wants_ref"),
    )
    return rows.join(ref, "o_custkey", "left").drop("o_custkey")


MEDIA = """media AS (
  SELECT o_orderkey AS rec, o_orderkey % 97 <> 0 AS path_exists, CASE WHEN o_orderkey % 89 <> 0 THEN CAST(trunc(o_totalprice) AS BIGINT) END AS size,
         CAST(floor(o_totalprice / 200) + (o_orderkey % 5) / 2.0::DOUBLE - 1 AS DOUBLE) AS duration, o_orderstatus <> 'P' AS has_video, o_orderkey % 3 <> 0 AS has_audio,
         CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 13 END AS n_frames, o_orderkey % 4 <> 0 AS wants_ref,
         CAST(trunc(abs(c_acctbal) * 60) AS BIGINT) AS ref_size, c_nationkey * 100.0::DOUBLE AS ref_duration
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey)"""
