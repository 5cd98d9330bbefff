"""Access to the driver tables and the window tables Spark derives from them.

The derived tables are plans, never files: they grow with the source tables.

* ``ev_windows``  – events cut per user into 16-sample windows of ``value``,
  label = value of the next event (``y``), NaN copy ``x_nan`` where the event
  is an error.
* ``emb_windows`` – each embedding is one 64-sample window, ``label`` as y.
* ``emb_axes``    – three axes over all 64 samples: the embedding, its reverse,
  and the embedding turned by ``AXIS_TURN`` samples.
* ``li_reg``      – lineitem as a regression table (3 features, price label).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.operators.windows import cut_windows

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

EV_WINDOW = 16        # samples per event window
AXIS_TURN = 21        # the z axis starts at this sample and wraps around


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ev_windows(spark: SparkSession, sf_dir: str, n: int = EV_WINDOW) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", "value",
        F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value_nan"))
    w = cut_windows(ev, "user_id", ["ts", "event_id"], ["value", "value_nan"], n,
                    label_col="value")
    return w.select("window_id", F.col("user_id").alias("subject"), "blk",
                    F.col("value").alias("x"), F.col("value_nan").alias("x_nan"), "y")


def emb_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("window_id"), F.col("embedding").alias("x"),
        F.col("label").cast("double").alias("y"))


def emb_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("window_id"), e.alias("ax"), F.reverse(e).alias("ay"),
        F.concat(F.slice(e, F.lit(AXIS_TURN + 1), F.size(e) - AXIS_TURN), F.slice(e, 1, AXIS_TURN)).alias("az"),
        F.col("label").cast("double").alias("y"))


LI_FEATURES = ("l_quantity", "l_discount", "l_tax")


def li_reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as (row key columns, features array, y)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     F.array(*[F.col(c).cast("double") for c in LI_FEATURES]).alias("features"),
                     F.col("l_extendedprice").cast("double").alias("y"))


# Total order of lineitem rows (only the full row is unique).
LI_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus")
WEAR_WINDOW = 64       # samples per lineitem window (per supplier)
LONG_WINDOW = 1024     # samples per long lineitem window (per line status: two hot subjects)


def li_wear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wearable-style windows: per supplier, 64 consecutive lines; bvp = price,
    acc = (quantity, discount, tax), eda = quantity*(1-discount);
    y = price of the next line."""
    li = table(spark, sf_dir, "lineitem").withColumn(
        "eda_src", F.col("l_quantity") * (1 - F.col("l_discount")))
    w = cut_windows(li, "l_suppkey", list(LI_ORDER),
                    ["l_extendedprice", "l_quantity", "l_discount", "l_tax", "eda_src"], WEAR_WINDOW,
                    label_col="l_extendedprice")
    return w.select("window_id", F.col("l_suppkey").alias("subject"), "blk",
                    F.col("l_extendedprice").alias("bvp"), F.col("l_quantity").alias("acc_x"),
                    F.col("l_discount").alias("acc_y"), F.col("l_tax").alias("acc_z"),
                    F.col("eda_src").alias("eda"), "y")


def li_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-rate-style windows (twelve channels) from the same lineitem windows."""
    w = li_wear(spark, sf_dir)
    return w.select("window_id", "subject", "blk", "y",
                    F.col("acc_z").alias("temp"), F.col("acc_y").alias("eda"), F.col("acc_x").alias("hr"),
                    "bvp", "acc_x", "acc_y", "acc_z", F.col("bvp").alias("ecg"), F.col("acc_x").alias("breath"),
                    F.col("acc_z").alias("zacc_x"), F.col("acc_y").alias("zacc_y"), F.col("acc_x").alias("zacc_z"))


def li_long(spark: SparkSession, sf_dir: str, n: int = LONG_WINDOW) -> DataFrame:
    """Long windows of prices per line status (two subjects hold all rows)."""
    li = table(spark, sf_dir, "lineitem").withColumn(
        "status_id", F.when(F.col("l_linestatus") == "O", F.lit(1)).otherwise(F.lit(0)))
    w = cut_windows(li, "status_id", list(LI_ORDER), ["l_extendedprice"], n)
    return w.select("window_id", F.col("status_id").alias("subject"), "blk", F.col("l_extendedprice").alias("x"))
