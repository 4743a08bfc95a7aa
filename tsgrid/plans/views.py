"""Keyed series views over the driver's tables (events, lineitem).

RAW    events shaped as raw activity rows: square_id = user_id + 1,
       time_interval = epoch ms of the 10-minute floor, country_code = event_type,
       internet_traffic as text with 'NA' where event_type = 'error' (null tokens).
HOURLY events by event_type x hour, y = sum(value); step 1 h, period 24.
DAILY  lineitem by l_returnflag x ship day, y = sum(l_quantity); step 1 day, period 7.
GRID   lineitem totals by part, id = l_partkey + 1.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import epoch_seconds, floor_time
from ..spec import SeriesSpec

HOURLY = SeriesSpec(key=("event_type",), time="ts", value="y", step="1 hour", period=24)
HOURLY_SPLIT = "2024-01-24"
DAILY = SeriesSpec(key=("l_returnflag",), time="ts", value="y", step="1 day", period=7)
DAILY_SPLIT = "2001-01-01"
STORE = SeriesSpec(key=("square_id",), time="datetime", value="internet_traffic",
                   step="10 minutes", period=144)
GRID_WIDTH = 50


def _exact_sum(c: str):
    """Sum of 2-decimal amounts in DECIMAL, so the order of addition cannot matter."""
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return (ev.select("event_type", floor_time("ts", 3600).alias("ts"), "value")
              .groupBy("event_type", "ts").agg(_exact_sum("value").alias("y")))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.select("l_returnflag", floor_time("l_shipdate", 86400).alias("ts"), "l_quantity")
              .groupBy("l_returnflag", "ts").agg(_exact_sum("l_quantity").alias("y")))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the raw activity shape (8 columns, traffic as text)."""
    ev = table(spark, sf_dir, "events")
    s = epoch_seconds("ts")
    ms = (s - F.pmod(s, F.lit(600))) * 1000
    traffic = F.when(F.col("event_type") == "error", F.lit("NA")).otherwise(F.col("value").cast("string"))
    nul = F.lit(None).cast("double")
    return ev.select((F.col("user_id") + 1).cast("int").alias("square_id"),
                     ms.cast("long").alias("time_interval"),
                     F.col("event_type").alias("country_code"),
                     nul.alias("sms_in"), nul.alias("sms_out"), nul.alias("call_in"), nul.alias("call_out"),
                     traffic.alias("internet_traffic"),
                     F.date_format(F.col("ts"), "yyyy-MM-dd").alias("day"))


def part_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy((F.col("l_partkey") + 1).alias("square_id"))
              .agg(F.sum("l_quantity").alias("total")))
