"""Unique users kept as values that merge: sketches and bitmaps per day.

A day's users are reduced once, when the day is loaded; weeks, windows and combinations of
tables are then merged from the stored rows, without the raw events.

* sketches (HyperLogLog): estimates, a few KB per (day, gender, os) whatever the number of users;
* bitmaps: exact counts, unions and intersections, one row per day and 32,768 user ids.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.time import day_range

SKETCH_DIMENSIONS = ["gender", "os"]
#: 2 ^ LG_K registers: a relative standard error of 1.04 / sqrt(2 ^ LG_K)
LG_K = 12
SKETCH_SCHEMA = "gender bigint, os string, sketch binary, event_date date"
BITMAP_SCHEMA = "bucket bigint, users binary, event_date date"


def _days(table: DataFrame, first: dt.date | str | None, last: dt.date | str | None) -> DataFrame:
    rows = table if first is None else table.where(day_range(table, first, last if last is not None else first))
    return rows.where(F.col("user_id").isNotNull()).withColumn("event_date", F.to_date("time"))


def _write(daily: DataFrame, path: str) -> None:
    """Replaces exactly the days that ``daily`` holds."""
    daily.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)


def write_daily_sketches(table: DataFrame, path: str, first: dt.date | str | None = None, last: dt.date | str | None = None, lg_k: int = LG_K) -> None:
    """One sketch of the users per (day, gender, os), for the days in [first, last] or all."""
    rows = _days(table, first, last)
    _write(rows.groupBy("event_date", *SKETCH_DIMENSIONS).agg(F.hll_sketch_agg("user_id", F.lit(lg_k)).alias("sketch")), path)


def read_daily_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SKETCH_SCHEMA).parquet(path)


def merged_uniques(sketches: DataFrame, *by) -> DataFrame:
    """(``by``, users_approx): the estimated users of all days and dimensions that are merged."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("users_approx"))


def sketch_check(exact: DataFrame, approx: DataFrame, keys: list[str], lg_k: int = LG_K) -> DataFrame:
    """(keys, users_exact, within_3_sigma) of exact counts and merged estimates."""
    sigma = 1.04 / 2 ** (lg_k / 2)
    near = F.abs(F.col("users_approx") - F.col("users_exact")) <= 3 * sigma * F.col("users_exact")
    return exact.join(approx, keys).select(*keys, "users_exact", near.alias("within_3_sigma"))


def write_daily_bitmaps(table: DataFrame, path: str, first: dt.date | str | None = None, last: dt.date | str | None = None) -> None:
    """The users of each day as bitmaps of 32,768 ids, for the days in [first, last] or all."""
    rows = _days(table, first, last).select("event_date", F.bitmap_bucket_number("user_id").alias("bucket"), F.bitmap_bit_position("user_id").alias("place"))
    _write(rows.groupBy("event_date", "bucket").agg(F.bitmap_construct_agg("place").alias("users")), path)


def read_daily_bitmaps(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BITMAP_SCHEMA).parquet(path)


def audience_from_bitmaps(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """Per day, from both tables' bitmaps: users active anywhere, in the feed, in the messenger, in both."""
    rows = feed.withColumn("in_feed", F.lit(1)).unionByName(messages.withColumn("in_feed", F.lit(0)))
    count = lambda bitmap: F.bitmap_count(bitmap)
    per = rows.groupBy("event_date", "bucket").agg(
        count(F.bitmap_or_agg("users")).alias("users"),
        F.sum(F.when(F.col("in_feed") == 1, count(F.col("users")))).alias("feed_users"),
        F.sum(F.when(F.col("in_feed") == 0, count(F.col("users")))).alias("message_users"),
        # a table has one bitmap per day and bucket: two rows are both tables
        F.when(F.count(F.lit(1)) == 2, count(F.bitmap_and_agg("users"))).otherwise(0).alias("both_users"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
    return per.groupBy(F.col("event_date").alias("date")).agg(*[total(c) for c in ("users", "feed_users", "message_users", "both_users")])
