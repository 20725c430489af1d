"""15-minute metrics that late rows correct.

The stateful step keeps one row per (bucket, source, user) for ``lateness`` and emits, in update
mode, those that a micro-batch changed, from a bucket's first rows on.  Each batch stores them as
versions (partitions of day and batch id, so a replayed batch replaces its own), and writes a new
version of exactly the buckets they belong to, from the latest version of each of their users.
A reader takes the latest version of each bucket: the batch result over all rows that are at most
``lateness`` late.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedlens.streaming.alerts_stream import bucket_user_stream, closed_buckets, feed_15min_rows

LATENESS = "2 days"

USERS_SCHEMA = "date_time timestamp_ntz, source string, user_id long, likes long, views long, n long, date date, batch_id long"
BUCKETS_SCHEMA = "date_time timestamp_ntz, source string, users long, likes long, views long, n long, date date, batch_id long"


def _write_versions(rows: DataFrame, path: str, batch_id: int) -> None:
    versions = rows.withColumn("date", F.to_date("date_time")).withColumn("batch_id", F.lit(batch_id).cast("long"))
    versions.repartition("date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "batch_id").parquet(path)


def correct_batch(spark: SparkSession, changed: DataFrame, batch_id: int, base: str) -> None:
    """foreachBatch body: store the changed user rows, write a new version of their buckets."""
    _write_versions(changed, f"{base}/users", batch_id)
    touched = changed.select("date_time", "source").distinct()
    days = [r["d"] for r in touched.select(F.to_date("date_time").alias("d")).distinct().collect()]  # the days within the lateness
    if not days:
        return
    versions = spark.read.schema(USERS_SCHEMA).parquet(f"{base}/users").where(F.col("date").isin(days) & (F.col("batch_id") <= batch_id))
    measures = ["likes", "views", "n"]
    last = F.max_by(F.struct(*measures), "batch_id").alias("last")
    users = versions.join(touched, ["date_time", "source"], "left_semi").groupBy("date_time", "source", "user_id").agg(last)
    _write_versions(closed_buckets(users.select("date_time", "source", "user_id", "last.*")), f"{base}/buckets", batch_id)


def read_versions(spark: SparkSession, base: str) -> DataFrame:
    """All versions of all buckets."""
    return spark.read.schema(BUCKETS_SCHEMA).parquet(f"{base}/buckets")


def current_buckets(spark: SparkSession, base: str, closed_by: dt.datetime | None = None) -> DataFrame:
    """The latest version of each (bucket, source); with ``closed_by`` of the buckets that end until then."""
    rows = read_versions(spark, base)
    if closed_by is not None:
        rows = rows.where(F.col("date_time") + F.expr("INTERVAL 15 MINUTES") <= F.lit(closed_by).cast("timestamp_ntz"))
    columns = ["users", "likes", "views", "n"]
    return rows.groupBy("date_time", "source").agg(F.max_by(F.struct(*columns), "batch_id").alias("last")).select("date_time", "source", "last.*")


def start_corrected_15min(spark: SparkSession, events: DataFrame, base: str, lateness: str = LATENESS, trigger: dict | None = None) -> StreamingQuery:
    """Keeps ``base``/buckets up to date with a stream of generic events; rows more than ``lateness`` late are dropped."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read three times; a lost cache is recomputed for the same batch id
        try:
            correct_batch(spark, batch, batch_id, base)
        finally:
            batch.unpersist()

    w = bucket_user_stream(events, lateness).writeStream.outputMode("update").foreachBatch(run)
    return w.option("checkpointLocation", f"{base}/checkpoint").trigger(**(trigger or {"availableNow": True})).start()


def corrected_feed_15min(spark: SparkSession, base: str, closed_by: dt.datetime | None = None) -> DataFrame:
    """``alerts.feed_15min`` columns from the current buckets."""
    return feed_15min_rows(current_buckets(spark, base, closed_by))
