"""Streaming 15-minute metrics and alerts.

Event time is ``time`` cast to TIMESTAMP (a watermark needs it).  A bucket is
emitted once the watermark passes its end, which is the streaming form of the
batch rule "only closed buckets".  Rows later than the watermark are dropped;
the batch alert instead re-reads the last two days on each run, so it absorbs
late rows.

Exact distinct users per bucket without ``count_distinct`` (not supported on
streams): the one stateful operator aggregates per (bucket, source, user) and
emits a bucket's rows together once the watermark passes its end; each
micro-batch then counts them per bucket in ``foreachBatch`` (a plain batch
aggregation).  State is one row per active user and open bucket, cleared by
the watermark.  The output is the batch result over the rows that were not late, for
every bucket that ends at or before the final watermark (max event time - 15 minutes);
rows that arrive later than the watermark are missing from it.

``start_alert_stream`` evaluates the interquartile-range rule in
``foreachBatch`` on every newly closed bucket of each metric; every output is
written per batch id with dynamic partition overwrite, so a replayed batch
replaces its own rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedlens.functions.time import hhmm
from feedlens.operators import alerts
from feedlens.sources.events import EVENTS_SCHEMA, feed_actions, message_actions

BUCKET = "15 minutes"

SERIES_SCHEMA = "metric string, date_time timestamp_ntz, value double, date date, batch_id long"


def read_event_stream(
    spark: SparkSession, path: str | None = None, fmt: str = "parquet", schema=EVENTS_SCHEMA, **options
) -> DataFrame:
    """A stream of event rows from any streaming source (files need a declared
    schema; e.g. ``fmt="kafka"`` with its options and a parsing projection)."""
    r = spark.readStream.format(fmt).options(**options)
    if schema is not None and fmt != "kafka":
        r = r.schema(schema)
    return r.load(path) if path is not None else r.load()


def _tagged(feed: DataFrame, messages: DataFrame) -> DataFrame:
    f = feed.select(
        F.lit("feed").alias("source"),
        "user_id",
        "time",
        (F.col("action") == "like").cast("int").alias("is_like"),
        (F.col("action") == "view").cast("int").alias("is_view"),
    )
    m = messages.select(F.lit("messages").alias("source"), "user_id", "time", F.lit(0).alias("is_like"), F.lit(0).alias("is_view"))
    return f.unionByName(m)


def bucket_user_stream(events: DataFrame, watermark: str = BUCKET) -> DataFrame:
    """Closed 15-minute buckets per (source, user) from a stream of generic events."""
    return bucket_user_from(feed_actions(events), message_actions(events), watermark)


def bucket_user_from(feed: DataFrame, messages: DataFrame, watermark: str = BUCKET) -> DataFrame:
    """The stateful step: one row per (bucket, source, user) with the user's
    likes, views and rows, emitted once the watermark passes the bucket's end.
    All users of a bucket are emitted in the same micro-batch."""
    rows = _tagged(feed, messages).where(F.col("user_id").isNotNull())
    rows = rows.withColumn("et", F.col("time").cast("timestamp")).withWatermark("et", watermark)
    per_user = rows.groupBy(F.window("et", BUCKET).alias("w"), "source", "user_id").agg(
        F.sum("is_like").alias("likes"), F.sum("is_view").alias("views"), F.count(F.lit(1)).alias("n")
    )
    return per_user.select(F.col("w.start").cast("timestamp_ntz").alias("date_time"), "source", "user_id", "likes", "views", "n")


def closed_buckets(per_user: DataFrame) -> DataFrame:
    """Batch step (inside ``foreachBatch``): per (bucket, source) the exact
    distinct users, likes, views and rows."""
    return per_user.groupBy("date_time", "source").agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("likes").alias("likes"),
        F.sum("views").alias("views"),
        F.sum("n").alias("n"),
    )


def feed_15min_rows(buckets: DataFrame) -> DataFrame:
    """``alerts.feed_15min`` columns from closed buckets."""
    b = buckets.where(F.col("source") == "feed")
    return b.select(
        "date_time",
        F.to_date("date_time").alias("date"),
        hhmm("date_time").alias("timeHM"),
        F.col("users").alias("users_feed"),
        F.col("views").cast("bigint").alias("views"),
        F.col("likes").cast("bigint").alias("likes"),
        F.try_divide(F.col("likes"), F.col("views").cast("double")).alias("CTR"),
    )


def start_feed_15min(events: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Streaming form of ``alerts.feed_15min``: one row per closed bucket,
    written per batch id (a replayed batch replaces its own rows)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = feed_15min_rows(closed_buckets(batch)).withColumn("batch_id", F.lit(batch_id))
        (
            rows.repartition("batch_id")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(out_path)
        )

    w = bucket_user_stream(events).writeStream.outputMode("append").foreachBatch(run)
    w = w.option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def _metric_rows(buckets: DataFrame) -> DataFrame:
    """Closed buckets (per source) to the six long metric rows."""
    feed = buckets.where(F.col("source") == "feed").select(
        "date_time",
        F.col("users").cast("double").alias("users_feed"),
        F.col("views").cast("double").alias("views"),
        F.col("likes").cast("double").alias("likes"),
        F.try_divide(F.col("likes"), F.col("views").cast("double")).alias("CTR"),
    )
    msgs = buckets.where(F.col("source") == "messages").select(
        "date_time", F.col("users").cast("double").alias("users_mes"), F.col("n").cast("double").alias("messages_cnt")
    )
    return feed.unpivot("date_time", alerts.FEED_METRICS, "metric", "value").unionByName(
        msgs.unpivot("date_time", alerts.MESSAGE_METRICS, "metric", "value")
    )


def _write_batch(df: DataFrame, path: str) -> None:
    """Partitions (date, batch_id): a replayed batch replaces exactly its own
    rows, and readers of recent days prune by date."""
    (
        df.withColumn("date", F.to_date("date_time"))
        .repartition("date", "batch_id")  # one file per partition, not one per task and partition
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "batch_id")
        .parquet(path)
    )


def alert_batch(spark: SparkSession, per_user: DataFrame, batch_id: int, series_path: str, alerts_path: str,
                a: float = 5.0, n: int = 5, history: dt.timedelta = dt.timedelta(days=2)) -> None:
    """foreachBatch body: store the new closed buckets, then judge each of them.

    Every (metric, new bucket) is judged as if it were the latest: quartiles and smoothing
    look back only (``iqr_bands(centred=False)``), over the stored buckets of ``history``
    before the batch's first bucket and the batch itself.  So buckets that close together, after
    a pause or in one ``availableNow`` run, give the same rows as if they had closed one by one.
    It runs several actions on ``per_user``: persist the batch around the call
    (``start_alert_stream`` does)."""
    if per_user.isEmpty():
        return
    new = _metric_rows(closed_buckets(per_user))
    _write_batch(new.withColumn("batch_id", F.lit(batch_id)), series_path)
    # days that can hold the history of this batch's buckets (partition pruning)
    first = new.agg(F.min("date_time").alias("t")).select(F.col("t"), F.date_sub(F.to_date("t"), history.days).alias("d")).first()
    stored = (
        spark.read.schema(SERIES_SCHEMA)
        .parquet(series_path)
        .where((F.col("date") >= F.lit(first["d"])) & (F.col("batch_id") <= batch_id))
    )
    since = F.lit(first["t"] - history).cast("timestamp_ntz")
    bands = alerts.iqr_bands(stored.where(F.col("date_time") > since), a, n, centred=False, keep=["batch_id"])
    judged = alerts.judge(bands, keep=["batch_id"]).where(F.col("batch_id") == batch_id)
    _write_batch(judged, alerts_path)


def start_alert_stream(spark: SparkSession, events: DataFrame, base: str, trigger: dict | None = None,
                       a: float = 5.0, n: int = 5) -> StreamingQuery:
    series_path, alerts_path = f"{base}/series", f"{base}/alerts"

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # used by several actions below; a lost cache is recomputed for the same batch id
        try:
            alert_batch(spark, batch, batch_id, series_path, alerts_path, a, n)
        finally:
            batch.unpersist()

    w = bucket_user_stream(events).writeStream.outputMode("append").foreachBatch(run)
    w = w.option("checkpointLocation", f"{base}/checkpoint")
    return w.trigger(**(trigger or {"availableNow": True})).start()
