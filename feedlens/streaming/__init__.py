"""Structured Streaming versions of the 15-minute alert pipeline."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.numeric import round_doubles
from feedlens.plans.params import DIGITS
from feedlens.session import shared_dir


def _events_glob(sf_dir: str) -> str:
    # the file stream source takes a directory or a glob, not a single file
    return f"{sf_dir}/events.parque[t]"


def feed_15min_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedlens.streaming.alerts_stream import read_event_stream, start_feed_15min

    base = shared_dir(spark, "feed_15min_stream")
    q = start_feed_15min(read_event_stream(spark, _events_glob(sf_dir)), f"{base}/out", f"{base}/checkpoint")
    q.awaitTermination()
    return round_doubles(spark.read.parquet(f"{base}/out").drop("batch_id"), DIGITS)


def anomaly_alerts_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedlens.streaming.alerts_stream import read_event_stream, start_alert_stream

    base = shared_dir(spark, "alerts_stream")
    q = start_alert_stream(spark, read_event_stream(spark, _events_glob(sf_dir)), base)
    q.awaitTermination()
    return round_doubles(spark.read.parquet(f"{base}/alerts").drop("batch_id", "date"), DIGITS)


def feed_15min_corrected_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedlens.sources.events import feed_actions, message_actions, read_events
    from feedlens.streaming.alerts_stream import read_event_stream
    from feedlens.streaming.corrections import corrected_feed_15min, start_corrected_15min

    base = shared_dir(spark, "feed_15min_corrected")
    start_corrected_15min(spark, read_event_stream(spark, _events_glob(sf_dir)), base).awaitTermination()
    e = read_events(spark, sf_dir)
    rows = feed_actions(e).select("time", "user_id").unionByName(message_actions(e).select("time", "user_id"))
    last = rows.where("user_id IS NOT NULL").agg(F.max("time")).first()[0]
    closed_by = last - dt.timedelta(minutes=15) if last is not None else None
    return round_doubles(corrected_feed_15min(spark, base, closed_by), DIGITS)


def registered() -> dict:
    return {
        "feed_15min_corrected_stream": feed_15min_corrected_query,
        "feed_15min_stream": feed_15min_stream_query,
        "anomaly_alerts_stream": anomaly_alerts_stream_query,
    }
