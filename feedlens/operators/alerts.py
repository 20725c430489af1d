"""15-minute metric series and interquartile-range anomaly alerts.

Series: closed 15-minute buckets since the start of yesterday (relative to
``now``).  Bands, for each metric, over rows (an empty bucket is absent, not 0):

* q25 / q75 of the previous ``n`` values (linear interpolation), NULL until
  ``n`` values exist;
* iqr = q75 - q25; raw limits q75 + a*iqr and q25 - a*iqr;
* limits = centred mean of the raw limits over 5 rows (2 before, 2 after),
  NULLs skipped.

Only the last row of each metric is an honest alert (its centred frame cannot
look ahead); ``anomaly_backtest`` evaluates every row with the trailing frame.
All metrics are evaluated in one pass: the series are unpivoted to
(metric, date_time, value) and every window is partitioned by metric.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.numeric import count_where, round_half_up
from feedlens.functions.time import as_datetime, floor_15min, floor_15min_py, hhmm, time_range

FEED_METRICS = ["users_feed", "views", "likes", "CTR"]
MESSAGE_METRICS = ["users_mes", "messages_cnt"]


def alert_range(now: dt.datetime | str) -> tuple[dt.datetime, dt.datetime]:
    """[start of yesterday, start of the current 15-minute bucket)."""
    t = as_datetime(now)
    start = dt.datetime.combine(t.date() - dt.timedelta(days=1), dt.time())
    return start, floor_15min_py(t)


def _bucketed(df: DataFrame, now) -> DataFrame:
    start, end = alert_range(now)
    return df.where(time_range(df, start, end)).withColumn("date_time", floor_15min("time"))


def feed_15min(feed: DataFrame, now: dt.datetime | str) -> DataFrame:
    """Closed 15-minute buckets of the feed, ordered by time (report output)."""
    return _feed_15min(feed, now).orderBy("date_time")


def messages_15min(messages: DataFrame, now: dt.datetime | str) -> DataFrame:
    """Closed 15-minute buckets of the messenger, ordered by time (report output)."""
    return _messages_15min(messages, now).orderBy("date_time")


def _feed_15min(feed: DataFrame, now: dt.datetime | str) -> DataFrame:
    b = _bucketed(feed, now).groupBy("date_time").agg(
        F.count_distinct("user_id").alias("users_feed"),
        count_where(F.col("user_id").isNotNull() & (F.col("action") == "view")).alias("views"),
        count_where(F.col("user_id").isNotNull() & (F.col("action") == "like")).alias("likes"),
    )
    return b.select(
        "date_time",
        F.to_date("date_time").alias("date"),
        hhmm("date_time").alias("timeHM"),
        "users_feed",
        "views",
        "likes",
        F.try_divide(F.col("likes"), F.col("views").cast("double")).alias("CTR"),
    )


def _messages_15min(messages: DataFrame, now: dt.datetime | str) -> DataFrame:
    b = _bucketed(messages, now).groupBy("date_time").agg(
        F.count_distinct("user_id").alias("users_mes"),
        F.count("user_id").alias("messages_cnt"),
    )
    return b.select(
        "date_time", F.to_date("date_time").alias("date"), hhmm("date_time").alias("timeHM"), "users_mes", "messages_cnt"
    )


def metric_series(feed: DataFrame, messages: DataFrame, now: dt.datetime | str) -> DataFrame:
    """All six metrics as long rows (metric, date_time, value DOUBLE)."""
    f = _feed_15min(feed, now).select("date_time", *[F.col(m).cast("double").alias(m) for m in FEED_METRICS])
    m = _messages_15min(messages, now).select("date_time", *[F.col(c).cast("double").alias(c) for c in MESSAGE_METRICS])
    return f.unpivot("date_time", FEED_METRICS, "metric", "value").unionByName(
        m.unpivot("date_time", MESSAGE_METRICS, "metric", "value")
    )


def iqr_bands(series: DataFrame, a: float = 5.0, n: int = 5, centred: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Add quantile25, quantile75, iqr, upper_limit, lower_limit per metric row (``keep``: further columns)."""
    order = Window.partitionBy("metric").orderBy("date_time")
    prev_n = order.rowsBetween(-n, -1)
    full = F.count("value").over(prev_n) == n
    q25 = F.when(full, F.percentile("value", F.lit(0.25)).over(prev_n))
    q75 = F.when(full, F.percentile("value", F.lit(0.75)).over(prev_n))
    half = n // 2
    smooth = order.rowsBetween(-half, half) if centred else order.rowsBetween(-half, 0)
    with_q = series.select("metric", "date_time", "value", *keep, q25.alias("quantile25"), q75.alias("quantile75"))
    with_q = with_q.withColumn("iqr", F.col("quantile75") - F.col("quantile25"))
    up = F.col("quantile75") + F.lit(float(a)) * F.col("iqr")
    lo = F.col("quantile25") - F.lit(float(a)) * F.col("iqr")
    return with_q.select(
        "*",
        F.avg(up).over(smooth).alias("upper_limit"),
        F.avg(lo).over(smooth).alias("lower_limit"),
    )


def anomaly_bands(feed: DataFrame, messages: DataFrame, now: dt.datetime | str, a: float = 5.0, n: int = 5) -> DataFrame:
    return iqr_bands(metric_series(feed, messages, now), a, n, centred=True)


def _is_alert() -> F.Column:
    v = F.col("value")
    out = (v < F.col("lower_limit")) | (v > F.col("upper_limit"))
    return F.coalesce(out, F.lit(False)).cast("int")


def judge_latest(bands: DataFrame) -> DataFrame:
    """One row per metric: the latest bucket of ``bands``, judged (see ``judge``)."""
    last = Window.partitionBy("metric").orderBy(F.col("date_time").desc())
    judged = judge(bands.withColumn("_rn", F.row_number().over(last)), keep=["_rn"])
    return judged.where(F.col("_rn") == 1).drop("_rn")


def judge(bands: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every bucket of ``bands`` with its previous value, alert flag and text (and the ``keep`` columns).

    deviation = 1 - current / previous (positive means a drop).
    """
    order = Window.partitionBy("metric").orderBy("date_time")
    latest = bands.withColumn("prev_value", F.lag("value").over(order))
    deviation = F.lit(1.0) - F.try_divide(F.col("value"), F.col("prev_value"))
    out = latest.select(
        "metric",
        "date_time",
        "value",
        "prev_value",
        "upper_limit",
        "lower_limit",
        _is_alert().alias("alert"),
        deviation.alias("deviation"),
        *keep,
    )
    msg = F.when(
        F.col("alert") == 1,
        F.format_string(
            "ALERT: metric %s has an abnormal value: current %.2f, deviation %s",
            F.col("metric"),
            round_half_up(F.col("value"), 2),
            F.when(F.col("deviation").isNotNull(), F.format_string("%.2f%%", round_half_up(F.col("deviation") * 100.0, 2))).otherwise("n/a"),
        ),
    )
    return out.withColumn("msg", msg)


def anomaly_alerts(feed: DataFrame, messages: DataFrame, now: dt.datetime | str, a: float = 5.0, n: int = 5) -> DataFrame:
    """One row per metric: the latest bucket, its band, alert flag and text."""
    return judge_latest(anomaly_bands(feed, messages, now, a, n))


def anomaly_backtest(feed: DataFrame, messages: DataFrame, now: dt.datetime | str, a: float = 5.0, n: int = 5) -> DataFrame:
    """Every bucket judged as if it were the latest (trailing smoothing frame)."""
    bands = iqr_bands(metric_series(feed, messages, now), a, n, centred=False)
    return bands.select("metric", "date_time", "value", "upper_limit", "lower_limit", _is_alert().alias("alert"))
