"""Audience reports: daily active users, feed totals, and the report rows.

Reporting window conventions (``as_of`` is "today"):
* yesterday = as_of - 1
* the trailing report window is as_of - 8 .. as_of - 1, both ends included
  (8 days; the report labels it "7 days").
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.numeric import count_where, round_half_up
from feedlens.functions.time import as_date, day_range


def report_window(as_of: dt.date | str, days: int = 8) -> tuple[dt.date, dt.date]:
    d = as_date(as_of)
    return d - dt.timedelta(days=days), d - dt.timedelta(days=1)


def feed_daily(feed: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Per day: DAU (exact distinct users), likes, views, CTR = likes / views;
    ordered by day.  Likes and views count all rows, those without a user too."""
    return _feed_daily(feed, first, last).orderBy("date")


def _feed_daily(feed: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    return (
        feed.where(day_range(feed, first, last))
        .groupBy(F.to_date("time").alias("date"))
        .agg(
            F.count_distinct("user_id").alias("DAU"),
            count_where(F.col("action") == "like").alias("likes"),
            count_where(F.col("action") == "view").alias("views"),
        )
        .withColumn("CTR", F.try_divide(F.col("likes"), F.col("views").cast("double")))
    )


def feed_yesterday(feed: DataFrame, as_of: dt.date | str) -> DataFrame:
    y = as_date(as_of) - dt.timedelta(days=1)
    return feed_daily(feed, y, y)


def dau_feed(feed: DataFrame, as_of: dt.date | str, days: int = 8) -> DataFrame:
    """Per day of the window: DAU, likes, views, CTR of the rows that have a user (this
    report's counts are of users' rows; ``report_daily`` counts all rows)."""
    return feed_daily(feed.where(F.col("user_id").isNotNull()), *report_window(as_of, days))


def daily_audience(feed: DataFrame, messages: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Per day, in one pass: users active anywhere, in the feed, and in both tables.

    Both tables are reduced to (day, user) with an "in feed" and an "in
    messenger" flag; the partial aggregate removes duplicate user-days before
    the shuffle, and a second aggregate counts per day.  Each scan gets the
    date range pushed down.  Rows without a user id are nobody's activity.
    """
    known = F.col("user_id").isNotNull()
    f = feed.where(day_range(feed, first, last) & known).select(
        F.to_date("time").alias("date"), "user_id", F.lit(1).alias("in_feed"), F.lit(0).alias("in_msg")
    )
    m = messages.where(day_range(messages, first, last) & known).select(
        F.to_date("time").alias("date"), "user_id", F.lit(0).alias("in_feed"), F.lit(1).alias("in_msg")
    )
    user_days = f.unionByName(m).groupBy("date", "user_id").agg(
        F.max("in_feed").alias("in_feed"), F.max("in_msg").alias("in_msg")
    )
    return user_days.groupBy("date").agg(
        F.count(F.lit(1)).alias("users"),
        count_where(F.col("in_feed") == 1).alias("feed_users"),
        count_where((F.col("in_feed") == 1) & (F.col("in_msg") == 1)).alias("both_users"),
    )


def dau_total(feed: DataFrame, messages: DataFrame, as_of: dt.date | str, days: int = 8) -> DataFrame:
    """Per day: distinct users active in the feed or the messenger."""
    aud = daily_audience(feed, messages, *report_window(as_of, days))
    return aud.select("date", "users").orderBy("date")


def dau_both(feed: DataFrame, messages: DataFrame, as_of: dt.date | str, days: int = 8) -> DataFrame:
    """Per day: users active in both the feed and the messenger that day
    (days without such a user are absent, as with an inner join)."""
    aud = daily_audience(feed, messages, *report_window(as_of, days))
    return aud.where(F.col("both_users") > 0).select("date", F.col("both_users").alias("DAU")).orderBy("date")


def report_daily(feed: DataFrame, as_of: dt.date | str, days: int = 8) -> DataFrame:
    """One row: yesterday's DAU / views / likes / CTR and the window totals.

    ``dau_window`` is the sum of daily DAUs (user-days, not unique users) and
    ``ctr_window`` the ratio of summed likes to summed views.
    """
    d = as_date(as_of)
    y = d - dt.timedelta(days=1)
    daily = _feed_daily(feed, *report_window(d, days))
    is_y = F.col("date") == F.lit(y)
    row = daily.agg(
        F.coalesce(F.sum(F.when(is_y, F.col("DAU"))), F.lit(0)).cast("bigint").alias("dau"),
        F.coalesce(F.sum(F.when(is_y, F.col("views"))), F.lit(0)).cast("bigint").alias("views"),
        F.coalesce(F.sum(F.when(is_y, F.col("likes"))), F.lit(0)).cast("bigint").alias("likes"),
        F.sum(F.when(is_y, F.col("CTR"))).alias("ctr"),
        F.coalesce(F.sum("DAU"), F.lit(0)).cast("bigint").alias("dau_window"),
        F.coalesce(F.sum("views"), F.lit(0)).cast("bigint").alias("views_window"),
        F.coalesce(F.sum("likes"), F.lit(0)).cast("bigint").alias("likes_window"),
    ).withColumn("ctr_window", F.try_divide(F.col("likes_window"), F.col("views_window").cast("double")))
    day_txt = y.strftime("%d/%m/%Y")
    msg = F.format_string(
        f"Report for {day_txt}: DAU %d, views %d, likes %d, CTR %.2f | window: DAU %d, views %d, likes %d, CTR %.2f",
        "dau",
        "views",
        "likes",
        round_half_up(F.coalesce(F.col("ctr"), F.lit(0.0)), 2),
        "dau_window",
        "views_window",
        "likes_window",
        round_half_up(F.coalesce(F.col("ctr_window"), F.lit(0.0)), 2),
    )
    return row.select(F.lit(y).alias("report_date"), "*", msg.alias("msg"))


def week_over_week(series: DataFrame, keys: list[str], date_col: str, value_col: str) -> DataFrame:
    """First and last value of each daily series and the change in percent,
    rounded half up to 2 places: (last - first) / first * 100."""
    agg = series.groupBy(*keys).agg(
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
        F.min_by(value_col, date_col).cast("bigint").alias("first_value"),
        F.max_by(value_col, date_col).cast("bigint").alias("last_value"),
    )
    pct = round_half_up(
        F.try_divide((F.col("last_value") - F.col("first_value")).cast("double"), F.col("first_value")) * 100.0, 2
    )
    out = agg.select("*", pct.alias("pct_change"))
    msg = F.format_string(
        "%s DAU: %d on %s, %d on %s (%s)",
        F.col(keys[0]) if keys else F.lit(value_col),
        F.col("last_value"),
        F.date_format("last_date", "dd/MM/yyyy"),
        F.col("first_value"),
        F.date_format("first_date", "dd/MM/yyyy"),
        F.when(F.col("pct_change").isNotNull(), F.format_string("%.2f%%", F.col("pct_change"))).otherwise("n/a"),
    )
    return out.withColumn("msg", msg)


def report_week_over_week(feed: DataFrame, messages: DataFrame, as_of: dt.date | str, days: int = 8) -> DataFrame:
    """Week-over-week change of total DAU, feed DAU and both-table DAU.

    The three series come from one ``daily_audience`` pass; a day where a
    series has no user is not part of that series.
    """
    aud = daily_audience(feed, messages, *report_window(as_of, days))
    long = aud.unpivot("date", ["users", "feed_users", "both_users"], "_col", "value").where(F.col("value") > 0)
    name = F.when(F.col("_col") == "users", "total").when(F.col("_col") == "feed_users", "feed").otherwise("both")
    return week_over_week(long.withColumn("series", name), ["series"], "date", "value")


def approx_uniques(feed: DataFrame, as_of: dt.date | str, days: int = 8, rsd: float = 0.05) -> DataFrame:
    """Per day: exact distinct users, and whether the HyperLogLog++ estimate lies within
    three standard errors of them.

    The sketch has an aggregate of its own: planned together with an exact distinct
    count it would be carried per (day, user) through the first shuffle; alone it is one
    fixed-size buffer per day and task.  The two one-row-per-day results are joined.
    """
    first, last = report_window(as_of, days)
    rows = feed.where(day_range(feed, first, last)).select(F.to_date("time").alias("date"), "user_id")
    exact = rows.groupBy("date").agg(F.count_distinct("user_id").alias("users_exact"))
    sketch = approx_daily_users(feed, first, last, rsd)
    near = F.abs(F.col("users_approx") - F.col("users_exact")) <= 3 * rsd * F.col("users_exact")
    return exact.join(sketch, "date").select("date", "users_exact", near.alias("within_3_sigma"))


def approx_daily_users(feed: DataFrame, first: dt.date, last: dt.date, rsd: float = 0.05) -> DataFrame:
    """Per day: the estimated number of distinct users (relative standard error ``rsd``)."""
    rows = feed.where(day_range(feed, first, last))
    return rows.groupBy(F.to_date("time").alias("date")).agg(F.approx_count_distinct("user_id", rsd).alias("users_approx"))
