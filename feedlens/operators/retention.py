"""Weekly audience retention.

For each week W in which a user was active (weeks start on Monday):
* at W the user is ``retained`` if also active in W-1, else ``new``
  (returning users count as new);
* at W+1 the user is ``lost`` if not active in W+1.

Counts are per (this_week, prev_week, user_status); lost users are counted
negative, and losses in the week after ``as_of``'s week (not finished yet) are
dropped.  Implemented on distinct (user, week) rows with lag/lead over the
user's weeks: no per-user arrays and no self-join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.time import as_date, day_range, monday_py, to_monday


def user_weeks(feed: DataFrame) -> DataFrame:
    """Distinct (user_id, week) over the whole history; rows without a user are left out."""
    return feed.where(F.col("user_id").isNotNull()).select("user_id", to_monday("time").alias("week")).distinct()


def weekly_status(feed: DataFrame, as_of: dt.date | str) -> DataFrame:
    """One row per (user, this_week) with prev_week and user_status."""
    return weekly_status_from_weeks(user_weeks(feed), as_of)


def weekly_status_from_weeks(uw: DataFrame, as_of: dt.date | str) -> DataFrame:
    """``weekly_status`` from distinct (user_id, week) rows."""
    next_week = monday_py(as_date(as_of)) + dt.timedelta(days=7)
    w = Window.partitionBy("user_id").orderBy("week")
    seq = uw.select(
        "user_id",
        "week",
        F.lag("week").over(w).alias("prev_active"),
        F.lead("week").over(w).alias("next_active"),
    )
    active = seq.select(
        "user_id",
        F.col("week").alias("this_week"),
        F.date_sub("week", 7).alias("prev_week"),
        F.when(F.col("prev_active") == F.date_sub("week", 7), "retained").otherwise("new").alias("user_status"),
    )
    lost = seq.where(F.col("next_active").isNull() | (F.col("next_active") != F.date_add("week", 7))).select(
        "user_id",
        F.date_add("week", 7).alias("this_week"),
        F.col("week").alias("prev_week"),
        F.lit("lost").alias("user_status"),
    )
    lost = lost.where(F.col("this_week") != F.lit(next_week))
    return active.unionByName(lost)


def retention(feed: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Signed user counts per (this_week, prev_week, user_status), ordered by week.

    Each (user, week) appears once, so the exact count is a row count.
    """
    return _count_status(weekly_status(feed, as_of))


# ---- incremental form -------------------------------------------------------------
#
# Retention needs every user's active weeks over the whole history.  Instead of
# rescanning all raw events each day, keep a compact table of distinct
# (user_id, event_date) - one row per active user and day - partitioned by day.
# A daily load adds (or, when retried, replaces) one partition.


def write_user_days(feed: DataFrame, path: str, first: dt.date | str | None = None, last: dt.date | str | None = None) -> None:
    """Write distinct (user_id, event_date) for the days in [first, last] (all
    days when not given), replacing exactly those day partitions."""
    f = feed if first is None else feed.where(day_range(feed, first, last if last is not None else first))
    days = f.where(F.col("user_id").isNotNull()).select("user_id", F.to_date("time").alias("event_date")).distinct()
    # the distinct is already spread over (user, day): every task writes its
    # share of each day (no single task per day); sorting by day keeps one
    # open file per task during a backfill
    (
        days.sortWithinPartitions("event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path)
    )


def read_user_days(spark, path: str) -> DataFrame:
    return spark.read.schema("user_id long, event_date date").parquet(path)


def retention_from_user_days(user_days: DataFrame, as_of: dt.date | str) -> DataFrame:
    """``retention`` computed from the (user_id, event_date) table."""
    uw = user_days.where(F.col("user_id").isNotNull()).select("user_id", to_monday("event_date").alias("week")).distinct()
    return _count_status(weekly_status_from_weeks(uw, as_of))


def _count_status(st: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return st.groupBy("this_week", "prev_week", "user_status").agg(
        F.when(F.col("user_status") == "lost", -n).otherwise(n).cast("bigint").alias("num_users")
    ).orderBy("this_week", "user_status")


# ---- bit-set form -------------------------------------------------------------------
#
# A user's active weeks as bits: one row per user and span of SPAN weeks.  Bit 1 .. SPAN are
# the span's weeks, bit 0 and bit SPAN + 1 the weeks before and after it, which the neighbouring
# spans hold too.  So each row tells by shifts and masks what its user's weeks are, and a daily load is
# a bit-or with the table so far.

SPAN = 60
_FIRST_MONDAY = dt.date(1970, 1, 5)
_OWN_WEEKS = ((1 << SPAN) - 1) << 1

WEEK_BITS_SCHEMA = "user_id bigint, span bigint, weeks bigint"


def week_bits(active: DataFrame, time_col: str = "time") -> DataFrame:
    """(user_id, span, weeks): the bit set of each user's active weeks, from rows of (user_id, ``time_col``)."""
    number = F.floor(F.date_diff(F.to_date(time_col), F.lit(_FIRST_MONDAY)) / 7)
    span, place = F.floor(number / SPAN), F.pmod(number, F.lit(SPAN)) + 1
    bit = lambda at: F.expr(f"shiftleft(1L, cast({at} as int))")
    rows = active.where(F.col("user_id").isNotNull() & F.col(time_col).isNotNull()).select("user_id", span.alias("span"), place.alias("place"))
    own = F.struct(F.col("span").alias("span"), bit("place").alias("weeks"))
    before = F.when(F.col("place") == 1, F.struct((F.col("span") - 1).alias("span"), bit(f"{SPAN + 1}").alias("weeks")))
    after = F.when(F.col("place") == SPAN, F.struct((F.col("span") + 1).alias("span"), bit("0").alias("weeks")))
    spread = rows.select("user_id", F.explode(F.array(own, before, after)).alias("s")).where("s IS NOT NULL")
    return merge_week_bits(spread.select("user_id", "s.span", "s.weeks"))


def merge_week_bits(*parts: DataFrame) -> DataFrame:
    """One bit set per (user_id, span) from any number of them (a daily load: the table so far and the day's)."""
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("user_id", "span").agg(F.bit_or("weeks").alias("weeks"))


def retention_from_week_bits(bits: DataFrame, as_of: dt.date | str) -> DataFrame:
    """``retention`` (in no order) from the bit sets: no window, no sort, no raw events."""
    weeks, mask = F.col("weeks"), F.lit(_OWN_WEEKS)
    week_before = F.shiftleft(weeks, 1)  # bit i: active in the week before week i
    masks = {
        "retained": weeks.bitwiseAND(week_before),
        "new": weeks.bitwiseAND(F.bitwise_not(week_before)),
        "lost": F.bitwise_not(weeks).bitwiseAND(week_before),
    }
    marks = F.array(*[F.struct(F.lit(name).alias("user_status"), m.bitwiseAND(mask).alias("bits")) for name, m in masks.items()])
    each = bits.select("span", F.explode(marks).alias("m")).where("m.bits <> 0")
    # users of one span with equal bits are counted together before the bits are taken apart
    each = each.groupBy("span", "m.user_status", "m.bits").agg(F.count(F.lit(1)).alias("users"))
    at = F.explode(F.filter(F.sequence(F.lit(1), F.lit(SPAN)), lambda i: F.call_function("getbit", F.col("bits"), i) == 1))
    per = each.select("span", "user_status", "users", at.alias("at"))
    counts = per.groupBy("span", "at", "user_status").agg(F.sum("users").alias("users"))
    this_week = F.date_add(F.lit(_FIRST_MONDAY), ((F.col("span") * SPAN + F.col("at") - 1) * 7).cast("int"))
    next_week = monday_py(as_date(as_of)) + dt.timedelta(days=7)
    out = counts.select(this_week.alias("this_week"), F.date_sub(this_week, 7).alias("prev_week"), "user_status", F.when(F.col("user_status") == "lost", -F.col("users")).otherwise(F.col("users")).alias("num_users"))
    return out.where((F.col("user_status") != "lost") | (F.col("this_week") != F.lit(next_week)))
