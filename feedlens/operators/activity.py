"""Daily activity: per-user feed and message rollups, their outer join, and the
demographic metric cube.

Plan shape: the feed rollup and the two message rollups are each a partially
aggregated groupBy (one shuffle each, on the group keys); the outer joins shuffle
the already-aggregated rows; the cube is one Expand + Aggregate over the joined
rows (GROUPING SETS), not three scans and a union.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.numeric import count_where
from feedlens.functions.time import as_date, day_range

DEMOGRAPHICS = ["gender", "age", "os"]
USER_DAY_KEYS = ["users", "event_date", "gender", "age", "os"]
FEED_MEASURES = ["likes", "views"]
MESSAGE_MEASURES = ["messages_received", "messages_sent", "users_received", "users_sent"]
CUBE_MEASURES = ["views", "likes", "messages_received", "messages_sent", "users_received", "users_sent"]


def _day(messages_or_feed: DataFrame, day: dt.date) -> DataFrame:
    return messages_or_feed.where(day_range(messages_or_feed, day, day))


def feed_user_day(feed: DataFrame, day: dt.date | str) -> DataFrame:
    """Likes and views per (user, day, gender, age, os) for one day."""
    d = as_date(day)
    return (
        _day(feed, d)
        .groupBy(
            F.col("user_id").alias("users"),
            F.to_date("time").alias("event_date"),
            *DEMOGRAPHICS,
        )
        .agg(
            count_where(F.col("action") == "like").alias("likes"),
            count_where(F.col("action") == "view").alias("views"),
        )
    )


def messages_sent(messages: DataFrame, day: dt.date | str) -> DataFrame:
    """Per sender and day: messages sent (non-null receivers) and distinct receivers."""
    d = as_date(day)
    return (
        _day(messages, d)
        .groupBy(F.col("user_id").alias("users"), F.to_date("time").alias("event_date"), *DEMOGRAPHICS)
        .agg(
            F.count("reciever_id").alias("messages_sent"),
            F.count_distinct("reciever_id").alias("users_sent"),
        )
    )


def messages_received(messages: DataFrame, day: dt.date | str) -> DataFrame:
    """Per receiver and day: messages received and distinct senders.

    The demographics are the ones on the message row, i.e. the sender's, so a
    receiver reached by several sender profiles has several rows.
    """
    d = as_date(day)
    return (
        _day(messages, d)
        .where(F.col("reciever_id").isNotNull())
        .groupBy(F.col("reciever_id").alias("users"), F.to_date("time").alias("event_date"), *DEMOGRAPHICS)
        .agg(
            F.count("reciever_id").alias("messages_received"),
            F.count_distinct("user_id").alias("users_received"),
        )
    )


def _message_roles(messages: DataFrame, day: dt.date) -> DataFrame:
    """Both rollups from one scan: every message counts once for its sender
    (role "sent", other party = receiver) and once for its receiver (role
    "recv", other party = sender); demographics are the row's (the sender's)."""
    m = _day(messages, day)
    role = F.explode(
        F.array(
            F.struct(F.lit("sent").alias("role"), F.col("user_id").alias("users"), F.col("reciever_id").alias("other")),
            F.struct(F.lit("recv").alias("role"), F.col("reciever_id").alias("users"), F.col("user_id").alias("other")),
        )
    )
    rows = m.select(F.to_date("time").alias("event_date"), *DEMOGRAPHICS, "reciever_id", role.alias("r"))
    rows = rows.select("r.role", "r.users", "event_date", *DEMOGRAPHICS, "reciever_id", "r.other")
    # a message without a receiver still makes its sender a row (with 0 messages:
    # count(reciever_id) skips it); it has no receiver-side row
    rows = rows.where(F.col("users").isNotNull())
    return rows.groupBy("role", "users", "event_date", *DEMOGRAPHICS).agg(
        F.count("reciever_id").alias("messages"), F.count_distinct("other").alias("partners")
    )


def message_user_day(messages: DataFrame, day: dt.date | str) -> DataFrame:
    """Sent and received rollups joined on the user only (faithful form).

    The two sides are joined on ``users`` alone; date and demographics come from
    the sender side, and a user who only received messages gets the type defaults
    (1970-01-01, 0, 0, '').  A receiver with several sender profiles repeats the
    sent measures once per profile.  See ``message_user_day_by_user`` for the form
    keyed on (user, day) with the user's own demographics.

    One scan and one aggregation serve both sides: per user, a window says
    whether each role is present; users with one role pass straight through,
    users with both pair their sent and received rows by a join whose two sides
    come from the same user-partitioned data.
    """
    d = as_date(day)
    roles = _message_roles(messages, d)
    per_user = Window.partitionBy("users")
    flagged = roles.select(
        "*",
        F.max((F.col("role") == "sent").cast("int")).over(per_user).alias("_has_sent"),
        F.max((F.col("role") == "recv").cast("int")).over(per_user).alias("_has_recv"),
    )
    zero = F.lit(0).cast("bigint")
    sent = flagged.where(F.col("role") == "sent")
    recv = flagged.where(F.col("role") == "recv")
    sent_only = sent.where(F.col("_has_recv") == 0).select(
        "users", "event_date", *DEMOGRAPHICS,
        zero.alias("messages_received"), F.col("messages").alias("messages_sent"),
        zero.alias("users_received"), F.col("partners").alias("users_sent"),
    )
    recv_only = recv.where(F.col("_has_sent") == 0).select(
        "users",
        F.lit(dt.date(1970, 1, 1)).alias("event_date"),
        zero.alias("gender"),
        zero.alias("age"),
        F.lit("").alias("os"),
        F.col("messages").alias("messages_received"),
        zero.alias("messages_sent"),
        F.col("partners").alias("users_received"),
        zero.alias("users_sent"),
    )
    s = sent.where(F.col("_has_recv") == 1).alias("s")
    r = recv.where(F.col("_has_sent") == 1).alias("r")
    both = s.join(r, F.col("s.users") == F.col("r.users"), "inner").select(
        F.col("s.users").alias("users"),
        *[F.col(f"s.{c}").alias(c) for c in ["event_date", *DEMOGRAPHICS]],
        F.col("r.messages").alias("messages_received"),
        F.col("s.messages").alias("messages_sent"),
        F.col("r.partners").alias("users_received"),
        F.col("s.partners").alias("users_sent"),
    )
    return sent_only.unionByName(recv_only).unionByName(both)


def message_user_day_by_user(messages: DataFrame, day: dt.date | str) -> DataFrame:
    """Sent and received measures per (user, day), demographics from the user's
    own sent rows (NULL for a user who only received).  No fan-out.

    One scan: each message counts for its sender and its receiver; both role
    rollups come from one aggregate keyed by (role, user, day), then one
    conditional aggregation per (user, day) puts them side by side.
    """
    d = as_date(day)
    m = _day(messages, d)
    role = F.explode(
        F.array(
            F.struct(F.lit("sent").alias("role"), F.col("user_id").alias("users"), F.col("reciever_id").alias("other")),
            F.struct(F.lit("recv").alias("role"), F.col("reciever_id").alias("users"), F.col("user_id").alias("other")),
        )
    )
    rows = m.select(
        F.to_date("time").alias("event_date"), "time", "reciever_id", F.struct(*DEMOGRAPHICS).alias("demo"), role.alias("r")
    ).where(F.col("r.users").isNotNull())
    agg = rows.groupBy("r.role", "r.users", "event_date").agg(
        F.count("reciever_id").alias("messages"),
        F.count_distinct("r.other").alias("partners"),
        F.min(F.struct("time", "demo")).alias("first"),  # equal times: the smallest profile
    )
    # at most one sent and one received row per (user, day): a pivot on the
    # role (conditional aggregation) is the full outer join, without a join
    is_sent, is_recv = F.col("role") == "sent", F.col("role") == "recv"
    zero = F.lit(0).cast("bigint")
    out = agg.groupBy("users", "event_date").agg(
        F.max(F.when(is_sent, F.col("first.demo"))).alias("demo"),
        F.coalesce(F.max(F.when(is_recv, F.col("messages"))), zero).alias("messages_received"),
        F.coalesce(F.max(F.when(is_sent, F.col("messages"))), zero).alias("messages_sent"),
        F.coalesce(F.max(F.when(is_recv, F.col("partners"))), zero).alias("users_received"),
        F.coalesce(F.max(F.when(is_sent, F.col("partners"))), zero).alias("users_sent"),
    )
    return out.select(
        "users",
        "event_date",
        *[F.col(f"demo.{c}").alias(c) for c in DEMOGRAPHICS],
        "messages_received",
        "messages_sent",
        "users_received",
        "users_sent",
    )


def user_activity_day(
    feed: DataFrame, messages: DataFrame, day: dt.date | str
) -> DataFrame:
    """Feed and message measures per (user, day, demographics), missing measures 0."""
    f = feed_user_day(feed, day)
    m = message_user_day(messages, day)
    j = f.join(m, USER_DAY_KEYS, "full")
    zero = F.lit(0).cast("bigint")
    return j.select(
        *USER_DAY_KEYS,
        *[F.coalesce(F.col(c), zero).cast("bigint").alias(c) for c in FEED_MEASURES + MESSAGE_MEASURES],
    )


# ---- co-located form ---------------------------------------------------------------
#
# The day's rollups as tables bucketed and sorted by user: written once, every join by user of
# theirs reads its buckets side by side, without a shuffle.

USER_TABLES = ("feed", "sent", "received", "message_users")


def write_user_tables(feed: DataFrame, messages: DataFrame, day: dt.date | str, path: str, prefix: str, buckets: int) -> dict[str, str]:
    """Write the feed, sent and received rollups of ``day``, and the users with messages, each bucketed by user.

    Returns the table names ("<prefix>_feed" ...) in the session's catalog; the files lie under ``path``.
    """
    sent, received = messages_sent(messages, day), messages_received(messages, day)
    sent = sent.where(F.col("users").isNotNull())  # as in ``message_user_day``: nobody's messages have receivers only
    frames = {"feed": feed_user_day(feed, day), "sent": sent, "received": received}
    frames["message_users"] = sent.select("users").unionByName(received.select("users")).distinct()
    names = {}
    for name in USER_TABLES:
        names[name] = f"{prefix}_{name}"
        frames[name].write.bucketBy(buckets, "users").sortBy("users").option("path", f"{path}/{name}").format("parquet").mode("overwrite").saveAsTable(names[name])
    return names


def message_user_day_from_tables(users: DataFrame, sent: DataFrame, received: DataFrame) -> DataFrame:
    """``message_user_day`` as joins of the bucketed tables, from the users with messages out (no Exchange)."""
    zero = F.lit(0).cast("bigint")
    s = sent.withColumnRenamed("users", "sender")
    r = received.select(F.col("users").alias("receiver"), "messages_received", "users_received")
    j = users.join(s, F.col("users") == F.col("sender"), "left").join(r, F.col("users") == F.col("receiver"), "left")
    sends = F.col("sender").isNotNull()
    defaults = {"event_date": F.lit(dt.date(1970, 1, 1)), "gender": zero, "age": zero, "os": F.lit("")}
    return j.select(
        "users",
        *[F.when(sends, F.col(c)).otherwise(d).alias(c) for c, d in defaults.items()],
        *[F.coalesce(F.col(c), zero).alias(c) for c in MESSAGE_MEASURES],
    )


def user_activity_from_tables(feed_day: DataFrame, message_day: DataFrame) -> DataFrame:
    """``user_activity_day`` from bucketed rollups: the sides meet by user, the other keys are compared in the join.

    (As further join keys they would ask for a shuffle by all keys.)
    """
    rest = USER_DAY_KEYS[1:]
    m = message_day.select(*[F.col(c).alias(f"m_{c}") if c in USER_DAY_KEYS else F.col(c) for c in message_day.columns])
    same = F.col("users") == F.col("m_users")
    for c in rest:
        same = same & (F.col(c) <= F.col(f"m_{c}")) & (F.col(c) >= F.col(f"m_{c}"))
    j = feed_day.join(m, same, "full")
    zero = F.lit(0).cast("bigint")
    side = F.col("m_users").isNotNull() & F.col("likes").isNull()  # a row of the messages alone
    return j.select(
        *[F.when(side, F.col(f"m_{c}")).otherwise(F.col(c)).alias(c) for c in USER_DAY_KEYS],
        *[F.coalesce(F.col(c), zero).cast("bigint").alias(c) for c in FEED_MEASURES + MESSAGE_MEASURES],
    )


def _measure_sums() -> list[Column]:
    return [F.sum(c).cast("bigint").alias(c) for c in CUBE_MEASURES]


def metrics_cube(activity: DataFrame) -> DataFrame:
    """Long-form cube: per (event_date, dimension, dimension_value) the sums of
    the six measures, for dimension in gender / age / os.

    One GROUPING SETS aggregate (a single Expand) instead of three group-bys and
    a union; ``grouping_id`` names the dimension of each row.
    """
    sets = [["event_date", d] for d in DEMOGRAPHICS]
    agg = activity.groupingSets(sets, "event_date", *DEMOGRAPHICS).agg(
        *_measure_sums(), F.grouping_id().alias("_gid")
    )
    # grouping_id over (event_date, gender, age, os), bit set = column not grouped:
    # gender-set -> 0b0011, age-set -> 0b0101, os-set -> 0b0110
    dim = F.when(F.col("_gid") == 3, "gender").when(F.col("_gid") == 5, "age").otherwise("os")
    value = (
        F.when(F.col("_gid") == 3, F.col("gender").cast("string"))
        .when(F.col("_gid") == 5, F.col("age").cast("string"))
        .otherwise(F.col("os"))
    )
    return agg.select("event_date", dim.alias("dimension"), value.alias("dimension_value"), *CUBE_MEASURES)


def dimension_report(activity: DataFrame, dimension: str) -> DataFrame:
    """One dimension of the cube (the data behind a demographic bar chart).

    Gender is shown as Female / Male (0 / 1); other values pass through.
    """
    if dimension not in DEMOGRAPHICS:
        raise ValueError(f"unknown dimension {dimension!r}")
    agg = activity.groupBy("event_date", dimension).agg(*_measure_sums())
    value = F.col(dimension).cast("string")
    if dimension == "gender":
        value = F.when(F.col("gender") == 0, "Female").when(F.col("gender") == 1, "Male").otherwise(value)
    return agg.select("event_date", F.lit(dimension).alias("dimension"), value.alias("dimension_value"), *CUBE_MEASURES)


def daily_metrics_cube(
    feed: DataFrame, messages: DataFrame, day: dt.date | str
) -> DataFrame:
    """The daily ETL: activity for ``day`` rolled up into the metric cube."""
    return metrics_cube(user_activity_day(feed, messages, day))
