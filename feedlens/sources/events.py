"""Event sources.

The engine works on two append-only event tables:

* ``feed_actions``    (user_id, time, action, exp_group, gender, age, os)
* ``message_actions`` (user_id, reciever_id, time, gender, age, os)

``read_feed_actions`` / ``read_message_actions`` load real tables (any format
Spark reads) and check the columns.  ``feed_actions(events)`` /
``message_actions(events)`` derive both tables from the generic ``events``
table used by the test data; they are plain projections, so Catalyst pushes
filters and column pruning through them into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEED_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("action", T.StringType()),
        T.StructField("exp_group", T.LongType()),
        T.StructField("gender", T.LongType()),
        T.StructField("age", T.LongType()),
        T.StructField("os", T.StringType()),
    ]
)

# ``reciever_id`` keeps the source table's spelling.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("reciever_id", T.LongType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("gender", T.LongType()),
        T.StructField("age", T.LongType()),
        T.StructField("os", T.StringType()),
    ]
)

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def check_columns(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """Fail early when a required column is missing; cast to the declared types."""
    have = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    return df.select(
        *[
            F.col(f.name) if df.schema[f.name].dataType == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generic events table; its schema is declared, so building a query reads no footers."""
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def _load(spark: SparkSession, path: str | None, fmt: str, options: dict) -> DataFrame:
    r = spark.read.format(fmt).options(**options)
    return r.load(path) if path is not None else r.load()


def read_feed_actions(spark: SparkSession, path: str | None = None, fmt: str = "parquet", **options) -> DataFrame:
    """Load feed_actions from any Spark source (parquet, orc, a table over JDBC
    with ``fmt="jdbc", url=..., dbtable=...``) and check its columns."""
    return check_columns(_load(spark, path, fmt, options), FEED_SCHEMA, "feed_actions")


def read_message_actions(spark: SparkSession, path: str | None = None, fmt: str = "parquet", **options) -> DataFrame:
    return check_columns(_load(spark, path, fmt, options), MESSAGE_SCHEMA, "message_actions")


def _os(user_id: Column) -> Column:
    return F.when(user_id % 3 == 0, F.lit("iOS")).otherwise(F.lit("Android"))


def feed_actions(events: DataFrame) -> DataFrame:
    """feed_actions view over ``events`` (view and click rows; a click is a like)."""
    u = F.col("user_id")
    return events.where(F.col("event_type").isin("view", "click")).select(
        u.alias("user_id"),
        F.col("ts").alias("time"),
        F.when(F.col("event_type") == "view", F.lit("view")).otherwise(F.lit("like")).alias("action"),
        (u % 5).alias("exp_group"),
        (u % 2).alias("gender"),
        (F.lit(15) + u % 45).alias("age"),
        _os(u).alias("os"),
    )


def message_actions(events: DataFrame) -> DataFrame:
    """message_actions view over ``events`` (signup and purchase rows).

    The receiver is the first number in ``props``; a row without one gets a NULL
    receiver (``try_cast``), which ``count(reciever_id)`` then skips.
    """
    u = F.col("user_id")
    return events.where(F.col("event_type").isin("signup", "purchase")).select(
        u.alias("user_id"),
        F.regexp_extract("props", "([0-9]+)", 1).try_cast("bigint").alias("reciever_id"),
        F.col("ts").alias("time"),
        (u % 2).alias("gender"),
        (F.lit(15) + u % 45).alias("age"),
        _os(u).alias("os"),
    )
