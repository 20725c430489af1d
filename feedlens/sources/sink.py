"""Metric-cube sink: a parquet table partitioned by the load day.

Each daily load replaces only its own partition (dynamic partition overwrite),
so a retried load is idempotent and other days are kept.  The partition key is
the day the load processed, not ``event_date``: the faithful message join puts
receiver-only users on 1970-01-01, and those rows belong to the load that made
them.  Rows are sorted by event_date inside each partition.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEASURES = ["views", "likes", "messages_received", "messages_sent", "users_received", "users_sent"]

METRICS_CUBE_SCHEMA = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        T.StructField("dimension", T.StringType()),
        T.StructField("dimension_value", T.StringType()),
    ]
    + [T.StructField(m, T.LongType()) for m in MEASURES]
)


def write_metrics_cube(cube: DataFrame, path: str, load_date: dt.date) -> None:
    """Write (or re-write) the cube of one daily load; other loads stay."""
    out = cube.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in METRICS_CUBE_SCHEMA.fields])
    (
        out.withColumn("load_date", F.lit(load_date))
        .repartition("load_date")
        .sortWithinPartitions("event_date", "dimension", "dimension_value")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("load_date")
        .parquet(path)
    )


def read_metrics_cube(spark: SparkSession, path: str, with_load_date: bool = False) -> DataFrame:
    schema = T.StructType(METRICS_CUBE_SCHEMA.fields + [T.StructField("load_date", T.DateType())])
    df = spark.read.schema(schema).parquet(path)
    cols = METRICS_CUBE_SCHEMA.fieldNames() + (["load_date"] if with_load_date else [])
    return df.select(*cols)
