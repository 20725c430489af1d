"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_half_up(c: Column, digits: int) -> Column:
    """floor(x * 10^d + 0.5) / 10^d.

    Plain IEEE arithmetic, so every engine (and every Spark version) gets the
    same bits; ``round`` differs between engines at decimal ties such as
    0.0015625.  Values with |x| * 10^d of 9e18 or more (beyond a BIGINT floor)
    are returned unchanged.
    """
    scale = F.lit(float(10**digits))
    return F.when(F.abs(c) * scale < F.lit(9.0e18), F.floor(c * scale + F.lit(0.5)) / scale).otherwise(c)


def count_where(cond: Column) -> Column:
    """Number of rows where ``cond`` is true (NULL counts as false).

    Same result as ``count_if``; written as ``count(CASE WHEN cond THEN 1 END)``
    so that identical aggregations in two branches of a plan stay identical
    after optimisation and Spark can reuse their shuffle.
    """
    return F.count(F.when(cond, F.lit(1)))


def round_doubles(df: DataFrame, digits: int) -> DataFrame:
    """``round_half_up`` applied to every DOUBLE column (other columns as is)."""
    return df.select(
        *[
            round_half_up(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
