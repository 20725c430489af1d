"""Deterministic experiment splitting."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.hashing import ab_split
from feedlens.functions.time import day_range


def active_users(feed: DataFrame, first: dt.date | str, last: dt.date | str) -> DataFrame:
    return feed.where(day_range(feed, first, last)).select("user_id").distinct()


def assign_groups(users: DataFrame, salt: str = "exp_mess_1", n_groups: int = 5) -> DataFrame:
    """hash_group = md5("<user_id>-<salt>") as an integer mod n_groups."""
    return users.select("user_id", ab_split("user_id", salt, n_groups).alias("hash_group"))


def split_balance(assigned: DataFrame) -> DataFrame:
    """Users per group of ``assign_groups`` (its users are distinct already, so rows are counted)."""
    return assigned.groupBy("hash_group").agg(F.count("user_id").alias("users"))
