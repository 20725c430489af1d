"""Per-user experiment metrics and their transforms."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.hashing import md5_mod, split_key, unsigned_mod, xxhash64_plain
from feedlens.functions.numeric import count_where
from feedlens.functions.ranking import running_totals
from feedlens.functions.time import day_range


def user_ctr(feed: DataFrame, first: dt.date | str, last: dt.date | str, groups: Sequence[int] | None = None) -> DataFrame:
    """Per (exp_group, user): likes, views and ctr = likes / views (NULL when
    the user has no views; such users are left out of every test)."""
    f = feed.where(day_range(feed, first, last))
    if groups is not None:
        # (the NOT NULL is implied; stating it keeps plans that join on the
        # group identical to those that do not, so their shuffles are shared)
        f = f.where(F.col("exp_group").isNotNull() & F.col("exp_group").isin(list(groups)))
    return (
        f.groupBy("exp_group", "user_id")
        .agg(count_where(F.col("action") == "like").alias("likes"), count_where(F.col("action") == "view").alias("views"))
        .withColumn("ctr", F.try_divide(F.col("likes"), F.col("views").cast("double")))
    )


def group_profile(uc: DataFrame) -> DataFrame:
    """Non-null count of every column per group."""
    return uc.groupBy("exp_group").agg(
        *[F.count(c).alias(c) for c in ("user_id", "likes", "views", "ctr")]
    )


def global_ctr(uc: DataFrame) -> DataFrame:
    """Ratio of sums per group: sum(likes) / sum(views)."""
    return uc.groupBy("exp_group").agg(
        F.sum("likes").cast("bigint").alias("likes"),
        F.sum("views").cast("bigint").alias("views"),
        F.try_divide(F.sum("likes"), F.sum("views").cast("double")).alias("global_ctr"),
    )


def smoothed_ctr(uc: DataFrame, alpha: float = 5.0, groups: Sequence[int] | None = None) -> DataFrame:
    """(likes + alpha * g) / (views + alpha), g = the user's group global CTR.

    With ``groups`` the per-group table is limited to them (at most
    ``len(groups)`` rows) and broadcast; without, the join strategy is left to
    the optimizer's size check.
    """
    if groups is not None:
        uc = uc.where(F.col("exp_group").isin(list(groups)))
    g = global_ctr(uc).select("exp_group", "global_ctr")
    if groups is not None:
        g = F.broadcast(g)
    a = F.lit(float(alpha))
    return uc.join(g, "exp_group").select(
        "exp_group",
        "user_id",
        "likes",
        "views",
        "ctr",
        F.try_divide(F.col("likes") + a * F.col("global_ctr"), F.col("views") + a).alias("smoothed_ctr"),
    )


def control_ctr(uc: DataFrame, control: int):
    """Global CTR of the control group as a scalar (one-row subquery)."""
    c = uc.where(F.col("exp_group") == control)
    return c.agg(F.try_divide(F.sum("likes"), F.sum("views").cast("double"))).scalar()


def linearized_likes(uc: DataFrame, control: int) -> DataFrame:
    """likes - CTR_control * views for every user."""
    c = control_ctr(uc, control)
    return uc.select(
        "exp_group", "user_id", "likes", "views", "ctr", (F.col("likes") - c * F.col("views")).alias("linearized_likes")
    )


def linearized_likes_pairs(uc: DataFrame, pairs) -> DataFrame:
    """``linearized_likes`` for several (control, test) pairs in one pass.

    Each user row is tagged with the control group of every pair its group
    belongs to; the per-group CTR table of the pairs' groups (broadcast, at
    most two rows per pair) supplies CTR_control.  Output adds ``control``.
    """
    tags = [F.when(F.col("exp_group").isin(c, t), F.lit(c)) for c, t in pairs]
    tagged = uc.withColumn("control", F.explode(F.array(*tags))).where(F.col("control").isNotNull())
    groups = sorted({g for pair in pairs for g in pair})
    uc = uc.where(F.col("exp_group").isin(groups))
    # one row per group of the pairs (the same user table feeds both sides)
    ctl = F.broadcast(global_ctr(uc).select(F.col("exp_group").alias("control"), F.col("global_ctr").alias("_c")))
    return tagged.join(ctl, "control").select(
        "exp_group",
        "user_id",
        "likes",
        "views",
        "ctr",
        (F.col("likes") - F.col("_c") * F.col("views")).alias("linearized_likes"),
        F.col("control").cast("int").alias("control"),
    )


def with_bucket(uc: DataFrame, n_buckets: int = 50, salt: str = "bucket", hash_fn: str = "md5") -> DataFrame:
    """Adds the user's bucket.

    ``hash_fn="md5"``: md5("<user_id>-<salt>") mod n_buckets.  ``hash_fn="xxhash64"``: the
    seed-0 xxHash64 of the user id's eight bytes as an unsigned integer, mod n_buckets
    (``salt`` plays no part).  Both can be computed again in any SQL engine.
    """
    if hash_fn == "xxhash64":
        return uc.withColumn("bucket", unsigned_mod(xxhash64_plain(F.col("user_id")), n_buckets))
    if hash_fn != "md5":
        raise ValueError(f"unknown hash_fn {hash_fn!r}")
    return uc.withColumn("bucket", md5_mod(split_key("user_id", salt), n_buckets))


def bucket_sums(uc: DataFrame, n_buckets: int = 50, salt: str = "bucket", hash_fn: str = "md5") -> DataFrame:
    """Per (exp_group, bucket): bucket_ctr = sum(likes) / sum(views)."""
    return with_bucket(uc, n_buckets, salt, hash_fn).groupBy("exp_group", "bucket").agg(
        F.try_divide(F.sum("likes"), F.sum("views").cast("double")).alias("bucket_ctr")
    )


def bucket_ctr(
    uc: DataFrame, n_buckets: int = 50, salt: str = "bucket", q: float = 0.9, hash_fn: str = "md5"
) -> DataFrame:
    """Per (exp_group, bucket): sum(likes) / sum(views) and the exact 0.9
    quantile (index rule) of the user CTRs in the bucket.

    One pass: users are counted per (group, bucket, ctr) together with their
    likes and views; the ranking pass gives both the bucket totals and the
    quantile.  Users with an undefined CTR count in the sums, not in the
    quantile (rank weight 0).
    """
    keys = ["exp_group", "bucket"]
    counts = with_bucket(uc, n_buckets, salt, hash_fn).groupBy(*keys, "ctr").agg(
        F.count("ctr").alias("_cnt"), F.sum("likes").alias("_l"), F.sum("views").alias("_v")
    )
    ranked = running_totals(counts, "ctr", ["_cnt", "_l", "_v"], keys)
    n = F.col("_cnt_total")
    target = F.least(F.floor(n * F.lit(float(q))), n - 1)
    hit = (F.col("_cnt") > 0) & (F.col("_cnt_below") <= target) & (target < F.col("_cnt_below") + F.col("_cnt"))
    return ranked.groupBy(*keys).agg(
        F.try_divide(F.max("_l_total"), F.max("_v_total").cast("double")).alias("bucket_ctr"),
        F.max(F.when(hit, F.col("ctr"))).alias("ctr9"),
    )

def group_moments(uc: DataFrame) -> DataFrame:
    """Per experiment group, everything the CTR and linearized-likes tests need
    (one aggregate; one row per group)."""
    return uc.groupBy("exp_group").agg(
        F.count("ctr").alias("n_ctr"),
        F.avg("ctr").alias("mean_ctr"),
        F.var_samp("ctr").alias("var_ctr"),
        F.count(F.lit(1)).alias("n"),
        F.sum("likes").alias("sum_likes"),
        F.sum("views").alias("sum_views"),
        F.avg("likes").alias("mean_likes"),
        F.avg("views").alias("mean_views"),
        F.var_samp("likes").alias("var_likes"),
        F.var_samp("views").alias("var_views"),
        F.covar_samp("likes", "views").alias("cov_lv"),
    )
