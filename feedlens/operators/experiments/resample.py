"""Resampling: A/A simulation and Poisson bootstrap.

Random draws come from md5 of "<user>-<block>-<salt>": the four 32-bit chunks
of one digest are the draws of ids 4*block .. 4*block+3.  Each draw is a pure
function of its key: repeatable, independent of partitioning and retries.
Ids are generated per user with ``explode(sequence(...))``; the bootstrap is
reduced by partial (map-side) aggregation, so the shuffle carries one row per
(replicate, group) per task, never users x replicates.  The A/A sampler draws
places in a numbered list of users (see ``aa_samples``): its work follows the samples,
not the users times the simulations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.hashing import md5_chunks, poisson1_weight, poisson_weight
from feedlens.functions.ranking import running_totals
from feedlens.operators.experiments.twosample import welch_ttest

DRAWS_PER_DIGEST = 4  # an md5 digest holds four independent 32-bit uniforms


def _ids(n: int):
    """0 .. n-1 as BIGINT, one row per id after explode."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))


def _draw_key(rep_col: str, salt: str):
    return F.concat_ws("-", F.col("user_id").cast("string"), F.col(rep_col).cast("string"), F.lit(salt))


def _draws(df: DataFrame, n: int, id_col: str, salt: str) -> DataFrame:
    """Every row of ``df`` times ids 0..n-1, with its 32-bit draw ``_u32``:
    one md5 digest per row and block of four ids."""
    n_blocks = -(-n // DRAWS_PER_DIGEST)
    blocks = df.withColumn("_blk", _ids(n_blocks)).withColumn("_h", F.md5(_draw_key("_blk", salt)))
    cols = [c for c in df.columns]
    d = blocks.select(*cols, "_blk", F.posexplode(F.array(*md5_chunks(F.col("_h")))).alias("_j", "_u32"))
    d = d.select(*cols, (F.col("_blk") * DRAWS_PER_DIGEST + F.col("_j")).alias(id_col), "_u32")
    return d.where(F.col(id_col) < n)


def aa_samples(uc: DataFrame, a: int, b: int, n_sims: int, k: int, salt: str = "aa", fit: bool = False) -> DataFrame:
    """For each simulation, k users per group drawn without replacement: (exp_group, user_id, ctr, sim_id).

    The users of a group with a defined CTR are numbered 0 .. n - 1 by user id (distributed
    running totals).  Each (simulation, group) draws k distinct numbers by Floyd's method: for
    i = 0 .. k - 1 with j = n - k + i, the number is 60 bits of
    md5("<sim>-<group>-<i>-<salt>") mod (j + 1), or j if that was drawn before; every
    k-subset is equally likely.  The numbers are joined to the numbered users, so n_sims * k rows per
    group move, however many users there are.  A group with fewer than k users fails the query;
    with ``fit``, k is instead at most half the smaller group (all of it would make every sample
    the same), but at least 1.
    """
    users = uc.where(F.col("exp_group").isin(a, b) & F.col("ctr").isNotNull()).select("exp_group", "user_id", "ctr")
    numbered = running_totals(users.withColumn("_one", F.lit(1).cast("bigint")), "user_id", ["_one"], ["exp_group"])
    numbered = numbered.select("exp_group", "user_id", "ctr", F.col("_one_below").cast("bigint").alias("_at"))
    # one row per group: the broadcast is bounded by the two groups
    sizes = users.groupBy("exp_group").agg(F.count(F.lit(1)).alias("_n"))
    half = F.greatest(F.floor(F.min("_n").over(Window.partitionBy(F.lit(1))) / 2), F.lit(1))
    sizes = sizes.withColumn("_k", (F.least(F.lit(k), half) if fit else F.lit(k)).cast("bigint"))
    sims = uc.sparkSession.range(n_sims).select(F.col("id").alias("sim_id"), F.explode(F.array(F.lit(a), F.lit(b))).alias("exp_group"))
    sims = sims.withColumn("exp_group", F.col("exp_group").cast(users.schema["exp_group"].dataType))
    sims = sims.join(F.broadcast(sizes), "exp_group", "left")
    short = F.raise_error(F.concat(F.lit(f"aa_samples: a group has fewer than {1 if fit else k} users: "), F.col("exp_group").cast("string")))
    few = F.coalesce(F.col("_n"), F.lit(0)) < F.coalesce(F.col("_k"), F.lit(1))
    sims = sims.withColumn("_n", F.when(few, short.cast("bigint")).otherwise(F.col("_n")))
    key = F.concat_ws("-", F.col("sim_id").cast("string"), F.col("exp_group").cast("string"))

    def draw(i: Column) -> Column:
        j = F.col("_n") - F.col("_k") + i
        u = F.conv(F.substring(F.md5(F.concat(key, F.lit("-"), i.cast("string"), F.lit(f"-{salt}"))), 1, 15), 16, 10).cast("bigint")
        return F.struct(j.alias("j"), (u % (j + 1)).alias("t"))

    drawn = F.aggregate(
        F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("_k") - 1), draw),
        F.array().cast("array<bigint>"),
        lambda s, d: F.array_append(s, F.when(F.array_contains(s, d["t"]), d["j"]).otherwise(d["t"])),
    )
    picks = sims.select("sim_id", "exp_group", F.explode(drawn).alias("_at"))
    # every number has its user; the left join keeps the draws, and their check, whatever the users
    return picks.join(numbered, ["exp_group", "_at"], "left").select("exp_group", "user_id", "ctr", "sim_id")


def aa_test(uc: DataFrame, a: int, b: int, n_sims: int = 10000, k: int = 500, salt: str = "aa", fit: bool = False) -> DataFrame:
    """Welch t-test of group a vs b on each simulated pair of samples.

    Fails (like sampling k from fewer than k rows would) when a group has
    fewer than k users with a defined CTR; with ``fit`` smaller samples are drawn then.
    """
    res = welch_ttest(aa_samples(uc, a, b, n_sims, k, salt, fit), "exp_group", "ctr", a, b, ["sim_id"])
    res = uc.sparkSession.range(n_sims).select(F.col("id").alias("sim_id")).join(res, "sim_id", "left")
    least = 1 if fit else k
    short = (F.col("n_a") < least) | (F.col("n_b") < least) | F.col("n_a").isNull() | F.col("n_b").isNull()
    guard = F.when(short, F.raise_error(F.lit(f"aa_test: a group has fewer than {least} users")))
    return res.select(
        "sim_id", "n_a", "n_b", "t_stat", "dof", F.coalesce(guard.cast("double"), F.col("p_value")).alias("p_value")
    )


def aa_false_positive_rate(aa: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Share of simulations with p < alpha (about alpha when the split is sound); a
    simulation whose p is undefined (no variance) counts as one that is not below alpha."""
    return aa.agg(
        F.count(F.lit(1)).alias("n_sims"),
        F.avg(F.coalesce(F.col("p_value") < alpha, F.lit(False)).cast("int")).alias("false_positive_rate"),
    )


def poisson_bootstrap(uc: DataFrame, a: int, b: int, n_bootstrap: int = 2000, salt: str = "boot") -> DataFrame:
    """Global CTR of each group in each Poisson(1)-weighted replicate.

    The weight of (user, replicate r) is the Poisson(1) inverse CDF of 32-bit
    chunk r mod 4 of md5("<user>-<r div 4>-<salt>"): one digest per user and
    block of four replicates.
    """
    users = uc.where(F.col("exp_group").isin(a, b)).select("exp_group", "user_id", "likes", "views")
    reps = _draws(users, n_bootstrap, "replicate", salt).select(
        "exp_group", "likes", "views", "replicate", poisson1_weight(F.col("_u32")).alias("_w")
    )
    return reps.groupBy("replicate", "exp_group").agg(
        F.try_divide(F.sum(F.col("_w") * F.col("likes")), F.sum(F.col("_w") * F.col("views")).cast("double")).alias(
            "ctr"
        )
    )


#: a class of users draws in parts of 1, 2, 4 ... users, and of this many
LARGEST_PART = 256


def poisson_bootstrap_classes(uc: DataFrame, a: int, b: int, n_bootstrap: int = 2000, salt: str = "boot") -> DataFrame:
    """``poisson_bootstrap`` by classes of users with equal (group, likes, views).

    The weights of a class's m users add up to a Poisson(m) draw, so a class draws once for each
    part of m (the powers of two of m modulo ``LARGEST_PART``, and that for every further so many users): rows
    follow classes times replicates, not users.  The draw of part (size, number) in replicate r is the
    inverse CDF at 32-bit chunk r mod 4 of md5("<group>-<likes>-<views>-<size>-<number>-<r div 4>-<salt>").
    """
    users = uc.where(F.col("exp_group").isin(a, b))
    classes = users.groupBy("exp_group", "likes", "views").agg(F.count(F.lit(1)).alias("m"))
    powers = [1 << k for k in range(LARGEST_PART.bit_length() - 1)]
    part = lambda size, number: F.struct(F.lit(size).alias("size"), number.cast("bigint").alias("number"))
    small = [F.when(F.col("m").bitwiseAND(F.lit(x).cast("bigint")) != 0, part(x, F.lit(0))) for x in powers]
    whole = F.floor(F.col("m") / LARGEST_PART)
    large = F.transform(F.when(whole > 0, F.sequence(F.lit(1).cast("bigint"), whole)).otherwise(F.array().cast("array<bigint>")), lambda i: part(LARGEST_PART, i))
    parts = classes.select("exp_group", "likes", "views", F.explode(F.array_compact(F.concat(F.array(*small), large))).alias("p"))
    blocks = parts.select("exp_group", "likes", "views", "p.size", "p.number", _ids(-(-n_bootstrap // DRAWS_PER_DIGEST)).alias("block"))
    digest = F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in ("exp_group", "likes", "views", "size", "number", "block")], F.lit(salt)))
    draws = blocks.withColumn("h", digest).select("exp_group", "likes", "views", "size", "block", F.posexplode(F.array(*md5_chunks(F.col("h")))).alias("j", "u"))
    draws = draws.withColumn("replicate", F.col("block") * DRAWS_PER_DIGEST + F.col("j")).where(F.col("replicate") < n_bootstrap)
    weight = poisson_weight(F.col("u"), LARGEST_PART)
    for x in reversed(powers):
        weight = F.when(F.col("size") == x, poisson_weight(F.col("u"), x)).otherwise(weight)
    drawn = draws.select("replicate", "exp_group", "likes", "views", weight.alias("w"))
    return drawn.groupBy("replicate", "exp_group").agg(F.try_divide(F.sum(F.col("w") * F.col("likes")), F.sum(F.col("w") * F.col("views")).cast("double")).alias("ctr"))


def bootstrap_diff(boot: DataFrame, a: int, b: int) -> DataFrame:
    """Per replicate: ctr_a, ctr_b and diff = ctr_b - ctr_a."""
    r = boot.groupBy("replicate").agg(
        F.max(F.when(F.col("exp_group") == a, F.col("ctr"))).alias("ctr_a"),
        F.max(F.when(F.col("exp_group") == b, F.col("ctr"))).alias("ctr_b"),
    )
    return r.withColumn("diff", F.col("ctr_b") - F.col("ctr_a"))
