"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the whole ``events`` table of ``sf_dir`` through the
feed_actions / message_actions views and runs one operator with the
parameters in ``params.DEFAULT``.  Double columns are rounded to ``DIGITS``
places (p-values included) so results compare exactly with the SQL oracle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.numeric import round_doubles
from feedlens.functions.time import day_range, to_monday
from feedlens.operators import activity, alerts, audience, retention, uniques
from feedlens.operators.experiments import distribution, metrics, resample, split, twosample
from feedlens.plans.params import DEFAULT, DIGITS, Params
from feedlens.session import shared_dir
from feedlens.sources import events as ev
from feedlens.sources import sink

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return round_doubles(df, digits)


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two views over ``events``, built anew for each query: files added since are seen."""
    e = ev.read_events(spark, sf_dir)
    return ev.feed_actions(e), ev.message_actions(e)


def _uc(feed: DataFrame, p: Params, groups) -> DataFrame:
    return metrics.user_ctr(feed, p.exp_first, p.exp_last, groups)


def build(p: Params = DEFAULT) -> dict[str, Query]:
    y = p.yesterday
    A, B = p.ab_groups
    AA, AB = p.aa_groups
    q: dict[str, Query] = {}

    def reg(name: str):
        def deco(fn):
            q[name] = lambda spark, sf_dir, _fn=fn: rounded(_fn(*_tables(spark, sf_dir), spark))
            return fn

        return deco

    # ---- activity / ETL cube -------------------------------------------------
    @reg("feed_user_day")
    def _(feed, msgs, spark):
        return activity.feed_user_day(feed, y)

    @reg("messages_sent")
    def _(feed, msgs, spark):
        return activity.messages_sent(msgs, y)

    @reg("messages_received")
    def _(feed, msgs, spark):
        return activity.messages_received(msgs, y)

    @reg("message_user_day")
    def _(feed, msgs, spark):
        return activity.message_user_day(msgs, y)

    @reg("message_user_day_by_user")
    def _(feed, msgs, spark):
        return activity.message_user_day_by_user(msgs, y)

    @reg("user_activity_day")
    def _(feed, msgs, spark):
        return activity.user_activity_day(feed, msgs, y)

    def _user_tables(feed, msgs, spark):
        path = shared_dir(spark, "user_tables")
        prefix = "user_tables_" + path.rsplit("/", 1)[-1]
        names = activity.write_user_tables(feed, msgs, y, path, prefix, int(spark.conf.get("spark.sql.shuffle.partitions")))
        return [spark.table(names[n]) for n in activity.USER_TABLES]

    @reg("message_user_day_bucketed")
    def _(feed, msgs, spark):
        _, sent, received, users = _user_tables(feed, msgs, spark)
        return activity.message_user_day_from_tables(users, sent, received)

    @reg("user_activity_day_bucketed")
    def _(feed, msgs, spark):
        feed_day, sent, received, users = _user_tables(feed, msgs, spark)
        return activity.user_activity_from_tables(feed_day, activity.message_user_day_from_tables(users, sent, received))

    @reg("metrics_cube")
    def _(feed, msgs, spark):
        return activity.daily_metrics_cube(feed, msgs, y)

    for dim in activity.DEMOGRAPHICS:

        @reg(f"{dim}_report")
        def _(feed, msgs, spark, _dim=dim):
            return activity.dimension_report(activity.user_activity_day(feed, msgs, y), _dim)

    @reg("metrics_cube_sink")
    def _(feed, msgs, spark):
        path = shared_dir(spark, "metrics_cube")
        cube = activity.daily_metrics_cube(feed, msgs, y)
        sink.write_metrics_cube(cube, path, y)
        return sink.read_metrics_cube(spark, path)

    # ---- audience reports ----------------------------------------------------
    @reg("feed_yesterday")
    def _(feed, msgs, spark):
        return audience.feed_yesterday(feed, p.as_of)

    @reg("dau_feed")
    def _(feed, msgs, spark):
        return audience.dau_feed(feed, p.as_of, p.report_days)

    @reg("dau_total")
    def _(feed, msgs, spark):
        return audience.dau_total(feed, msgs, p.as_of, p.report_days)

    @reg("dau_both")
    def _(feed, msgs, spark):
        return audience.dau_both(feed, msgs, p.as_of, p.report_days)

    @reg("approx_uniques")
    def _(feed, msgs, spark):
        return audience.approx_uniques(feed, p.as_of, p.report_days)

    @reg("report_daily")
    def _(feed, msgs, spark):
        return audience.report_daily(feed, p.as_of, p.report_days)

    @reg("report_week_over_week")
    def _(feed, msgs, spark):
        return audience.report_week_over_week(feed, msgs, p.as_of, p.report_days)

    @reg("retention")
    def _(feed, msgs, spark):
        return retention.retention(feed, p.as_of)

    @reg("retention_incremental")
    def _(feed, msgs, spark):
        # backfill the (user, day) store in one job, then compute retention from it
        path = shared_dir(spark, "user_days")
        retention.write_user_days(feed, path)
        return retention.retention_from_user_days(retention.read_user_days(spark, path), p.as_of)

    @reg("retention_bitmap")
    def _(feed, msgs, spark):
        # the bit sets of the weeks before as_of's, then the later days merged into them, as a daily load does
        path = shared_dir(spark, "week_bits")
        start = F.lit(p.as_of - dt.timedelta(days=7))
        retention.week_bits(feed.where(F.col("time") < start)).write.parquet(path + "/old")
        old = spark.read.schema(retention.WEEK_BITS_SCHEMA).parquet(path + "/old")
        retention.merge_week_bits(old, retention.week_bits(feed.where(F.col("time") >= start))).write.parquet(path + "/new")
        return retention.retention_from_week_bits(spark.read.schema(retention.WEEK_BITS_SCHEMA).parquet(path + "/new"), p.as_of)

    @reg("uniques_by_week_sketches")
    def _(feed, msgs, spark):
        path = shared_dir(spark, "daily_sketches")
        uniques.write_daily_sketches(feed, path)
        approx = uniques.merged_uniques(uniques.read_daily_sketches(spark, path), to_monday("event_date").alias("week"), "os")
        exact = feed.where(F.col("user_id").isNotNull()).groupBy(to_monday("time").alias("week"), "os").agg(F.count_distinct("user_id").alias("users_exact"))
        return uniques.sketch_check(exact, approx, ["week", "os"])

    @reg("uniques_window_sketches")
    def _(feed, msgs, spark):
        # the report window, by gender, merged from its days
        path = shared_dir(spark, "daily_sketches")
        first, last = p.window
        uniques.write_daily_sketches(feed, path, first, last)
        approx = uniques.merged_uniques(uniques.read_daily_sketches(spark, path), "gender")
        rows = feed.where(day_range(feed, first, last) & F.col("user_id").isNotNull())
        return uniques.sketch_check(rows.groupBy("gender").agg(F.count_distinct("user_id").alias("users_exact")), approx, ["gender"])

    def _bitmaps(feed, msgs, spark):
        first, last = p.window
        stored = []
        for name, table in (("feed", feed), ("messages", msgs)):
            path = shared_dir(spark, "daily_bitmaps", name)
            uniques.write_daily_bitmaps(table, path, first, last)
            stored.append(uniques.read_daily_bitmaps(spark, path))
        return uniques.audience_from_bitmaps(*stored)

    @reg("dau_total_bitmaps")
    def _(feed, msgs, spark):
        return _bitmaps(feed, msgs, spark).select("date", "users")

    @reg("dau_both_bitmaps")
    def _(feed, msgs, spark):
        return _bitmaps(feed, msgs, spark).where("both_users > 0").select("date", F.col("both_users").alias("DAU"))

    # ---- alerts ----------------------------------------------------------------
    @reg("feed_15min")
    def _(feed, msgs, spark):
        return alerts.feed_15min(feed, p.now)

    @reg("messages_15min")
    def _(feed, msgs, spark):
        return alerts.messages_15min(msgs, p.now)

    @reg("anomaly_bands")
    def _(feed, msgs, spark):
        return alerts.anomaly_bands(feed, msgs, p.now, p.alert_a, p.alert_n)

    @reg("anomaly_alerts")
    def _(feed, msgs, spark):
        return alerts.anomaly_alerts(feed, msgs, p.now, p.alert_a, p.alert_n)

    @reg("anomaly_backtest")
    def _(feed, msgs, spark):
        return alerts.anomaly_backtest(feed, msgs, p.now, p.alert_a, p.alert_n)

    # ---- experiments -----------------------------------------------------------
    @reg("user_ctr")
    def _(feed, msgs, spark):
        return _uc(feed, p, p.ab_groups)

    @reg("group_profile")
    def _(feed, msgs, spark):
        return metrics.group_profile(_uc(feed, p, p.ab_groups))

    @reg("global_ctr")
    def _(feed, msgs, spark):
        return metrics.global_ctr(_uc(feed, p, p.ab_groups))

    @reg("ab_split")
    def _(feed, msgs, spark):
        return split.assign_groups(split.active_users(feed, p.exp_first, p.exp_last), p.split_salt, p.n_groups)

    @reg("split_balance")
    def _(feed, msgs, spark):
        users = split.active_users(feed, p.exp_first, p.exp_last)
        return split.split_balance(split.assign_groups(users, p.split_salt, p.n_groups))

    @reg("welch_ttest")
    def _(feed, msgs, spark):
        return twosample.welch_ttest(_uc(feed, p, p.ab_groups), "exp_group", "ctr", A, B)

    @reg("mann_whitney")
    def _(feed, msgs, spark):
        return twosample.mann_whitney(_uc(feed, p, p.ab_groups), "exp_group", "ctr", A, B)

    @reg("prob_a_gt_b")
    def _(feed, msgs, spark):
        return twosample.prob_a_gt_b(_uc(feed, p, p.ab_groups), "exp_group", "ctr", A, B)

    @reg("smoothed_ctr")
    def _(feed, msgs, spark):
        return metrics.smoothed_ctr(_uc(feed, p, p.ab_groups), p.alpha_smooth, p.ab_groups)

    @reg("smoothed_ctr_ttest")
    def _(feed, msgs, spark):
        sm = metrics.smoothed_ctr(_uc(feed, p, p.ab_groups), p.alpha_smooth, p.ab_groups)
        return twosample.welch_ttest(sm, "exp_group", "smoothed_ctr", A, B)

    @reg("poisson_bootstrap")
    def _(feed, msgs, spark):
        return resample.poisson_bootstrap(_uc(feed, p, p.ab_groups), A, B, p.n_bootstrap, p.boot_salt)

    @reg("poisson_bootstrap_classes")
    def _(feed, msgs, spark):
        return resample.poisson_bootstrap_classes(_uc(feed, p, p.ab_groups), A, B, p.n_bootstrap, p.boot_salt)

    @reg("bootstrap_diff")
    def _(feed, msgs, spark):
        boot = resample.poisson_bootstrap(_uc(feed, p, p.ab_groups), A, B, p.n_bootstrap, p.boot_salt)
        return resample.bootstrap_diff(boot, A, B)

    @reg("bucket_ctr")
    def _(feed, msgs, spark):
        return metrics.bucket_ctr(_uc(feed, p, p.ab_groups), p.n_buckets, p.bucket_salt, p.bucket_q)

    @reg("bucket_ctr_xxhash")
    def _(feed, msgs, spark):
        return metrics.bucket_ctr(_uc(feed, p, p.ab_groups), p.n_buckets, q=p.bucket_q, hash_fn="xxhash64")

    def _bucket_tests(b):
        w = twosample.welch_ttest(b, "exp_group", "bucket_ctr", A, B).select(
            F.lit("welch").alias("test"), "group_a", "group_b", "n_a", "n_b",
            F.col("t_stat").alias("statistic"), "p_value",
        )
        m = twosample.mann_whitney(b, "exp_group", "bucket_ctr", A, B).select(
            F.lit("mann_whitney").alias("test"), "group_a", "group_b", "n_a", "n_b",
            F.col("u_stat").alias("statistic"), "p_value",
        )
        return w.unionByName(m)

    @reg("bucket_tests")
    def _(feed, msgs, spark):
        return _bucket_tests(metrics.bucket_sums(_uc(feed, p, p.ab_groups), p.n_buckets, p.bucket_salt))

    @reg("bucket_tests_xxhash")
    def _(feed, msgs, spark):
        return _bucket_tests(metrics.bucket_sums(_uc(feed, p, p.ab_groups), p.n_buckets, hash_fn="xxhash64"))

    @reg("linearized_likes")
    def _(feed, msgs, spark):
        groups = sorted({g for pair in p.lin_pairs for g in pair})
        return metrics.linearized_likes_pairs(_uc(feed, p, groups), p.lin_pairs)

    @reg("linearized_ttest")
    def _(feed, msgs, spark):
        groups = sorted({g for pair in p.lin_pairs for g in pair})
        return twosample.linearized_ttests(_uc(feed, p, groups), p.lin_pairs)

    @reg("ctr_histogram")
    def _(feed, msgs, spark):
        return distribution.histogram(_uc(feed, p, p.ab_groups), "ctr", p.hist_bins, ["exp_group"])

    @reg("ctr_group_histogram")
    def _(feed, msgs, spark):
        # raw CTR, one histogram per group with its own edges
        return distribution.histogram(_uc(feed, p, p.ab_groups), "ctr", p.hist_bins, ["exp_group"], shared_edges=False, groups=p.ab_groups)

    @reg("bootstrap_diff_histogram")
    def _(feed, msgs, spark):
        boot = resample.poisson_bootstrap(_uc(feed, p, p.ab_groups), A, B, p.n_bootstrap, p.boot_salt)
        return distribution.histogram(resample.bootstrap_diff(boot, A, B), "diff", p.hist_bins)

    @reg("smoothed_ctr_histogram")
    def _(feed, msgs, spark):
        sm = metrics.smoothed_ctr(_uc(feed, p, p.ab_groups), p.alpha_smooth, p.ab_groups)
        # one histogram per group, each with its own edges
        return distribution.histogram(sm, "smoothed_ctr", p.hist_bins, ["exp_group"], shared_edges=False, groups=p.ab_groups)

    @reg("bootstrap_ctr_histogram")
    def _(feed, msgs, spark):
        boot = resample.poisson_bootstrap(_uc(feed, p, p.ab_groups), A, B, p.n_bootstrap, p.boot_salt)
        return distribution.histogram(boot, "ctr", p.hist_bins, ["exp_group"], shared_edges=False, groups=p.ab_groups)

    @reg("bucket_ctr_histogram")
    def _(feed, msgs, spark):
        b = metrics.bucket_sums(_uc(feed, p, p.ab_groups), p.n_buckets, p.bucket_salt)
        return distribution.histogram(b, "bucket_ctr", p.hist_bins, ["exp_group"])

    def _aa(feed):
        return resample.aa_test(_uc(feed, p, p.aa_groups), AA, AB, p.n_sims, p.k, p.aa_salt, fit=True)

    def _p_values(feed, spark):
        """The p-values of the A/A test, one row per simulation, computed once: what follows reads them several times."""
        path = shared_dir(spark, "aa_p_values")
        _aa(feed).select("p_value").write.parquet(path)
        return spark.read.schema("p_value double").parquet(path)

    @reg("aa_test")
    def _(feed, msgs, spark):
        return _aa(feed)

    @reg("pvalue_histogram")
    def _(feed, msgs, spark):
        return distribution.histogram(_p_values(feed, spark), "p_value", p.pvalue_bins)

    @reg("aa_false_positive_rate")
    def _(feed, msgs, spark):
        return resample.aa_false_positive_rate(_aa(feed), p.p_alpha)

    @reg("pvalue_qq")
    def _(feed, msgs, spark):
        return distribution.uniform_qq(_p_values(feed, spark), "p_value")

    @reg("pvalue_qq_fit")
    def _(feed, msgs, spark):
        return distribution.qq_fit(distribution.uniform_qq(_p_values(feed, spark), "p_value"))

    return q


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build()["metrics_cube"](spark, sf_dir)
