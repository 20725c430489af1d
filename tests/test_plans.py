"""Plan-shape checks: the scale properties the operators are designed for."""

import re

import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def qs():
    from feedlens.plans import catalog
    from feedlens.streaming import registered

    return catalog.build() | registered()


def _plan(spark, df) -> str:
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan a cluster starts from
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def _pushed(plan: str) -> list[str]:
    return re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan)


@pytest.mark.parametrize(
    "name", ["feed_user_day", "metrics_cube", "dau_feed", "dau_total", "feed_15min", "user_ctr", "anomaly_bands"]
)
def test_time_range_reaches_the_scan(spark, qs, name):
    plan = _plan(spark, qs[name](spark, SF))
    pushed = _pushed(plan)
    assert pushed and all("GreaterThanOrEqual(ts," in p and "LessThan(ts," in p for p in pushed), pushed


def test_scan_reads_only_needed_columns(spark, qs):
    plan = _plan(spark, qs["dau_feed"](spark, SF))
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert "value" not in schema and "event_id" not in schema


def test_cube_is_one_expand(spark, qs):
    plan = _plan(spark, qs["metrics_cube"](spark, SF))
    assert plan.count("Expand [") == 1


def test_group_ctr_join_is_broadcast(spark, qs):
    plan = _plan(spark, qs["smoothed_ctr"](spark, SF))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_no_cross_joins(spark, qs):
    for name in ["linearized_likes", "linearized_ttest", "ctr_histogram", "mann_whitney", "report_week_over_week"]:
        plan = _plan(spark, qs[name](spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_aa_draws_follow_the_samples(spark, qs):
    # draws are generated from the range of simulations, never from the users
    plan = _plan(spark, qs["aa_test"](spark, SF))
    assert "Range (0, 10000" in plan and "md5(cast(user_id" not in plan


def test_user_rows_are_not_shuffled_on_the_group(spark, qs):
    for name in ["smoothed_ctr_histogram", "ctr_group_histogram"]:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only forced broadcasts
        try:
            plan = _plan(spark, qs[name](spark, SF))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        joins = re.findall(r"SortMergeJoin \[exp_group#\d+L?\]", plan)
        assert not joins, (name, joins)


def test_bootstrap_aggregates_map_side(spark, qs):
    plan = _plan(spark, qs["poisson_bootstrap"](spark, SF))
    assert re.search(r"HashAggregate\(keys=\[replicate#\d+L, exp_group#\d+L\], functions=\[partial_sum", plan)


def test_daily_audience_scans_each_table_once(spark, qs):
    plan = _plan(spark, qs["report_week_over_week"](spark, SF))
    assert len(re.findall(r"FileScan parquet", plan)) == 2


def test_cube_reads_each_table_once(spark, qs):
    plan = _plan(spark, qs["metrics_cube"](spark, SF))
    assert len(re.findall(r"FileScan parquet", plan)) == 2  # feed rows and message rows of one day


TWO_TABLES = {
    "age_report", "gender_report", "os_report", "metrics_cube", "user_activity_day",
    "anomaly_alerts", "anomaly_backtest", "anomaly_bands", "dau_both", "dau_total", "report_week_over_week",
}
# the A/A draws count the users of a group beside numbering them; the sketch has an aggregate of its own
TWO_BRANCHES = {"aa_test", "aa_false_positive_rate", "approx_uniques"}
WRITES = {"pvalue_histogram", "pvalue_qq", "pvalue_qq_fit", "metrics_cube_sink", "retention_incremental", "feed_15min_stream", "feed_15min_corrected_stream", "anomaly_alerts_stream",
          "retention_bitmap", "uniques_by_week_sketches", "uniques_window_sketches", "dau_total_bitmaps", "dau_both_bitmaps",
          "message_user_day_bucketed", "user_activity_day_bucketed"}


def test_each_table_is_read_once(spark, qs):
    for name, q in sorted(qs.items()):
        if name in WRITES:
            continue
        plan = _plan(spark, q(spark, SF))
        scans = len(re.findall(r"FileScan parquet", plan))
        assert scans == (2 if name in TWO_TABLES | TWO_BRANCHES else 1), (name, scans)


def test_bucketed_joins_have_no_exchange(spark, qs):
    """J1 and J2 over tables bucketed by user: both joins read their buckets side by side."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, joins in (("message_user_day_bucketed", 2), ("user_activity_day_bucketed", 3)):
            plan = _plan(spark, qs[name](spark, SF))
            assert "Exchange" not in plan and len(re.findall(r"SortMergeJoin", plan)) >= joins, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
