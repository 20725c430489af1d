"""The user-facing path: real feed / message tables loaded with column checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedlens.operators import activity
from feedlens.operators.experiments import metrics, twosample
from feedlens.sources import events as ev
from feedlens.sources import read_feed_actions, read_message_actions, sink

SF = "/root/testdata/sf0.01"


def test_tables_from_files_give_the_same_cube(spark, tmp_path):
    e = ev.read_events(spark, SF)
    feed, msgs = ev.feed_actions(e), ev.message_actions(e)
    # a user's own tables: ints stored narrower than the engine's types
    feed.withColumn("gender", F.col("gender").cast("int")).write.parquet(str(tmp_path / "feed"))
    msgs.write.orc(str(tmp_path / "msgs"))
    f2 = read_feed_actions(spark, str(tmp_path / "feed"))
    m2 = read_message_actions(spark, str(tmp_path / "msgs"), fmt="orc")
    assert f2.schema == ev.FEED_SCHEMA and m2.schema == ev.MESSAGE_SCHEMA
    day = dt.date(2024, 1, 30)
    a = activity.daily_metrics_cube(f2, m2, day)
    b = activity.daily_metrics_cube(feed, msgs, day)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    sink.write_metrics_cube(a, str(tmp_path / "cube"), load_date=day)
    assert sink.read_metrics_cube(spark, str(tmp_path / "cube")).count() == b.count()
    uc = metrics.user_ctr(f2, "2024-01-08", "2024-01-14", groups=(1, 2))
    r = twosample.welch_ttest(uc, "exp_group", "ctr", 1, 2).first()
    assert r.n_a > 0 and r.n_b > 0 and 0 <= r.p_value <= 1


def test_missing_column_is_reported(spark, tmp_path):
    e = ev.read_events(spark, SF)
    ev.feed_actions(e).drop("os").write.parquet(str(tmp_path / "feed"))
    with pytest.raises(ValueError, match="os"):
        read_feed_actions(spark, str(tmp_path / "feed"))


def test_cluster_settings_size_shuffle_partitions():
    from feedlens.session import cluster_settings

    big = cluster_settings(largest_shuffle_bytes=50 << 40, total_cores=4000)  # 50 TiB shuffle
    assert int(big["spark.sql.shuffle.partitions"]) == -(-(50 << 40) // (200 << 20))
    small = cluster_settings(largest_shuffle_bytes=1 << 30, total_cores=4000)
    assert int(small["spark.sql.shuffle.partitions"]) == 8000  # at least two waves of tasks
    assert big["spark.sql.adaptive.enabled"] == "true" and big["spark.sql.session.timeZone"] == "UTC"
