"""Rows without a user, fresh listings, ranking edge cases, t tails, session settings."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlens.functions.ranking import running_totals
from feedlens.functions.stats import t_sf2
from feedlens.operators import audience, retention
from feedlens.operators.experiments import metrics
from feedlens.sources import events as ev

AS_OF = dt.date(2024, 1, 31)


@pytest.fixture(scope="module")
def tables(spark):
    t = dt.datetime(2024, 1, 30, 12)
    feed = [(u, t, "view", 1, 0, 20, "iOS") for u in (1, 1, None)] + [(None, t, "like", 1, 0, 20, "iOS")]
    msgs = [(u, 5, t, 0, 20, "iOS") for u in (1, None)]
    return spark.createDataFrame(feed, ev.FEED_SCHEMA), spark.createDataFrame(msgs, ev.MESSAGE_SCHEMA)


def test_rows_without_a_user_are_nobody(spark, tables, tmp_path):
    feed, msgs = tables
    row = audience.dau_feed(feed, AS_OF).first()
    assert (row.DAU, row.views, row.likes) == (1, 2, 0)
    assert audience.dau_total(feed, msgs, AS_OF).first().users == 1
    assert audience.dau_both(feed, msgs, AS_OF).first().DAU == 1
    wow = {r.series: r.last_value for r in audience.report_week_over_week(feed, msgs, AS_OF).collect()}
    assert wow == {"total": 1, "feed": 1, "both": 1}
    daily = audience.report_daily(feed, AS_OF).first()
    assert (daily.dau, daily.views, daily.likes) == (1, 3, 1)  # this report counts all rows
    assert {r.num_users for r in retention.retention(feed, AS_OF).collect()} == {1}
    retention.write_user_days(feed, str(tmp_path / "days"))
    days = retention.read_user_days(spark, str(tmp_path / "days"))
    assert {r.num_users for r in retention.retention_from_user_days(days, AS_OF).collect()} == {1}


def test_queries_see_files_added_later(spark, tmp_path):
    import __spark_entry__ as E

    e = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    path = str(tmp_path / "events.parquet")
    e.where("ts < timestamp_ntz'2024-01-30 00:00:00'").write.parquet(path)
    q = E.queries()["feed_yesterday"]
    assert q(spark, str(tmp_path)).collect() == []
    e.where("ts >= timestamp_ntz'2024-01-30 00:00:00'").write.mode("append").parquet(path)
    assert len(q(spark, str(tmp_path)).collect()) == 1


def test_running_totals_orders_nan_infinities_and_null(spark):
    values = [None, float("-inf"), -2.0, 0.0, 0.0001, 5.0, 1e300, float("inf"), float("nan")]
    df = spark.createDataFrame([(v, 1) for v in values], "v double, w long")
    got = {str(r.v): r.w_below for r in running_totals(df, "v", ["w"], n_parts=4).collect()}
    assert [got[str(v)] for v in values] == list(range(len(values)))


def test_close_values_are_spread(spark):
    df = spark.range(200_000).select((1e6 + F.col("id") / 2000).alias("v"), F.lit(1).cast("long").alias("w"))
    out = running_totals(df, "v", ["w"], n_parts=64)
    got = out.withColumn("task", F.spark_partition_id())
    assert got.where(F.abs(F.col("w_below") - F.round((F.col("v") - 1e6) * 2000)) > 0).isEmpty()
    chunks = out._jdf.queryExecution().toString()
    assert "_cut" in chunks


@pytest.mark.parametrize("nu", [1.0, 2.0])
def test_t_tail_closed_forms(nu):
    t = np.array([1e-3, 0.5, 2.0, 30.0, 1e4])
    want = 2 / math.pi * np.arctan(1 / t) if nu == 1 else 2 / (2 + t * t + t * np.sqrt(2 + t * t))
    assert np.max(np.abs(t_sf2(t, np.full_like(t, nu)) / want - 1)) < 1e-9


@pytest.mark.parametrize("nu", [1e4, 1e6, 1e8, 1e10])
def test_t_tail_with_many_degrees_of_freedom(nu):
    """Against Simpson's rule on the density in u = atan(t / sqrt(nu))."""
    for t in (0.3, 1.0, 2.5, 5.0):
        x = np.linspace(0.0, t, 20_001)
        log_c = -1 / (4 * nu) + 1 / (24 * nu**3)  # log of Gamma((nu+1)/2) / Gamma(nu/2) * sqrt(2/nu)
        f = np.exp(log_c - (nu + 1) / 2 * np.log1p(x * x / nu)) / math.sqrt(2 * math.pi)
        w = np.where(np.arange(len(x)) % 2 == 1, 4.0, 2.0)
        w[[0, -1]] = 1.0
        inside = (f * w).sum() * t / (len(x) - 1) / 3
        assert abs(t_sf2(np.array([t]), np.array([nu]))[0] - (1 - 2 * inside)) < 1e-9


def test_checkpoint_dir_is_needed_on_a_cluster(spark, monkeypatch):
    from feedlens import session

    class Context:
        def __init__(self, master):
            self.master = master
            self.dir = None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    class Session:
        def __init__(self, master):
            self.sparkContext, self.conf = Context(master), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session("spark://host:7077"))
    assert session.ensure_checkpoint_dir(Session("local[4]"))
    clustered = Session("yarn")
    clustered.conf.set("spark.checkpoint.dir", "hdfs:///shared")
    assert session.ensure_checkpoint_dir(clustered) == "hdfs:///shared"
