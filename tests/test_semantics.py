import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from feedlens.operators import activity, alerts, retention
from feedlens.operators.experiments import metrics
from feedlens.sources import events as ev

T0 = dt.datetime(2024, 1, 30, 0, 0)


def _series(spark, values, metric="m", gaps=()):
    rows, t = [], T0
    for i, v in enumerate(values):
        if i in gaps:
            t += dt.timedelta(minutes=15)
        rows.append((metric, t, None if v is None else float(v)))
        t += dt.timedelta(minutes=15)
    return spark.createDataFrame(rows, "metric string, date_time timestamp_ntz, value double")


def test_alert_warm_up_has_no_band(spark):
    b = alerts.iqr_bands(_series(spark, [1, 2, 3, 4, 5])).orderBy("date_time").collect()
    assert all(r.quantile25 is None and r.quantile75 is None for r in b)
    assert all(r.upper_limit is None for r in b)


def test_flat_series_never_alerts(spark):
    b = alerts.iqr_bands(_series(spark, [7] * 21)).orderBy("date_time").collect()
    last = b[-1]
    assert last.iqr == 0 and last.upper_limit == 7 and last.lower_limit == 7
    assert not (last.value > last.upper_limit or last.value < last.lower_limit)


def test_spike_alerts(spark):
    s = _series(spark, [7] * 20 + [8])
    b = alerts.iqr_bands(s).orderBy(F.col("date_time").desc()).first()
    assert b.value > b.upper_limit


def test_rows_not_time_window_spans_gap(spark):
    b = alerts.iqr_bands(_series(spark, [1, 2, 3, 4, 5, 6, 7], gaps=(5,))).orderBy("date_time").collect()
    # row 6 (after a missing bucket) still sees the 5 previous rows
    assert b[5].quantile25 == 2.0 and b[5].quantile75 == 4.0


def test_bands_match_pandas_rolling(spark):
    rnd = np.random.default_rng(1)
    vals = list(rnd.integers(0, 50, size=60).astype(float))
    vals[17] = None
    got = alerts.iqr_bands(_series(spark, vals)).orderBy("date_time").toPandas()
    s = pd.Series(vals, dtype="float64")
    q25 = s.shift(1).rolling(5).quantile(0.25)
    q75 = s.shift(1).rolling(5).quantile(0.75)
    iqr = q75 - q25
    up = (q75 + 5 * iqr).rolling(window=5, center=True, min_periods=1).mean()
    lo = (q25 - 5 * iqr).rolling(window=5, center=True, min_periods=1).mean()
    for mine, ref in ((got.quantile25, q25), (got.quantile75, q75), (got.upper_limit, up), (got.lower_limit, lo)):
        a, b = mine.to_numpy(dtype=float, na_value=np.nan), ref.to_numpy(dtype=float)
        assert np.array_equal(np.isnan(a), np.isnan(b))
        assert np.allclose(a[~np.isnan(a)], b[~np.isnan(b)], rtol=0, atol=1e-9)


def _feed(spark, rows):
    return spark.createDataFrame(rows, ev.FEED_SCHEMA)


def test_week_gap_retention(spark):
    # active in the weeks of 2024-01-01 and 2024-01-15 only
    feed = _feed(
        spark,
        [
            (1, dt.datetime(2024, 1, 2, 10), "view", 1, 0, 20, "iOS"),
            (1, dt.datetime(2024, 1, 16, 10), "like", 1, 0, 20, "iOS"),
        ],
    )
    st = {(r.this_week, r.user_status) for r in retention.weekly_status(feed, dt.date(2024, 3, 1)).collect()}
    d = dt.date
    assert st == {
        (d(2024, 1, 1), "new"),
        (d(2024, 1, 8), "lost"),
        (d(2024, 1, 15), "new"),
        (d(2024, 1, 22), "lost"),
    }
    # the week after as_of's week is not finished: its losses are dropped
    st2 = {(r.this_week, r.user_status) for r in retention.weekly_status(feed, dt.date(2024, 1, 17)).collect()}
    assert (d(2024, 1, 22), "lost") not in st2


MSG = "user_id long, reciever_id long, time timestamp_ntz, gender long, age long, os string"


def test_receiver_only_and_sender_only(spark):
    t = dt.datetime(2024, 1, 30, 12)
    msgs = spark.createDataFrame([(1, 2, t, 1, 30, "iOS")], MSG)
    rows = {r.users: r for r in activity.message_user_day(msgs, dt.date(2024, 1, 30)).collect()}
    assert rows[1].messages_sent == 1 and rows[1].messages_received == 0
    # receiver-only user: sender-side defaults
    assert rows[2].messages_received == 1 and rows[2].messages_sent == 0
    assert rows[2].event_date == dt.date(1970, 1, 1) and rows[2].gender == 0 and rows[2].os == ""


def test_receiver_with_two_sender_profiles(spark):
    t = dt.datetime(2024, 1, 30, 12)
    msgs = spark.createDataFrame(
        [
            (1, 3, t, 1, 30, "iOS"),
            (2, 3, t, 0, 40, "Android"),
            (3, 1, t, 0, 25, "iOS"),
        ],
        MSG,
    )
    day = dt.date(2024, 1, 30)
    faithful = [r for r in activity.message_user_day(msgs, day).collect() if r.users == 3]
    assert len(faithful) == 2 and sum(r.messages_sent for r in faithful) == 2  # sent measures repeated
    clean = [r for r in activity.message_user_day_by_user(msgs, day).collect() if r.users == 3]
    assert len(clean) == 1 and clean[0].messages_sent == 1 and clean[0].messages_received == 2
    assert clean[0].users_received == 2 and clean[0].gender == 0 and clean[0].age == 25


def test_zero_view_user_has_null_ctr(spark):
    feed = _feed(spark, [(5, dt.datetime(2024, 1, 9, 8), "like", 1, 1, 20, "iOS")])
    r = metrics.user_ctr(feed, dt.date(2024, 1, 8), dt.date(2024, 1, 14)).first()
    assert r.likes == 1 and r.views == 0 and r.ctr is None


def test_cube_dimensions_have_equal_totals(spark):
    e = ev.read_events(spark, "/root/testdata/sf0.01")
    cube = activity.daily_metrics_cube(ev.feed_actions(e), ev.message_actions(e), dt.date(2024, 1, 30))
    tot = cube.groupBy("dimension").agg(*[F.sum(c).alias(c) for c in activity.CUBE_MEASURES]).collect()
    assert len(tot) == 3
    assert len({tuple(r[c] for c in activity.CUBE_MEASURES) for r in tot}) == 1


def test_metrics_cube_sink_is_idempotent_and_keeps_other_days(spark, tmp_path):
    from feedlens.sources import sink

    e = ev.read_events(spark, "/root/testdata/sf0.01")
    f, m = ev.feed_actions(e), ev.message_actions(e)
    path = str(tmp_path / "cube")
    d1, d2 = dt.date(2024, 1, 29), dt.date(2024, 1, 30)
    c1, c2 = activity.daily_metrics_cube(f, m, d1), activity.daily_metrics_cube(f, m, d2)
    sink.write_metrics_cube(c1, path, d1)
    sink.write_metrics_cube(c2, path, d2)
    sink.write_metrics_cube(c2, path, d2)  # retried load of the same day
    back = sink.read_metrics_cube(spark, path)
    assert back.count() == c1.count() + c2.count()
    assert back.exceptAll(c1.unionByName(c2)).count() == 0


def test_incremental_user_days_give_the_same_retention(spark, tmp_path):
    e = ev.read_events(spark, "/root/testdata/sf0.01")
    feed = ev.feed_actions(e)
    path = str(tmp_path / "user_days")
    # day by day, with one day loaded twice (retry)
    for d in range(1, 31):
        retention.write_user_days(feed, path, dt.date(2024, 1, d))
    retention.write_user_days(feed, path, dt.date(2024, 1, 15))
    inc = retention.retention_from_user_days(retention.read_user_days(spark, path), dt.date(2024, 1, 31))
    full = retention.retention(feed, dt.date(2024, 1, 31))
    assert sorted(inc.collect()) == sorted(full.collect())


def test_sender_without_receiver_keeps_a_zero_row(spark):
    t = dt.datetime(2024, 1, 30, 12)
    msgs = spark.createDataFrame([(1, None, t, 1, 30, "iOS"), (2, 3, t, 0, 20, "Android")], MSG)
    day = dt.date(2024, 1, 30)
    sent = {r.users: r for r in activity.messages_sent(msgs, day).collect()}
    assert sent[1].messages_sent == 0 and sent[1].users_sent == 0
    faithful = {r.users: r for r in activity.message_user_day(msgs, day).collect()}
    assert set(faithful) == {1, 2, 3}
    assert faithful[1].messages_sent == 0 and faithful[1].gender == 1 and faithful[1].event_date == day
    clean = {r.users: r for r in activity.message_user_day_by_user(msgs, day).collect()}
    assert set(clean) == {1, 2, 3} and clean[1].messages_sent == 0 and clean[1].users_sent == 0
