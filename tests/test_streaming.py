import datetime as dt

from pyspark.sql import functions as F

from feedlens.operators import alerts
from feedlens.sources import events as ev
from feedlens.streaming import anomaly_alerts_stream_query, feed_15min_stream_query

SF = "/root/testdata/sf0.01"


def test_stream_equals_batch_on_closed_buckets(spark):
    stream = feed_15min_stream_query(spark, SF)
    e = ev.read_events(spark, SF)
    batch = alerts.feed_15min(ev.feed_actions(e), dt.datetime(2024, 1, 31))
    lo = dt.datetime(2024, 1, 30)
    s = {r.date_time: r for r in stream.where(F.col("date_time") >= lo).collect()}
    b = {r.date_time: r for r in batch.collect()}
    assert s and set(s) <= set(b)
    # buckets ending after the final watermark (last event - 15 min) stay open
    last_event = ev.feed_actions(e).unionByName(ev.message_actions(e), allowMissingColumns=True).agg(F.max("time")).first()[0]
    still_open = {t for t in b if t + dt.timedelta(minutes=15) > last_event - dt.timedelta(minutes=15)}
    assert set(s) == set(b) - still_open
    for t, r in s.items():
        assert r.asDict() == {k: (round(v, 6) if isinstance(v, float) else v) for k, v in b[t].asDict().items()}


def test_alert_stream_judges_every_closed_bucket(spark):
    rows = anomaly_alerts_stream_query(spark, SF).select("metric", "date_time", "alert").collect()
    closed = feed_15min_stream_query(spark, SF).select("date_time").collect()
    keys = [(r.metric, r.date_time) for r in rows]
    assert len(keys) == len(set(keys)) and all(r.alert in (0, 1) for r in rows)
    for metric in alerts.FEED_METRICS:
        assert {t for m, t in keys if m == metric} == {r.date_time for r in closed}
    assert {m for m, _ in keys} == {*alerts.FEED_METRICS, *alerts.MESSAGE_METRICS}


def _buckets(spark, first, last):
    t0, rows = dt.datetime(2024, 1, 30, 0, 0), []
    for i in range(first, last):
        t = t0 + dt.timedelta(minutes=15 * i)
        rows += [(t, "feed", u, 1 + u % 2, 2 + (i * u) % 3, 3) for u in range(10 + i % 3 + (40 if i == 17 else 0))]
        rows += [(t, "messages", u, 0, 0, 2) for u in range(4 + i % 2)]
    return spark.createDataFrame(rows, "date_time timestamp_ntz, source string, user_id long, likes long, views long, n long")


def test_many_batches_judge_as_one(spark, tmp_path):
    """A catch-up run that closes all buckets at once gives the rows of one bucket at a time."""
    from feedlens.streaming.alerts_stream import alert_batch

    def run(name, cuts):
        base = str(tmp_path / name)
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            alert_batch(spark, _buckets(spark, a, b), k, base + "/series", base + "/alerts")
        return sorted(map(str, spark.read.parquet(base + "/alerts").drop("batch_id").collect()))

    whole = run("whole", [0, 24])
    assert len(whole) == 24 * 6 and any("ALERT" in r for r in whole)
    assert run("some", [0, 1, 7, 8, 18, 24]) == whole


def test_late_rows_and_several_files(spark, tmp_path):
    """Rows later than the watermark are left out; everything else equals the batch result."""
    from feedlens.streaming.alerts_stream import closed_buckets, bucket_user_stream, feed_15min_rows

    schema = ev.EVENTS_SCHEMA
    def rows(times, first):
        fields = {f.name: None for f in schema}
        return [tuple((fields | {"event_id": first + i, "user_id": i % 3, "ts": t, "event_type": "view"})[f.name] for f in schema) for i, t in enumerate(times)]

    t = lambda m: dt.datetime(2024, 1, 30) + dt.timedelta(minutes=m)
    parts = [[t(1), t(2), t(20)], [t(70), t(71)], [t(80)], [t(3), t(72)], [t(150)]]  # t(3) comes after the watermark has passed its bucket
    src = tmp_path / "events"
    for k, times in enumerate(parts):
        spark.createDataFrame(rows(times, 10 * k), schema).coalesce(1).write.mode("append").parquet(str(src))
        (src / "_SUCCESS").unlink(missing_ok=True)
    files = sorted(src.glob("part-*"), key=lambda p: p.stat().st_mtime_ns)
    got: list = []

    def keep(batch, batch_id):
        got.extend(feed_15min_rows(closed_buckets(batch)).collect())

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    q = bucket_user_stream(stream).writeStream.outputMode("append").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    views = {r.date_time: r.views for r in got}
    assert len(files) == 5 and views[t(0)] == 2 and views[t(15)] == 1 and views[t(60)] == 3


def test_replayed_batch_is_idempotent(spark, tmp_path):
    from feedlens.streaming.alerts_stream import SERIES_SCHEMA, alert_batch

    t0 = dt.datetime(2024, 1, 30, 0, 0)
    rows = []
    for i in range(12):
        t = t0 + dt.timedelta(minutes=15 * i)
        rows += [(t, "feed", u, 1, 2, 3) for u in range(10 + i % 3)]
        rows += [(t, "messages", u, 0, 0, 2) for u in range(4)]
    per_user = spark.createDataFrame(
        rows, "date_time timestamp_ntz, source string, user_id long, likes long, views long, n long"
    )
    series, out = str(tmp_path / "series"), str(tmp_path / "alerts")
    alert_batch(spark, per_user, 0, series, out)
    first = (spark.read.schema(SERIES_SCHEMA).parquet(series).count(), spark.read.parquet(out).count())
    alert_batch(spark, per_user, 0, series, out)  # replay after a failure
    again = (spark.read.schema(SERIES_SCHEMA).parquet(series).count(), spark.read.parquet(out).count())
    assert first == again == (12 * 6, 12 * 6)


def test_late_file_corrects_exactly_its_buckets(spark, tmp_path):
    from feedlens.streaming import corrections
    from feedlens.streaming.alerts_stream import read_event_stream

    t0 = dt.datetime(2024, 1, 29, 22)
    names = [f.name for f in ev.EVENTS_SCHEMA]

    def write(rows, first):
        full = [tuple(({n: None for n in names} | {"event_id": first + i, "user_id": u, "ts": t0 + dt.timedelta(minutes=m), "event_type": kind, "props": "7"})[n] for n in names) for i, (u, m, kind) in enumerate(rows)]
        spark.createDataFrame(full, ev.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(src)

    src, base = str(tmp_path / "events"), str(tmp_path / "out")

    def run():
        corrections.start_corrected_15min(spark, read_event_stream(spark, src), base).awaitTermination()
        return {(r.date_time, r.source): tuple(r)[2:] for r in corrections.current_buckets(spark, base).collect()}

    kinds = ("view", "click", "signup")
    write([(k % 5, 7 * k, kinds[k % 3]) for k in range(60)], 0)
    first = run()
    late = [(1, 3, "view"), (99, 4, "click"), (2, 200, "signup"), (None, 100, "view")]  # after buckets of minute 413 are written
    write(late, 1000)
    second = run()
    assert {k for k in second if second[k] != first.get(k)} == {(t0, "feed"), (t0 + dt.timedelta(minutes=195), "messages")}
    versions = corrections.read_versions(spark, base).groupBy("date_time", "source").count().where("count > 1").collect()
    assert {(r.date_time, r.source) for r in versions} == {(t0, "feed"), (t0 + dt.timedelta(minutes=195), "messages")}
    # the whole history: the batch result with the late rows
    e = spark.read.schema(ev.EVENTS_SCHEMA).parquet(src)
    batch = {r.date_time: r for r in alerts.feed_15min(ev.feed_actions(e), t0 + dt.timedelta(hours=12)).collect()}
    got = {r.date_time: r for r in corrections.corrected_feed_15min(spark, base).collect()}
    assert got.keys() == {t for t in batch if batch[t].users_feed} and all(got[t] == batch[t] for t in got)
    before = sorted(map(str, corrections.read_versions(spark, base).collect()))
    corrections.correct_batch(spark, spark.read.schema(corrections.USERS_SCHEMA).parquet(f"{base}/users").where("batch_id = 1").drop("date", "batch_id"), 1, base)
    assert sorted(map(str, corrections.read_versions(spark, base).collect())) == before  # a replayed batch replaces its own
