"""Seed-0 xxHash64 buckets, stored sketches and bitmaps, bit sets of active weeks."""

import datetime as dt
import random
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from feedlens.functions.hashing import unsigned_mod, xxhash64_plain
from feedlens.operators import audience, retention, uniques
from feedlens.operators.experiments import metrics

VALUES = [0, 1, -1, 42, 50, 2**31, 2**32 + 7, 2**63 - 1, -(2**63), 123456789, *range(1000, 1100)]


def test_xxhash_vectors(spark):
    # fixed values: xxHash64 of the little-endian 8 bytes of 0 and 1, seed 0
    known = {0: 0x34C96ACDCADB1BBB, 1: 0x9F29CB17A2A49995}
    rows = spark.createDataFrame([(v,) for v in VALUES], "v long")
    got = {r.v: (r.h, r.b) for r in rows.select("v", xxhash64_plain(F.col("v")).alias("h"), unsigned_mod(xxhash64_plain(F.col("v")), 50).alias("b")).collect()}
    for v in VALUES:
        want = xxhash.xxh64_intdigest(struct.pack("<q", v))
        assert got[v] == (want - 2**64 if want >= 2**63 else want, want % 50)
    assert {v: got[v][0] % 2**64 for v in known} == known
    assert rows.select(xxhash64_plain(F.lit(None).cast("long")).alias("h")).first().h is None


def test_xxhash_buckets(spark):
    users = spark.range(20_000).select(F.lit(1).alias("exp_group"), F.col("id").alias("user_id"), F.lit(1).cast("long").alias("likes"), F.lit(2).cast("long").alias("views"), F.lit(0.5).alias("ctr"))
    sums = metrics.bucket_sums(users, 10, "s", hash_fn="xxhash64").collect()
    assert sorted(r.bucket for r in sums) == list(range(10))
    plan = metrics.with_bucket(users, 50, hash_fn="xxhash64")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    with pytest.raises(ValueError):
        unsigned_mod(F.lit(1), 0)


def feed_rows(spark, n=4000, users=300, days=900, seed=3):
    rng = random.Random(seed)
    start = dt.datetime(2022, 11, 28)
    rows = [(rng.choice([None, *range(-3, users)]), start + dt.timedelta(days=rng.randrange(days), minutes=rng.randrange(1440)), rng.choice(("view", "like")), 1, rng.randrange(2), 20, rng.choice(("iOS", "Android"))) for _ in range(n)]
    return spark.createDataFrame(rows, "user_id long, time timestamp_ntz, action string, exp_group long, gender long, age long, os string")


def test_retention_bitmap_equals_retention(spark, tmp_path):
    feed = feed_rows(spark)  # more than two spans of weeks
    as_of = dt.date(2025, 4, 2)
    key = lambda df: sorted(tuple(r) for r in df.select("this_week", "prev_week", "user_status", "num_users").collect())
    want = key(retention.retention(feed, as_of))
    bits = retention.week_bits(feed)
    assert key(retention.retention_from_week_bits(bits, as_of)) == want and bits.select("span").distinct().count() > 2
    # daily loads, one of them twice, in any order
    cut = F.lit(dt.date(2024, 2, 7))
    early, late = retention.week_bits(feed.where(F.col("time") < cut)), retention.week_bits(feed.where(F.col("time") >= cut))
    merged = retention.merge_week_bits(late, early, late)
    assert key(retention.retention_from_week_bits(merged, as_of)) == want
    merged.write.parquet(str(tmp_path / "bits"))
    stored = spark.read.schema(retention.WEEK_BITS_SCHEMA).parquet(str(tmp_path / "bits"))
    plan = retention.retention_from_week_bits(stored, as_of)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan
    assert retention.retention_from_week_bits(retention.week_bits(feed.limit(0)), as_of).count() == 0


def test_sketches_merge_without_raw_events(spark, tmp_path):
    feed = feed_rows(spark, 6000, 500, 28)
    path = str(tmp_path / "sketches")
    uniques.write_daily_sketches(feed, path, "2022-11-28", "2022-12-10")
    uniques.write_daily_sketches(feed, path, "2022-12-10", "2022-12-31")  # a day again: replaced, not added
    stored = uniques.read_daily_sketches(spark, path)
    known = feed.where("user_id IS NOT NULL")
    exact = known.groupBy("os").agg(F.count_distinct("user_id").alias("users_exact"))
    rows = uniques.sketch_check(exact, uniques.merged_uniques(stored, "os"), ["os"]).collect()
    assert len(rows) == 2 and all(r.within_3_sigma for r in rows)
    assert stored.count() == known.select(F.to_date("time"), "gender", "os").distinct().count()


def test_bitmaps_equal_daily_audience(spark, tmp_path):
    feed, messages = feed_rows(spark, 3000, 70_000, 10, 1).unionByName(feed_rows(spark, 3000, 200, 10, 4)), feed_rows(spark, 3000, 300, 12, 2)
    stored = []
    for name, table in (("feed", feed), ("messages", messages)):
        uniques.write_daily_bitmaps(table, str(tmp_path / name))
        stored.append(uniques.read_daily_bitmaps(spark, str(tmp_path / name)))
    got = uniques.audience_from_bitmaps(*stored)
    want = audience.daily_audience(feed, messages, dt.date(2022, 11, 28), dt.date(2022, 12, 31))
    columns = ["date", "users", "feed_users", "both_users"]
    key = lambda df: sorted(tuple(r) for r in df.select(*columns).collect())
    assert key(got) == key(want) and stored[0].select("bucket").distinct().count() > 2
