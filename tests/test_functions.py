import hashlib
import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from feedlens.functions import hashing, stats
from feedlens.functions.ranking import exact_quantile, running_totals
from feedlens.operators.experiments import twosample as T


def test_md5_split_matches_python_integer_arithmetic(spark):
    ids = list(range(0, 3000)) + [2**40 + 7, 123456789012]
    df = spark.createDataFrame([(i,) for i in ids], "user_id long")
    for n in (2, 5, 7, 50, 1000003):
        got = {r.user_id: r.g for r in df.select("user_id", hashing.ab_split("user_id", "exp_mess_1", n).alias("g")).collect()}
        for i in ids:
            want = int(hashlib.md5(f"{i}-exp_mess_1".encode("ascii")).hexdigest(), 16) % n
            assert got[i] == want


def test_md5_split_fixture_value(spark):
    # FIXTURES: id 1, salt exp_mess_1, n = 5 -> 2
    row = spark.range(1, 2).select(hashing.ab_split(F.col("id"), "exp_mess_1", 5).alias("g")).first()
    assert row.g == 2


def test_poisson_thresholds_are_inverse_cdf():
    th = hashing.poisson1_thresholds()
    assert th[-1] == 2**32 and all(a < b for a, b in zip(th, th[1:]))
    cdf = 0.0
    for k, t in enumerate(th[:-1]):
        cdf += math.exp(-1) / math.factorial(k)
        assert abs(t / 2**32 - cdf) < 1e-9


def test_poisson_weights_have_mean_one(spark):
    df = spark.range(200000).select(hashing.poisson1_weight(hashing.md5_u32(F.col("id").cast("string"))).alias("w"))
    r = df.agg(F.avg("w").alias("m"), F.var_samp("w").alias("v")).first()
    assert abs(r.m - 1) < 0.01 and abs(r.v - 1) < 0.02


def test_t_tail_known_values():
    # t = 2.0, 10 df two-sided: 0.07338803; t = 1.96, large df ~ 0.05
    p = stats.t_sf2(np.array([2.0, 0.0, 1.959963984540054, 12.0, 3.5]), np.array([10.0, 5.0, 1e7, 3.0, 1.0]))
    assert abs(p[0] - 0.0733880) < 1e-6
    assert abs(p[1] - 1.0) < 1e-12
    assert abs(p[2] - 0.05) < 1e-5
    # closed forms: nu = 3 and nu = 1 (Cauchy)
    x = 12.0 / math.sqrt(3.0)
    cdf3 = 0.5 + (x / (1 + x * x) + math.atan(x)) / math.pi
    assert abs(p[3] - 2 * (1 - cdf3)) < 1e-12
    assert abs(p[4] - (1 - 2 / math.pi * math.atan(3.5))) < 1e-12


WELCH_A = [27.5, 21.0, 19.0, 23.6, 17.0, 17.9, 16.9, 20.1, 21.9, 22.6, 23.1, 19.6, 19.0, 21.7, 21.4]
WELCH_B = [27.1, 22.0, 20.8, 23.4, 23.4, 23.5, 25.8, 22.0, 24.8, 20.2, 21.9, 22.1, 22.9, 20.5, 24.4]


def _two_groups(spark, a, b):
    rows = [(1, float(x)) for x in a] + [(2, float(x)) for x in b]
    return spark.createDataFrame(rows, "g int, v double")


def test_welch_textbook(spark):
    r = T.welch_ttest(_two_groups(spark, WELCH_A, WELCH_B), "g", "v", 1, 2).first()
    assert abs(r.t_stat - (-2.455356)) < 1e-5
    assert abs(r.dof - 24.988529) < 1e-5
    assert abs(r.p_value - 0.021378) < 1e-6


def test_mann_whitney_textbook(spark):
    r = T.mann_whitney(_two_groups(spark, [19, 22, 16, 29, 24], [20, 11, 17, 12]), "g", "v", 1, 2).first()
    assert r.u_stat == 17
    assert abs(r.p_value - 0.111347) < 1e-6


def test_mann_whitney_ties_and_symmetry(spark):
    rnd = random.Random(3)
    a = [rnd.randint(0, 9) for _ in range(60)]
    b = [rnd.randint(2, 11) for _ in range(45)]
    df = _two_groups(spark, a, b)
    r1 = T.mann_whitney(df, "g", "v", 1, 2).first()
    r2 = T.mann_whitney(df, "g", "v", 2, 1).first()
    assert r1.u_stat + r2.u_stat == len(a) * len(b)
    assert abs(r1.p_value - r2.p_value) < 1e-12
    # brute-force U with ties counted 1/2
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert r1.u_stat == u
    # brute-force P(A > B)
    pr = T.prob_a_gt_b(df, "g", "v", 1, 2).first().prob_a_gt_b
    assert abs(pr - sum(x > y for x in a for y in b) / (len(a) * len(b))) < 1e-12


def test_running_totals_brute_force_with_skew(spark):
    rnd = random.Random(7)
    rows = []
    for key in range(3):
        vals = set()
        # clustered values plus a far outlier: most values in one fine bucket region
        while len(vals) < 400:
            vals.add(round(rnd.gauss(0.2, 0.001), 7))
        vals.add(1e6 * (key + 1))
        for v in vals:
            rows.append((key, v, rnd.randint(1, 5)))
    df = spark.createDataFrame(rows, "k int, v double, w long")
    got = running_totals(df, "v", ["w"], ["k"], n_parts=16).toPandas()
    pdf = pd.DataFrame(rows, columns=["k", "v", "w"]).sort_values(["k", "v"])
    pdf["want"] = pdf.groupby("k")["w"].cumsum() - pdf["w"]
    m = got.merge(pdf, on=["k", "v", "w"])
    assert len(m) == len(rows)
    assert (m["w_below"] == m["want"]).all()


def test_running_totals_no_keys(spark):
    rows = [(float(i % 97) / 7.0 + i * 1e-9, 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "v double, w long")
    got = running_totals(df, "v", ["w"], n_parts=9).toPandas().sort_values("v")
    assert list(got["w_below"]) == list(range(2000))


def test_exact_quantile_index_rule(spark):
    # 0..9 at 0.9 -> element at index floor(9.0) = 9 (percentile_disc would give 8)
    df = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    assert exact_quantile(df, "x", 0.9).first()[0] == 9.0
    df2 = spark.createDataFrame([(g, float(v)) for g in range(3) for v in range(g * 7 + 3)], "g int, x double")
    got = {r.g: r.q for r in exact_quantile(df2, "x", 0.5, ["g"], "q").collect()}
    for g in range(3):
        vals = sorted(float(v) for v in range(g * 7 + 3))
        assert got[g] == vals[int(math.floor(len(vals) * 0.5))]


def test_oracle_t_integral_agrees_with_udf_tail():
    import duckdb

    from feedlens.plans.oracle import normal_pvalue_cte, t_pvalue_cte

    rng = np.random.default_rng(0)
    ts = np.concatenate([rng.normal(0, 3, 300), [0.0, 5.0, 30.0, -12.0]])
    vs = np.concatenate([rng.uniform(1.0, 3.0, 100), rng.uniform(3, 60, 100), rng.uniform(60, 5000, 100), [1.0, 2.0, 4.5, 1000.0]])
    con = duckdb.connect()
    con.execute(
        "CREATE TABLE src AS SELECT * FROM (SELECT unnest(?) AS t_stat, unnest(?) AS dof, unnest(?) AS z, unnest(range(?)) AS k)",
        [ts.tolist(), vs.tolist(), ts.tolist(), len(ts)],
    )
    got = np.array([r[1] for r in con.execute("WITH " + t_pvalue_cte("tp", "src", ["k"]) + " SELECT k, p_value FROM tp ORDER BY k").fetchall()])
    assert np.abs(got - stats.t_sf2(ts, vs)).max() < 1e-9
    got = np.array([r[1] for r in con.execute("WITH " + normal_pvalue_cte("np", "src", ["k"]) + " SELECT k, p_value FROM np ORDER BY k").fetchall()])
    want = np.minimum(1.0, stats.normal_sf2(ts))
    assert np.abs(got - want).max() < 1e-9


def test_running_totals_heavy_tail_spreads_over_chunks(spark):
    # 5,000 values in [0, 1] plus one huge outlier: the bulk still spreads over many fine buckets
    rows = [(i / 5000.0, 1) for i in range(5000)] + [(1e12, 1)]
    df = spark.createDataFrame(rows, "v double, w long")
    got = running_totals(df, "v", ["w"], n_parts=10).toPandas().sort_values("v")
    assert list(got["w_below"]) == list(range(5001))
    from feedlens.functions.ranking import FINE_PER_UNIT

    v = np.array([r[0] for r in rows[:-1]])
    b = np.floor(np.sign(v) * np.log1p(np.abs(v)) * FINE_PER_UNIT)
    assert len(np.unique(b)) > 2000


def test_round_half_up_is_safe_for_huge_values(spark):
    from feedlens.functions.numeric import round_half_up

    rows = spark.createDataFrame([(0.0015625,), (2.675,), (-1.005,), (5e15,), (1e300,), (None,)], "x double")
    got = [r[0] for r in rows.select(round_half_up(F.col("x"), 6)).collect()]
    assert got[:2] == [0.001563, 2.675] and got[3:5] == [5e15, 1e300] and got[5] is None


def test_mann_whitney_with_a_hugely_tied_value(spark):
    # 3,000,000 users share one value: the tie term t^3 does not fit a BIGINT
    a = spark.range(3_000_000).select(F.lit(1).alias("g"), F.lit(0.0).alias("v"))
    b = spark.range(1000).select(F.lit(2).alias("g"), (F.col("id") / 1000.0).alias("v"))
    r = T.mann_whitney(a.unionByName(b), "g", "v", 1, 2).first()
    # all of A ties with B's single 0.0 and is below the rest: U1 = 3e6 * 0.5
    assert r.u_stat == 3_000_000 * 0.5
    assert r.p_value is not None and 0 <= r.p_value <= 1
