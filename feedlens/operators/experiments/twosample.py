"""Two-sample tests as aggregations.

``welch_ttest``   - Welch's unequal-variance t-test (two-sided).
``mann_whitney``  - Mann-Whitney U, two-sided, normal approximation with tie
                    and continuity corrections (no small-sample exact table).
``prob_a_gt_b``   - P(A > B) for one random draw from each group, exactly.

Each returns one row per value of ``keys`` (e.g. one per simulation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions.numeric import count_where
from feedlens.functions.ranking import running_totals
from feedlens.functions.stats import normal_two_sided_p, t_two_sided_p


def _pair(df: DataFrame, group_col: str, value_col: str, a, b) -> DataFrame:
    return df.where(F.col(group_col).isin(a, b) & F.col(value_col).isNotNull())


def welch_from_moments(n_a: Column, m_a: Column, v_a: Column, n_b: Column, m_b: Column, v_b: Column):
    """t and Welch-Satterthwaite degrees of freedom from group moments."""
    se_a = v_a / n_a
    se_b = v_b / n_b
    se2 = se_a + se_b
    t = F.try_divide(m_a - m_b, F.sqrt(se2))
    dof = F.try_divide(se2 * se2, se_a * se_a / (n_a - 1) + se_b * se_b / (n_b - 1))
    return t, dof


def welch_ttest(df: DataFrame, group_col: str, value_col: str, a, b, keys: Sequence[str] = ()) -> DataFrame:
    """Welch's t-test of ``value_col`` between groups ``a`` and ``b`` (NULL values
    left out): one conditional aggregate per key, then t, the Welch-Satterthwaite
    degrees of freedom and the two-sided p-value."""
    ga = F.col(group_col) == a
    gb = F.col(group_col) == b
    v = F.col(value_col)
    mom = _pair(df, group_col, value_col, a, b).groupBy(*keys).agg(
        count_where(ga).alias("n_a"),
        count_where(gb).alias("n_b"),
        F.avg(F.when(ga, v)).alias("mean_a"),
        F.avg(F.when(gb, v)).alias("mean_b"),
        F.var_samp(F.when(ga, v)).alias("_var_a"),
        F.var_samp(F.when(gb, v)).alias("_var_b"),
    )
    t, dof = welch_from_moments(
        F.col("n_a").cast("double"), F.col("mean_a"), F.col("_var_a"),
        F.col("n_b").cast("double"), F.col("mean_b"), F.col("_var_b"),
    )
    out = mom.select(*keys, "n_a", "n_b", "mean_a", "mean_b", t.alias("t_stat"), dof.alias("dof"))
    return out.select(
        *keys,
        F.lit(a).alias("group_a"),
        F.lit(b).alias("group_b"),
        "n_a",
        "n_b",
        "mean_a",
        "mean_b",
        "t_stat",
        "dof",
        t_two_sided_p(F.col("t_stat"), F.col("dof")).alias("p_value"),
    )


def value_counts(
    df: DataFrame, group_col: str, value_col: str, a, b, keys: Sequence[str] = ()
) -> DataFrame:
    """Per distinct value: how many of group a and of group b have it, and how
    many values of each group lie strictly below (global ranks, no single task)."""
    ga = F.col(group_col) == a
    counts = _pair(df, group_col, value_col, a, b).groupBy(*keys, value_col).agg(
        count_where(ga).alias("c_a"), count_where(~ga).alias("c_b")
    )
    counts = counts.withColumn("c_t", F.col("c_a") + F.col("c_b"))
    return running_totals(counts, value_col, ["c_t", "c_b"], keys)


def mann_whitney(
    df: DataFrame, group_col: str, value_col: str, a, b, keys: Sequence[str] = ()
) -> DataFrame:
    """Mann-Whitney U of group ``a`` against ``b``: U1 = R1 - n1 (n1 + 1) / 2 from
    midranks, p from the normal approximation with tie and continuity
    corrections (two-sided, as ``max(U1, U2)``)."""
    vc = value_counts(df, group_col, value_col, a, b, keys)
    midrank = F.col("c_t_below") + (F.col("c_t") + F.lit(1.0)) / 2.0
    s = vc.groupBy(*keys).agg(
        F.sum("c_a").cast("double").alias("_na"),
        F.sum("c_b").cast("double").alias("_nb"),
        F.sum(F.col("c_a") * midrank).alias("_r1"),
        # tie term in double: a value shared by millions of users overflows t^3 in BIGINT
        F.sum(F.pow(F.col("c_t").cast("double"), F.lit(3.0)) - F.col("c_t").cast("double")).alias("_ties"),
    )
    na, nb = F.col("_na"), F.col("_nb")
    n = na + nb
    u1 = F.col("_r1") - na * (na + 1) / 2.0
    s = s.withColumn("u_stat", u1)
    u = F.greatest(F.col("u_stat"), na * nb - F.col("u_stat"))
    sd = F.sqrt(na * nb / 12.0 * ((n + 1) - F.try_divide(F.col("_ties"), n * (n - 1))))
    z = F.try_divide(u - na * nb / 2.0 - F.lit(0.5), sd)
    return s.select(
        *keys,
        F.lit(a).alias("group_a"),
        F.lit(b).alias("group_b"),
        na.cast("bigint").alias("n_a"),
        nb.cast("bigint").alias("n_b"),
        "u_stat",
        normal_two_sided_p(z).alias("p_value"),
    )


def prob_a_gt_b(df: DataFrame, group_col: str, value_col: str, a, b, keys: Sequence[str] = ()) -> DataFrame:
    """P(X > Y) for X drawn from group a and Y from group b (strict)."""
    vc = value_counts(df, group_col, value_col, a, b, keys)
    s = vc.groupBy(*keys).agg(
        F.sum(F.col("c_a").cast("double") * F.col("c_b_below").cast("double")).alias("_wins"),
        F.sum("c_a").alias("n_a"),
        F.sum("c_b").alias("n_b"),
    )
    return s.select(
        *keys,
        F.lit(a).alias("group_a"),
        F.lit(b).alias("group_b"),
        "n_a",
        "n_b",
        F.try_divide(F.col("_wins"), F.col("n_a").cast("double") * F.col("n_b").cast("double")).alias("prob_a_gt_b"),
    )


def linearized_ttests(uc: DataFrame, pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """Welch tests of CTR and of linearized likes for each (control, test) pair.

    linearized_likes = likes - CTR_control * views, CTR_control = the control
    group's sum(likes) / sum(views).  Its mean and variance per group follow
    from the group moments of likes and views:
    mean = mean_l - c mean_v, var = var_l + c^2 var_v - 2 c cov(l, v),
    so all tests come from one aggregate over the per-user table.
    """
    from feedlens.operators.experiments.metrics import group_moments

    mom = group_moments(uc)
    cols = [c for c in mom.columns if c != "exp_group"]
    groups = sorted({g for pair in pairs for g in pair})
    # one row: every group's moments side by side (the moments have one row per group)
    wide = mom.where(F.col("exp_group").isin(groups)).agg(
        *[F.max(F.when(F.col("exp_group") == g, F.col(c))).alias(f"g{g}_{c}") for g in groups for c in cols]
    )

    def col(g: int, name: str):
        return F.col(f"g{g}_{name}")

    rows = []
    for ctrl, test in pairs:
        c = F.try_divide(col(ctrl, "sum_likes"), col(ctrl, "sum_views").cast("double"))

        def lin(g: int):
            m = col(g, "mean_likes") - c * col(g, "mean_views")
            v = col(g, "var_likes") + c * c * col(g, "var_views") - F.lit(2.0) * c * col(g, "cov_lv")
            return m, v

        for metric in ("ctr", "linearized_likes"):
            if metric == "ctr":
                na, nb = col(ctrl, "n_ctr"), col(test, "n_ctr")
                (ma, va), (mb, vb) = (col(ctrl, "mean_ctr"), col(ctrl, "var_ctr")), (col(test, "mean_ctr"), col(test, "var_ctr"))
            else:
                na, nb = col(ctrl, "n"), col(test, "n")
                (ma, va), (mb, vb) = lin(ctrl), lin(test)
            t, dof = welch_from_moments(na.cast("double"), ma, va, nb.cast("double"), mb, vb)
            rows.append(
                F.struct(
                    F.lit(metric).alias("metric"),
                    F.lit(ctrl).alias("group_a"),
                    F.lit(test).alias("group_b"),
                    na.alias("n_a"),
                    nb.alias("n_b"),
                    t.alias("t_stat"),
                    dof.alias("dof"),
                )
            )
    out = wide.select(F.inline(F.array(*rows)))
    return out.withColumn("p_value", t_two_sided_p(F.col("t_stat"), F.col("dof")))
