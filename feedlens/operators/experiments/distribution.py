"""Distribution summaries: histograms and the uniform QQ plot data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.ranking import exact_percentiles_linear, running_totals, with_stats


def _stats(v: DataFrame, value_col: str, bins: int | str, keys: Sequence[str] = ()) -> DataFrame:
    """One row per key group (one row overall without keys): lo, hi and the bin
    count nb (numpy's "auto" rule when asked: the smaller of the Sturges and
    Freedman-Diaconis widths)."""
    keys = list(keys)
    if isinstance(bins, int):
        return v.groupBy(*keys).agg(F.min(value_col).alias("lo"), F.max(value_col).alias("hi"), F.lit(bins).alias("nb"))
    if bins != "auto":
        raise ValueError(f"bins must be an int or 'auto', not {bins!r}")
    st = exact_percentiles_linear(v, value_col, [0.25, 0.75], keys, with_range=True)
    lo, hi, n = F.col("lo"), F.col("hi"), F.col("n").cast("double")
    ptp = hi - lo
    sturges = ptp / (F.log2(n) + F.lit(1.0))
    fd = F.lit(2.0) * (F.col("p_1") - F.col("p_0")) * F.pow(n, F.lit(-1.0 / 3.0))
    width = F.when(fd > 0, F.least(fd, sturges)).otherwise(sturges)
    nb = F.when(ptp > 0, F.ceil(ptp / width)).otherwise(F.lit(1)).cast("int")
    return st.select(*keys, "lo", "hi", nb.alias("nb"))


def histogram(
    df: DataFrame,
    value_col: str,
    bins: int | str = 10,
    keys: Sequence[str] = (),
    shared_edges: bool = True,
    groups: Sequence[int] | None = None,
) -> DataFrame:
    """Equal-width bins over min..max.

    bin = min(floor((v - min) * bins / (max - min)), bins - 1); the maximum falls
    in the last bin.  ``bins="auto"`` picks numpy's automatic bin count.
    ``shared_edges``: one set of edges for all key groups (a histogram with a
    hue); otherwise each key group gets its own range and bin count (joined back
    on the keys: one row per group).  ``groups`` limits the first key to these values;
    the per-group table is then at most one row per value (single key) and is broadcast, so
    no value row is shuffled on a key of a few values.  Returns (keys, bin, bin_lo, bin_hi, count)
    for non-empty bins.
    """
    v = df.where(F.col(value_col).isNotNull())
    if groups is not None:
        v = v.where(F.col(keys[0]).isin(list(groups)))
    if shared_edges or not keys:
        tagged = with_stats(v, _stats(v, value_col, bins), "_h")
    else:
        st = _stats(v, value_col, bins, keys)
        st = st.select(*keys, F.struct("lo", "hi", "nb").alias("_h"))
        tagged = v.join(F.broadcast(st) if groups is not None and len(keys) == 1 else st, list(keys))
    lo, hi, nb = F.col("_h.lo"), F.col("_h.hi"), F.col("_h.nb")
    width = hi - lo
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(value_col) - lo) * nb.cast("double") / width), nb - 1)
    ).cast("int")
    step = width / nb.cast("double")
    binned = tagged.select(
        *keys,
        idx.alias("bin"),
        (lo + idx * step).alias("bin_lo"),
        (lo + (idx + 1) * step).alias("bin_hi"),
    )
    return binned.groupBy(*keys, "bin", "bin_lo", "bin_hi").agg(F.count(F.lit(1)).alias("count"))


def uniform_qq(df: DataFrame, value_col: str) -> DataFrame:
    """Sorted values against uniform order-statistic medians (Filliben):
    m_1 = 1 - 0.5^(1/n), m_n = 0.5^(1/n), m_i = (i - 0.3175) / (n + 0.365).

    Ranks come from running totals over distinct values (no single-task sort).
    """
    v = df.where(F.col(value_col).isNotNull())
    counts = v.groupBy(value_col).agg(F.count(F.lit(1)).alias("_c"))
    ranked = running_totals(counts, value_col, ["_c"])
    n = F.col("_c_total")
    pos = ranked.select(
        "_c_total",
        F.col(value_col).alias("osr"),
        F.explode(F.sequence(F.col("_c_below") + 1, F.col("_c_below") + F.col("_c"))).alias("i"),
    )
    nd = n.cast("double")
    osm = (
        F.when(F.col("i") == n, F.pow(F.lit(0.5), F.lit(1.0) / nd))
        .when(F.col("i") == 1, F.lit(1.0) - F.pow(F.lit(0.5), F.lit(1.0) / nd))
        .otherwise((F.col("i") - F.lit(0.3175)) / (nd + F.lit(0.365)))
    )
    return pos.select(F.col("i").cast("bigint").alias("i"), osm.alias("osm"), "osr")


def qq_fit(qq: DataFrame) -> DataFrame:
    """Least-squares line of osr on osm and the correlation r."""
    return qq.agg(
        F.regr_slope("osr", "osm").alias("slope"),
        F.regr_intercept("osr", "osm").alias("intercept"),
        F.corr("osm", "osr").alias("r"),
    )
