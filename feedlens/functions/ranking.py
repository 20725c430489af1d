"""Global ranks and running totals without a single-task window.

A window with an ORDER BY but no PARTITION BY runs in one task.  Instead:

1. each row gets a fine bucket ``floor(t * FINE_PER_UNIT)`` of the compressed
   value t = sign(v) log(1 + |v|): monotone (buckets keep the order), resolves about
   1/4096 relative everywhere, and a heavy tail does not crowd the bulk into a few
   buckets.  -Inf, +Inf and NaN have end buckets in Spark's order (NaN largest);
2. an exact histogram per (keys, fine bucket) with each bucket's smallest and largest
   value; a bucket that holds more than a chunk's share is cut evenly between those
   two, so values that lie close together are spread as well;
3. a second exact histogram, per (keys, fine bucket, cut), gives the totals of all
   smaller cuts and gathers the cuts into chunks of about rows / partitions;
4. rows join their cut's chunk and offset, and a window partitioned by
   (keys, chunk) adds the running total inside the chunk.

Every step is a deterministic function of the data (no sampled range
bounds), so re-computing any branch after a lost executor gives the same
chunks.  Work per task is about rows / n_parts unless values crowd at two
scales at once within one fine bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FINE_PER_UNIT = 4096
#: beyond the fine bucket of any finite double
LAST = 1 << 30


def with_stats(df: DataFrame, stats: DataFrame, name: str) -> DataFrame:
    """Attach a one-row aggregate to every row as a struct column.

    The aggregate is a single scalar subquery (run once, its value shipped to
    the tasks); later expressions read plain fields of ``name``.
    """
    return df.select("*", stats.select(F.struct(*stats.columns)).scalar().alias(name))


def _n_parts(df: DataFrame, n_parts: int | None) -> int:
    if n_parts:
        return n_parts
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running_totals(
    df: DataFrame,
    order_col: str,
    weights: Sequence[str],
    keys: Sequence[str] = (),
    n_parts: int | None = None,
    fine_per_unit: int = FINE_PER_UNIT,
) -> DataFrame:
    """Add ``<w>_below`` = sum of ``w`` over rows with the same ``keys`` and a
    strictly smaller numeric ``order_col``, and ``<w>_total`` = sum of ``w``
    over the key.  ``(keys, order_col)`` must be unique, as it is after a
    ``groupBy(keys, order_col)``.  NULL is smallest, NaN largest.
    """
    keys = list(keys)
    parts = _n_parts(df, n_parts)
    x = F.col(order_col).cast("double")
    inf = F.lit(float("inf"))
    fine = (
        F.when(x.isNull(), -LAST)
        .when(x == -inf, 1 - LAST)
        .when(F.isnan(x), LAST)
        .when(x == inf, LAST - 1)
        .otherwise(F.floor(F.signum(x) * F.log1p(F.abs(x)) * F.lit(float(fine_per_unit))).cast("int"))
    )
    tagged = df.select(*df.columns, x.alias("_x"), fine.alias("_fine"))

    share = F.greatest(F.ceil(F.sum("_n").over(Window.partitionBy(*keys)) / F.lit(parts)), F.lit(1))
    cuts = tagged.groupBy(*keys, "_fine").agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    cuts = cuts.select(*keys, "_fine", "_lo", (F.col("_hi") - F.col("_lo")).alias("_span"), F.when(F.col("_n") > share, F.ceil(4 * F.col("_n") / share)).otherwise(1).alias("_m"))
    cut = F.least(F.floor((F.col("_x") - F.col("_lo")) / F.col("_span") * F.col("_m")), F.col("_m") - 1).cast("int")
    placed = tagged.join(cuts, [*keys, "_fine"], "inner")
    placed = placed.select(*df.columns, "_fine", F.when((F.col("_m") > 1) & (F.col("_span") > 0), cut).otherwise(0).alias("_cut"))

    hist = placed.groupBy(*keys, "_fine", "_cut").agg(
        F.count(F.lit(1)).alias("_h_rows"), *[F.sum(w).alias(f"_h_{w}") for w in weights]
    )
    # one row per non-empty cut: ordered windows over the histogram are cheap
    before = Window.partitionBy(*keys).orderBy("_fine", "_cut").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    per_chunk = F.greatest(F.ceil(F.sum("_h_rows").over(whole) / F.lit(parts)), F.lit(1))
    hist = hist.select(
        *keys,
        "_fine",
        "_cut",
        F.floor(F.coalesce(F.sum("_h_rows").over(before), F.lit(0)) / per_chunk).alias("_chunk"),
        *[F.coalesce(F.sum(f"_h_{w}").over(before), F.lit(0)).alias(f"_cb_{w}") for w in weights],
        *[F.sum(f"_h_{w}").over(whole).alias(f"{w}_total") for w in weights],
    )
    chunk = Window.partitionBy(*keys, "_chunk")
    mapping = hist.select(
        *keys,
        "_fine",
        "_cut",
        "_chunk",
        *[F.min(f"_cb_{w}").over(chunk).alias(f"_off_{w}") for w in weights],
        *[f"{w}_total" for w in weights],
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    out = placed.join(mapping, [*keys, "_fine", "_cut"], "inner")
    return out.select(
        *df.columns,
        *[(F.col(f"_off_{w}") + F.coalesce(F.sum(w).over(inside), F.lit(0))).alias(f"{w}_below") for w in weights],
        *[f"{w}_total" for w in weights],
    )


def exact_quantile(
    df: DataFrame,
    value_col: str,
    p: float,
    keys: Sequence[str] = (),
    out_col: str | None = None,
) -> DataFrame:
    """Exact quantile without interpolation: the element at 0-based index
    ``floor(p * n)`` of the sorted non-null values of each key group.

    (``percentile_disc`` picks index ``ceil(p * n) - 1`` instead; the two differ
    when ``p * n`` is a whole number.)  Distinct values are counted first, so the
    shuffle carries one row per (key, value).
    """
    out_col = out_col or f"q_{value_col}"
    if not keys:
        # one group: a constant key keeps every join an equi-join
        return exact_quantile(df.withColumn("_all", F.lit(0)), value_col, p, ["_all"], out_col).drop("_all")
    keys = list(keys)
    counts = df.where(F.col(value_col).isNotNull()).groupBy(*keys, value_col).agg(F.count(F.lit(1)).alias("_cnt"))
    with_n = running_totals(counts, value_col, ["_cnt"], keys).withColumnRenamed("_cnt_total", "_n")
    target = F.floor(F.col("_n") * F.lit(float(p)))
    target = F.least(target, F.col("_n") - 1)
    hit = (F.col("_cnt_below") <= target) & (target < F.col("_cnt_below") + F.col("_cnt"))
    return with_n.where(hit).select(*keys, F.col(value_col).alias(out_col))


def exact_percentiles_linear(
    df: DataFrame,
    value_col: str,
    ps: Sequence[float],
    keys: Sequence[str] = (),
    with_range: bool = False,
) -> DataFrame:
    """Exact percentiles with linear interpolation between order statistics
    (numpy's default): h = (n - 1) * p, x[floor h] + frac(h) * (x[floor h + 1] - x[floor h]).

    All ``ps`` come from one ranking pass; columns are named ``p_<i>`` in the
    order of ``ps``.  ``with_range`` adds the key's ``lo``, ``hi`` and ``n``.
    """
    if not keys:
        return exact_percentiles_linear(
            df.withColumn("_all", F.lit(0)), value_col, ps, ["_all"], with_range
        ).drop("_all")
    keys = list(keys)
    counts = df.where(F.col(value_col).isNotNull()).groupBy(*keys, value_col).agg(F.count(F.lit(1)).alias("_cnt"))
    j = running_totals(counts, value_col, ["_cnt"], keys).withColumnRenamed("_cnt_total", "_n")
    lo, hi = F.col("_cnt_below"), F.col("_cnt_below") + F.col("_cnt")
    parts, covers = [], []
    for i, p in enumerate(ps):
        h = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        i0 = F.floor(h)
        i1 = F.least(i0 + 1, F.col("_n") - 1)
        c0, c1 = (lo <= i0) & (i0 < hi), (lo <= i1) & (i1 < hi)
        covers += [c0, c1]
        parts += [
            F.max(F.when(c0, F.col(value_col))).alias(f"_x0_{i}"),
            F.max(F.when(c1, F.col(value_col))).alias(f"_x1_{i}"),
            F.max(h - i0).alias(f"_f_{i}"),
        ]
    hit = covers[0]
    for c in covers[1:]:
        hit = hit | c
    extra = []
    if with_range:
        hit = hit | (F.col("_cnt_below") == 0) | (F.col("_cnt_below") + F.col("_cnt") == F.col("_n"))
        extra = [F.min(value_col).alias("lo"), F.max(value_col).alias("hi"), F.max("_n").alias("n")]
    agg = j.where(hit).groupBy(*keys).agg(*parts, *extra)
    return agg.select(
        *keys,
        *[
            (F.col(f"_x0_{i}") + F.col(f"_f_{i}") * (F.col(f"_x1_{i}") - F.col(f"_x0_{i}"))).alias(f"p_{i}")
            for i in range(len(ps))
        ],
        *(["lo", "hi", "n"] if with_range else []),
    )
