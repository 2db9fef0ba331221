"""Per-series window operators (previous row, change, rolling deviation).

Windows are always partitioned by the series key.  After the daily reduction
a series has at most one row per calendar day, so a partition is bounded by
the calendar, not by the volume of raw points behind it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from cadence.schemas import VOLATILITY_ROWS


def series_window(by: Sequence[str] | str = "coin_id", order: str = "reference_date") -> WindowSpec:
    by = [by] if isinstance(by, str) else list(by)
    return Window.partitionBy(*by).orderBy(order)


def pct_change(price: str = "price_usd", w: WindowSpec | None = None, *,
               scale: int | None = 4, exact: bool = True) -> Column:
    """Percent change against the previous row of the series (not the
    previous calendar day).  NULL on the first row.

    ``exact``: decimal arithmetic, ``/`` raises on a zero previous price (as
    the SQL form does); otherwise double arithmetic with ``try_divide``
    (a zero previous price gives NULL).  ``scale`` rounds half away from
    zero; ``None`` keeps the full value."""
    w = w or series_window()
    p = F.col(price)
    prev = F.lag(p).over(w)
    if exact:
        change = ((p - prev) / prev) * F.lit(100)
    else:
        change = F.try_divide(p.cast("double") - prev.cast("double"), prev.cast("double")) \
            * F.lit(100.0)
    if scale is not None:
        change = F.round(change, scale)
    return F.when(prev.isNotNull(), change)


def rolling_stddev(col: str, w: WindowSpec | None = None, *, rows: int = VOLATILITY_ROWS,
                   scale: int | None = 4) -> Column:
    """Sample standard deviation over the current row and the ``rows - 1``
    preceding rows; NULLs are skipped and fewer than two values give NULL."""
    w = (w or series_window()).rowsBetween(-(rows - 1), Window.currentRow)
    sd = F.stddev_samp(F.col(col)).over(w)
    return F.round(sd, scale) if scale is not None else sd


def bucketed_series(df: DataFrame, key: Sequence[str] | str, order: str,
                    compute: Callable[[DataFrame, WindowSpec], DataFrame], reach: int,
                    bucket: Callable[[Column], Column] = F.year) -> DataFrame:
    """Apply row-based window columns per series without putting a whole
    series in one partition.

    ``compute(frame, w)`` adds columns over the window ``w`` (partitioned and
    ordered); ``reach`` is how many preceding rows any output row depends on
    (a ``lag(1)`` feeding a 7-row frame reaches back 7 rows).

    1. Rows are partitioned by ``(key, bucket(order))`` -- the only full
       shuffle -- and ``compute`` runs there: every row after the first
       ``reach`` of its bucket only depends on rows of its own bucket, so its
       values are exact.
    2. Bucket sizes (from the same partitioning) give each row its global row number
       in the series.  The first ``reach`` rows of each bucket ("heads") are
       recomputed together with the ``reach`` rows that precede the bucket
       ("halo": the tails of earlier buckets, matched by global row number
       through an equi-join, so no pairs are formed).  Only these few rows
       per bucket are shuffled again.

    The result is exactly the per-series window, while a series holding a
    third of all rows is spread over its buckets.  Rows must be unique per
    ``(key, order)``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = df.columns
    x = df.withColumn("_wb", bucket(F.col(order)))
    w_b = Window.partitionBy(*keys, "_wb").orderBy(order)
    x = (x.withColumn("_wrn", F.row_number().over(w_b))
         .withColumn("_wn", F.count(F.lit(1)).over(Window.partitionBy(*keys, "_wb"))))
    first = compute(x, w_b)
    out_cols = [c for c in first.columns if not c.startswith("_w")]
    rest = first.where(F.col("_wrn") > reach).select(*out_cols)

    # bucket sizes: one row per bucket, taken from rows already partitioned
    # by the bucket (no further shuffle); offsets need a window over the
    # buckets of a key only
    sizes = x.where(F.col("_wrn") == 1).select(*keys, "_wb", "_wn")
    w_k = Window.partitionBy(*keys).orderBy("_wb")
    offsets = sizes.withColumn("_woff", F.coalesce(
        F.sum("_wn").over(w_k.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    xg = (x.drop("_wn").join(offsets, [*keys, "_wb"])
          .withColumn("_wg", F.col("_woff") + F.col("_wrn")))
    heads = (xg.where(F.col("_wrn") <= reach).select(*cols, F.col("_wb").alias("_wpb"))
             .withColumn("_whalo", F.lit(0)))
    starts = offsets.select(*keys, F.col("_wb").alias("_wpb"),
                            (F.col("_woff") + 1).alias("_wstart"))
    halo = (xg.where(F.col("_wrn") > F.col("_wn") - reach)
            .withColumn("_wk", F.explode(F.sequence(F.lit(1), F.lit(reach))))
            .withColumn("_wstart", F.col("_wg") + F.col("_wk"))
            .join(starts, [*keys, "_wstart"])
            .select(*cols, "_wpb").withColumn("_whalo", F.lit(1)))
    w_pb = Window.partitionBy(*keys, "_wpb").orderBy(order)
    fixed = compute(heads.unionByName(halo), w_pb).where(F.col("_whalo") == 0)
    return rest.unionByName(fixed.select(*out_cols))
