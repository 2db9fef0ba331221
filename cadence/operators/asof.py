"""As-of join (backward, inclusive) with optional earliest-value fallback.

For every left row: the value columns of the right row with the greatest
``right.on <= left.on`` and the same ``by`` keys.  With ``backfill`` a left
row that has no such right row takes, per value column, the value of the
right row with the smallest ``on`` (so a NULL as-of value also falls back,
as ``COALESCE(as_of, earliest)`` does).

Plan (no pairs are emitted, no group is unbounded):

1. Left and right rows are unioned and tagged; a coarse *bucket* of ``on``
   (a calendar unit or a numeric width) is added.
2. Inside each ``(by, bucket)`` partition a running ``last(right, ignorenulls)``
   ordered by ``(on, side)`` finds the latest right row at or before each left
   row; right rows sort before left rows on equal ``on`` (inclusive ``<=``).
3. A bucket-level table -- one row per ``(by, bucket)``, one aggregate over
   the union with a map-side partial phase -- gives the
   carry-in (last right row of all earlier buckets) and the earliest right
   row of the key.  It is joined back on ``(by, bucket)``; it has one row
   per key and bucket, so AQE broadcasts it when its measured size is small.

Window partitions are bounded by the bucket width rather than by the size of
a key, so a key holding a third of all rows is spread over its buckets.
Right rows are expected to be unique per ``(by, on)`` (the natural key of a
stored series, enforced by the duplicate-key rule); ties are otherwise
resolved arbitrarily.

Without ``by`` keys there is one series.  It is scanned by prefix
(``operators.prefix``): range-partitioned on ``on``, the last value of every
part carried to the parts after it.

``asof_by_day`` is a second form for days: every right row is valid from its
day to the day before the next, these intervals are expanded to a calendar,
and the left rows find their day by an equi-join.  Nothing is sorted or
windowed on the left, and a left row without a day takes the fallback.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.operators.prefix import last_known

_CAL_UNITS = {"year", "quarter", "month", "week", "day", "hour", "minute"}


def _bucket_expr(bucket, on_type) -> Column:
    t = F.col("_asof_t")
    if bucket is None:
        return F.lit(0)
    if callable(bucket):
        return bucket(t)
    if isinstance(bucket, str):
        if bucket not in _CAL_UNITS:
            raise ValueError(f"unknown bucket unit {bucket!r}")
        if isinstance(on_type, T.DateType) and bucket == "year":
            return F.year(t)
        return F.date_trunc(bucket, t)
    if isinstance(bucket, (int, float)):
        return F.floor(t / F.lit(bucket))
    raise TypeError("bucket must be a calendar unit, a numeric width or a callable")


def asof_join(left: DataFrame, right: DataFrame, on: str, by: Sequence[str] = (),
              values: Sequence[str] | None = None, *, backfill: bool = False,
              bucket: str | int | float | Callable[[Column], Column] | None = "year",
              right_on: str | None = None) -> DataFrame:
    """Return ``left`` with the as-of ``values`` of ``right`` appended.

    ``bucket`` bounds the window partitions: a calendar unit applied to
    ``on`` (default ``"year"``), a numeric width for numeric ``on``, a
    callable, or ``None`` for one partition per ``by`` key.
    """
    by = list(by)
    right_on = right_on or on
    if values is None:
        values = [c for c in right.columns if c not in set(by) | {right_on}]
    values = list(values)
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"value columns already on the left: {sorted(clash)}")
    on_type = left.schema[on].dataType

    lcols = left.columns
    l_side = left.select(*[F.col(k) for k in by], F.col(on).alias("_asof_t"),
                         F.lit(1).alias("_asof_side"),
                         F.struct(*[F.col(c) for c in lcols]).alias("_asof_l"))
    # a NULL key never equals anything: such right rows can match no left row
    r_keep = right
    for k in by:
        r_keep = r_keep.where(F.col(k).isNotNull())
    r_side = r_keep.select(*[F.col(k) for k in by],
                           F.col(right_on).cast(on_type).alias("_asof_t"),
                           F.lit(0).alias("_asof_side"),
                           F.struct(*[F.col(v) for v in values]).alias("_asof_r"))
    if not by:
        return _asof_series(l_side, r_side, lcols, values, backfill)
    bexpr = _bucket_expr(bucket, on_type)
    l_side = l_side.withColumn("_asof_b", bexpr)
    r_side = r_side.withColumn("_asof_b", bexpr)
    keys = by + ["_asof_b"]

    # 2. within-bucket running last right row
    union = l_side.unionByName(r_side, allowMissingColumns=True)
    w_in = (Window.partitionBy(*keys).orderBy("_asof_t", "_asof_side")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = (union.withColumn("_asof_in", F.last("_asof_r", ignorenulls=True).over(w_in))
             .where(F.col("_asof_side") == 1)
             .select(*keys, "_asof_l", "_asof_in"))

    # 3. bucket-level carry-in and earliest value per key: one aggregate over
    #    the union, partially aggregated before its (small) shuffle;
    #    left-only buckets get NULL summaries
    is_right = F.col("_asof_r").isNotNull()
    grid = union.groupBy(*keys).agg(
        F.max_by("_asof_r", F.when(is_right, F.col("_asof_t"))).alias("_asof_last"),
        F.min_by("_asof_r", F.when(is_right, F.col("_asof_t"))).alias("_asof_first"))
    w_b = Window.partitionBy(*by).orderBy("_asof_b")
    carry = grid.select(
        *keys,
        F.last("_asof_last", ignorenulls=True)
         .over(w_b.rowsBetween(Window.unboundedPreceding, -1)).alias("_asof_carry"),
        F.first("_asof_first", ignorenulls=True)
         .over(w_b.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
         .alias("_asof_earliest"))

    joined = inner.join(carry, keys, "left")
    matched = F.coalesce(F.col("_asof_in"), F.col("_asof_carry"))
    out = [F.col(f"_asof_l.{c}").alias(c) for c in lcols]
    for v in values:
        val = matched.getField(v)
        if backfill:
            val = F.coalesce(val, F.col("_asof_earliest").getField(v))
        out.append(val.alias(v))
    return joined.select(*out)


def _asof_series(l_side: DataFrame, r_side: DataFrame, lcols: Sequence[str],
                 values: Sequence[str], backfill: bool) -> DataFrame:
    """The join of one series: the last right row, carried over the parts."""
    union = l_side.unionByName(r_side, allowMissingColumns=True).withColumn(
        "_asof_id", F.monotonically_increasing_id())
    filled = last_known(union, "_asof_r", ["_asof_t", "_asof_side", "_asof_id"], "_asof_in") \
        .where("_asof_side = 1")
    earliest = r_side.where(F.col("_asof_t").isNotNull()).select(
        F.min_by("_asof_r", "_asof_t")).scalar() if backfill else None      # one row
    out = [F.col(f"_asof_l.{c}").alias(c) for c in lcols]
    for v in values:
        val = F.col("_asof_in").getField(v)
        if backfill:
            val = F.coalesce(val, earliest.getField(v))
        out.append(val.alias(v))
    return filled.select(*out)


def asof_by_day(left: DataFrame, right: DataFrame, on: str, by: Sequence[str],
                values: Sequence[str], *, backfill: bool = False) -> DataFrame:
    """``left`` with the as-of ``values`` of ``right`` appended, for a DATE
    ``on`` and at least one ``by`` key.

    The right rows of a key are expanded to one row per day of their validity;
    the last one has no end and is joined once per key, beside the earliest.
    Both sides are bounded by keys and calendar days, whatever the left side
    holds.  The left side is joined twice by equality and never sorted."""
    by, values = list(by), list(values)
    if not by:
        raise ValueError("asof_by_day needs a key; asof_join takes one series")
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"value columns already on the left: {sorted(clash)}")
    known = right.select(*by, F.col(on).alias("_day"),
                         F.struct(*[F.col(v) for v in values]).alias("_row"))
    for k in (*by, "_day"):
        known = known.where(F.col(k).isNotNull())
    following = Window.partitionBy(*by).orderBy("_day")
    valid = known.withColumn("_until", F.date_sub(F.lead("_day").over(following), 1))
    calendar = (valid.where(F.col("_day") <= F.col("_until"))
                .select(*by, F.explode(F.sequence("_day", "_until")).alias(on),
                        F.col("_row").alias("_at")))
    ends = known.groupBy(*by).agg(F.min_by("_row", "_day").alias("_first"),
                                  F.max_by("_row", "_day").alias("_last"),
                                  F.max("_day").alias("_since"))
    found = left.join(calendar, [*by, on], "left").join(ends, by, "left")
    row = F.when(F.col(on) >= F.col("_since"), F.col("_last")).otherwise(F.col("_at"))
    out = [F.col(c) for c in left.columns]
    for v in values:
        val = row.getField(v)
        out.append((F.coalesce(val, F.col("_first").getField(v)) if backfill else val).alias(v))
    return found.select(*out)
