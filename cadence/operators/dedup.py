"""Keep-last reductions expressed as aggregates.

``max_by`` is a declarative aggregate with a partial (map-side) phase, so a
hot key is reduced before the shuffle instead of being sorted in one task as a
``row_number`` window would be.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_key(df: DataFrame, order: Sequence[str]) -> Column:
    """One orderable value for the tuple ``order``: a number where it is one
    whole number, day or timestamp (NULL first), which keeps ``max_by`` in
    hash aggregation; else a struct."""
    if len(order) == 1:
        kind, c = dict(df.dtypes)[order[0]], F.col(order[0])
        if kind in ("tinyint", "smallint", "int", "bigint"):
            return F.coalesce(c.cast("decimal(20,0)"), F.lit("-" + "9" * 20).cast("decimal(20,0)"))
        if kind == "date":
            return F.coalesce(F.unix_date(c), F.lit(-2 ** 31))
        if kind.startswith("timestamp"):
            return F.coalesce(timestamp_micros(c), F.lit(-2 ** 63))
    return F.struct(*[F.col(c) for c in order])


def last_values(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[Column]:
    """One ``max_by`` per column that is no key: with one ordering value they
    all pick the same row."""
    key = order_key(df, order)
    return [F.max_by(F.col(c), key).alias(c) for c in df.columns if c not in keys]


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order`` tuple."""
    keys = list(keys)
    return df.groupBy(*keys).agg(*last_values(df, keys, order)).select(*df.columns)


def packed_order(primary: Column, tie: Column, tie_digits: int = 19) -> Column:
    """``(primary, tie)`` as one exact ``DECIMAL(38,0)`` ordering key:
    ``primary * 10**tie_digits + tie`` -- order preserving for an integral
    ``primary`` (timestamps are taken as epoch microseconds, numbers are
    truncated to integers) and ``0 <= tie < 10**tie_digits``.

    One orderable number keeps ``max_by``/``min_by`` in hash aggregation; a
    struct key would force sort-based aggregation (a map-side sort of every
    input row)."""
    scale = F.lit("1" + "0" * tie_digits).cast("decimal(38,0)")
    return primary.cast("decimal(38,0)") * scale + tie.cast("decimal(38,0)")


def timestamp_micros(col: Column) -> Column:
    return F.unix_micros(col.cast("timestamp"))


def last_of_day(points: DataFrame, series: str, day: str, order: Sequence[str],
                value: str, *, extra: dict | None = None) -> DataFrame:
    """Per ``(series, day)``: the ``value`` of the last point by ``order``
    (one column, or a timestamp/integer plus a non-negative integer tie),
    plus ``extra`` named aggregates computed in the same pass -- a hash
    aggregate with a map-side partial phase."""
    if len(order) == 1:
        order_key = F.col(order[0])
    elif len(order) == 2:
        first = F.col(order[0])
        kinds = dict(points.dtypes)
        if kinds[order[0]].startswith("timestamp"):
            first = timestamp_micros(first)
        order_key = packed_order(first, F.col(order[1]))
    else:
        order_key = F.struct(*[F.col(c) for c in order])
    aggs = [F.max_by(F.col(value), order_key).alias(value)]
    for name, expr in (extra or {}).items():
        aggs.append(expr.alias(name))
    return points.groupBy(series, day).agg(*aggs)
