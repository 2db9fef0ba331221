"""Prefix scans over one global order: running sums, row numbers, carried
values.

A window without ``partitionBy`` sorts everything in one task, and a window
over a key that holds a third of all rows sorts that third in one task.  Here
the rows are range-partitioned on the order instead and stored with their
partition's number.  Every partition is scanned on its own, and what the
partitions before it add is a table of one row per partition (and key), the
only thing that is summed in one place.

The order should be unique (end it with a key): equal rows are neighbours in
an arbitrary order, and they cannot be split over partitions.  A descending
order is a negated or complemented column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.work import work_table

PART = "_part"


def range_parts(df: DataFrame, order: Sequence[str | Column], parts: int | None = None
                ) -> DataFrame:
    """``df`` range-partitioned on ``order`` and stored with the partition's
    number in ``_part``: all rows of a part precede those of the next."""
    parts = parts or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return work_table(df.repartitionByRange(parts, *order)
                      .withColumn(PART, F.spark_partition_id()))


def running_sum(df: DataFrame, value: str, order: Sequence[str], by: Sequence[str] = (),
                name: str = "running", parts: int | None = None) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows up to and with
    this one, in ``order``, per ``by`` key.  NULL values add nothing; NULL keys
    form one group; an empty frame gives an empty result."""
    by, order = list(by), list(order)
    stored = range_parts(df, by + order, parts)
    totals = stored.groupBy(PART, *by).agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy(PART).rowsBetween(
        Window.unboundedPreceding, -1)
    carried = totals.select(F.col(PART).alias("_p"), *[F.col(k).alias(f"_k{i}")
                                                       for i, k in enumerate(by)],
                            F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_carry"))
    inside = Window.partitionBy(PART, *by).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0)
    same = F.col(PART) == F.col("_p")
    for i, k in enumerate(by):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (stored.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(carried, same)
            .select(*df.columns, (F.col("_carry") + F.col("_inside")).alias(name)))


def row_numbers(df: DataFrame, order: Sequence[str], by: Sequence[str] = (),
                name: str = "row_number", parts: int | None = None) -> DataFrame:
    """``df`` with ``name``: the row's number from 1 in ``order``, per ``by``."""
    numbered = running_sum(df.withColumn("_one", F.lit(1).cast("long")), "_one", order, by, name,
                           parts)
    return numbered.drop("_one")


def last_known(df: DataFrame, value: str, order: Sequence[str], name: str,
               parts: int | None = None) -> DataFrame:
    """``df`` with ``name``: the last non-NULL ``value`` among the rows up to
    and with this one in the global ``order`` (NULL before the first)."""
    stored = range_parts(df, order, parts)
    inside = Window.partitionBy(PART).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    scanned = stored.withColumn("_inside", F.last(value, ignorenulls=True).over(upto))
    # one row per part: its last value, carried to the parts after it
    ends = (stored.withColumn("_n", F.row_number().over(inside)).groupBy(PART)
            .agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col("_n"))).alias("_end")))
    earlier = Window.partitionBy(F.lit(0)).orderBy(PART).rowsBetween(
        Window.unboundedPreceding, -1)
    carried = ends.select(F.col(PART).alias("_p"),
                          F.last("_end", ignorenulls=True).over(earlier).alias("_carry"))
    return (scanned.join(carried, F.col(PART) == F.col("_p"))
            .select(*df.columns, F.coalesce("_inside", "_carry").alias(name)))
