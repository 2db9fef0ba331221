"""Adapters that turn the given TPC-H-ish tables into the engine's inputs.

They stand in for the landed sources so every operator runs on
``/root/testdata/sf*/``; their work grows with the tables.

* ``market``  -- ``orders``: one series per ``o_orderpriority``; per day the
  price is the total of the order with the greatest ``o_orderkey``, the cap
  the day's largest total, the volume the day's sum.
* ``macro``   -- ``lineitem``, every row of it: R/A/N become the exchange
  rate, the daily policy rate and the monthly inflation, averaged and scaled
  into their valid ranges.  Ship days are shifted by a constant, so the
  series begin months after the first market day and the early market days
  need the earliest-value fallback.  Weekend rows of the two rates count for
  the Friday before, all inflation rows of a month for its first day -- the
  gaps force forward fill.
* ``ticks``   -- ``events``: intra-day points, series ``event_type``.
* ``target``/``batch`` -- ``market`` split by date with an overlap year and
  re-priced batch rows, for the keyed merge.
* ``dirty``   -- ``market`` with deterministic nulls, repeated keys and out
  of range values, for the quality rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.operators.dedup import last_of_day

# Fixed values of the adapters (shared with the SQL oracles).
MACRO_SHIFT_DAYS = 150
FLAG_TO_INDICATOR = {"R": "dolar", "A": "selic", "N": "ipca"}
TARGET_BEFORE = "2000-01-01"
BATCH_FROM = "1999-01-01"
BATCH_PRICE_FACTOR = "1.01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("coin_id"),
        F.to_date("o_orderdate").alias("reference_date"), "o_orderkey",
        F.col("o_totalprice").cast("decimal(20,2)").alias("price_usd"))
    daily = last_of_day(points, "coin_id", "reference_date", ["o_orderkey"], "price_usd",
                        extra={"market_cap_usd": F.max("price_usd"),
                               "volume_24h_usd": F.sum("price_usd")})
    return daily.select("coin_id", "reference_date",
                        F.col("price_usd").cast("decimal(20,8)").alias("price_usd"),
                        F.col("market_cap_usd").cast("decimal(30,2)").alias("market_cap_usd"),
                        F.col("volume_24h_usd").cast("decimal(30,2)").alias("volume_24h_usd"))


def macro_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``indicator, reference_date, valor, points``: the macro series with the
    number of ``lineitem`` rows behind each value.  Sums are taken over exact
    decimals, so the averages do not depend on the order of rows."""
    shipped = F.date_add(F.to_date("l_shipdate"), MACRO_SHIFT_DAYS)
    past_friday = F.greatest(F.lit(0), F.weekday(shipped) - 4)
    day = F.when(F.col("l_returnflag") == "N", F.trunc(shipped, "month")).otherwise(
        F.date_sub(shipped, past_friday))

    def mean(name: str):
        exact = F.col(name).cast("decimal(12,2)")
        return F.sum(exact).cast("double") / F.count(exact)

    indicator = F.element_at(F.create_map(*[F.lit(x) for kv in FLAG_TO_INDICATOR.items()
                                           for x in kv]), F.col("l_returnflag"))
    value = (F.when(F.col("indicator") == "dolar", F.lit(4.0) + F.col("d") * 20)
             .when(F.col("indicator") == "selic", F.col("t"))
             .otherwise(F.col("t") * 10 - F.lit(0.2)))
    return (table(spark, sf_dir, "lineitem")
            .groupBy(indicator.alias("indicator"), day.alias("reference_date"))
            .agg(mean("l_discount").alias("d"), mean("l_tax").alias("t"),
                 F.count(F.lit(1)).alias("points"))
            .select("indicator", "reference_date",
                    F.round(value, 8).cast("decimal(15,8)").alias("valor"), "points"))


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return macro_points(spark, sf_dir).drop("points")


def macro_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``macro`` as the landed long rows: text day ``DD/MM/YYYY`` and a
    double value, before any transformation; the exchange rate of every
    10th day of a month arrives without a value."""
    m = macro(spark, sf_dir)
    missing = (F.col("indicator") == "dolar") & (F.dayofmonth("reference_date") == 10)
    return m.select("indicator",
                    F.date_format("reference_date", "dd/MM/yyyy").alias("reference_date"),
                    F.when(~missing, F.col("valor").cast("double")).alias("valor"))


def macro_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``macro`` with defects: NULL exchange rate on day 10, policy rate
    x 10000 (out of range) on day 20, inflation rows delivered twice."""
    m = macro(spark, sf_dir)
    dom = F.dayofmonth("reference_date")
    ind = F.col("indicator")
    m = m.withColumn("valor", F.when((ind == "dolar") & (dom == 10), F.lit(None))
                     .when((ind == "selic") & (dom == 20),
                           F.col("valor") * F.lit(10000))
                     .otherwise(F.col("valor")).cast("decimal(15,8)"))
    return m.unionByName(m.where(ind == "ipca"))


def macro_target(spark: SparkSession, sf_dir: str, m: DataFrame | None = None) -> DataFrame:
    m = macro(spark, sf_dir) if m is None else m
    return m.where(F.col("reference_date") < F.lit(TARGET_BEFORE).cast("date"))


def macro_batch(spark: SparkSession, sf_dir: str, m: DataFrame | None = None) -> DataFrame:
    """Macro rows from 1999 on, valor + 0.01 (``batch_seq`` 1), and a later
    correction of every 15th day, valor + 0.02 (``batch_seq`` 2)."""
    m = macro(spark, sf_dir) if m is None else m
    m = m.where(F.col("reference_date") >= F.lit(BATCH_FROM).cast("date"))
    first = m.select("indicator", "reference_date",
                     (F.col("valor") + F.lit(0.01).cast("decimal(3,2)")).cast("decimal(15,8)")
                     .alias("valor"), F.lit(1).alias("batch_seq"))
    fix = m.where(F.dayofmonth("reference_date") == 15).select(
        "indicator", "reference_date",
        (F.col("valor") + F.lit(0.02).cast("decimal(3,2)")).cast("decimal(15,8)").alias("valor"),
        F.lit(2).alias("batch_seq"))
    return first.unionByName(fix)


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("series"), "ts", "event_id", "user_id", "value")


def target(spark: SparkSession, sf_dir: str, m: DataFrame | None = None) -> DataFrame:
    m = market(spark, sf_dir) if m is None else m
    return m.where(F.col("reference_date") < F.lit(TARGET_BEFORE).cast("date"))


def batch(spark: SparkSession, sf_dir: str, m: DataFrame | None = None) -> DataFrame:
    """Market rows from 1999 on re-priced x 1.01 (``batch_seq`` 1) and a
    later correction of every 15th day, x 1.02 (``batch_seq`` 2)."""
    m = market(spark, sf_dir) if m is None else m
    m = m.where(F.col("reference_date") >= F.lit(BATCH_FROM).cast("date"))

    def priced(factor: str, seq: int, rows: DataFrame) -> DataFrame:
        return rows.withColumn("price_usd", F.round(
            F.col("price_usd") * F.lit(factor).cast("decimal(4,2)"), 8).cast("decimal(20,8)")) \
            .withColumn("batch_seq", F.lit(seq))

    return priced(BATCH_PRICE_FACTOR, 1, m).unionByName(
        priced("1.02", 2, m.where(F.dayofmonth("reference_date") == 15)))


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic defects keyed by day of month: day 13 loses its price,
    day 17 its volume, day 23 is priced out of range, days 7 and 29 are
    delivered twice."""
    m = market(spark, sf_dir)
    dom = F.dayofmonth("reference_date")
    m = (m.withColumn("price_usd", F.when(dom == 13, F.lit(None))
                      .when(dom == 23, F.lit(2_000_000).cast("decimal(20,8)"))
                      .otherwise(F.col("price_usd")))
         .withColumn("volume_24h_usd", F.when(dom == 17, F.lit(None))
                     .otherwise(F.col("volume_24h_usd"))))
    return m.unionByName(m.where(dom.isin(7, 29)))
