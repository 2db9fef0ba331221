"""Monthly states: a table of counts, sums and moments per asset and month
from which the reports finish.

A state of a month is one row per asset.  States merge by addition (counts,
sums), by the earliest or latest day (first and last prices) and by the
parallel form of the second moments, so a report over any months reads one row
per asset and month instead of one per asset and day.  After a merge only the
touched months are computed again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.operators.upsert import PARTITION_COL, read_table, table_exists
from cadence.schemas import CONSOLIDATED

PRICE = "price_brl"
AGAINST = ("dolar_brl", "selic_annual_rate", "ipca_monthly")
_SUMMED = ("pct_change_1d", "volatility_7d", "price_brl", "selic_annual_rate")
_FIRST_LAST = ("price_usd", "price_brl")


def monthly_states(consolidated: DataFrame) -> DataFrame:
    """``coin_id, ref_month`` and the state columns: ``rows, latest``; per
    summed column ``n_, sum_``; per price ``first_, first_day_, last_,
    last_day_`` (the first and last day of the asset, NULL prices
    included); per macro column paired with the price ``pairs_``, both means,
    both sums of squared deviations, the sum of products, and the extremes
    that tell a constant side."""
    day = F.col("reference_date")
    aggs = [F.count(F.lit(1)).alias("rows"), F.max(day).alias("latest"),
            F.min(day).alias("earliest")]
    for c in _SUMMED:
        aggs += [F.count(c).alias(f"n_{c}"), F.sum(c).alias(f"sum_{c}")]
    for c in _FIRST_LAST:
        aggs += [F.min_by(c, day).alias(f"first_{c}"), F.max_by(c, day).alias(f"last_{c}")]
    for c in AGAINST:
        both = F.col(PRICE).isNotNull() & F.col(c).isNotNull()
        x, y = (F.when(both, F.col(k).cast("double")) for k in (PRICE, c))
        n = F.count(x)
        aggs += [n.alias(f"pairs_{c}"), F.avg(x).alias(f"mean_x_{c}"), F.avg(y).alias(f"mean_y_{c}"),
                 (F.var_pop(x) * n).alias(f"m2_x_{c}"), (F.var_pop(y) * n).alias(f"m2_y_{c}"),
                 (F.covar_pop(x, y) * n).alias(f"m2_xy_{c}"),
                 F.min(x).alias(f"min_x_{c}"), F.max(x).alias(f"max_x_{c}"),
                 F.min(y).alias(f"min_y_{c}"), F.max(y).alias(f"max_y_{c}")]
    return consolidated.groupBy("coin_id", F.date_format(day, "yyyy-MM").alias(PARTITION_COL)) \
        .agg(*aggs)


def refresh(spark: SparkSession, path: str, consolidated_path: str, months: Sequence[str]) -> None:
    """Compute the states of ``months`` again from the stored fact table, of
    which only those months are read; other months stay as they are.  A month
    without facts keeps no state."""
    if table_exists(spark, path) and not months:
        return
    facts = read_table(spark, consolidated_path, CONSOLIDATED, keep_partition=True)
    if table_exists(spark, path):
        facts = facts.where(F.col(PARTITION_COL).isin(list(months)))
    (monthly_states(facts.drop(PARTITION_COL)).repartition(PARTITION_COL).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION_COL).parquet(path))


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """The states of all months.  Their schema is that of
    :func:`monthly_states`, so no file is opened to infer it."""
    facts = spark.createDataFrame([], CONSOLIDATED)
    schema = monthly_states(facts).schema
    return spark.read.schema(schema).parquet(path)


# ------------------------------------------------------------------- reports
def _mean(column: str, only: Column | None = None) -> Column:
    """The mean as ``avg`` of the column gives it: four more digits than the
    stored scale."""
    stored = CONSOLIDATED[column].dataType
    total, n = F.col(f"sum_{column}"), F.col(f"n_{column}")
    if only is not None:
        total, n = F.when(only, total), F.when(only, n)
    return F.try_divide(F.sum(total), F.sum(n).cast("decimal(20,0)")).cast(
        f"decimal({min(38, stored.precision + 4)},{min(37, stored.scale + 4)})")


def _corr(column: str, only: Column | None = None) -> Column:
    """Correlation of the price with ``column`` from the months' moments; NULL
    where either side is constant."""
    def v(name: str) -> Column:
        c = F.col(f"{name}_{column}")
        return c if only is None else F.when(only, c)

    n, mx, my = v("pairs"), v("mean_x"), v("mean_y")
    total = F.sum(n)

    def moment(m2: Column, a: Column, b: Column) -> Column:
        between = F.sum(n * a * b) - F.try_divide(F.sum(n * a) * F.sum(n * b), total)
        return F.sum(m2) + between

    xx, yy = moment(v("m2_x"), mx, mx), moment(v("m2_y"), my, my)
    constant = (F.min(v("min_x")) == F.max(v("max_x"))) | (F.min(v("min_y")) == F.max(v("max_y")))
    return F.when(~constant, F.try_divide(moment(v("m2_xy"), mx, my), F.sqrt(xx) * F.sqrt(yy)))


def _end(which: str, column: str, only: Column | None = None) -> Column:
    by = F.col("earliest" if which == "first" else "latest")
    value = F.col(f"{which}_{column}")
    if only is not None:
        by, value = F.when(only, by), F.when(only, value)
    return (F.min_by if which == "first" else F.max_by)(value, by)


def asset_summary(states: DataFrame) -> DataFrame:
    """As :func:`cadence.plans.reports.asset_summary`."""
    return (states.groupBy("coin_id")
            .agg(F.round(_mean("pct_change_1d"), 4).alias("avg_daily_return"),
                 F.round(_mean("volatility_7d"), 4).alias("avg_volatility"),
                 F.round(_mean("price_brl"), 4).alias("avg_price_brl"))
            .orderBy(F.col("avg_volatility").desc_nulls_first()))


def kpi_panel(states: DataFrame, coin_id: str) -> DataFrame:
    """As :func:`cadence.plans.reports.kpi_panel`."""
    mine = F.col("coin_id") == F.lit(coin_id)
    return states.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count_distinct("coin_id").alias("total_coins"),
        F.max("latest").alias("latest_date"),
        _mean("price_brl", mine).alias("avg_price_brl"),
        _end("last", "price_brl", mine).alias("latest_price_brl"),
        _corr("dolar_brl", mine).alias("corr_price_fx"))


def corr_matrix(states: DataFrame) -> DataFrame:
    """As :func:`cadence.plans.reports.corr_matrix`."""
    return states.groupBy("coin_id").agg(*[_corr(c).alias(f"corr_{c}") for c in AGAINST])


def period_return(states: DataFrame) -> DataFrame:
    """As :func:`cadence.plans.reports.period_return`."""
    return (states.groupBy("coin_id")
            .agg(_end("first", "price_usd").alias("first_price_usd"),
                 _end("last", "price_usd").alias("last_price_usd"),
                 _mean("selic_annual_rate").alias("avg_selic_annual_rate"))
            .withColumn("period_return_pct",
                        F.round((F.try_divide(F.col("last_price_usd"), F.col("first_price_usd"))
                                 - F.lit(1)) * F.lit(100), 4)))
