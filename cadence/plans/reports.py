"""Analytical queries over the consolidated table (summary, ranking,
history, KPI panel, correlations and the documented analyses).

All are single-scan aggregates or filters with projection pushed to the
scan; none brings rows to the driver except the helpers named ``scalar``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.formatting import (CURRENCY_PREFIX, MISSING, format_br_number,
                                          format_percent_int, format_reais)
from cadence.functions.numeric import safe_corr

HISTORY_COLS = ["reference_date", "price_usd", "price_brl", "pct_change_1d", "volatility_7d",
                "dolar_brl", "selic_annual_rate", "ipca_monthly"]


# ------------------------------------------------------------ query helpers
def run_query(spark: SparkSession, sql: str, params: dict | None = None,
              **frames: DataFrame) -> DataFrame:
    """A parametrised SQL query: named markers such as ``:coin_id`` bound
    from ``params``; DataFrames passed as keywords are referenced as
    ``{name}`` in the text (no temporary view is registered)."""
    return spark.sql(sql, args=params or None, **frames)


def scalar(df: DataFrame):
    """First cell of the first row, ``None`` when empty (one row reaches
    the driver)."""
    row = df.limit(1).first()
    return None if row is None else row[0]


# ---------------------------------------------------------------- summaries
def asset_summary(consolidated: DataFrame) -> DataFrame:
    """Per asset: mean daily change, mean 7-day volatility and mean BRL
    price, each rounded to 4; ordered by mean volatility, NULLs first."""
    return (consolidated.groupBy("coin_id")
            .agg(F.round(F.avg("pct_change_1d"), 4).alias("avg_daily_return"),
                 F.round(F.avg("volatility_7d"), 4).alias("avg_volatility"),
                 F.round(F.avg("price_brl"), 4).alias("avg_price_brl"))
            .orderBy(F.col("avg_volatility").desc_nulls_first()))


def summary_formatted(summary: DataFrame) -> DataFrame:
    """Display form of :func:`asset_summary`: ``int(round(x*100))%`` for the
    two means (half-even), ``R$ 1.234`` for the price, ``-`` for NULL."""
    return summary.select(
        "coin_id",
        format_percent_int("avg_daily_return").alias("avg_daily_return"),
        format_percent_int("avg_volatility").alias("avg_volatility"),
        format_reais("avg_price_brl").alias("avg_price_brl"))


def price_ranking(consolidated: DataFrame) -> DataFrame:
    """Mean BRL price per asset, assets without one dropped, highest first."""
    return (asset_summary(consolidated).select("coin_id", "avg_price_brl")
            .dropna(subset=["avg_price_brl"])
            .orderBy(F.col("avg_price_brl").desc()))


def distinct_assets(consolidated: DataFrame) -> DataFrame:
    return consolidated.select("coin_id").distinct().orderBy("coin_id")


# ------------------------------------------------------------------ history
def asset_history(consolidated: DataFrame, coin_id: str) -> DataFrame:
    """One asset's daily history in day order."""
    return (consolidated.where(F.col("coin_id") == F.lit(coin_id))
            .select(*HISTORY_COLS).orderBy("reference_date"))


def history_series(consolidated: DataFrame, coin_id: str, column: str) -> DataFrame:
    """``(reference_date, column)`` of one asset without NULL points (a
    chart series)."""
    return (asset_history(consolidated, coin_id).select("reference_date", column)
            .dropna(subset=[column]))


def fx_history(consolidated: DataFrame) -> DataFrame:
    """The exchange rate in day order, one row per asset-day (not
    de-duplicated), NULL rates dropped."""
    return (consolidated.select("reference_date", "dolar_brl")
            .dropna(subset=["dolar_brl"]).orderBy("reference_date"))


def latest_row(consolidated: DataFrame, coin_id: str, column: str = "price_brl") -> DataFrame:
    """The most recent ``column`` of one asset (top-1; NULL days first in a
    descending order, as the original SQL sorted)."""
    return (consolidated.where(F.col("coin_id") == F.lit(coin_id))
            .orderBy(F.col("reference_date").desc_nulls_first())
            .select("reference_date", column).limit(1))


# ---------------------------------------------------------------- KPI panel
def kpi_panel(consolidated: DataFrame, coin_id: str) -> DataFrame:
    """Row count, asset count, latest day, and for one asset the mean BRL
    price, the latest BRL price and the BRL price x exchange-rate
    correlation -- one aggregate over one scan."""
    mine = F.col("coin_id") == F.lit(coin_id)

    def only(c: str) -> Column:
        return F.when(mine, F.col(c))

    return consolidated.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("coin_id").alias("total_coins"),
        F.max("reference_date").alias("latest_date"),
        F.avg(only("price_brl")).alias("avg_price_brl"),
        F.max_by(only("price_brl"), only("reference_date")).alias("latest_price_brl"),
        safe_corr(only("price_brl"), only("dolar_brl")).alias("corr_price_fx"))


def kpi_panel_formatted(panel: DataFrame) -> DataFrame:
    """Display strings of :func:`kpi_panel` (pt-BR separators, ``-`` for
    missing values, the correlation as a percentage)."""
    return panel.select(
        format_br_number("total_rows").alias("total_rows"),
        format_br_number("total_coins").alias("total_coins"),
        F.coalesce(F.col("latest_date").cast("string"), F.lit(MISSING)).alias("latest_date"),
        F.concat(F.lit(CURRENCY_PREFIX), format_br_number("avg_price_brl")).alias("avg_price_brl"),
        F.concat(F.lit(CURRENCY_PREFIX), format_br_number("latest_price_brl"))
        .alias("latest_price_brl"),
        format_br_number("corr_price_fx", percent=True).alias("corr_price_fx"))


# ------------------------------------------------------- documented analyses
def corr_matrix(consolidated: DataFrame,
                against: Sequence[str] = ("dolar_brl", "selic_annual_rate", "ipca_monthly"),
                price: str = "price_brl") -> DataFrame:
    """Per asset, the correlation of ``price`` with each macro column (NULL
    where either side is constant)."""
    return consolidated.groupBy("coin_id").agg(
        *[safe_corr(price, c).alias(f"corr_{c}") for c in against])


def period_return(consolidated: DataFrame) -> DataFrame:
    """Per asset: first and last USD price of the period, the period return
    in percent and the mean annualised policy rate over the same days."""
    first = F.min_by("price_usd", "reference_date")
    last = F.max_by("price_usd", "reference_date")
    return (consolidated.groupBy("coin_id")
            .agg(first.alias("first_price_usd"), last.alias("last_price_usd"),
                 F.avg("selic_annual_rate").alias("avg_selic_annual_rate"))
            .withColumn("period_return_pct",
                        F.round((F.try_divide(F.col("last_price_usd"), F.col("first_price_usd"))
                                 - F.lit(1)) * F.lit(100), 4)))


def return_histogram(consolidated: DataFrame, width: float = 5.0) -> DataFrame:
    """Daily-change histogram per asset: bucket lower bound ``floor(pct /
    width) * width`` and the number of days in it."""
    w = F.lit(width).cast("double")
    lo = F.floor(F.col("pct_change_1d").cast("double") / w) * w
    return (consolidated.where(F.col("pct_change_1d").isNotNull())
            .groupBy("coin_id", lo.alias("bucket_lo")).agg(F.count(F.lit(1)).alias("days")))


# ------------------------------------------------------------------- counts
def null_counts(df: DataFrame) -> DataFrame:
    """NULL count of every column, one pass."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def computed_counts(consolidated: DataFrame) -> DataFrame:
    """How many rows carry a computed change, volatility and annual rate."""
    return consolidated.agg(F.count("pct_change_1d").alias("n_pct_change"),
                            F.count("volatility_7d").alias("n_volatility"),
                            F.count("selic_annual_rate").alias("n_selic_annual"))


# ---------------------------------------------------------------- dashboard
def dashboard(consolidated: DataFrame, coin_id: str) -> dict[str, DataFrame]:
    """Every view of the dashboard over one persisted scan of the
    consolidated table (memory and disk; lost blocks are recomputed): the
    summary and its display form, KPI panel and display form, asset list,
    asset history and chart series, price ranking and exchange-rate
    history.  Call ``unpersist()`` on ``views["table"]`` when done."""
    from pyspark import StorageLevel
    table = consolidated.persist(StorageLevel.MEMORY_AND_DISK)
    summary = asset_summary(table)
    panel = kpi_panel(table, coin_id)
    return {
        "table": table,
        "summary": summary,
        "summary_formatted": summary_formatted(summary),
        "kpi": panel,
        "kpi_formatted": kpi_panel_formatted(panel),
        "assets": distinct_assets(table),
        "history": asset_history(table, coin_id),
        "price_series": history_series(table, coin_id, "price_brl"),
        "volatility_series": history_series(table, coin_id, "volatility_7d"),
        "ranking": price_ranking(table),
        "fx_history": fx_history(table),
    }
