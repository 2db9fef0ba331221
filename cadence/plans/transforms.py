"""Row-level transforms of the landed series (pure DataFrame -> DataFrame)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.dates import parse_day_month_year, to_day
from cadence.functions.numeric import annualize_rate
from cadence.operators.windows import pct_change, rolling_stddev, series_window

MARKET_CRITICAL = ["coin_id", "reference_date", "price_usd"]


def transform_macro(df: DataFrame) -> DataFrame:
    """``(indicator, reference_date 'DD/MM/YYYY', valor)`` ->
    ``reference_date`` as DATE (strict), ``selic_annual`` -- the compounded
    annual rate, only on policy-rate rows (NULL elsewhere; the column is
    always present) -- and rows without ``valor`` dropped."""
    return (df.withColumn("reference_date", parse_day_month_year("reference_date"))
            .withColumn("selic_annual", F.when(F.col("indicator") == F.lit("selic"),
                                               annualize_rate("valor")))
            .dropna(subset=["valor"]))


def clean_market(df: DataFrame) -> DataFrame:
    """Day-typed market rows; rows lacking asset, day or price are dropped.
    Row by row: no shuffle."""
    return df.withColumn("reference_date", to_day("reference_date")).dropna(
        how="any", subset=MARKET_CRITICAL)


def transform_market(df: DataFrame, ordered: bool = False) -> DataFrame:
    """Day-typed market rows with the unrounded double percent change against
    the previous row of the asset and the sample deviation of that change
    over up to 7 rows (fewer than two values -> NULL).  Rows lacking asset,
    day or price are dropped first.  ``ordered`` sorts the output by asset
    and day (a global sort: only when the order itself is wanted)."""
    w = series_window("coin_id", "reference_date")
    out = (clean_market(df)
           .withColumn("pct_change_1d", pct_change("price_usd", w, scale=None, exact=False))
           .withColumn("volatility_7d", rolling_stddev("pct_change_1d", w, scale=None)))
    return out.orderBy("coin_id", "reference_date") if ordered else out
