"""Consolidation of market series and macro indicators into the daily fact
table (one row per asset and day).

    market --(optional slice)--> lag / pct change / rolling volatility
        (one shuffle by asset; both windows share partitioning and order)
    distinct market days x indicators --as-of with earliest fallback--> macro
        (by validity calendar, see ``operators.asof``) --pivot--> one row per day
    facts LEFT JOIN macro-by-day (one row per day; AQE broadcasts it if small)
    -> BRL price, annualised policy rate, cast to the stored widths.

Modes for ``start_date``:

* ``"reference"`` -- the slice is taken *before* the windows, so the first
  row of each asset in the slice has no previous price and a cut volatility
  frame (the behaviour being reproduced).
* ``"lookback"`` -- the windows see the rows before the slice, only the slice
  is returned.  Exactly the 7 rows per asset the windows need before the
  slice are read: a small per-asset query finds the earliest of them, and
  that day becomes a pushed-down lower bound.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.numeric import annualize_rate, store_cast
from cadence.operators.asof import asof_by_day, asof_join
from cadence.operators.reshape import long_to_wide
from cadence.operators.upsert import since
from cadence.operators.windows import (bucketed_series, pct_change, rolling_stddev,
                                       series_window)
from cadence.schemas import CONSOLIDATED, INDICATORS, VOLATILITY_ROWS

MARKET_COLS = ["coin_id", "reference_date", "price_usd", "market_cap_usd", "volume_24h_usd"]
# macro indicator -> consolidated column
MACRO_COLUMNS = {"dolar": "dolar_brl", "selic": "selic_daily_rate", "ipca": "ipca_monthly"}


def _date(value) -> Column:
    return F.lit(str(value)).cast("date")


def _metrics(frame: DataFrame, w) -> DataFrame:
    return (frame.withColumn("pct_change_1d", pct_change("price_usd", w, scale=4, exact=True))
            .withColumn("volatility_7d", rolling_stddev("pct_change_1d", w,
                                                        rows=VOLATILITY_ROWS, scale=4)))


_YEAR_BUCKETS = {"year": F.year, "month": lambda c: F.date_trunc("month", c)}


def market_metrics(market: DataFrame, bucket: str | None = None) -> DataFrame:
    """Previous-row percent change (rounded to 4) and the rolling sample
    deviation of that *rounded* change over 7 rows (rounded to 4).

    ``bucket=None`` (default): one window partition per asset.  The input
    has one row per asset and day (the daily reduction and the unique-key
    rule guarantee it), so a partition holds at most one row per calendar
    day whatever the data volume -- a hot asset cannot exceed its calendar.
    ``bucket="year"``/``"month"``: per asset and calendar bucket with a
    7-row halo from earlier buckets (``bucketed_series``), for series whose
    length is not bounded that way; exact, at the price of a few more
    (small) stages."""
    base = market.select(*MARKET_COLS)
    if bucket is None:
        return _metrics(base, series_window("coin_id", "reference_date"))
    return bucketed_series(base, "coin_id", "reference_date", _metrics,
                           reach=VOLATILITY_ROWS, bucket=_YEAR_BUCKETS[bucket])


def lookback_start(market: DataFrame, start_date, rows: int = VOLATILITY_ROWS,
                   recent_days: int = 45) -> Column:
    """Earliest day among the ``rows`` rows before ``start_date`` of every
    asset present in the slice -- reading from there gives every window of
    the slice its full frame.  Returns a literal (one scalar reaches the
    driver).

    The frames are looked up in the last ``recent_days`` first (partition
    pruned); only assets with fewer than ``rows`` rows there ("short") are
    looked up in older history, joined to the short assets -- when there
    are none that branch is empty at run time and AQE drops it.  Assets
    absent from the slice do not move the cut."""
    start = _dt.date.fromisoformat(str(start_date)[:10])
    lo = start - _dt.timedelta(days=recent_days)
    has_month = "ref_month" in market.columns

    def between(df, first=None, last=None):
        if first is not None:
            df = df.where(F.col("reference_date") >= _date(first))
            if has_month:
                df = df.where(F.col("ref_month") >= F.lit(str(first)[:7]))
        if last is not None:
            df = df.where(F.col("reference_date") < _date(last))
            if has_month:
                df = df.where(F.col("ref_month") <= F.lit(str(last)[:7]))
        return df.select("coin_id", "reference_date")

    def last_rows(df):
        w = Window.partitionBy("coin_id").orderBy(F.col("reference_date").desc())
        return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= rows)

    in_slice = between(market, first=start).select("coin_id").distinct()
    recent = between(market, first=lo, last=start).join(in_slice, "coin_id", "left_semi")
    frames = last_rows(recent).groupBy("coin_id").agg(F.count(F.lit(1)).alias("_n"),
                                                      F.min("reference_date").alias("_lo"))
    full = frames.where(F.col("_n") >= rows)
    short = in_slice.join(full, "coin_id", "left_anti")
    short_rows = between(market, last=start).join(short, "coin_id", "left_semi")
    cut = (full.select(F.col("_lo").alias("d"))
           .unionByName(last_rows(short_rows).select(F.col("reference_date").alias("d")))
           .agg(F.min("d")).first()[0])
    return _date(cut) if cut is not None else _date(start)


def macro_by_day(days: DataFrame, macro: DataFrame, indicators=None,
                 bucket="year", method: str = "calendar") -> DataFrame:
    """For each day: the latest value of each indicator at or before the day,
    else the indicator's earliest value; one row per day, one column per
    indicator (``dolar_brl``, ``selic_daily_rate``, ``ipca_monthly``).  A NULL
    day takes the earliest values.

    ``method="calendar"`` joins the days to the values' validity
    (:func:`asof_by_day`), ``"bucket"`` scans both by buckets of time
    (:func:`asof_join`)."""
    if method not in ("calendar", "bucket"):
        raise ValueError("method must be 'calendar' or 'bucket'")
    names = list(indicators or INDICATORS)
    left = days.select("reference_date").withColumn(
        "indicator", F.explode(F.array(*[F.lit(n) for n in names])))
    right = macro.select("indicator", "reference_date", "valor").where(
        F.col("indicator").isin(names))
    if method == "calendar":
        filled = asof_by_day(left, right, "reference_date", ["indicator"], ["valor"],
                             backfill=True)
    else:
        filled = asof_join(left, right, on="reference_date", by=["indicator"],
                           values=["valor"], backfill=True, bucket=bucket)
    return long_to_wide(filled, "reference_date", "indicator", "valor", names,
                        rename={k: v for k, v in MACRO_COLUMNS.items() if k in names})


def consolidate(market: DataFrame, macro: DataFrame, start_date=None, *,
                mode: str = "reference", created_at=None, series_bucket: str | None = None
                ) -> DataFrame:
    """The daily fact table (stored column types, ``created_at`` one
    timestamp for the whole batch).

    The fact/macro join is left to AQE, which broadcasts the macro-by-day
    side (one row per distinct fact day) only when its measured size is under
    its threshold.  ``series_bucket`` selects bucketed per-asset windows (see
    :func:`market_metrics`).
    """
    if mode not in ("reference", "lookback"):
        raise ValueError("mode must be 'reference' or 'lookback'")
    base = market
    if start_date is not None:
        if isinstance(start_date, _dt.datetime):
            start_date = start_date.date()
        if mode == "reference":
            base = since(base, start_date)
        else:
            base = since(base, lookback_start(base, start_date))
    facts = market_metrics(base.select(*MARKET_COLS), series_bucket)
    if start_date is not None and mode == "lookback":
        facts = facts.where(F.col("reference_date") >= _date(start_date))

    days = facts.select("reference_date").distinct()
    by_day = macro_by_day(days, macro).withColumnRenamed("reference_date", "_day")
    joined = facts.join(by_day, F.col("reference_date").eqNullSafe(F.col("_day")), "left")

    stamp = F.localtimestamp() if created_at is None else F.lit(created_at).cast("timestamp_ntz")
    price_brl = F.round(F.col("price_usd") * F.col("dolar_brl"), 8)
    out = joined.select(
        F.col("reference_date"), F.col("coin_id"),
        F.col("price_usd").cast("decimal(20,8)").alias("price_usd"),
        price_brl.cast("decimal(20,8)").alias("price_brl"),
        F.col("market_cap_usd").cast("decimal(30,2)").alias("market_cap_usd"),
        F.col("volume_24h_usd").cast("decimal(30,2)").alias("volume_24h_usd"),
        store_cast("pct_change_1d", 10, 4).alias("pct_change_1d"),
        store_cast("volatility_7d", 10, 4).alias("volatility_7d"),
        store_cast("dolar_brl", 10, 6).alias("dolar_brl"),
        store_cast("selic_daily_rate", 12, 8).alias("selic_daily_rate"),
        store_cast(annualize_rate("selic_daily_rate", 6), 10, 6).alias("selic_annual_rate"),
        store_cast("ipca_monthly", 8, 4).alias("ipca_monthly"),
        stamp.alias("created_at"),
    )
    return out.select(*[f.name for f in CONSOLIDATED.fields])
