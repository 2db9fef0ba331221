"""Date column functions.  The day boundary is the session time zone, which
the engine pins to UTC."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadence.schemas import EXTRACTION_DAYS_BACK


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_day_month_year(col) -> Column:
    """``DD/MM/YYYY`` text (one- or two-digit day and month) to DATE; raises
    under ANSI on text that is not a valid day."""
    return F.to_date(_c(col), "d/M/yyyy")


def epoch_ms_to_date(col) -> Column:
    """Epoch milliseconds (any numeric type) to the UTC calendar day."""
    return F.to_date(F.timestamp_millis(_c(col).cast("bigint")))


def to_day(col) -> Column:
    """Timestamp, timestamp_ntz, date or ISO text to DATE."""
    return F.to_date(_c(col))


def in_extraction_window(col, as_of, days: int = EXTRACTION_DAYS_BACK) -> Column:
    """``as_of - days <= col <= as_of`` (both ends inclusive).  ``as_of`` is a
    parameter, so results are repeatable."""
    if isinstance(as_of, (str, _dt.date)):
        as_of = F.lit(str(as_of)).cast("date")
    return _c(col).between(F.date_sub(as_of, days), as_of)
