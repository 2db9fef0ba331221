"""pt-BR display formatting as column expressions.

``format_number`` rounds half-even, like Python's ``format``; the thousands
and decimal separators are swapped afterwards (``1,234,567`` ->
``1.234.567``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the display formats.
MISSING = "-"
CURRENCY_PREFIX = "R$ "
PERCENT_SUFFIX = "%"
SEPARATORS_FROM = ",."   # thousands ",", decimal "." as format_number writes them
SEPARATORS_TO = ".,"     # pt-BR: thousands ".", decimal ","


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def format_br_number(col, percent: bool = False) -> Column:
    """No decimals, ``.`` as thousands separator; with ``percent`` the value
    is multiplied by 100 and suffixed with ``%``; NULL -> ``-``."""
    c = _c(col)
    if percent:
        c = c * F.lit(100)
    text = F.translate(F.format_number(c, 0), SEPARATORS_FROM, SEPARATORS_TO)
    if percent:
        text = F.concat(text, F.lit(PERCENT_SUFFIX))
    return F.coalesce(text, F.lit(MISSING))


def format_percent_int(col) -> Column:
    """``x * 100`` rounded half-even to an integer, suffixed ``%``; NULL -> ``-``."""
    return F.coalesce(
        F.concat(F.bround(_c(col) * F.lit(100), 0).cast("bigint").cast("string"),
                 F.lit(PERCENT_SUFFIX)),
        F.lit(MISSING))


def format_reais(col) -> Column:
    """``R$ `` + pt-BR number without decimals; NULL -> ``-``."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(MISSING)).otherwise(
        F.concat(F.lit(CURRENCY_PREFIX),
                 F.translate(F.format_number(c, 0), SEPARATORS_FROM, SEPARATORS_TO)))
