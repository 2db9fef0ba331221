"""Column-level functions (all built-in expressions, codegen friendly)."""

from cadence.functions.numeric import (  # noqa: F401
    annualize_rate, nan_to_null, parse_decimal_comma, safe_corr, store_cast,
)
from cadence.functions.dates import (  # noqa: F401
    epoch_ms_to_date, in_extraction_window, parse_day_month_year, to_day,
)
from cadence.functions.formatting import (  # noqa: F401
    format_br_number, format_percent_int, format_reais,
)
