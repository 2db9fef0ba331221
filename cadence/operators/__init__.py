"""DataFrame operators (compositions of built-in Spark operators)."""

from cadence.operators.asof import asof_join  # noqa: F401
from cadence.operators.dedup import keep_last, last_of_day  # noqa: F401
from cadence.operators.reshape import long_to_wide  # noqa: F401
from cadence.operators.windows import pct_change, rolling_stddev, series_window  # noqa: F401
