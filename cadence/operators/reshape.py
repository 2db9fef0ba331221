"""Long -> wide reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def long_to_wide(df: DataFrame, index: Sequence[str] | str, names: str, value: str,
                 columns: Sequence[str], rename: dict | None = None) -> DataFrame:
    """One row per ``index`` with one column per listed name (NULL where the
    name has no row).  The name list is explicit, so no job runs to find it."""
    index = [index] if isinstance(index, str) else list(index)
    rename = rename or {}
    # conditional aggregation: one aggregate stage (pivot() plans two)
    return df.groupBy(*index).agg(*[
        F.max(F.when(F.col(names) == F.lit(n), F.col(value))).alias(rename.get(n, n))
        for n in columns])
