"""Data-quality rules: fail-fast validation and a violation report.

All null and range counts, the row count and the duplicate-key count come
from **one** job: rows are first grouped by the natural key (partial,
map-side aggregation, so a hot key is reduced before the shuffle), then the
per-key partial counts are summed.  The driver receives a single row and
evaluates the rules in the fixed order:

    required columns -> nulls (listed order) -> duplicate keys -> ranges

Null counts treat NaN as null; range checks coerce to double (non-numeric
text becomes NULL), turn NaN into NULL and pass NULLs, on closed intervals.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.schemas import KEYS, REQUIRED_COLUMNS, RULES, Rule

# Rule messages.
MSG_MISSING = "colunas ausentes: {columns}"
MSG_NULLS = "{column} possui {n} valores nulos"
MSG_DUPLICATES = "{n} linhas duplicadas em {keys}"
MSG_RANGE = "{column} possui {n} valores fora do intervalo [{minimum}, {maximum}]"

REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("rule", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("violations", T.LongType()),
])


class DataQualityError(ValueError):
    """A table breaks one of its rules; the text names both."""

    def __init__(self, table: str, problem: str):
        super().__init__(": ".join((table, problem)))
        self.table, self.problem = table, problem


@dataclass(frozen=True)
class Check:
    """One rule instance; ``expr`` is a per-row 0/1 flag (None for rules
    evaluated without a job or from the key grouping)."""
    table: str
    rule: str
    column: str
    expr: Column | None
    message: str


def _is_null(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _numeric(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    dt = df.schema[name].dataType
    if isinstance(dt, T.StringType):
        c = F.trim(c).try_cast("double")
    else:
        c = c.cast("double")
    return F.when(~F.isnan(c), c)


def _out_of(df: DataFrame, name: str, lo, hi) -> Column:
    v = _numeric(df, name)
    return (v < F.lit(float(lo))) | (v > F.lit(float(hi)))


def table_checks(df: DataFrame, table: str, rules: Sequence[Rule] | None = None,
                 keys: Sequence[str] | None = None,
                 required: Sequence[str] | None = None) -> tuple[list[Check], list[str]]:
    rules = [r for r in (RULES if rules is None else rules) if r.table == table]
    keys = list(KEYS[table] if keys is None else keys)
    required = list(REQUIRED_COLUMNS[table] if required is None else required)
    missing = [c for c in required if c not in df.columns]
    if missing:          # reported first; the other rules need the columns
        return [], missing
    checks = [Check(table, r.kind, r.column, _is_null(df, r.column), MSG_NULLS)
              for r in rules if r.kind == "not_null"]
    checks.append(Check(table, "unique_key", ",".join(keys), None, MSG_DUPLICATES))
    for r in rules:
        if r.kind != "range":
            continue
        bad, name = _out_of(df, r.column, r.minimum, r.maximum), table
        if r.indicator:
            bad, name = (F.col("indicator") == F.lit(r.indicator)) & bad, f"{table}[{r.indicator}]"
        checks.append(Check(name, "range", r.column, bad, MSG_RANGE.replace(
            "{minimum}", str(r.minimum)).replace("{maximum}", str(r.maximum))))
    return checks, missing


def _report(df: DataFrame, checks: list[Check], keys: list[str]) -> DataFrame:
    """One job: per-key partial counts, then their sums, unpivoted to one
    row per check (in check order)."""
    flagged = [(i, ch) for i, ch in enumerate(checks) if ch.expr is not None]
    per_key = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(F.when(ch.expr, 1).otherwise(0)).alias(f"_c{i}") for i, ch in flagged])
    sums = per_key.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("_dups"),
        *[F.coalesce(F.sum(f"_c{i}"), F.lit(0)).cast("bigint").alias(f"_c{i}")
          for i, _ in flagged])
    rows = []
    for i, ch in enumerate(checks):
        val = F.col("_dups") if ch.rule == "unique_key" else F.col(f"_c{i}")
        rows.append(F.struct(F.lit(ch.table).alias("table_name"), F.lit(ch.rule).alias("rule"),
                             F.lit(ch.column).alias("column_name"),
                             val.alias("violations")))
    return sums.select(F.inline(F.array(*rows)))


def evaluate(df: DataFrame, table: str, **kw) -> list[tuple[Check, int]]:
    """All rules of ``table`` with their violation counts, in rule order
    (one job, one row to the driver per rule)."""
    checks, missing = table_checks(df, table, **kw)
    if missing:
        return [(Check(table, "required_column", c, None, MSG_MISSING), 1) for c in missing]
    keys = list(kw.get("keys") or KEYS[table])
    counts = [int(r["violations"]) for r in _report(df, checks, keys).collect()]
    return list(zip(checks, counts))


def batch_flags(df: DataFrame, table: str) -> tuple[list[Check], dict[str, Column]]:
    """The rules of ``table`` and, by their numbers, the columns that flag a
    row breaking them: for counting them while a batch is written.  Missing
    columns raise."""
    checks, missing = table_checks(df, table)
    if missing:
        raise DataQualityError(table, MSG_MISSING.format(columns=", ".join(missing)))
    return checks, {str(i): ch.expr for i, ch in enumerate(checks) if ch.expr is not None}


def raise_violations(table: str, found: Sequence[tuple[Check, int]]) -> None:
    """Raise for the first rule that was broken, in the fixed order."""
    for ch, n in found:
        if not n:
            continue
        if ch.rule == "unique_key":
            raise DataQualityError(ch.table, ch.message.format(n=n,
                                                               keys=ch.column.replace(",", ", ")))
        raise DataQualityError(ch.table, ch.message.format(n=n, column=ch.column))


def validate(df: DataFrame, table: str, **kw) -> DataFrame:
    """Raise :class:`DataQualityError` for the first violated rule, in the
    fixed order; otherwise return ``df`` unchanged."""
    checks, missing = table_checks(df, table, **kw)
    if missing:
        raise DataQualityError(table, MSG_MISSING.format(columns=", ".join(missing)))
    raise_violations(table, evaluate(df, table, **kw))
    return df


def violation_report(df: DataFrame, table: str, **kw) -> DataFrame:
    """The rule counts as a DataFrame ``(table_name, rule, column_name,
    violations)`` -- one row per rule, zero when it passes.  Lazy: a single
    aggregate job when it is collected."""
    checks, missing = table_checks(df, table, **kw)
    if missing:
        return df.sparkSession.createDataFrame(
            [(table, "required_column", c, 1) for c in missing], REPORT_SCHEMA)
    return _report(df, checks, list(kw.get("keys") or KEYS[table]))


def check_not_empty(count: int | None, strict: bool = False, table: str = "daily_consolidated"):
    """Post-load check: a missing count fails; zero fails only if ``strict``."""
    if count is None or (strict and count == 0):
        raise DataQualityError(table, f"contagem invalida: {count}")
    return count


# ------------------------------------------------------- documented rules

def gap_counts(df: DataFrame, key: str, day: str = "reference_date", max_gap_days: int = 7
               ) -> DataFrame:
    """``key, gaps``: per key, how often two consecutive days lie more than
    ``max_gap_days`` apart.  Days that are closer share a session
    (``session_window``, half a day wider than that), so gaps are sessions minus one; with
    ``spark.sql.sessionWindow.merge.sessions.in.local.partition`` a hot key's
    rows are merged into sessions before the shuffle.  NULL days belong to no
    session."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
    session = F.session_window(F.col(day).cast("timestamp"), f"{24 * max_gap_days + 12} hours")
    sessions = df.groupBy(key, session.alias("_session")).agg(F.count(F.lit(1)).alias("_rows"))
    return sessions.groupBy(key).agg((F.count(F.lit(1)) - 1).alias("gaps"))


def documented_report(consolidated: DataFrame, as_of, *, max_gap_days: int = 7,
                      band=(0.5, 5.0), table: str = "daily_consolidated") -> DataFrame:
    """Rules described but not coded by the original: rows dated after
    ``as_of``; gaps of more than ``max_gap_days`` between consecutive rows of
    an asset; assets whose mean 7-day volatility is outside ``band``.
    One row per rule ``(table_name, rule, column_name, violations)``."""
    as_of_col = F.lit(str(as_of)).cast("date")
    w = Window.partitionBy("coin_id").orderBy("reference_date")
    gap = F.datediff(F.col("reference_date"), F.lag("reference_date").over(w))
    per_asset = (consolidated.select("coin_id", "reference_date", "volatility_7d")
                 .withColumn("_gap", (gap > max_gap_days).cast("int"))
                 .groupBy("coin_id")
                 .agg(F.sum(F.when(F.col("reference_date") > as_of_col, 1).otherwise(0))
                      .alias("_future"),
                      F.sum(F.coalesce("_gap", F.lit(0))).alias("_gaps"),
                      F.avg("volatility_7d").cast("double").alias("_vol")))
    lo, hi = band
    sums = per_asset.agg(
        F.coalesce(F.sum("_future"), F.lit(0)).cast("bigint").alias("future"),
        F.coalesce(F.sum("_gaps"), F.lit(0)).cast("bigint").alias("gaps"),
        F.count(F.when((F.col("_vol") < lo) | (F.col("_vol") > hi), 1)).cast("bigint")
        .alias("band"))
    rows = [("future_date", "reference_date", "future"),
            ("gap_over_days", "reference_date", "gaps"),
            ("mean_volatility_band", "volatility_7d", "band")]
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(r).alias("rule"),
                 F.lit(c).alias("column_name"), F.col(v).alias("violations"))
        for r, c, v in rows])))
