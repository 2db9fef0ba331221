"""Batch jobs: incremental macro load, incremental market load,
consolidation, and the full run.  Jobs communicate only through tables.

A load evaluates its batch once.  One job reduces it to one row per key,
writes it beside the table and observes row count, NULLs, ranges, repeated
keys and months on the way; the rules are judged from that, and only then are
the touched months merged.  A run-log row is appended either way (a failure to
log is only a warning).
"""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cadence.functions.dates import in_extraction_window
from cadence.operators.quality import (batch_flags, check_not_empty, evaluate, raise_violations,
                                       validate)
from cadence.operators.upsert import (conform, market_batch_clean, merge_staged, read_table,
                                      stage_batch)
from cadence.plans import states
from cadence.plans.consolidate import consolidate
from cadence.plans.transforms import clean_market, transform_macro
from cadence.schemas import CONSOLIDATED, KEYS, MACRO, MARKET
from cadence.sources.tables import append_run_log

log = logging.getLogger(__name__)


@dataclass
class Paths:
    """Table locations (shared storage on a cluster).  ``states`` is the
    optional table of monthly states behind the reports."""
    macro: str
    market: str
    consolidated: str
    run_log: str
    states: str | None = None


def _logged(spark: SparkSession, paths: Paths, dag_id: str, task_id: str, source: str, fn,
            notes: dict | None = None):
    started = _dt.datetime.now()
    try:
        rows = fn()
    except Exception as exc:
        append_run_log(spark, paths.run_log, dag_id=dag_id, task_id=task_id, source=source,
                       status="failed", error_message=str(exc), started_at=started,
                       finished_at=_dt.datetime.now())
        raise
    append_run_log(spark, paths.run_log, dag_id=dag_id, task_id=task_id, source=source,
                   status="success", rows_inserted=rows, started_at=started,
                   finished_at=_dt.datetime.now(),
                   error_message=(notes or {}).get("error_message"))
    return rows


def _extracted(rows: DataFrame, series: str, names: Sequence[str] | None, as_of) -> DataFrame:
    """The listed series and the extraction window before ``as_of``, each only
    where asked for."""
    if names is not None:
        rows = rows.where(F.col(series).isin(list(names)))
    return rows if as_of is None else rows.where(in_extraction_window("reference_date", as_of))


def _load(spark: SparkSession, path: str, batch: DataFrame, table: str, schema: StructType,
          clean: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> int:
    """Stage, judge, merge; the number of batch rows."""
    checks, flags = batch_flags(batch, table)
    staged = stage_batch(spark, path, batch, KEYS[table], flags=flags)
    try:
        raise_violations(table, [
            (ch, staged.repeated if ch.rule == "unique_key" else staged.counts[str(i)])
            for i, ch in enumerate(checks)])
        rows = conform(clean(staged.rows), schema, stamp_col="ingested_at", table=table)
        merge_staged(spark, path, rows, staged.months, KEYS[table], schema)
    finally:
        staged.drop()
    return staged.count


def load_macro(spark: SparkSession, landed: DataFrame, paths: Paths,
               dag_id: str = "load_macro", task_id: str = "load_macro",
               indicators: Sequence[str] | None = None, as_of=None) -> int:
    """C4: landed long rows ``(indicator, reference_date text, valor)`` ->
    transform -> allow-list and window (``indicators``, ``as_of``) -> validate
    -> keyed merge into the macro table -> run log."""
    def run():
        batch = _extracted(transform_macro(landed), "indicator", indicators, as_of)
        return _load(spark, paths.macro, batch, "bcb_indicators", MACRO)
    return _logged(spark, paths, dag_id, task_id, "macro", run)


def load_market(spark: SparkSession, landed: DataFrame, paths: Paths,
                dag_id: str = "load_market", task_id: str = "load_market",
                assets: Sequence[str] | None = None, as_of=None) -> int:
    """Landed daily market rows -> clean -> allow-list and window
    (``assets``, ``as_of``) -> validate -> NaN to NULL -> keyed merge into the
    market table -> run log.  The change and volatility of
    ``transform_market`` are neither stored nor validated, so the load does
    not compute them."""
    def run():
        batch = _extracted(clean_market(landed), "coin_id", assets, as_of)
        return _load(spark, paths.market, batch, "crypto_market", MARKET, market_batch_clean)
    return _logged(spark, paths, dag_id, task_id, "market", run)


def store_facts(spark: SparkSession, paths: Paths, facts: DataFrame,
                check: Callable[[DataFrame], object] | None = None) -> list[str]:
    """Merge consolidated rows into the fact table; the months they touch."""
    staged = stage_batch(spark, paths.consolidated, facts, KEYS["daily_consolidated"])
    try:
        merge_staged(spark, paths.consolidated, staged.rows, staged.months,
                     KEYS["daily_consolidated"], CONSOLIDATED, check=check)
    finally:
        staged.drop()
    return staged.months


def run_consolidation(spark: SparkSession, paths: Paths, start_date=None, *,
                      mode: str = "reference", validate_when: str = "before",
                      series_bucket: str | None = None,
                      strict: bool = False, dag_id: str = "consolidate",
                      task_id: str = "consolidate") -> int:
    """Consolidate the stored tables and merge the result into the fact
    table.  ``validate_when="before"`` checks the staged merged partitions
    before they are published; ``"after"`` publishes first and then checks
    the whole table (the original order); ``"report"`` publishes and records
    the violation counts (one aggregate job) in the run log without failing.
    The monthly states of the touched months follow, where ``paths`` names
    their table.  Returns the fact-table row count."""
    if validate_when not in ("before", "after", "report"):
        raise ValueError("validate_when must be 'before', 'after' or 'report'")
    notes = {}

    def run():
        # the month column stays so a date slice prunes partition directories
        market = read_table(spark, paths.market, MARKET, keep_partition=True)
        macro = read_table(spark, paths.macro, MACRO)
        facts = consolidate(market, macro, start_date, mode=mode, series_bucket=series_bucket)
        check = ((lambda staged: validate(staged, "daily_consolidated"))
                 if validate_when == "before" else None)
        touched = store_facts(spark, paths, facts, check)
        if paths.states:
            states.refresh(spark, paths.states, paths.consolidated, touched)
        table = read_table(spark, paths.consolidated, CONSOLIDATED)
        if validate_when == "after":
            validate(table, "daily_consolidated")
        elif validate_when == "report":
            bad = [f"{c.table}.{c.column} {c.rule}={n}"
                   for c, n in evaluate(table, "daily_consolidated") if n]
            if bad:
                log.warning("consolidated table violations: %s", "; ".join(bad))
                notes["error_message"] = "violations: " + "; ".join(bad)
        return check_not_empty(table.count(), strict=strict)
    return _logged(spark, paths, dag_id, task_id, "consolidation", run, notes)


def run_all(spark: SparkSession, macro_landed: DataFrame, market_landed: DataFrame,
            paths: Paths, **consolidation) -> dict:
    """Macro load -> market load -> consolidation; stops at the first
    failure (the exception propagates after its run-log row is written)."""
    results = {}
    results["macro"] = load_macro(spark, macro_landed, paths)
    results["market"] = load_market(spark, market_landed, paths)
    results["consolidated"] = run_consolidation(spark, paths, **consolidation)
    log.info("run finished: %s", results)
    return results
