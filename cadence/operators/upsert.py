"""Keyed upsert (merge by natural key) and its table writes.

Semantics: ``target UNION batch`` reduced to one row per key, where a batch
row beats the target row and, inside the batch, the later row beats the
earlier one.  "Later" needs an explicit order since a DataFrame has no row
order: ``batch_order`` columns (e.g. an ingest sequence), else the arrival
order given by ``monotonically_increasing_id`` of the batch scan.  NULL keys
compare equal (as grouping does).

The batch is reduced with ``max_by`` aggregates over ``order``: they have a
map-side partial phase, so a key repeated millions of times in a batch is
reduced before the shuffle instead of being sorted in one task.  The target
is only filtered (anti-join on the batch keys), never aggregated.

Writes evaluate the batch once (``stage_batch``): it is reduced and written to
a folder beside the table, and the same job's observation tells its rows,
repeated keys, rule violations and months.  Merges (``merge_staged``) rewrite
only those months.  They bound the scan of the target as a list of literal
``ref_month`` values, so a batch of two distant months reads two.  The merged
months are staged too (Spark cannot overwrite a path it is reading) and then
replace the months by a dynamic partition overwrite of that one write.  One
writer per table is assumed; where a catalog supports it,
``DataFrame.mergeInto`` is the way to concurrent writers.  Re-running a failed
or repeated load gives the same table (the merge is idempotent).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions.numeric import nan_to_null
from cadence.operators.dedup import keep_last, last_values

PARTITION_COL = "ref_month"


def _ordered(batch: DataFrame, columns: Sequence[str], batch_order: Sequence[str] | None
             ) -> tuple[DataFrame, list[str]]:
    """``columns`` and the order of the batch's rows."""
    if batch_order:
        extra = [c for c in batch_order if c not in columns]
        return batch.select(*columns, *extra), list(batch_order)
    return batch.select(*columns, F.monotonically_increasing_id().alias("_seq")), ["_seq"]


def upsert(target: DataFrame | None, batch: DataFrame, keys: Sequence[str],
           batch_order: Sequence[str] | None = None,
           columns: Sequence[str] | None = None, unique: bool = False) -> DataFrame:
    """Merged rows (``columns`` of the target; default: the batch's).

    Plan: the batch is reduced to its last row per key (``max_by``
    aggregates with a map-side phase; not if it is ``unique`` already), target
    rows whose key is in the batch are dropped with a null-safe left-anti join
    on the key (the key side is broadcast by AQE when small, so the target
    streams through without being shuffled or sorted), and the two are
    unioned.  The batch is evaluated twice: pass a stored one."""
    keys = list(keys)
    columns = list(columns or [c for c in batch.columns if c not in (batch_order or [])])
    latest = batch.select(*columns)
    if not unique:
        rows, order = _ordered(batch, columns, batch_order)
        latest = keep_last(rows, keys, order).select(*columns)
    if target is None:
        return latest
    bk = latest.select(*[F.col(k).alias(f"_bk_{k}") for k in keys])
    cond = [F.col(k).eqNullSafe(F.col(f"_bk_{k}")) for k in keys]
    kept = target.select(*columns).join(bk, cond, "left_anti")
    return kept.unionByName(latest)


def market_batch_clean(batch: DataFrame) -> DataFrame:
    """NaN -> NULL on the measures before a market load."""
    out = batch
    for c in ("price_usd", "market_cap_usd", "volume_24h_usd"):
        if c in batch.columns and isinstance(batch.schema[c].dataType,
                                             (T.FloatType, T.DoubleType)):
            out = out.withColumn(c, nan_to_null(c))
    return out


def conform(df: DataFrame, schema: T.StructType, stamp_col: str | None = None,
            stamp=None, table: str = "table") -> DataFrame:
    """Select/cast to the stored schema (store-time rounding to the decimal
    scale, half away from zero; overflow raises under ANSI); fill the load
    timestamp; enforce the NOT NULL columns of the schema -- a NULL fails the
    write job with ``raise_error`` (per-row, inside codegen), so nothing of
    the batch is committed, as a rejected insert."""
    cols = []
    for f in schema.fields:
        if f.name == stamp_col:
            val = (F.localtimestamp() if stamp is None else F.lit(stamp).cast("timestamp_ntz"))
        elif isinstance(f.dataType, T.DecimalType):
            val = F.round(F.col(f.name), f.dataType.scale).cast(f.dataType)
        else:
            val = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            val = F.when(val.isNull(), F.raise_error(F.lit(
                f"{table}: NOT NULL violated for column {f.name}"))).otherwise(val)
        cols.append(val.alias(f.name))
    return df.select(*cols)


def _filesystem(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path``, of any filesystem Spark knows, is there (no job)."""
    fs, jpath = _filesystem(spark, path)
    return bool(fs.exists(jpath))


def _drop_staging(spark: SparkSession, stage: str) -> None:
    """Remove this run's own staging folder after a successful publish."""
    fs, jpath = _filesystem(spark, stage)
    fs.delete(jpath, True)


def _stage_path(path: str) -> str:
    """A new folder beside the table; readers skip names with ``_``."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_staging_{name}_{uuid.uuid4().hex}"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               keep_partition: bool = False) -> DataFrame:
    """Scan a stored table with its explicit schema.  ``keep_partition``
    keeps the ``ref_month`` directory column so that date slices can prune
    whole partitions (see :func:`since`)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType(schema.fields + [
            T.StructField(PARTITION_COL, T.StringType())]))
    df = reader.parquet(path)
    return df if keep_partition else df.drop(PARTITION_COL)


def since(df: DataFrame, day, date_col: str = "reference_date") -> DataFrame:
    """Rows on or after ``day``; when the month partition column is present
    the matching ``ref_month >= 'YYYY-MM'`` predicate is added, which prunes
    partition directories (the date predicate alone cannot)."""
    lit_day = F.lit(str(day)).cast("date") if not isinstance(day, Column) else day
    out = df.where(F.col(date_col) >= lit_day)
    if PARTITION_COL in df.columns:
        out = out.where(F.col(PARTITION_COL) >= F.date_format(lit_day, "yyyy-MM"))
    return out


@dataclass(frozen=True)
class Staged:
    """A batch written once, one row per key, and what that write observed."""
    rows: DataFrame
    path: str
    count: int                  # rows before the reduction to one per key
    repeated: int               # rows of a key beyond its first
    months: list[str]
    counts: dict[str, int]      # rows for which each flag holds

    def drop(self) -> None:
        _drop_staging(self.rows.sparkSession, self.path)


def stage_batch(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                date_col: str = "reference_date", batch_order: Sequence[str] | None = None,
                flags: dict[str, Column] | None = None) -> Staged:
    """Write ``batch``, reduced to its last row per key, beside the table at
    ``path`` and observe it in the same job: the batch is evaluated once.

    ``flags`` are boolean columns whose rows are counted over the whole batch.
    They are summed per key first, so the observation sits in the job's last
    stage, where a task counts once however often it is run again."""
    keys, flags = list(keys), flags or {}
    columns = [c for c in batch.columns if c not in (batch_order or []) or c in keys]
    rows, order = _ordered(batch.withColumns({f"_flag_{n}": f for n, f in flags.items()}),
                           [*columns, *(f"_flag_{n}" for n in flags)], batch_order)
    values = [c for c in last_values(rows.select(*columns, *[o for o in order if o not in columns]),
                                     keys, order)]
    reduced = rows.groupBy(*keys).agg(
        *values, F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"_flag_{n}")).alias(f"_flag_{n}") for n in flags])
    seen = Observation(f"stage-{uuid.uuid4().hex}")
    reduced = reduced.observe(
        seen, F.sum("_rows").alias("rows"), F.count(F.lit(1)).alias("keys"),
        F.collect_set(F.date_format(F.col(date_col), "yyyy-MM")).alias("months"),
        *[F.sum(f"_flag_{n}").alias(f"flag_{n}") for n in flags])
    stage = _stage_path(path)
    reduced.select(*columns).write.mode("errorifexists").parquet(stage)
    found = seen.get
    count = found.get("rows") or 0
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in
                           batch.select(*columns).schema.fields])
    return Staged(spark.read.schema(schema).parquet(stage), stage, count,
                  count - (found.get("keys") or 0), sorted(found.get("months") or []),
                  {n: found.get(f"flag_{n}") or 0 for n in flags})


def merge_staged(spark: SparkSession, path: str, rows: DataFrame, months: Sequence[str],
                 keys: Sequence[str], schema: T.StructType, date_col: str = "reference_date",
                 check: Callable[[DataFrame], object] | None = None,
                 keep_staging: bool = False) -> None:
    """Merge stored ``rows``, unique per key and of the listed months, into the
    table at ``path`` (created when missing).  ``check`` runs on the merged
    months before they are published; raising there leaves the table
    untouched."""
    columns = [f.name for f in schema.fields]
    stored = T.StructType(schema.fields + [T.StructField(PARTITION_COL, T.StringType())])
    known = table_exists(spark, path)
    if known and not months:
        return
    current = None
    if known:
        current = (spark.read.schema(stored).parquet(path)
                   .where(F.col(PARTITION_COL).isin(list(months))).drop(PARTITION_COL))
    # rebalance: AQE sizes the write tasks by month -- small months are
    # coalesced into few files, a hot month is split over several tasks
    merged = upsert(current, rows, keys, None, columns, True).withColumn(
        PARTITION_COL, F.date_format(F.col(date_col), "yyyy-MM")).hint("rebalance", PARTITION_COL)
    if not known and check is None:      # nothing to read back first
        merged.write.mode("errorifexists").partitionBy(PARTITION_COL).parquet(path)
        return
    stage = _stage_path(path)
    merged.write.mode("errorifexists").partitionBy(PARTITION_COL).parquet(stage)
    staged = spark.read.schema(stored).parquet(stage)
    if check is not None:
        check(staged.drop(PARTITION_COL))
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(PARTITION_COL).parquet(path))
    if not keep_staging:
        _drop_staging(spark, stage)


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                 schema: T.StructType, date_col: str = "reference_date",
                 batch_order: Sequence[str] | None = None,
                 check: Callable[[DataFrame], object] | None = None,
                 keep_staging: bool = False) -> int:
    """Merge ``batch`` into the Parquet table at ``path`` (created when
    missing), rewriting only the month partitions the batch touches.

    ``check`` runs on the staged merged partitions before they are
    published; raising there leaves the table untouched.  Since a key lives
    in one month partition, checking the touched partitions checks the whole
    new table given the untouched ones were valid.
    The batch is evaluated once.  Returns the number of batch rows."""
    batch = batch.select(*[f.name for f in schema.fields], *(batch_order or []))
    staged = stage_batch(spark, path, batch, keys, date_col, batch_order)
    try:
        merge_staged(spark, path, staged.rows, staged.months, keys, schema, date_col, check,
                     keep_staging)
    finally:
        staged.drop()
    return staged.count
