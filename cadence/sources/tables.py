"""Stored tables: scans, the run log, the table-count report.

Tables are Parquet directories with an explicit schema (no inference),
partitioned by month of ``reference_date`` when written by an upsert.
"""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.operators.upsert import read_table  # noqa: F401  (S3 scan)
from cadence.schemas import COUNT_REPORT_HEADER, RUN_LOG

log = logging.getLogger(__name__)


def count_report(tables: dict[str, DataFrame | None], with_timestamp: bool = True) -> DataFrame:
    """One row per table ``(table_name, row_count[, captured_at])``; a
    missing table (``None``) counts 0.  Each count is a partial aggregate;
    the union is one job."""
    parts = []
    spark = None
    for name, df in tables.items():
        if df is not None:
            spark = df.sparkSession
            parts.append(df.agg(F.count(F.lit(1)).alias("row_count"))
                         .select(F.lit(name).alias("table_name"), "row_count"))
    if spark is None:
        spark = SparkSession.getActiveSession()
    missing = [(n, 0) for n, df in tables.items() if df is None]
    if missing:
        parts.append(spark.createDataFrame(missing, "table_name string, row_count long"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if with_timestamp:
        out = out.withColumn("captured_at", F.localtimestamp())
    return out


def write_count_report_csv(report: DataFrame, path: str) -> None:
    """CSV with the fixed header (table, count, capture time)."""
    cols = ["table_name", "row_count", "captured_at"]
    (report.select(*[F.col(c).alias(h) for c, h in zip(cols, COUNT_REPORT_HEADER)])
     .coalesce(1).write.mode("overwrite").option("header", True).csv(path))


def run_log_entry(spark: SparkSession, dag_id: str, task_id: str, source: str | None,
                  status: str, rows_inserted: int = 0, error_message: str | None = None,
                  started_at: _dt.datetime | None = None,
                  finished_at: _dt.datetime | None = None) -> DataFrame:
    now = _dt.datetime.now()
    row = (dag_id, task_id, source, status, int(rows_inserted or 0), error_message,
           started_at or now, finished_at or now)
    return spark.createDataFrame([row], RUN_LOG)


def append_run_log(spark: SparkSession, path: str, **entry) -> bool:
    """Append one run-log row; a failure to log is only a warning."""
    try:
        run_log_entry(spark, **entry).write.mode("append").parquet(path)
        return True
    except Exception as exc:  # noqa: BLE001
        log.warning("run log not written: %s", exc)
        return False


def run_log_json(run_log: DataFrame, logger_name: str = "cadence.jobs") -> DataFrame:
    """The run log as JSON log lines ``{timestamp, level, logger, message,
    exception?}`` (one column ``line``)."""
    level = F.when(F.col("status") == "failed", F.lit("ERROR")).otherwise(F.lit("INFO"))
    message = F.format_string("%s/%s - %s (%d rows)", "dag_id", "task_id", "status",
                              F.coalesce("rows_inserted", F.lit(0)))
    return run_log.select(F.to_json(F.struct(
        F.date_format("finished_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        level.alias("level"), F.lit(logger_name).alias("logger"), message.alias("message"),
        F.col("error_message").alias("exception"))).alias("line"))


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)
