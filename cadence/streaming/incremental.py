"""The repeated daily load as a file stream.

Landed payload files (one JSON document per file) arrive under
``<landing>/<key>=<series>/...``.  A file-source stream with
``trigger(availableNow=True)`` picks up every file not seen before (the
source's checkpoint records them, so a restarted or retried run neither
skips nor repeats a file), and ``foreachBatch`` runs the ordinary batch
path on each micro-batch: parse -> transform -> validate -> keyed merge.
The merge is idempotent, so a micro-batch replayed after a failure leaves
the same table.  A micro-batch that fails validation stops the query with
the rule's error (and a failed run-log row); its offsets are not committed,
so the corrected restart processes the same files again.  No watermark is
needed: there is no streaming aggregation state; ordering across batches is
resolved by the merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadence.plans.jobs import Paths, load_macro, load_market
from cadence.sources.payloads import parse_macro_payload, parse_market_payload


def _series_from_path(key: str):
    return F.regexp_extract(F.input_file_name(), f"{key}=([^/]+)", 1)


def _landed_files(spark: SparkSession, landing: str, key: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.option("wholetext", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(landing).select(
        _series_from_path(key).alias(key), F.col("value").alias("payload"),
        F.unix_millis("_metadata.file_modification_time").alias("fetched"))


def start_macro_stream(spark: SparkSession, landing: str, paths: Paths, checkpoint: str,
                       available_now: bool = True, max_files: int | None = None
                       ) -> StreamingQuery:
    """Stream landed macro documents (``indicator=<name>/*.json``) into the
    macro table."""
    def each(batch: DataFrame, batch_id: int):
        if batch.isEmpty():
            return
        load_macro(batch.sparkSession, parse_macro_payload(batch, fetched="fetched"), paths,
                   dag_id="stream_macro", task_id=f"batch_{batch_id}")

    w = _landed_files(spark, landing, "indicator", max_files).writeStream.foreachBatch(each)
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_market_stream(spark: SparkSession, landing: str, paths: Paths, checkpoint: str,
                        available_now: bool = True, max_files: int | None = None
                        ) -> StreamingQuery:
    """Stream landed market documents (``coin_id=<asset>/*.json``) into the
    market table (daily reduction, transform, validation, merge)."""
    def each(batch: DataFrame, batch_id: int):
        if batch.isEmpty():
            return
        daily = parse_market_payload(batch, fetched="fetched")
        load_market(batch.sparkSession, daily, paths,
                    dag_id="stream_market", task_id=f"batch_{batch_id}")

    w = _landed_files(spark, landing, "coin_id", max_files).writeStream.foreachBatch(each)
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
