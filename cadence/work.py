"""Work tables: a frame written once, so that every later reader sees the
same rows.

A plan that is evaluated twice need not give the same row numbers, range
bounds or partition ids twice: they follow how files are packed into splits,
what a range sample saw and which executors are alive.  Whatever is joined
with such numbers must therefore be stored first and read from there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from cadence.session import checkpoint_dir


def work_table(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the cluster's shared folder
    (``spark.checkpoint.dir``) and read back; lineage ends there."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/work-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
