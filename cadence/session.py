"""SparkSession defaults the engine relies on.

* ``spark.sql.session.timeZone=UTC`` -- the daily boundary of epoch-ms
  points is UTC.
* ANSI mode on -- malformed numbers/dates and numeric overflow raise instead
  of silently becoming NULL (fail-fast parsing).
* AQE on -- runtime coalescing of shuffle partitions, skew-join splitting and
  broadcast conversion from real map-output sizes.
* ``spark.checkpoint.dir`` -- lineage is cut with reliable checkpoints in the
  shared folder the cluster names.  We only fill it in when it is unset
  (local runs/tests); a cluster's value is always respected.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "cadence",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults and ``extra``
    settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL defaults to an existing session."""
    for key, value in SESSION_DEFAULTS.items():
        try:
            spark.conf.set(key, value)
        except Exception:  # static / locked confs on a shared session
            pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the cluster's ``spark.checkpoint.dir``
    (or the directory already set on the SparkContext).  Where neither is
    set, a ``local`` master gets a folder below the system's temporary one
    and any other master an error: executors could not share a local folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: the server owns the checkpoint folder
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the remote session")
        return configured
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = os.path.join(tempfile.gettempdir(), "cadence-checkpoints")
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()
