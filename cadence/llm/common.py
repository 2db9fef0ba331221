"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.session import checkpoint_dir

# ASCII white space: the separators of the word definition [^\x20\x09-\x0D]+
SPACES = " \t\n\x0b\x0c\r"
BLOCK = 64              # values of a block of running sums
MAX_FILES = 200_000     # numbers of a table's files are broadcast up to this many
SHUFFLES_REMOVED = [f"spark.sql.{kind}.shuffleDependency.fileCleanup.enabled"
                    for kind in ("classic", "connect")]
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def ship(module: str) -> None:
    """Send the functions of ``module`` to the executors by value, so tasks
    need no installed copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_path(spark: SparkSession) -> str:
    """A new table's path in the cluster's shared folder
    (``spark.checkpoint.dir``), inside a ``scratch`` in that one's."""
    base = _SCRATCH.get() or checkpoint_dir(spark).rstrip("/")
    return f"{base}/work-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialise`` names itself inside are removed at the end;
    what is still read then needs a path from before.  (A remote session
    cannot reach the file system: its tables stay.)"""
    path = work_path(spark)
    token = _SCRATCH.set(path)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        if hasattr(spark, "_jsc"):
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, path: str | None = None, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet into the cluster's shared folder
    (``spark.checkpoint.dir``) and read it back: lineage is cut by a table
    that outlives any executor."""
    spark = df.sparkSession
    path = path or work_path(spark)
    with _shuffles_removed(spark):
        df.write.mode("overwrite").option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files (Spark 4.1 or later), which else
    stay until the driver collects its garbage."""
    kept = {key: spark.conf.get(key, None) for key in SHUFFLES_REMOVED}
    try:
        for key in kept:
            spark.conf.set(key, "true")
        yield
    finally:
        for key, value in kept.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def distilled(spark: SparkSession, make: Callable[[], DataFrame], codec: str = "snappy"
              ) -> DataFrame:
    """``materialise(make())`` without the work tables it took."""
    path = work_path(spark)
    with scratch(spark):
        return materialise(make(), path, codec)


def with_row_id(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with ``name``, an id of every row that each scan gives again:
    the number of its Parquet file, by path, and its place there.  (Running
    numbers of a scan follow how files are packed into splits, so they change
    with the cores alive.)  What is no plain scan of Parquet files is stored
    once with running numbers, and the stored table returned."""
    path, at = "_metadata.file_path", "_metadata.row_index"
    file, = fresh(docs, "file_path")
    try:
        placed = docs.withColumns({file: F.col(path), name: F.col(at)})
    except AnalysisException:
        return materialise(docs.withColumn(name, F.struct(
            F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("row"))))
    files = placed.select(file).distinct()
    files = materialise(files.select(                            # one row per file
        file, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(file)).cast("long")
        .alias("_n")))
    numbered = placed.join(maybe_broadcast(files, files.count(), MAX_FILES), file)
    return numbered.select(*(col(c) for c in docs.columns),
                           F.struct(F.col("_n").alias("file"), col(name).alias("row")).alias(name))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names starting with ``names`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def maybe_broadcast(df: DataFrame, rows: int, max_rows: int) -> DataFrame:
    """Broadcast a side whose counted rows prove a bound; otherwise leave it
    to a shuffle join (same result)."""
    return F.broadcast(df) if rows <= max_rows else df


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; NULL has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(values: Column, levels: int = 2) -> Column:
    """The sum of the values before each one, of an array of ints; appended to
    blocks only, so that long arrays are not copied per value."""
    none = F.array().cast("array<int>")

    def short(block: Column) -> Column:
        return F.aggregate(
            block, F.struct(F.lit(0).alias("at"), none.alias("sums")),
            lambda acc, x: F.struct((acc["at"] + x).alias("at"),
                                    F.concat(acc["sums"], F.array(acc["at"])).alias("sums")),
            lambda acc: acc["sums"])

    def blocked(array: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.size(array) - 1, F.lit(BLOCK)),
                             lambda at: F.slice(array, at + 1, F.lit(BLOCK)))
        return let(blocks, lambda bs: F.flatten(F.zip_with(
            bs, running_sums(F.transform(bs, lambda b: F.aggregate(
                b, F.lit(0), lambda x, y: x + y)), levels - 1),
            lambda b, start: F.transform(short(b), lambda x: x + start))))

    if not levels:
        return short(values)
    return let(values, lambda array: F.when(F.size(array) <= BLOCK, short(array)).otherwise(
        blocked(array)))
