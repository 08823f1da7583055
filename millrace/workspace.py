"""The folder that driver and executors share, and tables derived once from an input."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the context's checkpoint folder; a new temporary folder only where the master is local."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="millrace-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Compute df once and cut its lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let go of shuffle files and checkpoints that nothing refers to any more: Spark removes them once the driver collects its garbage."""
    spark.sparkContext._jvm.System.gc()


def spread(df: DataFrame) -> DataFrame:
    """df as it is, or dealt to all cores where its scan makes fewer tasks than there are (a few small files)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


#: Rows of an event table that one task sorts at a time: some 200 MB of whole rows.
ROWS_A_TASK = 100_000


def tasks_for(spark: SparkSession, rows: int, rows_a_task: int = ROWS_A_TASK) -> int:
    """How many tasks share so many rows, one a core at least: what a task holds doesn't grow with the table."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_a_task))


def small_methods(spark: SparkSession) -> None:
    """Generated methods too large for the JVM to compile are left out for smaller ones.

    HotSpot interprets methods of more than 8,000 bytes for ever; one stage over all columns of an event makes such methods.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


_DERIVED: dict[tuple, str] = {}


def derived(spark: SparkSession, source: str, name: str, write: Callable[[str], None]) -> DataFrame:
    """The table `name` derived from the Parquet files at source: written on the first call, read again by later ones.

    It is written anew where the files have changed and in every application; write(path) writes it below shared_dir().
    """
    # the name, time and size of every file: one row of the format's metadata a file, no column is read
    state = spark.read.parquet(source).select("_metadata.file_path", "_metadata.file_modification_time", "_metadata.file_size").groupBy("file_path", "file_modification_time", "file_size").agg(F.count(F.lit(1)).alias("rows"))
    hashed = F.xxhash64("file_path", "file_modification_time", "file_size", "rows").cast("decimal(20,0)")
    stamp = tuple(state.agg(F.sum(hashed).cast("string"), F.count(F.lit(1)), F.sum("rows")).first())
    key = (spark.sparkContext.applicationId, source, name, stamp)
    if key not in _DERIVED:
        path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        write(path)
        _DERIVED[key] = path
    return spark.read.parquet(_DERIVED[key])
