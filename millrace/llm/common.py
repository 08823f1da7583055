"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.workspace import materialize, shared_dir

__all__ = ["BROADCAST_ROWS", "WORD", "bound_batches", "bounded_broadcast", "documents", "free_name", "materialize", "set_aside", "shared_dir", "skew_join", "text_or_empty"]

#: Word characters of every size and shingle contract: all but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"

#: The most rows of a checked table that are broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 200_000


def bounded_broadcast(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has been counted at no more than limit rows, else as it is."""
    return F.broadcast(df) if rows <= limit else df


def skew_join(left: DataFrame, right: DataFrame, key: str, total: int) -> DataFrame:
    """left joined with right, one row for each key of left with n, how many of the total rows of left have it; n goes.

    Keys of more rows than a limit are joined by broadcast, so their rows stay where they are; the limit grows with the
    total, so at most BROADCAST_ROWS keys can pass it. All others are joined by a shuffle that no hot key takes part in.
    """
    limit = max(1_000, total // BROADCAST_ROWS)
    hot, rest = right.filter(F.col("n") > limit).drop("n"), right.filter(F.col("n") <= limit).drop("n")
    cold = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key)
    return cold.unionByName(left.join(F.broadcast(hot), key))


def bound_batches(spark: SparkSession, rows: int = 512) -> None:
    """Let an Arrow batch of the session hold at most so many rows: whole texts can be long, and a task holds some batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """A working column name that no column of df has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def set_aside(df: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """df with its own columns of these names out of the way, and what gives a result the columns of df again."""
    taken = {n.lower() for n in names}
    moved = {c: free_name(df, f"_own_{c}") for c in df.columns if c.lower() in taken}
    return df.withColumnsRenamed(moved), lambda out: out.select(*[F.col(f"`{moved.get(c, c)}`").alias(c) for c in df.columns])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
