"""Stored tables: layout, collapsed reads, rebuilding a day, retention, moving to another layout."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EVENT_KEY = ["bucket", "runner_ip", "ts_ms", "event_id"]
#: Days that each table is kept.
RETENTION = {"events": 30, "suspicious_events": 90, "rejected_events": 30, "data_quality": 180, "daily_summary": 400, "event_reviews": 365, "training_labels": 90, "models": 365}


def bucket(ts_ms: Column) -> Column:
    """The ten-minute bucket of a time, in epoch milliseconds."""
    return F.floor(ts_ms / 600_000) * 600_000


def with_layout(df: DataFrame) -> DataFrame:
    return df.withColumns({"bucket": bucket(F.col("ts_ms")), "event_date": F.to_date(F.timestamp_millis("ts_ms"))})


def write_events(df: DataFrame, path: str, files_a_day: int = 8, mode: str = "append", tasks: int | None = None) -> None:
    """Days as partitions, rows sorted by (bucket, runner, time, id) within files, a bloom filter on the id.

    Rows of a day are dealt to a few files by runner, so a day is no single task. tasks: how many write; None: Spark's choice.
    """
    out = with_layout(df)
    by = ["event_date", F.pmod(F.xxhash64("runner_ip"), F.lit(files_a_day))]
    out = out.repartition(*by if tasks is None else [tasks, *by]).sortWithinPartitions("event_date", *EVENT_KEY)
    writer = out.write.mode(mode).partitionBy("event_date").option("parquet.bloom.filter.enabled#event_id", "true")
    writer.parquet(path)


def overwrite_day(df: DataFrame, path: str, by: str = "day") -> None:
    """Replace only the days that df holds; running it again gives the same table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def final_rows(df: DataFrame, key: list[str], version: list[str]) -> DataFrame:
    """One row of each key, the newest version: what a replacing table reads as."""
    order = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in version])
    return df.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def copies_of_day(df: DataFrame, day: str | Column, key: list[str]) -> DataFrame:
    """One row: how many rows of a day a collapsed read would leave out."""
    on = df.filter(F.to_date(F.timestamp_millis("ts_ms")) == day)
    per = on.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("copies"))


def merge_copies(spark: SparkSession, path: str, day: str, key: list[str], version: list[str]) -> int:
    """Rewrite one day of an event table without its copies, if it has any; how many there were."""
    stored = spark.read.parquet(path).filter(F.col("event_date") == F.lit(day).cast("date"))
    found = copies_of_day(stored, F.lit(day).cast("date"), key).first()["copies"]
    if found:
        merged = f"{path.rstrip('/')}__merging"
        final_rows(stored, key, version).write.mode("overwrite").partitionBy("event_date").parquet(merged)
        overwrite_day(spark.read.parquet(merged), path, "event_date")
    return int(found)


def keep(df: DataFrame, days: int, today: Column, column: str = "ts_ms") -> DataFrame:
    """The rows that a retention of so many days keeps."""
    return df.filter(F.to_date(F.timestamp_millis(column)) >= F.date_sub(today, days))


def files_a_day(rows: int, days: int, rows_a_file: int = 1_000_000) -> int:
    """How many files a day of a table should be, so that each holds about so many rows."""
    return max(1, -(-rows // (max(days, 1) * rows_a_file)))


def sized_files(stored: DataFrame, rows_a_file: int = 1_000_000) -> int:
    """files_a_day() of a stored table, from one pass over its times."""
    seen = stored.agg(F.count(F.lit(1)).alias("n"), F.min("ts_ms").alias("a"), F.max("ts_ms").alias("b")).first()
    return files_a_day(seen["n"], 1 + ((seen["b"] or 0) - (seen["a"] or 0)) // 86_400_000, rows_a_file)


def relayout(spark: SparkSession, source: str, target: str, columns: list[str]) -> tuple[int, int]:
    """Copy a table to the event layout by column name; (rows before, rows after), equal if nothing was lost."""
    before = spark.read.parquet(source)
    write_events(before.select(*columns), target, sized_files(before), mode="overwrite")
    return before.count(), spark.read.parquet(target).count()


def reconcile(before: DataFrame, after: DataFrame, by: Column) -> DataFrame:
    """(part, rows_before, rows_after, equal) for each part of either."""
    count = lambda df, name: df.groupBy(by.alias("part")).agg(F.count(F.lit(1)).alias(name))
    both = count(before, "rows_before").join(count(after, "rows_after"), "part", "full")
    both = both.select("part", F.coalesce("rows_before", F.lit(0)).alias("rows_before"), F.coalesce("rows_after", F.lit(0)).alias("rows_after"))
    return both.withColumn("equal", F.col("rows_before") == F.col("rows_after"))


def incremental(df: DataFrame, since_ms: int | Column, upto_ms: int | Column, lookback_ms: int = 7_200_000) -> DataFrame:
    """Rows stored in (since, upto]; the bound on the event time lets partitions be pruned."""
    stored, at = F.col("ingested_ms"), F.col("ts_ms")
    return df.filter((stored > since_ms) & (stored <= upto_ms) & (at > since_ms - lookback_ms))


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


class Pointer:
    """Where a table is now: a row for each switch, the newest one counts. A row is one file, so a reader sees it whole or not.

    Old locations stay, so readers that began before a switch end on what they began with, and a switch can be taken back.
    One writer at a time.
    """

    ROW = "version long, current string, previous string, first_day date"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def create(self, location: str) -> None:
        self._say(1, location, None, None)

    def _say(self, version: int, current: str, previous: str | None, first_day: dt.date | None) -> None:
        self.spark.createDataFrame([(version, current, previous, first_day)], self.ROW).coalesce(1).write.mode("append").parquet(self.path)

    def now(self):
        """The row that counts."""
        return self.spark.read.schema(self.ROW).parquet(self.path).orderBy(F.desc("version")).first()

    def switch(self, location: str) -> None:
        at = self.now()
        self._say(at["version"] + 1, location, at["current"], at["first_day"])

    def rollback(self) -> None:
        """Back to where the table was before the last switch."""
        at = self.now()
        if at["previous"] is None:
            raise ValueError("the table was never switched")
        self._say(at["version"] + 1, at["previous"], at["current"], at["first_day"])

    def read(self) -> DataFrame:
        """The table of this moment; days before the first one kept are pruned, whether their files are gone or not."""
        at = self.now()
        rows = self.spark.read.parquet(at["current"])
        return rows if at["first_day"] is None else rows.filter(F.col("event_date") >= F.lit(at["first_day"]))

    def relayout(self, target: str, columns: list[str]) -> DataFrame:
        """Copy the table to target in the event layout, compare both hour by hour, and switch if they agree.

        The comparison comes back; where an hour differs the table stays where it was.
        """
        before = self.read()
        write_events(before.select(*columns), target, sized_files(before), mode="overwrite")
        told = reconcile(before, self.spark.read.parquet(target), F.floor(F.col("ts_ms") / 3_600_000) * 3_600_000)
        if told.filter("not equal").isEmpty():
            self.switch(target)
        return told

    def drop_before(self, first_day: dt.date) -> list[str]:
        """Retention: no reader sees days before first_day from now on, then their partitions go; the paths that went."""
        at = self.now()
        self._say(at["version"] + 1, at["current"], at["previous"], max(first_day, at["first_day"] or first_day))
        jvm, gone = self.spark._jvm, []
        root = jvm.org.apache.hadoop.fs.Path(at["current"])
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for one in fs.listStatus(root):
            name = one.getPath().getName()
            if one.isDirectory() and name.startswith("event_date=") and name.removeprefix("event_date=") < first_day.isoformat():
                fs.delete(one.getPath(), True)
                gone.append(one.getPath().toString())
        return sorted(gone)


class Progress:
    """Results of a table read further and further, with the mark up to which it is read.

    A step writes its results to a folder of its own, then appends one row, a single file: (step, from, upto, folder). Only
    this row makes the results count, and the next step begins where it ends. A step that died before it left a folder that
    nobody reads, and is done again whole: nothing counts twice or is left out.
    """

    ROW = "step long, from_ms long, upto_ms long, folder string"

    def __init__(self, spark: SparkSession, path: str, first_ms: int = -(1 << 62)):
        self.spark, self.path, self.first_ms = spark, path.rstrip("/"), first_ms
        if not self._there():
            spark.createDataFrame([], self.ROW).coalesce(1).write.mode("ignore").parquet(f"{self.path}/marks")

    def _there(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/marks/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _marks(self) -> DataFrame:
        return self.spark.read.schema(self.ROW).parquet(f"{self.path}/marks")

    def mark(self) -> int:
        last = self._marks().orderBy(F.desc("step")).first()
        return self.first_ms if last is None else last["upto_ms"]

    def step(self, upto_ms: int, result) -> bool:
        """result(from_ms, upto_ms), a frame of what was stored in (from, upto], becomes part of the results; False if nothing is new."""
        last = self._marks().orderBy(F.desc("step")).first()
        since, number = (self.first_ms, 1) if last is None else (last["upto_ms"], last["step"] + 1)
        if upto_ms <= since:
            return False
        folder = f"{self.path}/step={number}-{uuid.uuid4().hex}"
        result(since, upto_ms).write.parquet(folder)
        self._commit(number, since, upto_ms, folder)
        return True

    def _commit(self, number: int, since: int, upto_ms: int, folder: str) -> None:
        self.spark.createDataFrame([(number, since, upto_ms, folder)], self.ROW).coalesce(1).write.mode("append").parquet(f"{self.path}/marks")

    def results(self) -> DataFrame | None:
        """What all finished steps have given; None before the first."""
        folders = [r["folder"] for r in self._marks().select("folder").toLocalIterator()]  # a row for each step
        return self.spark.read.parquet(*folders) if folders else None
