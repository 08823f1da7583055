"""Stored tables: what a read skips, the pointer that a reader follows, marks that survive a kill."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.operators import investigate
from millrace.sources import tables

DAY = 86_400_000


def events(spark, days=6, each=300):
    rows = [(f"e{d:02d}-{i:05d}", f"10.0.0.{i % 17}", d * DAY + i * 200_000, d * DAY + i * 200_000 + 50 + i % 7, "ok") for d in range(days) for i in range(each)]
    return spark.createDataFrame(rows, "event_id string, runner_ip string, ts_ms long, ingested_ms long, recommended_action string")


def scanned(df):
    """(rows, files read, plan) of a frame with one scan."""
    n = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return n, int(leaves.head().metrics().apply("numFiles").value()), plan.toString()


def test_reads_of_a_moment_skip_other_days(spark, tmp_path):
    path = str(tmp_path / "events")
    tables.write_events(events(spark), path, 2)
    stored = spark.read.parquet(path)
    rows, files, plan = scanned(investigate.runner_window(stored, "10.0.0.3", 2 * DAY + 1_000_000, 900_000).select("event_id", "ts_ms"))
    assert 0 < len(rows) < 5 and files <= 2
    assert "event_date" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    pushed = plan.split("PushedFilters: ")[1]
    assert "EqualTo(runner_ip,10.0.0.3)" in pushed and "GreaterThanOrEqual(ts_ms," in pushed and "ReadSchema: struct<event_id:string,runner_ip:string,ts_ms:bigint>" in plan
    rows, files, plan = scanned(investigate.event_by_id(stored, "e03-00042").select("event_id"))
    assert len(rows) == 1 and "EqualTo(event_id,e03-00042)" in plan
    rows, files, plan = scanned(investigate.within_last(stored, 600_000).select("event_id"))
    assert len(rows) == 3 and files <= 2 and "event_date" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert investigate.within_last(stored.limit(0), 1000).count() == 0


def test_the_pointer_switches_whole(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    events(spark).write.parquet(old)
    table = tables.Pointer(spark, str(tmp_path / "pointer"))
    table.create(old)
    reader = table.read()  # began before the switch
    told = table.relayout(new, ["event_id", "runner_ip", "ts_ms", "ingested_ms"])
    assert told.filter("not equal").isEmpty() and table.now()["current"] == new
    assert reader.count() == table.read().count() == 1800 and "recommended_action" in reader.columns and "event_date" in table.read().columns
    table.rollback()
    assert table.now()["current"] == old and table.read().count() == 1800
    table.rollback()
    gone = table.drop_before(dt.date(1970, 1, 4))
    assert [p.rsplit("/", 1)[1] for p in gone] == ["event_date=1970-01-01", "event_date=1970-01-02", "event_date=1970-01-03"]
    assert spark.read.parquet(new).count() == table.read().count() == 900 and spark.read.parquet(old).count() == 1800
    with pytest.raises(ValueError):
        fresh = tables.Pointer(spark, str(tmp_path / "other"))
        fresh.create(old)
        fresh.rollback()


def test_no_switch_where_an_hour_differs(spark, tmp_path, monkeypatch):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    events(spark).write.parquet(old)
    table = tables.Pointer(spark, str(tmp_path / "pointer"))
    table.create(old)
    written = tables.write_events
    monkeypatch.setattr(tables, "write_events", lambda df, *a, **k: written(df.filter("event_id <> 'e02-00007'"), *a, **k))
    told = table.relayout(new, ["event_id", "runner_ip", "ts_ms", "ingested_ms"])
    assert told.filter("not equal").count() == 1 and table.now()["current"] == old


def test_marks_survive_a_kill(spark, tmp_path, monkeypatch):
    """Killed between the result and the mark: the step is done again, and nothing counts twice or is left out."""
    stored = events(spark)
    count = lambda since, upto: tables.incremental(stored, since, upto).groupBy(F.lit("n").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    read = tables.Progress(spark, str(tmp_path / "marks"))
    assert read.results() is None and read.step(DAY, count)
    told = lambda r: sum(x["n"] for x in r.results().collect())
    first = told(read)
    monkeypatch.setattr(tables.Progress, "_commit", lambda *a: (_ for _ in ()).throw(SystemExit("killed")))
    with pytest.raises(SystemExit):
        read.step(3 * DAY, count)
    monkeypatch.undo()
    again = tables.Progress(spark, str(tmp_path / "marks"))  # another process
    assert again.mark() == DAY and told(again) == first
    assert again.step(3 * DAY, count) and not again.step(3 * DAY, count) and again.step(99 * DAY, count)
    assert told(again) == stored.count() and again.mark() == 99 * DAY


def test_files_follow_the_rows(spark, tmp_path):
    assert [tables.files_a_day(n, 30) for n in (0, 10**6, 3 * 10**7, 3 * 10**7 + 1, 10**12)] == [1, 1, 1, 2, 33_334]
    assert tables.sized_files(events(spark)) == 1 and tables.sized_files(events(spark).limit(0)) == 1
