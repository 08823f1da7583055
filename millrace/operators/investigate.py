"""Questions an engineer asks of the stored decisions. "Last" counts back from the newest row, so answers repeat."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.rollups import day


def newest_ms(events: DataFrame, column: str = "ts_ms") -> int | None:
    """The newest value, as a number of the driver: filters on it reach the scan. In the event layout one day is read for it."""
    if column == "ts_ms" and "event_date" in events.columns:
        day = events.agg(F.max("event_date")).first()[0]
        events = events.filter(F.col("event_date") == F.lit(day)) if day is not None else events
    return events.agg(F.max(column)).first()[0]


def date_of(ms: int) -> Column:
    return F.lit((dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms)).date())


def within_last(events: DataFrame, ms: int, column: str = "ts_ms") -> DataFrame:
    """The rows of the last ms before the newest; days before are not read where the table has them as partitions."""
    newest = newest_ms(events, column)
    if newest is None:
        return events.limit(0)
    recent = events.filter(F.col(column) > newest - ms)
    return recent.filter(F.col("event_date") >= date_of(newest - ms)) if column == "ts_ms" and "event_date" in events.columns else recent


def event_by_id(events: DataFrame, event_id: str) -> DataFrame:
    return events.filter(F.col("event_id") == event_id)


def runner_window(events: DataFrame, runner: str, at_ms: int, around_ms: int = 900_000) -> DataFrame:
    """A runner's events around a moment. Bounds are numbers, so partitions of other days are not read, nor row groups without the runner."""
    near = events.filter((F.col("runner_ip") == runner) & F.col("ts_ms").between(at_ms - around_ms, at_ms + around_ms))
    return near.filter(F.col("event_date").between(date_of(at_ms - around_ms), date_of(at_ms + around_ms))) if "event_date" in events.columns else near


def runner_history(events: DataFrame, runner: str) -> DataFrame:
    """A runner's days: events by action, and the rules' strongest score."""
    own = events.filter(F.col("runner_ip") == runner)
    return own.groupBy(day().alias("day"), "recommended_action").agg(F.count(F.lit(1)).alias("events"), F.max("rule_score").alias("strongest"))


def model_alerts(events: DataFrame, last_ms: int = 600_000) -> DataFrame:
    return within_last(events, last_ms).filter("ml_reason <> '' and recommended_action = 'alert'")


def top_quarantined(events: DataFrame, last_ms: int = 3_600_000, top: int = 10) -> DataFrame:
    recent = within_last(events, last_ms).filter("recommended_action = 'quarantine'")
    return recent.groupBy("runner_ip").agg(F.count(F.lit(1)).alias("events"), F.max("final_anomaly_score").alias("strongest")).orderBy(F.desc("events"), "runner_ip").limit(top)


def recent_decisions(events: DataFrame, last_ms: int = 900_000) -> DataFrame:
    return within_last(events, last_ms).select("event_id", "recommended_action", "rule_hits", "runner_ip", "ts_ms")


def work_queue(events: DataFrame, top: int = 20) -> DataFrame:
    """Runners to look at first: quarantined, then alerted, then the newest."""
    per = events.filter("recommended_action <> 'ok'").groupBy("runner_ip").agg(
        F.count_if(F.col("recommended_action") == "quarantine").alias("quarantined"), F.count_if(F.col("recommended_action") == "alert").alias("alerted"), F.max("ts_ms").alias("last_ms")
    )
    return per.orderBy(F.desc("quarantined"), F.desc("alerted"), F.desc("last_ms"), "runner_ip").limit(top)


def rejected_messages(rejects: DataFrame, column: str = "raw_value") -> DataFrame:
    """Refused messages with their bytes as text."""
    return rejects.withColumn("message", F.decode(F.unbase64(column), "UTF-8"))


def stored_last(events: DataFrame, ms: int = 60_000) -> DataFrame:
    return within_last(events, ms, "ingested_ms").agg(F.count(F.lit(1)).alias("events"))


def morning_list(events: DataFrame, last_ms: int = 86_400_000) -> DataFrame:
    """Per runner flagged in the last day: what fired, and when first and last."""
    flagged = within_last(events, last_ms).filter("recommended_action <> 'ok'")
    return flagged.groupBy("runner_ip").agg(F.count(F.lit(1)).alias("events"), F.max("final_anomaly_score").alias("strongest"), F.min("ts_ms").alias("first_ms"), F.max("ts_ms").alias("last_ms"))


def detection_history(reports: DataFrame, last: int = 20) -> DataFrame:
    """The newest evaluations: what was caught, how fast, and who was quarantined without cause."""
    told = lambda name, kind: F.get_json_object("report", f"$.{name}").cast(kind).alias(name)
    rows = reports.orderBy(F.desc("evaluated_ms")).limit(last)
    return rows.select("evaluated_ms", told("incidents_seen", "long"), told("incidents_caught", "long"), told("median_time_to_flag_s", "double"), told("normal_quarantined_uninvolved", "long"), "passed", "failures")


def ask(spark, text: str, tables: dict[str, DataFrame], **values) -> DataFrame:
    """A stored question with named parameters (:name) over tables, which are bound by {name}."""
    return spark.sql(text, args=values, **tables)
