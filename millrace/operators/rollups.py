"""Daily and hourly rollups, histograms and quantiles of stored decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Histogram bounds.
LATENCY_BOUNDS = [25, 50, 100, 150, 200, 250, 300, 400, 500, 750, 1000, 1500, 2000, 3000, 5000, 10_000, 30_000, 60_000]
SCORE_BOUNDS = [round(0.05 * i, 2) for i in range(1, 21)]
FLAG_BOUNDS = [0.25, 0.5, 1, 2, 5, 10, 30, 60]
TOP_SOURCES = 50


def n_if(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def action(name: str) -> Column:
    return F.col("recommended_action") == name


def day(ts_ms: str = "ts_ms") -> Column:
    return F.to_date(F.timestamp_millis(ts_ms))


def daily_summary(events: DataFrame) -> DataFrame:
    """Events, distinct runners and suspicious events by day, type and action."""
    return events.groupBy(day().alias("day"), "event_type", "recommended_action").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("runner_ip").alias("runners"), n_if(F.col("is_suspicious") == 1, "suspicious")
    )


def daily_rule_hits(events: DataFrame) -> DataFrame:
    hits = events.filter("rule_hits <> ''").select(day().alias("day"), F.explode(F.split("rule_hits", ",")).alias("rule"), "recommended_action", "runner_ip")
    return hits.groupBy("day", "rule", "recommended_action").agg(F.count(F.lit(1)).alias("events"), F.countDistinct("runner_ip").alias("runners"))


def daily_top_sources(events: DataFrame, top: int = TOP_SOURCES) -> DataFrame:
    """Of each day the runners with most quarantines, then alerts, with the rules that fired."""
    base = events.select(day().alias("day"), "runner_ip", "recommended_action", "ts_ms", "rule_hits")
    per = base.groupBy("day", "runner_ip").agg(
        F.count(F.lit(1)).alias("events"), n_if(action("quarantine"), "quarantined"), n_if(action("alert"), "alerted"),
        F.min("ts_ms").alias("first_seen_ms"), F.max("ts_ms").alias("last_seen_ms"), F.collect_set("rule_hits").alias("_hits"),
    )
    rules = F.array_sort(F.array_remove(F.array_distinct(F.flatten(F.transform("_hits", lambda h: F.split(h, ",")))), ""))
    per = per.filter(F.col("quarantined") + F.col("alerted") > 0).withColumn("rules", rules).drop("_hits")
    order = Window.partitionBy("day").orderBy(F.desc("quarantined"), F.desc("alerted"), "runner_ip")
    return per.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= top).drop("_n")


def daily_reconcile(events: DataFrame) -> DataFrame:
    """(day, summarized, stored, equal)."""
    told = daily_summary(events).groupBy("day").agg(F.sum("events").alias("summarized"))
    stored = events.groupBy(day().alias("day")).agg(F.count(F.lit(1)).alias("stored"))
    return told.join(stored, "day", "full").withColumn("equal", F.col("summarized").eqNullSafe(F.col("stored")))


def days_closed(events: DataFrame, now_ms: Column, margin_ms: int = 120_000, anyway_ms: int = 3_600_000) -> DataFrame:
    """(day, closed): an event came after the day's end and the margin, within the hour, or now is an hour past the end."""
    days = events.select(day().alias("day"), "ts_ms")
    ends = days.select("day").distinct().withColumn("end_ms", F.unix_millis(F.date_add("day", 1).cast("timestamp")))
    after = days.select((F.floor(F.col("ts_ms") / 86_400_000) * 86_400_000).alias("end_ms"), (F.col("ts_ms") % 86_400_000).alias("into"))
    after = after.filter((F.col("into") >= margin_ms) & (F.col("into") < margin_ms + anyway_ms)).select("end_ms").distinct().withColumn("_seen", F.lit(True))
    out = ends.join(after, "end_ms", "left")
    return out.select("day", (F.coalesce("_seen", F.lit(False)) | (now_ms >= F.col("end_ms") + anyway_ms)).alias("closed"))


def hour(ts_ms: str = "ts_ms") -> Column:
    return F.floor(F.col(ts_ms) / 3_600_000) * 3_600_000


def ml_decisions_hourly(events: DataFrame, digits: int = 4) -> DataFrame:
    raised = F.col("ml_reason") != ""
    return events.groupBy(hour().alias("hour_ms"), "ml_model").agg(
        F.count(F.lit(1)).alias("events"), n_if(raised, "raised_by_model"), n_if(raised & action("alert"), "model_alerts"),
        F.round(F.avg("ml_score"), digits).alias("avg_ml_score"), F.round(F.percentile("ml_score", 0.99), digits).alias("p99_ml_score"),
        n_if(action("quarantine"), "quarantined"), n_if(action("alert"), "alerted"),
    )


def ml_model_review(reviews: DataFrame, sure: float = 0.8) -> DataFrame:
    why, normal, confident = F.col("why_selected"), F.col("verdict") == "normal", F.col("confidence") >= sure
    passed = F.col("pipeline_action") == "ok"
    return reviews.groupBy("ml_model", hour("reviewed_ms").alias("hour_ms")).agg(
        F.count(F.lit(1)).alias("reviewed"), n_if(why == "model_alert", "model_alerts_reviewed"),
        n_if((why == "model_alert") & normal & confident, "false_alarms"), n_if(passed, "passed_reviewed"),
        n_if(passed & ~normal & confident, "missed_incidents"), n_if(why == "random", "random_reviewed"),
        n_if((why == "random") & ~normal & confident, "random_missed"),
    )


def decided_by() -> Column:
    return F.when(F.col("ml_reason") != "", "model").when(F.col("rule_hits") != "", "rules").otherwise("none")


def histogram(df: DataFrame, value: Column, bounds: list, keys: list[str], where: Column | None = None) -> DataFrame:
    """(keys, le, events): how many values are at most each bound, per key; cumulative. One map-side aggregate, then a row for each bound."""
    ok = F.lit(True) if where is None else where
    per = df.groupBy(*keys).agg(*[F.count_if(ok & (value <= b)).alias(f"_{i}") for i, b in enumerate(bounds)])
    listed = F.array(*[F.struct(F.lit(float(b)).alias("le"), F.col(f"_{i}").alias("events")) for i, b in enumerate(bounds)])
    return per.select(*keys, F.inline(listed))


def latency(events: DataFrame) -> Column:
    return F.greatest(F.col("ingested_ms") - F.col("ts_ms"), F.lit(0))


def latency_histogram(events: DataFrame) -> DataFrame:
    keyed = events.withColumn("decided_by", decided_by())
    return histogram(keyed, F.col("ingested_ms") - F.col("ts_ms"), LATENCY_BOUNDS, ["recommended_action", "ml_model", "decided_by"])


def score_histogram(events: DataFrame) -> DataFrame:
    keyed = events.withColumn("decided_by", decided_by())
    return histogram(keyed, F.col("ml_score"), SCORE_BOUNDS, ["recommended_action", "ml_model", "decided_by"], F.col("ml_model") != "")


def latency_quantiles(events: DataFrame, last_ms: int = 60_000) -> DataFrame:
    """Exact quantiles of the rows stored last, and the age of the newest at its own time: anchored on the newest row."""
    newest = events.agg(F.max("ingested_ms").alias("newest"))
    recent = events.crossJoin(F.broadcast(newest)).filter(F.col("ingested_ms") > F.col("newest") - last_ms)
    value = F.col("ingested_ms") - F.col("ts_ms")
    q = recent.agg(F.count(F.lit(1)).alias("events"), F.percentile(value, F.array(*map(F.lit, (0.5, 0.95, 0.99)))).alias("q"), F.max(value).alias("max_ms"))
    return q.select("events", F.get("q", 0).alias("p50"), F.get("q", 1).alias("p95"), F.get("q", 2).alias("p99"), "max_ms")


#: Size of a score sketch: ranks are off by 0.4 % of the rows or less, 99 times of 100.
SKETCH_K = 800


def score_sketches(events: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """(start_ms, ml_model, events, scores) by hour: a mergeable quantile sketch of bounded size in place of every score."""
    return events.groupBy(hour().alias("start_ms"), "ml_model").agg(F.count("ml_score").alias("events"), F.kll_sketch_agg_double("ml_score", k).alias("scores"))


def merge_sketches(sketches: DataFrame, width_ms: int = 86_400_000, k: int = SKETCH_K) -> DataFrame:
    """Stored sketches merged upward: hours to days, days to weeks. No row of the events is read again."""
    start = (F.floor(F.col("start_ms") / width_ms) * width_ms).alias("start_ms")
    return sketches.groupBy(start, "ml_model").agg(F.sum("events").alias("events"), F.kll_merge_agg_double("scores", k).alias("scores"))


def sketch_quantiles(sketches: DataFrame, quantiles: tuple = (0.5, 0.95, 0.99)) -> DataFrame:
    """sketches with p50, p95 and so on in place of the sketch: the least score whose rank reaches the quantile, nearly."""
    at = [F.kll_sketch_get_quantile_double("scores", F.lit(float(q))).alias(f"p{int(q * 100)}") for q in quantiles]
    return sketches.select("start_ms", "ml_model", "events", *at)


def nearest_rank(df: DataFrame, value: str, order: list, keys: list[str], last: int = 2000, quantiles: tuple = (0.5, 0.95, 0.99)) -> DataFrame:
    """Quantiles as the element at min(n - 1, int(q n)) of the last samples of each key: bounded by `last`."""
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    kept = df.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= last)
    per = kept.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("_v"))
    at = lambda q: F.get("_v", F.least(F.size("_v") - 1, F.floor(F.size("_v") * q).cast("int")))
    return per.select(*keys, F.size("_v").alias("samples"), *[at(q).alias(f"p{int(q * 100)}") for q in quantiles], F.array_max("_v").alias("max"))


def tumbling(events: DataFrame, width: str = "1 hour") -> DataFrame:
    w = F.window("ts", width)
    return events.groupBy(w.alias("w"), "recommended_action").agg(F.count(F.lit(1)).alias("events")).select(F.unix_millis("w.start").alias("start_ms"), "recommended_action", "events")


def hopping(events: DataFrame, width: str, every: str) -> DataFrame:
    w = F.window("ts", width, every)
    return events.groupBy(w.alias("w"), "runner_ip").agg(F.count(F.lit(1)).alias("events"), n_if(F.col("event_type") == "BUILD_FAILURE", "failed")).select(
        F.unix_millis("w.start").alias("start_ms"), "runner_ip", "events", "failed"
    )


def failures_by_project(events: DataFrame, top: int = 30) -> DataFrame:
    """Is it the runner or the project: most failures by both."""
    per = events.filter("event_type = 'BUILD_FAILURE'").groupBy("project", "runner_ip").agg(F.count(F.lit(1)).alias("failures"), n_if(~action("ok"), "flagged"))
    return per.orderBy(F.desc("failures"), "project", "runner_ip").limit(top)


def decision_totals(events: DataFrame) -> DataFrame:
    return events.groupBy("recommended_action").agg(F.count(F.lit(1)).alias("events"), n_if(F.col("rule_hits") != "", "with_hits"))


def backlog_trend(samples: DataFrame) -> DataFrame:
    """Per topic: slope of the backlog in messages a second by least squares, and its extremes."""
    t = F.col("sampled_ms") / 1000.0
    return samples.groupBy("topic").agg(F.regr_slope("backlog", t).alias("slope"), F.min("backlog").alias("least"), F.max("backlog").alias("most"), F.count(F.lit(1)).alias("samples"))


def stream_sketches(events: DataFrame, late: str = "10 minutes", k: int = SKETCH_K) -> DataFrame:
    """score_sketches() of a stream with ts (timestamp): an hour is told once, when the watermark has passed its end."""
    w = F.window("ts", "1 hour")
    per = events.withWatermark("ts", late).groupBy(w.alias("w"), "ml_model").agg(F.count("ml_score").alias("events"), F.kll_sketch_agg_double("ml_score", k).alias("scores"))
    return per.select(F.unix_millis("w.start").alias("start_ms"), "ml_model", "events", "scores")


def stream_tumbling(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """tumbling() of a stream with ts (timestamp)."""
    return tumbling(events.withWatermark("ts", late), width)


def stream_sessions(events: DataFrame, keys: list[str], gap_ms: int, late: str = "10 minutes") -> DataFrame:
    """(keys, start_ms, end_ms, events) of a stream: a session of a key ends with a pause longer than the gap."""
    timed = events.withWatermark("ts", late)
    s = F.session_window("ts", f"{gap_ms + 1} milliseconds")  # a pause of the gap itself still belongs to it
    per = timed.groupBy(*keys, s.alias("s")).agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count(F.lit(1)).alias("events"))
    return per.select(*keys, F.unix_millis("a").alias("start_ms"), F.unix_millis("b").alias("end_ms"), "events")
