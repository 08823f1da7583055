"""Data-quality issues between the stages (counted, never dropped), scheduled checks, and health of the flow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.rules import action_for
from millrace.settings import LIVE, PROJECT_TYPES, SEVERITIES, UNKNOWN_SEVERITY, Settings

# The declared issues of each step.
ISSUES = [
    ("normalize", "severity_defaulted"), ("normalize", "missing_project"), ("normalize", "missing_hostname"),
    ("enrich", "unknown_region"), ("enrich", "future_timestamp"), ("enrich", "stale_timestamp"),
    ("features", "window_inconsistent"), ("rules", "score_out_of_range"), ("rules", "action_mismatch"),
]


def issue_conditions(clock_ms: Column, settings: Settings = LIVE) -> dict[str, Column]:
    raw = F.upper(F.trim(F.coalesce("raw_severity", F.lit(""))))
    ahead = F.col("ts_ms") - clock_ms
    score = F.col("final_anomaly_score")
    out_of_range = ~score.between(0.0, 1.0)
    return {
        "severity_defaulted": ~raw.isin(SEVERITIES) & (raw != UNKNOWN_SEVERITY) & (F.col("severity") == UNKNOWN_SEVERITY),
        "missing_project": F.col("event_type").isin(PROJECT_TYPES) & (F.col("project") == ""),
        "missing_hostname": F.col("hostname") == "",
        "unknown_region": (F.col("is_internal_ip") == 0) & (F.col("region") == ""),
        "future_timestamp": ahead > settings.future_ms,
        "stale_timestamp": -ahead > settings.stale_ms,
        "window_inconsistent": (F.col("failed_builds_1m") > F.col("failed_builds_5m")) | (F.col("events_1m") < 1),
        "score_out_of_range": out_of_range,
        "action_mismatch": ~out_of_range & (F.col("recommended_action") != action_for(score, settings)),
    }


def with_issues(scored: DataFrame, clock_ms: Column, settings: Settings = LIVE) -> DataFrame:
    """Scored events with dq_issues. clock_ms: the wall clock in a stream, the append time in a batch."""
    found = issue_conditions(clock_ms, settings)
    return scored.withColumn("dq_issues", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in found.items()])))


def issue_counts(flagged: DataFrame) -> DataFrame:
    """(step, issue, events), zero for every declared issue that does not occur."""
    declared = F.array(*[F.struct(F.lit(s).alias("step"), F.lit(i).alias("issue")) for s, i in ISSUES])
    table = flagged.sparkSession.range(1).select(F.inline(declared))
    seen = flagged.select(F.explode("dq_issues").alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))
    return table.join(seen, "issue", "left").select("step", "issue", F.coalesce("n", F.lit(0)).cast("long").alias("events"))


def shares(flagged: DataFrame) -> DataFrame:
    """One row: scored, doubtful_share of normalize and enrich issues, logic_inconsistent of the other two steps."""
    step = {i: s for s, i in ISSUES}
    of = lambda *steps: F.size(F.filter("dq_issues", lambda x: x.isin([i for i, s in step.items() if s in steps])))
    return flagged.agg(
        F.count(F.lit(1)).alias("scored"),
        (F.sum(of("normalize", "enrich")) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("doubtful_share"),
        F.coalesce(F.sum(of("features", "rules")), F.lit(0)).alias("logic_inconsistent"),
    )


@dataclass(frozen=True)
class Check:
    """A scheduled check: one number of a table, an operator and a threshold."""

    name: str
    severity: str
    op: str
    threshold: float
    about: str


# Severities, operators and thresholds of the scheduled checks.
CHECKS = [
    Check("volume", "fail", ">=", 1, "events stored in the interval"),
    Check("rejected_share", "fail", "<=", 0.01, "share of messages refused"),
    Check("missing_identity", "fail", "==", 0, "events without a runner or a type"),
    Check("latency_p95_ms", "warn", "<=", 2000, "p95 from event to stored row"),
    Check("duplicate_share", "warn", "<=", 0.01, "share of copies not merged away"),
    Check("quarantine_share_vs_7d", "warn", "<=", 5.0, "quarantines as a multiple of the week's"),
    Check("ml_score_drift_psi", "warn", "<=", 0.25, "stability of the model's scores against the week"),
]


def between(df: DataFrame, start: Column, end: Column, column: str = "ts_ms") -> DataFrame:
    """Rows of [start, end) in epoch milliseconds."""
    return df.filter((F.col(column) >= start) & (F.col(column) < end))


def volume(events: DataFrame) -> DataFrame:
    return events.agg(F.count(F.lit(1)).cast("double").alias("value"))


def missing_identity(events: DataFrame) -> DataFrame:
    return events.agg(F.count_if((F.col("runner_ip") == "") | (F.col("event_type") == "")).cast("double").alias("value"))


def latency_p95(events: DataFrame) -> DataFrame:
    return events.agg(F.percentile(F.col("ingested_ms") - F.col("ts_ms"), 0.95).alias("value"))


def share(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0))


def rejected_share(rejects: DataFrame, events: DataFrame) -> DataFrame:
    """Refused messages by append time over all messages; both sides are one row."""
    r, e = rejects.agg(F.count(F.lit(1)).alias("r")), events.agg(F.count(F.lit(1)).alias("e"))
    return r.crossJoin(e).select(share(F.col("r"), F.col("r") + F.col("e")).alias("value"))


def duplicate_share(stored: DataFrame, key: list[str]) -> DataFrame:
    per = stored.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(share(F.sum("n") - F.count(F.lit(1)), F.sum("n")).alias("value"))


def quarantine_share_ratio(hour: DataFrame, week: DataFrame) -> DataFrame:
    of = lambda df, name: df.agg(share(F.count_if(F.col("recommended_action") == "quarantine"), F.count(F.lit(1))).alias(name))
    return of(hour, "h").crossJoin(of(week, "w")).select(share(F.col("h"), F.col("w")).alias("value"))


def score_psi(hour: DataFrame, week: DataFrame) -> DataFrame:
    """Population stability of ml_score over ten bands; every present band is smoothed by a half, the totals by five."""
    band = F.least(F.floor(F.col("ml_score") * 10), F.lit(9)).cast("int").alias("band")
    of = lambda df, name: df.filter("ml_model <> ''").groupBy(band).agg(F.count(F.lit(1)).alias(name))
    both = of(hour, "hc").join(of(week, "wc"), "band", "full").select(F.coalesce("hc", F.lit(0)).alias("hc"), F.coalesce("wc", F.lit(0)).alias("wc"))
    totals = both.agg(F.sum("hc").alias("ht"), F.sum("wc").alias("wt"))
    h, w = (F.col("hc") + 0.5) / (F.col("ht") + 5), (F.col("wc") + 0.5) / (F.col("wt") + 5)
    return both.crossJoin(F.broadcast(totals)).agg(F.sum((h - w) * F.log(h / w)).alias("value"))


def judge(values: DataFrame, checks: list[Check] = CHECKS) -> DataFrame:
    """(check_name, value) to verdicts; no data passes, for volume says whether there was any."""
    listed = F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.lit(c.op).alias("op"), F.lit(float(c.threshold)).alias("threshold"), F.lit(c.about).alias("about")) for c in checks])
    table = values.sparkSession.range(1).select(F.inline(listed))
    v, t = F.col("value"), F.col("threshold")
    holds = F.when(F.col("op") == ">=", v >= t).when(F.col("op") == "<=", v <= t).otherwise(v == t)
    passed = F.when(v.isNull() | F.isnan(v), True).otherwise(holds)
    detail = F.when(v.isNull(), F.concat("check_name", F.lit(": no data in the interval"))).otherwise(
        F.concat("check_name", F.lit(" must be "), "op", F.lit(" "), t.cast("string"), F.lit(" ("), "about", F.lit(")"))
    )
    out = table.join(values, "check_name")
    return out.select("check_name", "severity", "op", "threshold", "value", passed.alias("passed"), detail.alias("detail"))


def flow_rates(snapshots: DataFrame, seconds: Column | None = None) -> DataFrame:
    """Per topic: arrivals a second between its first and last snapshot, and what a group has yet to read at the last.

    snapshots: (topic, partition, end_offset, committed_offset, sampled_ms); an uncommitted partition counts from 0.
    """
    per = snapshots.groupBy("topic", "partition").agg(
        (F.max_by("end_offset", "sampled_ms") - F.min_by("end_offset", "sampled_ms")).alias("arrived"),
        F.greatest(F.max_by("end_offset", "sampled_ms") - F.coalesce(F.max_by(F.coalesce("committed_offset", F.lit(0)), "sampled_ms"), F.lit(0)), F.lit(0)).alias("lag"),
        ((F.max("sampled_ms") - F.min("sampled_ms")) / 1000.0).alias("seconds"),
    )
    return per.groupBy("topic").agg(
        (F.sum("arrived") / F.greatest(F.max("seconds"), F.lit(1e-3))).alias("rate"), F.sum("lag").alias("lag")
    )


def counter_increases(samples: DataFrame) -> DataFrame:
    """(counter, label, increase) from (counter, label, value, sampled_ms): the last sample less the first, never below 0."""
    at = F.struct("sampled_ms", "value")
    grown = F.max_by("value", at) - F.min_by("value", at)
    return samples.groupBy("counter", "label").agg(F.greatest(grown, F.lit(0.0)).alias("increase"))


def health(rates: DataFrame, min_rate: float = 1.0, max_lag_s: float = 120, min_output: float = 0.5, max_rejected: float = 0.01, max_intake_s: float = 60) -> DataFrame:
    """(stage, check_name, severity, op, threshold, value, passed) from the rates of the topics raw, scored and rejected."""
    pick = lambda t, c: F.max(F.when(F.col("topic") == t, F.col(c)))
    one = rates.agg(*[F.coalesce(pick(t, c), F.lit(0)).cast("double").alias(f"{t}_{c}") for t in ("raw", "scored", "rejected") for c in ("rate", "lag")])
    item = lambda stage, name, sev, op, at, value: F.struct(F.lit(stage).alias("stage"), F.lit(name).alias("check_name"), F.lit(sev).alias("severity"), F.lit(op).alias("op"), F.lit(float(at)).alias("threshold"), value.cast("double").alias("value"))
    raw = F.col("raw_rate")
    checks = F.array(
        item("extract", "input_rate", "fail", ">=", min_rate, raw),
        item("extract", "rejected_share", "warn", "<=", max_rejected, share(F.col("rejected_rate"), raw)),
        item("transform", "lag_seconds", "fail", "<=", max_lag_s, F.col("raw_lag") / F.greatest(raw, F.lit(1.0))),
        item("transform", "output_ratio", "fail", ">=", min_output, share(F.col("scored_rate") + F.col("rejected_rate"), raw)),
        item("load", "lag_seconds", "fail", "<=", max_intake_s, F.col("scored_lag") / F.greatest("scored_rate", F.lit(1.0))),
    )
    v = F.col("value")
    passed = F.when(v.isNull(), True).when(F.col("op") == ">=", v >= F.col("threshold")).otherwise(v <= F.col("threshold"))
    return one.select(F.inline(checks)).withColumn("passed", passed)


def health_issues(issue_shares: DataFrame, max_doubtful: float = 0.01) -> DataFrame:
    """The transform stage's checks of the issue counts: shares()' one row. Nothing scored: no share to judge."""
    item = lambda name, sev, op, at, value: F.struct(F.lit("transform").alias("stage"), F.lit(name).alias("check_name"), F.lit(sev).alias("severity"), F.lit(op).alias("op"), F.lit(float(at)).alias("threshold"), value.cast("double").alias("value"))
    some = F.col("scored") > 0
    rows = issue_shares.select(F.inline(F.array(item("doubtful_share", "warn", "<=", max_doubtful, F.col("doubtful_share")), item("logic_inconsistent", "fail", "==", 0, F.when(some, F.col("logic_inconsistent"))))))
    v, t = F.col("value"), F.col("threshold")
    return rows.withColumn("passed", F.coalesce(F.when(F.col("op") == "==", v == t).otherwise(v <= t), F.lit(True)))


def health_intake(rates: DataFrame, stored: DataFrame, errors: DataFrame, now_ms: Column, min_rate: float = 1.0, last_ms: int = 60_000, max_p95_ms: float = 2000) -> DataFrame:
    """The load stage's checks of what was stored: rows of the last minute (judged only while input arrives), p95 of the last
    five minutes, intake errors (rows with failed_ms) of the last ten. Three one-row aggregates."""
    arriving = rates.agg(F.coalesce(F.max(F.when(F.col("topic") == "raw", F.col("rate"))), F.lit(0.0)).alias("arriving"))
    at = F.col("ingested_ms")
    seen = stored.agg(F.count_if(at > now_ms - last_ms).alias("rows"), F.percentile(F.when(at > now_ms - 5 * last_ms, at - F.col("ts_ms")), 0.95).alias("p95"))
    failed = errors.agg(F.count_if(F.col("failed_ms") > now_ms - 10 * last_ms).alias("failed"))
    one = arriving.crossJoin(seen).crossJoin(failed)
    item = lambda name, sev, op, at, value: F.struct(F.lit("load").alias("stage"), F.lit(name).alias("check_name"), F.lit(sev).alias("severity"), F.lit(op).alias("op"), F.lit(float(at)).alias("threshold"), value.cast("double").alias("value"))
    rows = one.select(F.inline(F.array(
        item("rows_last_minute", "fail", ">=", 1, F.when(F.col("arriving") >= min_rate, F.col("rows"))),
        item("latency_p95_ms", "warn", "<=", max_p95_ms, F.col("p95")),
        item("intake_errors", "warn", "==", 0, F.col("failed")),
    )))
    v, t = F.col("value"), F.col("threshold")
    holds = F.when(F.col("op") == ">=", v >= t).when(F.col("op") == "==", v == t).otherwise(v <= t)
    return rows.withColumn("passed", F.coalesce(holds, F.lit(True)))


def healthy_recently(results: DataFrame, now_ms: Column, max_age_ms: int = 20 * 60_000) -> DataFrame:
    """One row: whether the latest run within the age had no failed fail-check and reached load; false without a run."""
    recent = results.filter(F.col("checked_ms") > now_ms - max_age_ms)
    runs = recent.groupBy("run_id").agg(
        F.max("checked_ms").alias("at"),
        F.count_if((F.col("severity") == "fail") & ~F.col("passed")).alias("failed"),
        F.count_if(F.col("stage") == "load").alias("load_checks"),
    )
    last = runs.agg(F.max_by(F.struct("failed", "load_checks"), F.struct("at", "run_id")).alias("last"))
    return last.select(F.coalesce((F.col("last.failed") == 0) & (F.col("last.load_checks") > 0), F.lit(False)).alias("healthy"))


def latest_run(results: DataFrame) -> DataFrame:
    """The rows of the newest run."""
    newest = results.agg(F.max_by("run_id", F.struct("checked_ms", "run_id")).alias("newest"))
    return results.join(F.broadcast(newest), F.col("run_id") == F.col("newest")).drop("newest")
