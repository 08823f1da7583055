"""Stateless row stages: validate, normalize, enrich. Narrow projections only; nothing here shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import patterns as P
from millrace.settings import EVENT_TYPES, LIVE, MAX_DURATION_MS, MAX_EXIT_CODE, MAX_PORT, SEVERITIES, UNKNOWN_SEVERITY, UNKNOWN_UID, Settings

LOWER = ["project", "hostname", "reason", "log_source", "outcome", "protocol", "triggered_by", "step", "process_name", "parent_process", "cache_status"]
TRIMMED = ["command", "url_path", "user_agent", "file_path", "build_id", "dest_ip", "error_message"]
ZERO = ["exit_code", "dest_port", "http_status", "bytes_sent", "response_time_ms", "process_id", "duration_ms", "peak_memory_mb"]


def blank(c: Column) -> Column:
    """Null or spaces only; a tab is not blank."""
    return c.isNull() | (F.trim(c) == "")


def outside(c: Column, low: int, high: int) -> Column:
    return c.isNotNull() & ~c.between(low, high)


def parse_timestamp(c: Column) -> Column:
    """ISO 8601 text to a timestamp, naive texts as UTC; null where it is none.

    The pattern keeps out what a cast takes for a timestamp: words, times alone, partial dates.
    """
    text = F.regexp_replace(F.trim(c), ",", ".")
    return F.when(text.rlike(P.ISO), text.try_cast("timestamp"))


def reject_reason(settings: Settings = LIVE, wire_error: Column | None = None) -> Column:
    """The first check that fails, null if none does."""
    checks = [
        (blank(F.col("event_id")), "missing_event_id"),
        (~F.trim("event_id").rlike(P.UUID), "invalid_event_id"),
        (parse_timestamp(F.col("timestamp")).isNull(), "invalid_timestamp"),
        (blank(F.col("event_type")), "missing_event_type"),
        (~F.upper(F.trim("event_type")).isin(EVENT_TYPES), "unknown_event_type"),
        (blank(F.col("runner_ip")), "missing_runner_ip"),
        (outside(F.col("exit_code"), 0, MAX_EXIT_CODE), "exit_code_out_of_range"),
        (outside(F.col("dest_port"), 0, MAX_PORT), "port_out_of_range"),
        (outside(F.col("http_status"), 100, 599), "invalid_http_status"),
        (outside(F.col("duration_ms"), 0, MAX_DURATION_MS), "duration_out_of_range"),
    ]
    first = [] if wire_error is None else [wire_error]
    return F.coalesce(*first, *[F.when(failed, F.lit(name)) for failed, name in checks])


def validate(df: DataFrame, settings: Settings = LIVE) -> DataFrame:
    """df with reject_reason; a column wire_error, where there is one, comes first."""
    return df.withColumn("reject_reason", reject_reason(settings, F.col("wire_error") if "wire_error" in df.columns else None))


def severity(c: Column) -> Column:
    known = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(known.isin(SEVERITIES), known).otherwise(UNKNOWN_SEVERITY)


def normalize(df: DataFrame) -> DataFrame:
    """One spelling for each value. The raw severity stays as raw_severity for the issue counts."""
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    out = {c: F.lower(text(c)) for c in LOWER} | {c: text(c) for c in TRIMMED}
    out |= {c: F.coalesce(F.col(c), F.lit(0)) for c in ZERO}
    out |= {
        "event_id": F.trim("event_id"), "runner_ip": F.trim("runner_ip"), "event_type": F.upper(F.trim("event_type")),
        "http_method": F.upper(text("http_method")), "raw_severity": F.col("severity"), "severity": severity(F.col("severity")),
        "process_uid": F.coalesce("process_uid", F.lit(UNKNOWN_UID)), "ts": parse_timestamp(F.col("timestamp")),
    }
    return df.withColumns(out).withColumn("ts_ms", F.unix_millis("ts"))


def failure_signature(message: Column) -> Column:
    found = F.lit("")
    for name, pattern in reversed(P.SIGNATURES):
        found = F.when(message.rlike(pattern), name).otherwise(found)
    return found


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def region_table(spark) -> DataFrame:
    """(prefix, region): the fixed table of the address prefixes."""
    pairs = F.array(*[F.struct(F.lit(p).alias("prefix"), F.lit(r).alias("region")) for p, r in P.REGIONS])
    return spark.range(1).select(F.inline(pairs))


def with_region(df: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """df with region by a join to a prefix table; that of the constants (six rows) is broadcast, another is left to the planner."""
    table = F.broadcast(region_table(df.sparkSession)) if regions is None else regions
    table = table.select(F.col("prefix").alias("_prefix"), F.col("region").alias("_region"))
    out = df.join(table, F.substring_index("runner_ip", ".", 2) == F.col("_prefix"), "left")
    return out.withColumn("region", F.coalesce("_region", F.lit(""))).drop("_prefix", "_region")


def enrich(df: DataFrame, settings: Settings = LIVE, regions: DataFrame | None = None) -> DataFrame:
    """Indicators of a normalized event, and its region."""
    out = df.withColumns({"failure_signature": failure_signature(F.col("error_message")), "hour": F.hour("ts")})
    out = out.withColumns(
        {
            "is_failure_signature": flag(F.col("failure_signature") != ""),
            "is_untrusted_fetch": flag(F.col("url_path").rlike(P.UNTRUSTED_FETCH)),
            "is_rogue_command": flag(F.col("command").rlike(P.ROGUE_COMMAND) | F.col("file_path").rlike(P.ROGUE_FILE)),
            "is_privileged": flag(F.col("process_uid") == 0),
            "is_slow_step": flag((F.col("event_type") == "COMPILE_STEP") & (F.col("duration_ms") >= settings.slow_step_ms)),
            "is_cache_miss": flag(F.col("cache_status").isin("miss", "corrupt")),
            "is_internal_ip": flag(F.col("runner_ip").rlike(P.PRIVATE_IP)),
            "is_night": flag((F.col("hour") >= settings.night_from) | (F.col("hour") < settings.night_until)),
        }
    )
    return with_region(out, regions)


def clean_events(df: DataFrame, settings: Settings = LIVE) -> DataFrame:
    """Valid events, normalized and enriched."""
    return enrich(normalize(validate(df, settings).filter("reject_reason is null").drop("reject_reason")), settings)


def ms_text(ts: Column) -> Column:
    """Millisecond text, cut, not rounded."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")
