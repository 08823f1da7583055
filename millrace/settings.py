"""Vocabularies, column lists and tunable numbers of the event pipeline."""

from __future__ import annotations

from dataclasses import dataclass, replace

# The event contract, its vocabularies and limits.
STRING_FIELDS = [
    "event_id", "timestamp", "runner_ip", "project", "event_type", "hostname", "severity", "reason", "command",
    "log_source", "outcome", "build_id", "dest_ip", "protocol", "triggered_by", "http_method", "url_path", "user_agent",
    "process_name", "parent_process", "step", "file_path", "cache_status", "error_message",
]
INT_FIELDS = ["exit_code", "dest_port", "http_status", "response_time_ms", "process_id", "process_uid", "duration_ms", "peak_memory_mb"]
LONG_FIELDS = ["bytes_sent"]
EVENT_TYPES = ["BUILD_STARTED", "BUILD_SUCCESS", "BUILD_FAILURE", "COMPILE_STEP", "TEST_RUN", "DEPENDENCY_FETCH", "ARTIFACT_PUBLISH"]
PROJECT_TYPES = ["BUILD_STARTED", "BUILD_SUCCESS", "BUILD_FAILURE", "COMPILE_STEP", "TEST_RUN"]
SEVERITIES = ["INFO", "WARNING", "ERROR"]
ACTIONS = ["ok", "alert", "quarantine"]
VERDICTS = ["normal", "degraded", "incident"]
UNKNOWN_SEVERITY, UNKNOWN_UID = "UNKNOWN", -1
MAX_EXIT_CODE, MAX_PORT, MAX_DURATION_MS = 255, 65_535, 24 * 3_600_000

#: Columns of a cleaned event besides those of a raw one.
FLAGS = ["is_failure_signature", "is_untrusted_fetch", "is_rogue_command", "is_privileged", "is_slow_step", "is_cache_miss", "is_internal_ip", "is_night"]
SHORT_FEATURES = ["events_1m", "failed_builds_1m", "dependency_404_1m"]
LONG_FEATURES = [
    "failed_builds_5m", "unique_projects_5m", "oom_kills_5m", "distinct_exit_codes_5m", "compile_steps_5m", "build_frequency",
    "rogue_commands_5m", "failure_signatures_5m", "http_errors_5m", "distinct_artifacts_5m", "published_bytes_5m", "slow_steps_5m",
    "cache_misses_5m",
]
SCORES = ["rule_score", "rule_hits", "ml_score", "ml_reason", "ml_model", "final_anomaly_score", "is_suspicious", "recommended_action"]
REJECTED = ["reject_reason", "schema_id", "raw_value", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp"]

#: The model's input, in order.
MODEL_FEATURES = [
    "failed_builds_1m", "failed_builds_5m", "unique_projects_5m", "events_1m", "oom_kills_5m", "distinct_exit_codes_5m", "compile_steps_5m",
    "build_frequency", "rogue_commands_5m", "failure_signatures_5m", "http_errors_5m", "dependency_404_1m", "distinct_artifacts_5m",
    "published_bytes_5m", "slow_steps_5m", "cache_misses_5m", "is_internal_ip", "is_night", "is_failure_signature", "is_untrusted_fetch",
    "is_rogue_command", "is_privileged", "is_slow_step", "is_cache_miss", "http_status", "exit_code", "dest_port", "bytes_sent",
    "response_time_ms", "duration_ms", "peak_memory_mb", "is_build_failure", "is_build_success", "is_compile_step", "is_dependency_fetch",
]
MODEL_FLAGS = {"is_build_failure": "BUILD_FAILURE", "is_build_success": "BUILD_SUCCESS", "is_compile_step": "COMPILE_STEP", "is_dependency_fetch": "DEPENDENCY_FETCH"}
BEHAVIOUR = ["failed_builds_5m", "unique_projects_5m", "oom_kills_5m", "slow_steps_5m", "dependency_404_1m", "rogue_commands_5m", "failure_signatures_5m", "published_bytes_5m"]


@dataclass(frozen=True)
class Settings:
    """Windows in milliseconds and thresholds; the defaults are those of a busy build farm."""

    short_ms: int = 60_000
    long_ms: int = 300_000
    horizon_ms: int = 600_000
    recent_ids: int = 1024
    idle_ms: int = 900_000
    slow_step_ms: int = 300_000
    night_from: int = 22
    night_until: int = 6
    quarantine: float = 0.85
    suspicious: float = 0.65
    model_may_quarantine: bool = False
    storm: int = 20
    storm_projects: int = 8
    storm_after: int = 20
    oom_kills: int = 5
    slow_steps: int = 5
    not_found: int = 30
    published_bytes: int = 250_000_000
    signatures: int = 5
    future_ms: int = 300_000
    stale_ms: int = 24 * 3_600_000
    incident_gap_ms: int = 60_000
    containment_ms: int = 300_000


LIVE = Settings()
#: Sparse data: days in place of minutes, and lower counts.
SPARSE = replace(
    LIVE, short_ms=86_400_000, long_ms=5 * 86_400_000, horizon_ms=3_600_000, storm=3, storm_projects=4, storm_after=5, oom_kills=2,
    slow_steps=2, not_found=2, published_bytes=400_000_000, signatures=3, incident_gap_ms=6 * 3_600_000, containment_ms=86_400_000,
)
