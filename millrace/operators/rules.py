"""Rules, decisions, and how a model's score joins in."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import patterns as P
from millrace.settings import LIVE, Settings


@dataclass(frozen=True)
class Rule:
    """A named condition on an event's columns and how sure it is."""

    name: str
    score: float
    fired: Callable[[Settings], Column]


def _at_least(feature: str, setting: str) -> Callable[[Settings], Column]:
    return lambda s: F.col(feature) >= getattr(s, setting)


def _signature(name: str) -> Callable[[Settings], Column]:
    return lambda _: F.col("failure_signature") == name


# Names, scores and order; equal scores keep this order.
RULES = [
    Rule("reverse_shell", 1.00, lambda _: F.col("command").rlike(P.REVERSE_SHELL)),
    Rule("rogue_command_as_root", 0.97, lambda _: (F.col("is_rogue_command") == 1) & (F.col("is_privileged") == 1)),
    Rule("cache_poisoned", 0.95, _signature("checksum_mismatch")),
    Rule("compiler_crash", 0.95, _signature("ice")),
    Rule("disk_full", 0.90, _signature("disk_full")),
    Rule("rogue_command", 0.85, lambda _: F.col("is_rogue_command") == 1),
    Rule("oom_kill", 0.70, _signature("oom")),
    Rule("untrusted_fetch", 0.70, lambda _: F.col("is_untrusted_fetch") == 1),
    Rule("slow_step", 0.70, lambda _: F.col("is_slow_step") == 1),
    Rule("pass_after_failure_storm", 0.70, lambda s: (F.col("event_type") == "BUILD_SUCCESS") & (F.col("failed_builds_5m") >= s.storm_after)),
    Rule("failure_storm", 0.90, _at_least("failed_builds_1m", "storm")),
    Rule("broken_toolchain", 0.90, lambda s: (F.col("unique_projects_5m") >= s.storm_projects) & (F.col("failed_builds_5m") >= s.storm_after)),
    Rule("oom_kill_storm", 0.90, _at_least("oom_kills_5m", "oom_kills")),
    Rule("repeated_slow_steps", 0.90, _at_least("slow_steps_5m", "slow_steps")),
    Rule("dependency_not_found_storm", 0.85, _at_least("dependency_404_1m", "not_found")),
    Rule("artifact_bloat", 0.85, _at_least("published_bytes_5m", "published_bytes")),
    Rule("repeated_failure_signatures", 0.90, _at_least("failure_signatures_5m", "signatures")),
]


def action_for(score: Column, settings: Settings = LIVE) -> Column:
    return F.when(score >= settings.quarantine, "quarantine").when(score >= settings.suspicious, "alert").otherwise("ok")


def rule_columns(settings: Settings = LIVE, rules: list[Rule] = RULES) -> dict[str, Column]:
    """rule_hits: the names that fired, strongest first; rule_score: the strongest score, 0 if none fired."""
    ranked = sorted(rules, key=lambda r: -r.score)
    fired = {r.name: F.coalesce(r.fired(settings), F.lit(False)) for r in ranked}
    score = F.lit(0.0)
    for r in reversed(ranked):
        score = F.when(fired[r.name], r.score).otherwise(score)
    return {"rule_hits": F.concat_ws(",", *[F.when(fired[r.name], r.name) for r in ranked]), "rule_score": score}


def apply_rules(df: DataFrame, settings: Settings = LIVE, rules: list[Rule] = RULES) -> DataFrame:
    """df with the rules' columns and the decision by rules alone."""
    return decide(df.withColumns(rule_columns(settings, rules)), F.col("rule_score"), settings)


def decide(df: DataFrame, final: Column, settings: Settings = LIVE) -> DataFrame:
    df = df.withColumn("final_anomaly_score", final)
    score = F.col("final_anomaly_score")
    return df.withColumns({"is_suspicious": (score >= settings.suspicious).cast("int"), "recommended_action": action_for(score, settings)})


def apply_model(df: DataFrame, settings: Settings = LIVE, reason: Column | None = None) -> DataFrame:
    """Settle rules and model: df has rule_score, rule_hits, ml_score and ml_model ("" where no model scored).

    The model alone stays under the quarantine line. ml_reason is set where the model changed the action.
    """
    cap = F.least("ml_score", F.lit(settings.quarantine - 1e-4))
    share = F.col("ml_score") if settings.model_may_quarantine else F.when(F.col("rule_hits") != "", F.col("ml_score")).otherwise(cap)
    final = F.when(F.col("ml_model") == "", F.col("rule_score")).otherwise(F.greatest("rule_score", share))
    out = decide(df, final, settings)
    changed = F.col("recommended_action") != action_for(F.col("rule_score"), settings)
    return out.withColumn("ml_reason", F.when(changed, F.lit("ml: score") if reason is None else reason).otherwise(""))


def score_events(df: DataFrame, settings: Settings = LIVE, rules: list[Rule] = RULES) -> DataFrame:
    return apply_model(apply_rules(df, settings, rules), settings)


def fire_counts(df: DataFrame) -> DataFrame:
    """(rule, events) of scored events."""
    hits = df.filter("rule_hits <> ''").select(F.explode(F.split("rule_hits", ",")).alias("rule"))
    return hits.groupBy("rule").agg(F.count(F.lit(1)).alias("events"))
