"""The live job: topic -> decode -> clean -> per-runner state -> rules and model -> three tables.

At least once: a micro-batch that is run again writes its rows again under its own batch folder, which is replaced whole,
and reads collapse copies with millrace.sources.tables.final_rows. The model is read anew every few batches; when that
fails the last one stays.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from millrace.functions.clean import enrich, normalize, validate
from millrace.operators.dq import issue_counts, with_issues
from millrace.operators.rules import apply_model, apply_rules
from millrace.settings import LIVE, Settings
from millrace.sources.raw import dead_letters, decode
from millrace.streaming.progress import counted
from millrace.streaming.stateful import stream_features

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class HotModel:
    """The scoring column of the active model, read again after so many batches; the last one is kept when that fails."""

    def __init__(self, load: Callable[[], tuple[str, Column] | None], every: int = 10):
        self.load, self.every, self.current = load, every, None

    def at(self, batch_id: int) -> tuple[str, Column] | None:
        if self.current is None or batch_id % self.every == 0:
            try:
                self.current = self.load() or self.current
            except Exception as e:  # a store that is away must not stop the stream
                logging.getLogger(__name__).warning("model not loaded, keeping the last: %s", e)
        return self.current


def score(df: DataFrame, settings: Settings = LIVE, model: tuple[str, Column] | None = None) -> DataFrame:
    version, column = model or ("", F.lit(0.0))
    out = apply_rules(df, settings).withColumns({"ml_model": F.lit(version), "ml_score": column})
    return apply_model(out, settings)


def split(raw: DataFrame, settings: Settings = LIVE) -> tuple[DataFrame, DataFrame]:
    """Accepted events, cleaned, and the stored form of the refused messages."""
    checked = validate(decode(raw), settings)
    good = enrich(normalize(checked.filter("reject_reason is null").drop("reject_reason", "wire_error", "value")), settings)
    return good, dead_letters(checked.filter("reject_reason is not null"))


def counters(scored: DataFrame, settings: Settings = LIVE) -> DataFrame:
    """(counter, label, events) of scored events: scored, each action, raised by the model, each declared issue; zeros too."""
    action = F.col("recommended_action")
    raised = (action != "ok") & (F.col("rule_score") < settings.suspicious)
    told = [("scored", "", F.lit(True)), *[("action", a, action == a) for a in ("ok", "alert", "quarantine")], ("ml_raised", "", raised)]
    one = scored.agg(*[F.count_if(c).alias(f"n{i}") for i, (_, _, c) in enumerate(told)])
    rows = [F.struct(F.lit(k).alias("counter"), F.lit(v).alias("label"), F.col(f"n{i}").alias("events")) for i, (k, v, _) in enumerate(told)]
    return one.select(F.inline(F.array(*rows))).unionByName(issue_counts(scored).select(F.lit("issue").alias("counter"), F.col("issue").alias("label"), "events"))


def topic_rows(scored: DataFrame) -> DataFrame:
    """Scored events as the messages of a topic: keyed by runner, so that a runner's rows keep their order; one JSON line each."""
    return scored.select(F.col("runner_ip").alias("key"), F.to_json(F.struct(*scored.columns)).alias("value"))


def kafka_sink(servers: str, topic: str) -> Callable[[DataFrame], None]:
    """A publisher for start(): appends messages to a topic; needs the Kafka connector on the class path."""
    return lambda rows: rows.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def start(
    raw: DataFrame, events_path: str, rejects_path: str, suspicious_path: str, checkpoint: str, settings: Settings = LIVE,
    model: HotModel | None = None, idle: bool | None = None, counters_path: str | None = None, publish: Callable[[DataFrame], None] | None = None, **trigger,
) -> list[StreamingQuery]:
    """Start the two queries of the job over one topic: decisions (with the suspicious ones beside) and dead letters.

    idle: forget runners that were silent for the idle time, else their state stays; left open, live triggers forget and
    availableNow, whose timers would keep it from ending, does not. counters_path: where the counters of each batch go, refused messages by reason among them. publish: called with
    topic_rows() of each batch before the batch counts as done, so at least once.
    """
    good, refused = split(raw, settings)
    trigger = trigger or {"availableNow": True}
    featured = stream_features(good, settings, "availableNow" not in trigger if idle is None else idle)

    def write(batch: DataFrame, batch_id: int) -> None:
        scored = score(batch, settings, model.at(batch_id) if model else None)
        scored = with_issues(scored, F.unix_millis("appended_at"), settings).drop("raw_severity").withColumn("ingested_at", F.current_timestamp())
        scored = scored.persist()
        scored.write.mode("overwrite").parquet(f"{events_path}/batch={batch_id}")
        scored.filter("is_suspicious = 1").write.mode("overwrite").parquet(f"{suspicious_path}/batch={batch_id}")
        if counters_path:
            counters(scored, settings).write.mode("overwrite").parquet(f"{counters_path}/query=events/batch={batch_id}")
        if publish:
            publish(topic_rows(scored))
        scored.unpersist()

    def write_refused(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("rejected_at", F.current_timestamp()).persist()
        batch.write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")
        if counters_path:
            by = batch.groupBy(F.col("reject_reason").alias("label")).agg(F.count(F.lit(1)).alias("events"))
            by.select(F.lit("rejected").alias("counter"), "label", "events").write.mode("overwrite").parquet(f"{counters_path}/query=rejects/batch={batch_id}")
        batch.unpersist()

    one = counted(featured, "scored").writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/events").trigger(**trigger).start()
    two = counted(refused, "rejected").writeStream.foreachBatch(write_refused).option("checkpointLocation", f"{checkpoint}/rejects").trigger(**trigger).start()
    return [one, two]
