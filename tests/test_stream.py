"""The stream against the batch form over the same messages; restart from the checkpoint; the whole job's counts."""

import dataclasses
import datetime as dt
import json
import time
import uuid

import pytest
from pyspark.sql import functions as F

from millrace.operators import features
from millrace.operators.rules import apply_rules
from millrace.settings import LIVE, LONG_FEATURES, SHORT_FEATURES
from millrace.sources import raw
from millrace.streaming import job
from millrace.streaming.stateful import stream_features

T0 = dt.datetime(2026, 9, 20, 14, tzinfo=dt.timezone.utc)


def message(i, offset, seconds, kind, ip="10.0.0.1", event_id=None, **more):
    body = {"event_id": event_id or str(uuid.uuid5(uuid.NAMESPACE_DNS, str(i))), "timestamp": (T0 + dt.timedelta(seconds=seconds)).isoformat(), "runner_ip": ip, "project": "p", "event_type": kind, "hostname": "h", "severity": "INFO", **more}
    return (bytearray(b"\0\0\0\0\2" + json.dumps(body).encode()), "t", 0, offset, T0.replace(tzinfo=None) + dt.timedelta(seconds=seconds))


def messages():
    out = [message(i, i, i, "BUILD_FAILURE") for i in range(30)]
    out += [message(100 + i, 100 + i, 5 * i, "BUILD_SUCCESS", ip="10.0.0.2") for i in range(10)]
    out += [message(3, 200, 40, "BUILD_FAILURE"), message(4, 201, 41, "BUILD_FAILURE", event_id=f" {uuid.uuid5(uuid.NAMESPACE_DNS, str(4))} ")]
    out += [message(0, 202, 42, "BUILD_FAILURE", event_id="nope"), (bytearray(b"{}"), "t", 0, 203, T0.replace(tzinfo=None))]
    return sorted(out, key=lambda m: m[3])


@pytest.fixture
def rocksdb(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", job.ROCKSDB)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def run(spark, source, base):
    publish = lambda rows: rows.write.mode("append").parquet(f"{base}/topic")
    queries = job.start(
        raw.file_stream(spark, source), f"{base}/events", f"{base}/rejects", f"{base}/suspicious", f"{base}/checkpoint",
        counters_path=f"{base}/counters", publish=publish,
    )
    for q in queries:
        assert q.awaitTermination(240), "the stream did not end"
        assert q.exception() is None


def test_stream_equals_batch_and_restarts(spark, tmp_path, rocksdb):
    sent = messages()
    source, base = str(tmp_path / "topic"), str(tmp_path / "out")
    write = lambda part: spark.createDataFrame(part, raw.TOPIC).coalesce(1).write.mode("append").parquet(source)
    write(sent[:20])
    run(spark, source, base)
    write(sent[20:])
    run(spark, source, base)  # goes on from the checkpoint
    got = spark.read.parquet(f"{base}/events")
    assert got.count() == 40 and got.select("event_id").distinct().count() == 40
    refused = spark.read.parquet(f"{base}/rejects")
    assert sorted(r["reject_reason"] for r in refused.collect()) == ["invalid_event_id", "not_avro_framed"]

    good, _ = job.split(spark.createDataFrame(sent, raw.TOPIC))
    batch = apply_rules(features.rolling_features(features.dedup_recent_n(good), LIVE), LIVE)
    columns = ["event_id", *SHORT_FEATURES, *LONG_FEATURES, "rule_hits", "recommended_action"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, batch.select(columns).collect()))
    burst = got.filter("runner_ip = '10.0.0.1'").orderBy("offset").collect()
    assert [r["failed_builds_1m"] for r in burst] == list(range(1, 31))
    assert [r["recommended_action"] for r in burst] == ["ok"] * 19 + ["quarantine"] * 11
    assert spark.read.parquet(f"{base}/suspicious").count() == got.filter("is_suspicious = 1").count() == 11

    told = spark.read.parquet(f"{base}/counters").groupBy("counter", "label").agg(F.sum("events").alias("n")).collect()
    n = {(r["counter"], r["label"]): r["n"] for r in told}
    assert n["scored", ""] == 40 and n["action", "quarantine"] == 11 and n["action", "alert"] == 0 and n["ml_raised", ""] == 0
    assert n["rejected", "invalid_event_id"] == n["rejected", "not_avro_framed"] == 1
    assert n["issue", "score_out_of_range"] == 0 and sum(k == "issue" for k, _ in n) == 9
    sent_on = spark.read.parquet(f"{base}/topic")
    assert sent_on.count() == 40
    back = sent_on.select("key", F.get_json_object("value", "$.event_id").alias("event_id"), F.get_json_object("value", "$.recommended_action").alias("action"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, got.select("runner_ip", "event_id", "recommended_action").collect()))


def until(holds, seconds=120):
    end = time.time() + seconds
    while not holds():
        assert time.time() < end, "it did not come"
        time.sleep(0.5)


def test_a_silent_runner_is_forgotten(spark, tmp_path, rocksdb):
    """After the idle time a runner's ids and windows are gone: a redelivered event counts again, as its first one."""
    source = str(tmp_path / "topic")
    write = lambda part: spark.createDataFrame(part, raw.TOPIC).coalesce(1).write.mode("append").parquet(source)
    write([message(i, i, i, "BUILD_FAILURE") for i in range(3)])
    good, _ = job.split(raw.file_stream(spark, source))
    featured = stream_features(good, dataclasses.replace(LIVE, idle_ms=3000), idle=True)
    query = featured.writeStream.format("memory").queryName("idle_runner").option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(processingTime="1 second").start()
    try:
        seen = lambda: spark.table("idle_runner").select("offset", "failed_builds_1m").collect()
        until(lambda: query.exception() or len(seen()) == 3)
        time.sleep(15)  # idle time and some batches
        assert query.exception() is None
        write([message(0, 10, 5, "BUILD_FAILURE")])
        until(lambda: query.exception() or len(seen()) == 4)
        assert query.exception() is None
        assert sorted(map(tuple, seen())) == [(0, 1), (1, 2), (2, 3), (10, 1)]
    finally:
        query.stop()


def test_the_model_is_kept_when_a_reload_fails():
    answers = iter([("v1", F.lit), None])

    def load():
        got = next(answers, "gone")
        if got == "gone":
            raise OSError("store is away")
        return got

    hot = job.HotModel(load, every=1)
    assert [hot.at(i)[0] for i in range(3)] == ["v1", "v1", "v1"]
