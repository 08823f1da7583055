"""Lookups and tallies as streams: the rows of the batch form, in any order of arrival, over a restart, each once."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import evaluate
from millrace.settings import Settings
from millrace.streaming import job, truth

T0 = dt.datetime(2026, 9, 20, 14)
S = Settings(incident_gap_ms=60_000, containment_ms=300_000)


@pytest.fixture
def live(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", job.ROCKSDB)
    own.conf.set("spark.sql.shuffle.partitions", "2")
    return own


def run(live, stream, base):
    query = stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    assert query.awaitTermination(240) and query.exception() is None
    return live.read.schema(stream.schema).parquet(f"{base}/out").collect()


def source(live, path, schema):
    return live.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def write(live, path, rows, schema):
    live.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


TRUTH = "event_id string, partition int, offset long, appended_at timestamp_ltz"
DECIDED = "event_id string, action string, decided_at timestamp_ltz"
REFUSED = "partition int, offset long, reason string, rejected_at timestamp_ltz"


def test_lookups_over_a_restart(live, tmp_path):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    paths = [str(tmp_path / x) for x in ("truth", "decided", "refused")]
    stream = lambda: truth.delayed_lookups(*(source(live, p, s) for p, s in zip(paths, (TRUTH, DECIDED, REFUSED), strict=True)), late="30 seconds")

    def send(t, d, r):
        for path, rows, schema in zip(paths, (t, d, r), (TRUTH, DECIDED, REFUSED), strict=True):
            write(live, path, rows, schema)

    # e0 decided at once, e1 decided in the next file, e2 refused later, e3 never, e4 too late, e5 decided twice
    send([(f"e{i}", 0, i, at(i)) for i in range(6)], [("e0", "ok", at(1)), ("e5", "alert", at(6))], [(0, 99, "other", at(0))])
    send([("e6", 0, 6, at(20))], [("e1", "alert", at(15)), ("e5", "alert", at(12))], [(0, 2, "bad", at(25))])
    first = run(live, stream(), tmp_path / "run")
    assert {r["event_id"] for r in first} <= {"e0", "e1", "e5"}  # nothing is given up before the wait is over
    send([("e7", 0, 7, at(400))], [("e4", "ok", at(399))], [(0, 3, "late", at(400))])
    send([("e8", 0, 8, at(2000))], [("x", "ok", at(2000))], [(1, 1, "y", at(2000))])
    send([("e9", 0, 9, at(4000))], [("z", "ok", at(4000))], [(1, 2, "y", at(4000))])
    got = sorted((r["event_id"], r["action"], r["reason"]) for r in run(live, stream(), tmp_path / "run") if r["event_id"] < "e8")
    assert got == [("e0", "ok", None), ("e1", "alert", None), ("e2", None, "bad"), ("e3", None, None), ("e4", None, None), ("e5", "alert", None), ("e6", None, None), ("e7", None, None)]


def decided_rows(seed=4):
    r = random.Random(seed)
    rows, t = [], 0
    for i in range(500):
        t += r.choice([1_000, 5_000, 20_000, 90_000])
        rows.append((f"e{i:04d}", r.choice(["normal", "normal", "storm", "leak"]), f"r{r.randrange(4)}", r.choice(["ok", "ok", "alert", "quarantine"]), t))
    return rows


def test_the_tally_is_the_batch_whatever_the_order(spark, live, tmp_path):
    rows, path, schema = decided_rows(), str(tmp_path / "decided"), "event_id string, scenario string, runner_ip string, action string, ts_ms long"
    r = random.Random(1)
    # arrivals are out of order by up to eight minutes, within the ten that the watermark allows
    arriving = sorted(rows, key=lambda x: x[4] + r.randrange(480_000))
    stream = lambda: truth.tally(source(live, path, schema), S)
    for part in (arriving[:150], arriving[150:300]):
        write(live, path, part, schema)
    before = run(live, stream(), tmp_path / "run")
    end = rows[-1][4]
    for part in (arriving[300:], [("", "normal", "", "ok", end + 10**8)], [("", "normal", "", "ok", end + 2 * 10**8)]):
        write(live, path, part, schema)
    got = run(live, stream(), tmp_path / "run")
    assert 0 < len(before) < len(got)

    full = [(e, s, 0, i, True, a, "", 0.0, 0.0, "", ip, ts, 1, None) for i, (e, s, ip, a, ts) in enumerate(rows)]
    told = spark.createDataFrame(full, "event_id string, scenario string, partition int, offset long, in_window boolean, action string, rule_hits string, rule_score double, ml_score double, ml_model string, runner_ip string, ts_ms long, copies long, reason string")
    found = evaluate.incidents(told, F.lit(0), S).collect()
    want = sorted((x["scenario"], x["runner_ip"], x["start_ms"], x["end_ms"], x["events"], x["flagged"], x["known_source"]) for x in found)
    assert sorted((x["scenario"], x["runner_ip"], x["start_ms"], x["end_ms"], x["events"], x["flagged"], x["known_source"]) for x in got if x["kind"] == "incident") == want
    quiet = sorted((x["event_id"], x["affected"]) for x in evaluate.affected(told, S).collect())
    assert sorted((x["event_id"], x["affected"]) for x in got if x["kind"] == "quarantine") == quiet and quiet
