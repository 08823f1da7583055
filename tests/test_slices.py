"""Hot runners and projects in slices of time: the same rows as unsliced, and many tasks."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import evaluate, features
from millrace.settings import LIVE, Settings

S = Settings(incident_gap_ms=60_000, containment_ms=300_000)


def arrivals(spark, seed=2):
    """A third of all rows from one runner, late events, ties, long silences."""
    r, rows, t = random.Random(seed), [], 0
    for i in range(1500):
        t += r.choice([0, 0, 500, 20_000, 90_000, 400_000])
        ts = t - (r.randrange(900_000) if r.random() < 0.1 else 0)
        rows.append((f"e{i}", "hot" if i % 3 == 0 else f"r{i % 7}", r.choice(["", "p1", "p2", "p3"]), i, ts, r.choice(["BUILD_FAILURE", "BUILD_SUCCESS", "COMPILE_STEP", "ARTIFACT_PUBLISH"]), r.choice([0, 1, 137]), r.choice([0, 200, 404, 503]), r.randrange(9), r.choice(["", "/a", "/b"]), r.choice(["", "oom"])))
    df = spark.createDataFrame(rows, "event_id string, runner_ip string, project string, offset long, ts_ms long, event_type string, exit_code int, http_status int, bytes_sent long, url_path string, failure_signature string")
    return df.withColumns({c: (F.col("offset") % n == 0).cast("int") for c, n in (("is_rogue_command", 5), ("is_failure_signature", 4), ("is_slow_step", 3), ("is_cache_miss", 2))})


@pytest.mark.parametrize(("key", "widths", "arrivals_"), [("runner_ip", 1, 100), ("runner_ip", 3, 10_000), ("project", 1, 37)])
def test_sliced_features_are_the_features(spark, key, widths, arrivals_):
    df = arrivals(spark)
    columns = ["event_id", "eff", *features.measures(), *features.distincts()]
    columns.remove("finished_5m")
    want = sorted(map(str, features.rolling_features(df, LIVE, key).select(*columns).collect()))
    got = features.sliced_features(df, LIVE, key, widths, arrivals_)
    assert sorted(map(str, got.select(*columns).collect())) == want and len(got.columns) == len(features.rolling_features(df, LIVE, key).columns)


def test_a_hot_runner_is_many_tasks(spark):
    plan = features.sliced_features(arrivals(spark))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(runner_ip" in plan
    dealt = [line for line in plan.split("\n") if "Exchange hashpartitioning(runner_ip" in line]
    alone = [line for line in dealt if "_slice" not in line and "_arrivals" not in line]
    # by the runner alone go only the rows of the slices, one each
    assert len(alone) == 1 and any("_slice" in line for line in dealt)


def test_containment_by_brute_force(spark):
    r = random.Random(9)
    found = [("storm", "hot" if i % 3 else f"r{i % 4}", (a := r.randrange(90_000_000)), a + r.randrange(2_000_000), r.random() < 0.05) for i in range(60)]
    normal = [(i, "hot" if i % 3 else f"r{i % 5}", r.randrange(100_000_000)) for i in range(3000)] + [(9000, None, 5), (9001, "hot", None)]
    normal += [(10_000 + i, f[1], t) for i, f in enumerate(found) for t in (f[2], f[3] + S.containment_ms, f[3] + S.containment_ms + 1)]
    intervals = spark.createDataFrame(found, "scenario string, runner_ip string, start_ms long, end_ms long, started_before_window boolean")
    events = spark.createDataFrame(normal, "event_id long, runner_ip string, ts_ms long").withColumn("extra", F.lit("kept"))
    got = evaluate.contained(events, intervals, S, slice_ms=3_600_000)
    want = sorted(e[0] for e in normal if e[1] and e[2] is not None and any(f[1] == e[1] and (f[4] or f[2] <= e[2]) and e[2] <= f[3] + S.containment_ms for f in found))
    assert sorted(x["event_id"] for x in got.collect()) == want and got.columns == events.columns
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "_slice" in plan
    assert evaluate.contained(events, intervals.limit(0), S).count() == 0 and evaluate.contained(events.limit(0), intervals, S).count() == 0
