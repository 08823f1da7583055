import random

import pytest

from millrace.operators import features as T
from millrace.settings import LIVE, Settings
from millrace.streaming.stateful import FEATURES, RunnerWindow, record

SMALL = Settings(short_ms=10, long_ms=50, horizon_ms=30, recent_ids=4, idle_ms=40)
FIELDS = "runner_ip string, offset long, ts_ms long, event_id string, event_type string, project string, exit_code int, url_path string, http_status int, bytes_sent long, failure_signature string, is_rogue_command int, is_failure_signature int, is_slow_step int, is_cache_miss int"


def rows(seed, n=160):
    r = random.Random(seed)
    out, clock = [], {"a": 0, "b": 0}
    for i in range(n):
        ip = r.choice("ab")
        clock[ip] += r.choice([0, 0, 1, 3, 9, 30])
        late = r.choice([0, 0, 0, 5, 70])
        sig = r.choice(["", "", "oom", "ice"])
        out.append((ip, i, clock[ip] - late, f"id{r.randrange(n // 2)}", r.choice(["BUILD_FAILURE", "BUILD_SUCCESS", "COMPILE_STEP", "ARTIFACT_PUBLISH"]), r.choice(["", "p1", "p2", "p3"]),
                    r.choice([0, 0, 1, 2, 137]), r.choice(["", "/x", "/y"]), r.choice([0, 200, 404, 500]), r.randrange(100), sig, r.randrange(2), int(sig != ""), r.randrange(2), r.randrange(2)))
    return out


def brute(data, s):
    """Head eviction as of the newest time seen, counted over plain lists."""
    names = [f.split()[0] for f in FIELDS.split(", ")]
    found, log, newest = {}, {}, {}
    for row in data:
        e = dict(zip(names, row, strict=True))
        ip = e["runner_ip"]
        newest[ip] = max(newest.get(ip, e["ts_ms"]), e["ts_ms"])
        e["eff"] = newest[ip]
        log.setdefault(ip, []).append(e)
        far = [x for x in log[ip] if e["eff"] - x["eff"] <= s.long_ms]
        near = [x for x in far if e["eff"] - x["eff"] <= s.short_ms]
        n = lambda part, ok: sum(1 for x in part if ok(x))
        fail = lambda x: x["event_type"] == "BUILD_FAILURE"
        found[e["offset"]] = {
            "events_1m": len(near), "failed_builds_1m": n(near, fail), "dependency_404_1m": n(near, lambda x: x["http_status"] == 404), "failed_builds_5m": n(far, fail),
            "unique_projects_5m": len({x["project"] for x in far} - {""}), "oom_kills_5m": n(far, lambda x: x["failure_signature"] == "oom" or x["exit_code"] == 137),
            "distinct_exit_codes_5m": len({x["exit_code"] for x in far if x["exit_code"] > 0}), "compile_steps_5m": n(far, lambda x: x["event_type"] == "COMPILE_STEP"),
            "build_frequency": n(far, lambda x: x["event_type"] in ("BUILD_FAILURE", "BUILD_SUCCESS")) / 5.0, "rogue_commands_5m": n(far, lambda x: x["is_rogue_command"]),
            "failure_signatures_5m": n(far, lambda x: x["is_failure_signature"]), "http_errors_5m": n(far, lambda x: x["http_status"] >= 400), "distinct_artifacts_5m": len({x["url_path"] for x in far} - {""}),
            "published_bytes_5m": sum(x["bytes_sent"] for x in far if x["event_type"] == "ARTIFACT_PUBLISH"), "slow_steps_5m": n(far, lambda x: x["is_slow_step"]), "cache_misses_5m": n(far, lambda x: x["is_cache_miss"]),
        }
    return found


@pytest.mark.parametrize("seed", range(4))
def test_rolling_features_are_those_of_a_log(spark, seed):
    data = rows(seed)
    want = brute(data, SMALL)
    got = T.rolling_features(spark.createDataFrame(data, FIELDS), SMALL).collect()
    assert {r["offset"]: {c: r[c] for c in FEATURES} for r in got} == want


@pytest.mark.parametrize("seed", range(20))
def test_the_streams_window_is_the_same(seed):
    data = rows(seed)
    want, windows = brute(data, SMALL), {}
    names = [f.split()[0] for f in FIELDS.split(", ")]
    for row in data:
        e = dict(zip(names, row, strict=True))
        w = windows.setdefault(e["runner_ip"], RunnerWindow(SMALL))
        w = windows[e["runner_ip"]] = RunnerWindow(SMALL, list(w.records))  # stored and read back
        w.add(record(e, e["ts_ms"] if w.newest is None else max(e["ts_ms"], w.newest)))
        assert dict(zip(FEATURES, w.features(), strict=True)) == want[e["offset"]]


def test_a_burst_counts_up(spark):
    data = [("r", i, 1000 * i, f"e{i}", "BUILD_FAILURE", "p", 1, "", 0, 0, "", 0, 0, 0, 0) for i in range(30)]
    got = T.rolling_features(spark.createDataFrame(data, FIELDS), LIVE).orderBy("offset").collect()
    assert [r["failed_builds_1m"] for r in got] == list(range(1, 31))


def test_dedup(spark):
    data = rows(9)
    df = spark.createDataFrame(data, FIELDS)
    ring, kept, newest, last, horizon, first = {}, [], {}, {}, [], {}
    for r in data:
        ip, off, ts, eid = r[:4]
        q = ring.setdefault(ip, [])
        if eid not in q:
            kept.append(off)
            q.append(eid)
            del q[: -SMALL.recent_ids]
        newest[ip] = max(newest.get(ip, ts), ts)
        if (ip, eid) not in last or newest[ip] - last[ip, eid] > SMALL.horizon_ms:
            horizon.append(off)
            last[ip, eid] = newest[ip]
        first.setdefault((ip, eid), off)
    assert sorted(r["offset"] for r in T.dedup_recent_n(df, SMALL).collect()) == kept
    assert sorted(r["offset"] for r in T.dedup_horizon(df, SMALL).collect()) == horizon
    assert sorted(r["offset"] for r in T.dedup_keep_first(df).collect()) == sorted(first.values())


def test_an_empty_table(spark):
    assert T.rolling_features(spark.createDataFrame([], FIELDS), SMALL).count() == 0
