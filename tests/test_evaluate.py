import pytest
from pyspark.sql import functions as F

from millrace.operators import dq, evaluate, learn, review
from millrace.settings import MODEL_FEATURES, Settings
from millrace.sources import tables

S = Settings(incident_gap_ms=60_000, containment_ms=300_000)
TOLD = "event_id string, scenario string, partition int, offset long, in_window boolean, action string, rule_hits string, rule_score double, ml_score double, ml_model string, runner_ip string, ts_ms long, copies long, reason string"


def told(spark, rows):
    full = [(f"e{i}", s, 0, i, True, a, h, 0.9 if h else 0.0, 0.1, "v1", ip, ts, 1, None) for i, (s, a, h, ip, ts) in enumerate(rows)]
    return spark.createDataFrame(full, TOLD)


def test_incidents_gaps_and_flags(spark):
    rows = [("storm", "ok", "", "r1", 10_000), ("storm", "ok", "", "r1", 10_200), ("storm", "ok", "", "r1", 10_300), ("storm", "quarantine", "x", "r1", 10_400), ("storm", "ok", "", "r1", 70_400), ("storm", "ok", "", "r1", 130_401)]
    got = sorted(evaluate.incidents(told(spark, rows), F.lit(0), S).collect(), key=lambda r: r["start_ms"])
    assert [(r["events"], r["flagged"], r["first_flag_events"], r["first_flag_s"], r["known_source"]) for r in got] == [(5, 1, 3, 0.4, False), (1, 0, None, None, True)]


def test_containment(spark):
    rows = [("storm", "quarantine", "x", "r1", 100_000), ("normal", "quarantine", "x", "r1", 50_000), ("normal", "quarantine", "x", "r1", 400_000), ("normal", "quarantine", "x", "r1", 400_001), ("normal", "quarantine", "x", "r2", 100_000)]
    t = told(spark, rows)
    found = evaluate.incidents(t, F.lit(0), S)
    inside = evaluate.contained(t.filter("scenario = 'normal'"), found, S)
    assert {r["ts_ms"] for r in inside.collect()} == {400_000}
    s = evaluate.detection_summary(t, found, inside).first()
    assert (s["normal_quarantined"], s["normal_quarantined_contained"], s["precision_quarantine"], s["precision_quarantine_with_containment"]) == (4, 1, 0.2, 0.4)
    assert not evaluate.assess(evaluate.detection_summary(t, found, inside)).first()["passed"]


def test_an_empty_window_fails(spark):
    t = told(spark, [])
    found = evaluate.incidents(t, F.lit(0), S)
    assert evaluate.assess(evaluate.detection_summary(t, found, t)).first()["failures"] == ["no events"]


def test_counter_resets(spark):
    df = spark.createDataFrame([("a", t, v) for t, v in [(0, 5.0), (10, 8.0), (20, 2.0), (30, 4.0)]], "job string, ts_ms long, value double")
    got = evaluate.increase_over(df, ["job"], 20).orderBy("ts_ms").collect()
    assert [r["increase"] for r in got] == [0, 3, 2, 2] and [r["total"] for r in got] == [0, 3, 5, 7]


def test_judge(spark):
    values = [("volume", 0.0), ("rejected_share", 0.5), ("latency_p95_ms", None), ("ml_score_drift_psi", 0.1)]
    got = {r["check_name"]: r["passed"] for r in dq.judge(spark.createDataFrame(values, "check_name string, value double")).collect()}
    assert got == {"volume": False, "rejected_share": False, "latency_p95_ms": True, "ml_score_drift_psi": True}


def test_verdicts(spark):
    replies = [
        (1, 2, 'Sure: {"verdicts":[{"id":"0","verdict":"INCIDENT","confidence":1.7,"reason":"r"},{"id":"7","verdict":"normal","confidence":0.5}]} done'),
        (2, 2, '```{"verdicts":[{"id":"1","verdict":"maybe","confidence":0.5},{"id":"0","confidence":0.2},{"id":"x","verdict":"normal","confidence":0.5},{"id":"1","verdict":"normal","confidence":-1}]}```'),
        (3, 2, "no json"), (4, 2, "{broken"), (5, 2, None),
    ]
    got = review.parse_verdicts(spark.createDataFrame(replies, "page int, page_size int, reply string"), ["page"]).collect()
    assert sorted((r["page"], r["index"], r["verdict"], r["confidence"]) for r in got) == [(1, 0, "incident", 1.0), (2, 1, "normal", 0.0)]


def test_sample_weights_add_up(spark):
    df = spark.createDataFrame([("big", f"e{i}") for i in range(1000)] + [("small", f"s{i}") for i in range(3)], "runner_ip string, event_id string")
    got = learn.per_runner_sample(df).groupBy("runner_ip").agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n")).collect()
    assert {r["runner_ip"]: (r["w"], r["n"]) for r in got} == {"big": (1000.0, 5), "small": (3.0, 3)}


def test_split_is_that_of_zlib(spark):
    import zlib

    df = spark.createDataFrame([(f"id-{i}", i % 7 == 0) for i in range(200)], "event_id string, reviewed boolean")
    for r in learn.split(df).collect():
        assert r["part"] == ("train" if r["reviewed"] or zlib.crc32(f"13:{r['event_id']}".encode()) % 1000 / 1000 >= 0.2 else "holdout")


def test_average_precision_and_bound(spark):
    df = spark.createDataFrame([("a", 0.9, 1), ("b", 0.8, 0), ("c", 0.7, 1), ("d", 0.1, 0)], "event_id string, score double, label int")
    assert abs(learn.average_precision(df).first()[0] - (1 + 2 / 3) / 2) < 1e-12
    assert learn.average_precision(df.filter("label = 0")).first()[0] is None
    bounds = spark.range(1).select(*[learn.false_alarm_bound(F.lit(n)) for n in (0, 2, 10)]).first()
    assert [round(b, 1) for b in bounds] == [4.9, 6.7, 18.1]


def gate(spark, c=(0.9, 2), i=(0.9, 2), wrong=(0, 0), shadow=(1000, 1, 1, 1, 1)):
    m = lambda x: spark.createDataFrame([x], "average_precision double, false_positives long")
    w = spark.createDataFrame([wrong], "candidate_wrong long, incumbent_wrong long")
    s = spark.createDataFrame([shadow], "rows long, candidate_alerts long, candidate_runners long, incumbent_alerts long, incumbent_runners long")
    return learn.promotion_gate(m(c), m(i), w, s).first()["promote"]


def test_gate(spark):
    assert gate(spark) and gate(spark, c=(0.896, 2)) and not gate(spark, c=(0.89, 2))
    assert gate(spark, c=(0.9, 6)) and not gate(spark, c=(0.9, 7)) and not gate(spark, wrong=(1, 0)) and not gate(spark, c=(None, 0))
    assert not gate(spark, shadow=(1000, 6, 1, 6, 1)) and not gate(spark, shadow=(10_000, 8, 1, 1, 1)) and not gate(spark, shadow=(10_000, 1, 9, 1, 1))


def test_ensemble_forms_agree(spark):
    from millrace.plans.queries import TREES

    n = len(MODEL_FEATURES)
    df = spark.createDataFrame([([float((i * j) % 7) for j in range(n)],) for i in range(40)], "x array<double>")
    for r in df.select(learn.ensemble_score(TREES, F.col("x")).alias("a"), learn.score_nodes(TREES, F.col("x")).alias("b"), learn.explain(TREES, F.col("x")).alias("why")).collect():
        assert abs(r["a"] - r["b"]) < 1e-12 and r["why"].startswith("ml: ")
    with pytest.raises(ValueError, match="binary"):
        learn.load_ensemble('{"objective": "regression", "features": []}')


def test_tables_on_disk(spark, tmp_path):
    rows = [(f"e{i}", f"r{i % 3}", 86_400_000 * (i % 2) + i, i) for i in range(40)]
    df = spark.createDataFrame(rows, "event_id string, runner_ip string, ts_ms long, ingested_ms long")
    path = str(tmp_path / "events")
    tables.write_events(df.union(df.filter("ingested_ms < 10").withColumn("ingested_ms", F.lit(99).cast("long"))), path)
    assert spark.read.parquet(path).count() == 50
    assert tables.merge_copies(spark, path, "1970-01-01", tables.EVENT_KEY, ["ingested_ms"]) == 5
    left = spark.read.parquet(path)
    assert left.count() == 45 and left.filter("event_id = 'e0'").first()["ingested_ms"] == 99
    assert tables.merge_copies(spark, path, "1970-01-01", tables.EVENT_KEY, ["ingested_ms"]) == 0
    daily = df.groupBy(F.lit("d").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    for _ in range(2):
        tables.overwrite_day(daily, str(tmp_path / "daily"))
    assert spark.read.parquet(str(tmp_path / "daily")).count() == 1
    assert tables.relayout(spark, path, str(tmp_path / "moved"), ["event_id", "runner_ip", "ts_ms", "ingested_ms"]) == (45, 45)


def test_the_first_model_needs_no_incumbent(spark):
    one = spark.createDataFrame([(0.7, 3)], "average_precision double, false_positives long")
    wrong = spark.createDataFrame([(1, 0)], "candidate_wrong long, incumbent_wrong long")
    shadow = spark.createDataFrame([(100, 1, 1, 0, 0)], "rows long, candidate_alerts long, candidate_runners long, incumbent_alerts long, incumbent_runners long")
    first = learn.promotion_gate(one, one.limit(0), wrong, shadow).collect()
    assert [tuple(r) for r in first] == [(True, "the first model", 0.7, None)]
    later = learn.promotion_gate(one, one, wrong, shadow).first()
    assert not later["promote"] and "wrong on more reviewed events" in later["reason"]


@pytest.mark.parametrize("score", [lambda r: r.choice([0.0, 0.5, 0.5, round(r.random(), 3)]), lambda r: r.random(), lambda r: 0.5 + r.random() / 5000, lambda r: 0.5])
def test_average_precision_is_the_ranking(spark, score):
    """Rounded, continuous, close and equal scores."""
    import random

    r = random.Random(8)
    rows = [(f"{r.randrange(10**6):06d}", score(r), int(r.random() < 0.3)) for _ in range(600)]
    rows = list({x[0]: x for x in rows}.values())
    hits, total = 0, 0.0
    for k, (_, _, label) in enumerate(sorted(rows, key=lambda x: (-x[1], x[0])), 1):
        hits += label
        total += label * hits / k
    got = learn.average_precision(spark.createDataFrame(rows, "event_id string, score double, label int").repartition(5)).first()[0]
    assert abs(got - total / hits) < 1e-12


def test_training_needs_rows(spark):
    import pytest

    with pytest.raises(learn.TooFewRows):
        learn.train_gbt(spark.createDataFrame([(0,)], "label int"))


def test_a_reviewer_is_told_the_whole_event(spark):
    from millrace.settings import BEHAVIOUR

    row = {
        "event_type": "COMPILE_STEP", "runner_ip": "10.0.0.1", "recommended_action": "alert", "rule_hits": "rogue_command", "ml_reason": "", "is_internal_ip": 1, "is_night": 1, "process_uid": 0, "ml_score": 0.125,
        "project": "p", "step": "link", "command": "c" * 200, "parent_process": "make", "exit_code": 0, "duration_ms": 5, "peak_memory_mb": 512, "cache_status": "hit", "error_message": "boom", "triggered_by": "", "reason": "",
        "http_method": "", "url_path": "", "http_status": 0, "bytes_sent": 0, "events_1m": 3, "failed_builds_1m": 2, **{c: 0 for c in BEHAVIOUR},
    }
    told = spark.createDataFrame([row]).select(review.describe().alias("t")).first()["t"].split("\n")
    assert told == [
        "COMPILE_STEP on 10.0.0.1 was judged alert by rogue_command", "internal, at night, user 0, model score 13 of 100",
        "project=p; step=link; command=" + "c" * 80 + "; parent_process=make; duration_ms=5; peak_memory_mb=512; cache_status=hit; error_message=boom", "events_1m=3; failed_builds_1m=2",
    ]
