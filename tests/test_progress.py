"""The streams' own counts and offsets as samples: rates and increases of a real run, a reset included."""

import json
import time

from pyspark.sql import functions as F

from millrace.operators import dq, evaluate
from millrace.streaming import progress


def test_offsets_of_a_report():
    kafka = {"sources": [{"endOffset": {"builds": {"0": 40, "1": 7}}, "latestOffset": {"builds": {"0": 50, "1": 7}}}, {"endOffset": json.dumps({"other": {"0": 3}}), "latestOffset": None}, {"endOffset": 5}, {}]}
    assert progress.offsets_of(kafka, 9) == [("builds", 0, 50, 40, 9), ("builds", 1, 7, 7, 9), ("other", 0, 3, 3, 9)]


def test_rates_over_snapshots(spark):
    reports = [({"builds": {"0": 100}}, {"builds": {"0": 130}}, 0), ({"builds": {"0": 300}}, {"builds": {"0": 310}}, 10_000)]
    rows = [r for done, known, ms in reports for r in progress.offsets_of({"sources": [{"endOffset": done, "latestOffset": known}]}, ms)]
    one = dq.flow_rates(spark.createDataFrame(rows, progress.OFFSETS)).first()
    assert (one["topic"], one["rate"], one["lag"]) == ("builds", 18.0, 10)


def test_counts_of_a_run_and_a_restart(spark, tmp_path):
    source, kept = str(tmp_path / "in"), str(tmp_path / "samples")
    write = lambda n: spark.range(n).coalesce(1).write.mode("append").parquet(source)

    def run(expected):
        listener = progress.Snapshots()
        spark.streams.addListener(listener)
        stream = progress.counted(spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source), "read")
        query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        assert query.awaitTermination(120) and query.exception() is None
        end = time.time() + 30
        while listener.totals.get(("read", "rows"), 0) < expected and time.time() < end:
            time.sleep(0.2)
        spark.streams.removeListener(listener)
        assert listener.flush(spark, kept) and not listener.flush(spark, kept)

    for n in (5, 7, 11):
        write(n)
    run(23)
    write(4)
    run(4)  # another driver: its totals begin at 0
    samples = spark.read.parquet(f"{kept}/counters").filter("counter = 'read' and value > 0")
    told = [r["value"] for r in samples.orderBy("sampled_ms", "value").collect()]
    assert sorted(told[:3])[-1] == 23 and told[-1] == 4
    grown = evaluate.increases(samples.withColumn("ts_ms", F.col("sampled_ms")), ["counter", "label"]).agg(F.sum("increase")).first()[0]
    assert grown == 23 - told[0] + 4  # the first sample of all is where counting begins
    assert dq.counter_increases(samples).first()["increase"] == 0.0  # below its start: nothing gained
