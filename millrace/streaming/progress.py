"""What the streams say of themselves: observed counts and offsets of each micro-batch, kept as samples of a table."""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

SAMPLES = "counter string, label string, value double, sampled_ms long"
OFFSETS = "topic string, partition int, end_offset long, committed_offset long, sampled_ms long"


def counted(df: DataFrame, name: str) -> DataFrame:
    """df, whose rows each micro-batch counts on its way, without a job of its own."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


def offsets_of(progress: dict, sampled_ms: int) -> list[tuple]:
    """(topic, partition, end_offset, committed_offset, sampled_ms) of a progress report's sources that have offsets by partition."""
    out = []
    for source in progress.get("sources", []):
        read = lambda key: json.loads(source[key]) if isinstance(source.get(key), str) else source.get(key) or {}  # noqa: B023, E731
        done, known = read("endOffset"), read("latestOffset")
        if isinstance(done, dict):
            for topic, parts in done.items():
                if isinstance(parts, dict):
                    newest = known.get(topic) or parts
                    out += [(topic, int(p), int(newest.get(p, at)), int(at), sampled_ms) for p, at in sorted(parts.items())]
    return out


class Snapshots(StreamingQueryListener):
    """Listens to all queries of a session: adds up what counted() observes, notes offsets, and appends both as samples.

    Totals begin at 0 with each listener, so a restarted driver shows as a reset. flush() writes what came since the last
    one; a driver that dies before it loses these samples only, the next ones tell the totals again.
    """

    def __init__(self):
        self.lock, self.totals, self.samples, self.offsets = threading.Lock(), {}, [], []

    def note(self, progress: dict, sampled_ms: int) -> None:
        with self.lock:
            for name, row in (progress.get("observedMetrics") or {}).items():
                for label, n in row.items():
                    self.totals[name, label] = self.totals.get((name, label), 0) + (n or 0)
                    self.samples.append((name, label, float(self.totals[name, label]), sampled_ms))
            self.offsets += offsets_of(progress, sampled_ms)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.note(json.loads(event.progress.json), int(time.time() * 1000))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def flush(self, spark: SparkSession, path: str) -> int:
        """Append the new samples below path; how many there were."""
        with self.lock:
            samples, offsets, self.samples, self.offsets = self.samples, self.offsets, [], []
        if samples:
            spark.createDataFrame(samples, SAMPLES).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/counters")
        if offsets:
            spark.createDataFrame(offsets, OFFSETS).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/offsets")
        return len(samples) + len(offsets)
