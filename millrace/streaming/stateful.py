"""The per-runner state of the event stream: deduplication, rolling features and idle forgetting, row by row in arrival order.

The features are those of millrace.operators.features over the same input. State per runner, all in Spark's state store, so
a lost executor's runners are restored from the checkpoint: the records of the long window, a map entry for what each batch
added, dropped whole when all of it is too old; and the ring of recent ids in parts. A batch writes its own records and the
parts of the ring that it changes, however long the window is. Python handles one runner's new rows at a time.
"""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.settings import LIVE, LONG_FEATURES, SHORT_FEATURES, Settings

RECORD = "eff: bigint, kind: string, project: string, code: int, url: string, status: int, bytes: bigint, oom: int, rogue: int, signature: int, slow: int, miss: int"
#: Ids in a part of the ring.
RING_PART = 64
FEATURES = [*SHORT_FEATURES, *LONG_FEATURES]


def feature_schema() -> str:
    return ", ".join(f"{c} {'double' if c == 'build_frequency' else 'long'}" for c in FEATURES)


class RunnerWindow:
    """The records of one runner's long window and their sums; the short window is counted from the newer end."""

    def __init__(self, settings: Settings, records: list[tuple] = ()):
        self.settings, self.records, self.short = settings, deque(), deque()
        self.sums: Counter[str] = Counter()
        self.brief: Counter[str] = Counter()
        self.values = {c: Counter() for c in ("project", "code", "url")}
        self.newest = None
        for r in records:
            self.add(r)

    @staticmethod
    def _long(r: tuple) -> dict[str, int]:
        kind, status = r[1], r[5]
        return {
            "failed": kind == "BUILD_FAILURE", "oom": r[7], "compile": kind == "COMPILE_STEP", "finished": kind in ("BUILD_SUCCESS", "BUILD_FAILURE"),
            "rogue": r[8], "signature": r[9], "errors": status >= 400, "bytes": r[6], "slow": r[10], "miss": r[11],
        }

    @staticmethod
    def _brief(r: tuple) -> dict[str, int]:
        return {"events": 1, "failed": r[1] == "BUILD_FAILURE", "missing": r[5] == 404}

    @staticmethod
    def _values(r: tuple) -> dict[str, object]:
        return {k: v for k, v in (("project", r[2]), ("code", r[3] if r[3] > 0 else None), ("url", r[4])) if v}

    def add(self, r: tuple) -> None:
        self.newest = r[0]
        self.records.append(r)
        self.short.append(r)
        self.sums.update(self._long(r))
        self.brief.update(self._brief(r))
        for k, v in self._values(r).items():
            self.values[k][v] += 1
        while r[0] - self.records[0][0] > self.settings.long_ms:
            old = self.records.popleft()
            self.sums.subtract(self._long(old))
            for k, v in self._values(old).items():
                self.values[k][v] -= 1
                if not self.values[k][v]:
                    del self.values[k][v]
        while r[0] - self.short[0][0] > self.settings.short_ms:
            self.brief.subtract(self._brief(self.short.popleft()))

    def features(self) -> list:
        s, b, n = self.sums, self.brief, {k: len(v) for k, v in self.values.items()}
        by = {
            "events_1m": b["events"], "failed_builds_1m": b["failed"], "dependency_404_1m": b["missing"], "failed_builds_5m": s["failed"],
            "unique_projects_5m": n["project"], "oom_kills_5m": s["oom"], "distinct_exit_codes_5m": n["code"], "compile_steps_5m": s["compile"],
            "build_frequency": s["finished"] / 5.0, "rogue_commands_5m": s["rogue"], "failure_signatures_5m": s["signature"], "http_errors_5m": s["errors"],
            "distinct_artifacts_5m": n["url"], "published_bytes_5m": s["bytes"], "slow_steps_5m": s["slow"], "cache_misses_5m": s["miss"],
        }
        return [by[c] if c == "build_frequency" else int(by[c]) for c in FEATURES]


def record(row: dict, eff: int) -> tuple:
    kind, code = row["event_type"], int(row["exit_code"])
    return (
        eff, kind, row["project"], code, row["url_path"], int(row["http_status"]), int(row["bytes_sent"]) if kind == "ARTIFACT_PUBLISH" else 0,
        int(row["failure_signature"] == "oom" or code == 137), int(row["is_rogue_command"]), int(row["is_failure_signature"]), int(row["is_slow_step"]), int(row["is_cache_miss"]),
    )


class RunnerProcessor(StatefulProcessor):
    def __init__(self, settings: Settings, columns: list[str], idle: bool):
        self.settings, self.columns, self.idle = settings, columns, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.log = handle.getMapState("log", "batch long", f"rows array<struct<{RECORD}>>")
        self.ring = handle.getMapState("ring", "part int", "ids array<string>")
        self.place = handle.getValueState("place", "batch long, at int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n = self.settings.recent_ids
        entries = sorted((k[0], [tuple(r) for r in v[0]]) for k, v in self.log.iterator())
        window = RunnerWindow(self.settings, [r for _, part in entries for r in part])
        ids = [i for _, part in sorted((k[0], v[0]) for k, v in self.ring.iterator()) for i in part]
        batch_number, at = self.place.get() if self.place.exists() else (0, 0)
        held, changed, added, out = set(ids), set(), [], []
        batch = pd.concat(list(rows), ignore_index=True)
        batch = batch.sort_values(["partition", "offset"], kind="stable")  # a micro-batch has no order within a key
        for row in batch.to_dict("records"):
            prefix = row["event_id"].replace("-", "")[:16].lower()
            if prefix in held:
                continue
            if len(ids) < n:
                ids.append(prefix)
            else:
                held.discard(ids[at])
                ids[at] = prefix
            changed.add(at // RING_PART)
            at = (at + 1) % n
            held.add(prefix)
            ts = int(row["ts_ms"])
            eff = ts if window.newest is None else max(ts, window.newest)
            added.append(record(row, eff))
            window.add(added[-1])
            out.append([row[c] for c in self.columns] + [eff, *window.features()])
        if added:
            self.log.updateValue((batch_number,), (added,))
            for part in changed:
                self.ring.updateValue((part,), (ids[part * RING_PART : min((part + 1) * RING_PART, n)],))
            self.place.update((batch_number + 1, at))
            for number, part in entries:
                if window.newest - part[-1][0] > self.settings.long_ms:
                    self.log.removeKey((number,))
        if self.idle:
            for t in self.handle.listTimers():
                self.handle.deleteTimer(t[0] if isinstance(t, tuple) else t)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.settings.idle_ms)
        if out:
            yield pd.DataFrame(out, columns=[*self.columns, "eff", *FEATURES])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """A runner silent for the idle time is forgotten at once."""
        self.log.clear()
        self.ring.clear()
        self.place.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_features(cleaned: DataFrame, settings: Settings = LIVE, idle: bool = False) -> DataFrame:
    """Cleaned events of a stream with eff and the rolling features. One exchange, on the runner. idle forgets silent runners."""
    columns = [c for c in cleaned.columns if c not in ("ts", *FEATURES)]
    kinds = {f.name: f.dataType.simpleString() for f in cleaned.schema.fields}
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in columns], "eff long", feature_schema()])
    return cleaned.select(*columns).groupBy("runner_ip").transformWithStateInPandas(
        RunnerProcessor(settings, columns, idle), outputStructType=schema, outputMode="Append", timeMode="ProcessingTime" if idle else "None"
    )


def with_timestamp(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.timestamp_millis("ts_ms"))
