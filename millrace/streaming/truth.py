"""The detection job watched while it runs: decisions looked up for true events, incidents tallied as they end.

delayed_lookups() joins streams: an event of the truth waits for its decision, and for its refusal, until so long after it
was appended. Watermarks on all sides bound the state; what neither came for is missing, told once, after the wait.

IncidentProcessor keeps one state a runner, read once and written once a visit: events that may still be overtaken, each
scenario's running incident, the newest incident event, and the next timer. It works on rows, as most visits have few. Events are taken in order of their time once the watermark has passed them, so the result does not
depend on the order of arrival. An incident ends when the watermark is past its last event by more than the gap.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.settings import LIVE, Settings

#: Lookups are over so long after an event was appended; a decision or refusal may bear a time so much before the event's.
WAIT_S, SLACK_S = 120, 60


def delayed_lookups(truth: DataFrame, decisions: DataFrame, rejects: DataFrame, late: str = "10 minutes", wait_s: int = WAIT_S, slack_s: int = SLACK_S) -> DataFrame:
    """Each event of the truth with its first decision, else the reason of its refusal, else neither.

    truth: event_id, partition, offset, appended_at and more; decisions: event_id, decided_at and more; rejects: partition,
    offset, reason, rejected_at. Times are timestamps; rows later than `late` may be left out. For streams; frames work too.
    """
    t = truth.withWatermark("appended_at", late)
    # redelivered decisions are copies: the first one stands
    d = decisions.withWatermark("decided_at", late)
    d = (d.dropDuplicatesWithinWatermark(["event_id"]) if d.isStreaming else d.dropDuplicates(["event_id"])).withColumnRenamed("event_id", "_id").withColumn("decided_ms", F.unix_millis("decided_at"))
    within = lambda at: F.expr(f"{at} >= appended_at - interval {slack_s} seconds AND {at} <= appended_at + interval {wait_s} seconds")
    told = t.join(d, (F.col("event_id") == F.col("_id")) & within("decided_at"), "leftOuter").drop("_id", "decided_at")  # one event time goes on
    r = rejects.withWatermark("rejected_at", late).select(F.col("partition").alias("_p"), F.col("offset").alias("_o"), "reason", "rejected_at")
    return told.join(r, (F.col("partition") == F.col("_p")) & (F.col("offset") == F.col("_o")) & within("rejected_at"), "leftOuter").drop("_p", "_o", "rejected_at")


PENDING = "ts: long, event_id: string, scenario: string, action: string"
RUN = "scenario: string, start: long, last: long, events: long, flagged: long, first_flag: long, known: boolean"
STATE = f"pending array<struct<{PENDING}>>, runs array<struct<{RUN}>>, hit long, wake long"
OUTCOME = "kind string, runner_ip string, scenario string, event_id string, start_ms long, end_ms long, events long, flagged long, first_flag_ms long, known_source boolean, affected boolean"
_ROW = Row(*[c.split(" ")[0] for c in OUTCOME.split(", ")])


class IncidentProcessor(StatefulProcessor):
    def __init__(self, settings: Settings):
        self.settings = settings

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("runner", STATE)

    def _close(self, runner: str, scenario: str, run: tuple) -> Row:
        start, last, events, flagged, first, known = run
        return _ROW("incident", runner, scenario, None, start, last, events, flagged, first, known, None)

    def _advance(self, runner: str, new: list[tuple], watermark: int) -> Iterator[Row]:
        """Take all events up to the watermark in order, end what is quiet, keep the rest and wake up for it."""
        pending, running, hit, timer = self.state.get() or ([], [], None, None)
        held = sorted(new + list(map(tuple, pending)), key=lambda e: (e[0], e[2] == "normal", e[1]))  # an incident's event comes before normal ones of its time
        ready, later = [e for e in held if e[0] <= watermark], [e for e in held if e[0] > watermark]
        out, gap = [], self.settings.incident_gap_ms
        runs = {k[0]: tuple(k)[1:] for k in running}
        for ts, event, scenario, action in ready:
            if scenario == "normal":
                if action == "quarantine":
                    affected = hit is not None and ts - hit <= self.settings.containment_ms
                    out.append(_ROW("quarantine", runner, scenario, event, ts, ts, 1, 1, ts, None, affected))
                continue
            run = runs.get(scenario)
            if run is not None and ts - run[1] > gap:
                out.append(self._close(runner, scenario, run))
                run = None
            if run is None:
                run = (ts, ts, 0, 0, None, hit is not None and hit < ts and ts - hit <= self.settings.containment_ms)
            flagged = action != "ok"
            runs[scenario] = (run[0], ts, run[2] + 1, run[3] + flagged, ts if flagged and run[4] is None else run[4], run[5])
            hit = ts
        for scenario, run in list(runs.items()):
            if watermark - run[1] > gap:
                out.append(self._close(runner, scenario, run))
                del runs[scenario]
        if hit is not None and not (watermark - hit <= self.settings.containment_ms or runs or later):
            hit = None
        ends = [run[1] + gap + 1 for run in runs.values()] + ([hit + self.settings.containment_ms + 1] if hit is not None and not runs and not later else [])
        wake = min([e[0] for e in later[:1]] + ends, default=None)
        if wake is not None and wake <= watermark:
            wake = None
        if timer is not None and timer != wake and timer > watermark:
            self.handle.deleteTimer(timer)  # one that is due has gone off
        if wake is not None and wake != timer:
            self.handle.registerTimer(wake)
        if later or runs or hit is not None:
            self.state.update((later, [(scenario, *run) for scenario, run in runs.items()], hit, wake))
        else:
            self.state.clear()
        return iter(out)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = [(r["ts_ms"], r["event_id"], r["scenario"], r["action"]) for r in rows]
        return self._advance(key[0], new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self._advance(key[0], [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def tally(decided: DataFrame, settings: Settings = LIVE, late: str = "10 minutes") -> DataFrame:
    """Ended incidents and quarantined normal events of a stream (event_id, scenario, runner_ip, action, ts_ms), each once.

    kind `incident`: caught if flagged > 0, else missed. kind `quarantine`: affected if its runner's last incident event lies
    within the containment time. Needs the RocksDB state store.
    """
    timed = decided.withColumn("at", F.timestamp_millis("ts_ms")).withWatermark("at", late)
    # other normal events change nothing, so no state is visited for them; they do move the watermark: a filter on its own
    # column is not pushed below it
    timed = timed.filter("scenario <> 'normal' or action = 'quarantine' or at is null")
    keyed = timed.select("runner_ip", "event_id", "scenario", "action", "ts_ms", "at").groupBy("runner_ip")
    return keyed.transformWithState(IncidentProcessor(settings), outputStructType=OUTCOME, outputMode="Append", timeMode="EventTime")
