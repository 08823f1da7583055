"""What a batch writes to a runner's state follows its own rows, not the window; the features do not change."""

import dataclasses
import random

import pandas as pd

from millrace.settings import LIVE
from millrace.streaming.stateful import FEATURES, RING_PART, RunnerProcessor


class Map(dict):
    """A map state that counts what is written."""

    def __init__(self):
        super().__init__()
        self.written = []

    def iterator(self):
        return iter(list(self.items()))

    def updateValue(self, key, value):  # noqa: N802
        self.written.append(len(value[0]))
        self[key] = value

    def removeKey(self, key):  # noqa: N802
        del self[key]


class Value:
    held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


class Handle:
    def __init__(self):
        self.maps = {}

    def getMapState(self, name, *schema):  # noqa: N802
        return self.maps.setdefault(name, Map())

    def getValueState(self, name, *schema):  # noqa: N802
        return Value()


def rows(n, seed=3):
    r, out, t = random.Random(seed), [], 0
    for i in range(n):
        t += r.choice([0, 100, 2_000, 9_000])
        out.append(
            {"event_id": f"{r.randrange(10**15):016d}", "partition": 0, "offset": i, "ts_ms": t - r.choice([0, 0, 0, 40_000]), "event_type": r.choice(["BUILD_FAILURE", "BUILD_SUCCESS", "ARTIFACT_PUBLISH"]), "exit_code": r.choice([0, 1, 137]),
             "project": r.choice(["", "a", "b"]), "url_path": r.choice(["", "/x", "/y"]), "http_status": r.choice([0, 404, 503]), "bytes_sent": r.randrange(9), "failure_signature": "", "is_rogue_command": 0, "is_failure_signature": i % 2, "is_slow_step": 0, "is_cache_miss": 1}
        )
    return out


def run(sent, size, settings):
    processor, handle = RunnerProcessor(settings, ["event_id", "offset"], False), Handle()
    processor.init(handle)
    out, written = [], []
    for a in range(0, len(sent), size):
        for m in handle.maps.values():
            m.written = []
        out += [f for part in processor.handleInputRows(("r",), iter([pd.DataFrame(sent[a : a + size])]), None) for f in part[["offset", "eff", *FEATURES]].values.tolist()]
        written.append((sum(handle.maps["log"].written), handle.maps["ring"].written))
    return out, written, handle


def test_writes_follow_the_new_rows():
    sent = rows(600)
    whole, _, _ = run(sent, 600, LIVE)
    small, written, handle = run(sent, 10, LIVE)
    assert small == whole
    assert all(log == 10 and len(ring) <= 2 and sum(ring) <= 2 * RING_PART for log, ring in written)
    # what is too old is gone, batch by batch
    kept = [r for part in handle.maps["log"].values() for r in part[0]]
    assert len(kept) < 300 and len(handle.maps["log"]) < 40


def test_the_ring_in_parts_is_the_ring():
    """Redeliveries within and beyond the last N ids, N no multiple of a part."""
    settings = dataclasses.replace(LIVE, recent_ids=100)
    sent = rows(400)
    r = random.Random(8)
    for i in range(30, 400, 7):
        sent[i]["event_id"] = sent[i - r.choice([1, 20, 90, 99, 150])]["event_id"]
    whole, _, _ = run(sent, 400, settings)
    small, _, handle = run(sent, 9, settings)
    ring, at, want = [None] * 100, 0, []
    for x in sent:
        if x["event_id"] not in ring:
            want.append(x["offset"])
            ring[at], at = x["event_id"], (at + 1) % 100
    assert [int(x[0]) for x in small] == [int(x[0]) for x in whole] == want and small == whole
    assert sum(len(v[0]) for v in handle.maps["ring"].values()) == 100
