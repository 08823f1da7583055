"""What the near-copy stage broadcasts, and so holds in the driver, does not grow with the fingerprints."""

import random

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import simhash
from millrace.llm.components import components


def test_fingerprints_are_not_broadcast(spark, monkeypatch):
    """One bucket of 1,100 near-copies and 20 other pairs: only the node that over a thousand rows look up is broadcast."""
    monkeypatch.setattr(simhash, "bands", lambda nodes: np.zeros((1, 1), int))
    monkeypatch.setattr(simhash, "WORD_DISTANCE", 64)
    r = random.Random(14)
    words = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    base, texts, pairs = words(200), [], []
    for k in range(1_100):
        texts.append(" ".join([*base[: k % 200], f"new{k}", *base[k % 200 + 1 :]]))
    group = set(texts)
    for _ in range(20):
        one = words(120)
        pairs.append((" ".join(one), " ".join([*one[:60], "other", *one[61:]])))
    texts += [t for p in pairs for t in p]
    rows = []
    for t in texts:
        s = simhash.shingle_set(t)
        # the first bit zero, so that all meet in the one bucket
        f = bytearray(simhash.print_of(s))
        f[0] &= 0xFE
        rows.append((simhash.node_of(t), f, bytearray(simhash.parity_sketch(s)), len(s), t))
    # the least node, which all others of the bucket look up, is one of the group
    least = min(n for n, *_, t in rows if t in group)
    rows = [x for x in rows if x[4] in group or x[0] > least]
    pairs = [p for p in pairs if all(simhash.node_of(t) > least for t in p)]
    assert len(pairs) >= 10
    df = spark.createDataFrame(rows, "node long, f binary, s binary, n long, text string").repartition(4)
    df = df.localCheckpoint()

    wide, hint = [], F.broadcast

    def broadcast(of):
        if any("array" in kind or "binary" in kind for _, kind in of.dtypes):
            wide.append(of.count())
        return hint(of)

    monkeypatch.setattr(F, "broadcast", broadcast)
    links = simhash.similar(df.select("node", "f", "s", "n"), df.select("node", "text"))
    root = {x["node"]: x["root"] for x in components(links).collect()}
    # before, every fingerprint that shares a bucket, four times
    assert wide == [1]
    assert {root[simhash.node_of(t)] for t in group} == {least}
    assert all(root[simhash.node_of(a)] == root[simhash.node_of(b)] != least for a, b in pairs)
