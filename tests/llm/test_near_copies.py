"""The near-copy stage against brute force: no candidate of a bucket is skipped, and the similarity decides."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import simhash


def planted(r, kept, n=300, width=5):
    """Two texts of n shingles each whose sets have about the similarity `kept`: words change one by one until it is reached."""
    base = [f"w{r.randrange(10**6)}" for _ in range(n + width - 1)]
    other = list(base)
    while jaccard(" ".join(base), " ".join(other)) > kept:
        other[r.randrange(len(other))] = f"x{r.randrange(10**6)}"
    return " ".join(base), " ".join(other)


def shingles(text, width=5):
    w = text.lower().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / max(1, len(a | b))


def prints_of(spark, texts):
    nodes = [(simhash.node_of(t), bytearray(simhash.wide_print(t)), t) for t in texts]
    df = spark.createDataFrame(nodes, "node long, f binary, text string").repartition(4)
    return df.select("node", "f"), df.select("node", "text"), {n: t for n, _, t in nodes}


def test_links_are_those_of_brute_force(spark):
    r, texts, pairs = random.Random(11), [], []
    for kept in (0.7, 0.75, 0.78, 0.82, 0.85, 0.9):
        for _ in range(40):
            pairs.append(planted(r, kept))
    texts = [t for p in pairs for t in p]
    prints, docs, text_of = prints_of(spark, texts)
    got = {(text_of[a], text_of[b]) for a, b in simhash.similar(prints, docs).collect()}
    got |= {(b, a) for a, b in got}
    assert all(jaccard(a, b) >= 0.8 for a, b in got)
    want = [p for p in pairs if jaccard(*p) >= 0.8]
    assert len(want) >= 100 and sum(p in got for p in want) >= 0.97 * len(want)


def test_no_member_of_a_bucket_is_skipped(spark, monkeypatch):
    """One bucket for all: pairs are found however many others sort between them, and a large group costs no square."""
    monkeypatch.setattr(simhash, "bands", lambda nodes: np.zeros((1, 1), int))
    monkeypatch.setattr(simhash, "WORD_DISTANCE", 64)
    r = random.Random(12)
    pairs = [planted(r, 0.85, 60) for _ in range(25)]
    base = pairs[0][0].split()
    group = [" ".join([*base[:k], "new", *base[k + 1 :]]) for k in range(40)]
    prints, docs, text_of = prints_of(spark, [t for p in pairs for t in p] + group)
    fixed = prints.withColumn("f", F.lit(bytes(128)))
    from millrace.llm.components import components

    root = {text_of[x["node"]]: x["root"] for x in components(simhash.similar(fixed, docs)).collect()}
    assert all(root[a] == root[b] for a, b in pairs if jaccard(a, b) >= 0.8)
    assert len({root[t] for t in group}) == 1 and len(set(root.values())) == len([p for p in pairs if jaccard(*p) >= 0.8])


@pytest.mark.parametrize("nodes", [2, 10**5, 10**8])
def test_bands_grow_with_the_nodes(nodes):
    chosen = simhash.bands(nodes)
    assert nodes / 2 ** chosen.shape[1] <= 0.25 and 1 - (1 - (1 - simhash.MOVED) ** chosen.shape[1]) ** len(chosen) >= simhash.RECALL


def test_the_sketch_rejects_no_link_and_most_others(spark):
    """Pairs on both sides of 0.8 that all meet in one bucket: with sketches the links are the same, and few others are verified."""
    r = random.Random(13)
    pairs = [planted(r, kept, 200) for kept in (0.7, 0.74, 0.78, 0.79, 0.81, 0.83, 0.9) for _ in range(8)]
    for a, b in pairs:
        x, y = (simhash.shingle_set(t) for t in (a, b))
        differing = len(np.setxor1d(x, y))
        bits = int.from_bytes(simhash.parity_sketch(x)) ^ int.from_bytes(simhash.parity_sketch(y))
        assert bits.bit_count() <= differing
        if jaccard(a, b) >= 0.8:
            assert differing <= simhash.DIFFERENT * (len(x) + len(y)) + 1e-6
        elif jaccard(a, b) < 0.76:
            assert bits.bit_count() > simhash.DIFFERENT * (len(x) + len(y))
    prints, docs, _ = prints_of(spark, [t for p in pairs for t in p] + [""])
    rows = [(n, simhash.parity_sketch(simhash.shingle_set(t)), len(simhash.shingle_set(t))) for n, t in docs.collect()]
    sketched = prints.join(spark.createDataFrame(rows, "node long, s binary, n long"), "node")
    links = lambda p: {tuple(sorted(x)) for x in simhash.similar(p, docs).collect()}
    assert links(sketched) == links(prints)
