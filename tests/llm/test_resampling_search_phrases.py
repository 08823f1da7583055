"""Importance resampling, exact top-k search and collocations against brute force on odd rows."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import collocations, cover_tree, queries, resampling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: All languages, nulls, empty texts, repeated rows, other scripts, ids below zero and beyond 32 bits.
ODD = [
    (1, "the cat sat on the mat " * 9, "en"), (2, None, "en"), (3, "", None), (4, "  \t\n ", "en"), (5, "Über ÜBER Éa 東京 x1 " * 6, "de"), (5, "Über ÜBER Éa 東京 x1 " * 6, "de"),
    (-7, "the dog sat. On the mat, the cat! " * 8, "en"), (1 << 40, "a b\tc d;e f " * 20, None), (6, "one\x0bword\rper\x0cpiece\x00x " * 9, "fr"), (7, "no", "fr"), (8, "the cat sat on the mat " * 9, "en"),
    (9, "x" * 5000 + " the cat " + "y " * 700, "en"), (None, "the cat sat on a mat with the dog " * 4, "en"), (10, "ſtrange K İ words " * 7, "tr"),
]


def table(spark, rows=None):
    """With columns of clashing names."""
    df = spark.createDataFrame(ODD if rows is None else rows, "doc_id long, text string, lang string")
    return df.withColumns({c: F.lit("mine") for c in ("rank", "score", "n", "_at", "prefix", "id")})


# importance resampling


def drawn_by_brute_force(docs, target, runs=(1, 1), percent=10, least=20):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    feats = lambda w: [" ".join(w[i : i + n]) for n in range(runs[0], runs[1] + 1) for i in range(len(w) - n + 1)]
    bucket = lambda f: crc32(f.encode()) % 10_000
    s, t = (Counter(bucket(f) for x in texts for f in feats(words(x))) for texts in ([d[1] for d in docs], target))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(float(t[b] + 1) * (S + 10_000) / (float(s[b] + 1) * (T + 10_000))))
    rows = []
    for i, text, *_ in docs:
        f = feats(words(text))
        weight = sum(gain(bucket(x)) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))))
    enough = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    out = [(*r[:4], k + 1 if k < percent * len(enough) // 100 else None) for k, r in enumerate(enough)]
    return sorted(map(str, out + [(*r[:4], None) for r in rows if r[4] < least]))


@pytest.mark.parametrize("runs", [(1, 1), (1, 2), (2, 3)])
def test_resampling_of_odd_rows(spark, runs, monkeypatch):
    target = spark.createDataFrame([(1, "the cat"), (2, None), (3, "東京 words")], "item_id long, text string")
    got = resampling.resample(table(spark), target, percent=60, runs=runs)
    assert sorted(str((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"])) for r in got.collect()) == drawn_by_brute_force(ODD, ["the cat", None, "東京 words"], runs, 60)


def test_features_across_the_parts_of_a_text():
    text = " ".join(f"w{i}" for i in range(200)).encode()
    whole = [f for _, found in resampling.features(text, (1, 3)) for f in found]
    cut = [f for _, found in resampling.features(text, (1, 3), part=16) for f in found]
    assert sorted(whole) == sorted(cut) and len(whole) == 200 + 199 + 198


def test_radix_places_over_many_blocks(spark, monkeypatch):
    """Small blocks, hot digits, keys over all 64 bits and equal keys, which keep their order."""
    monkeypatch.setattr(resampling, "BLOCK", 3)
    rng = random.Random(5)
    rows = [(rng.choice([0, 0, 0, 7, 1 << 20, (1 << 62) + rng.randrange(9)]), rng.randrange(-3, 3), i) for i in range(300)]
    df = spark.createDataFrame(rows, "a long, b long, i long").coalesce(1).withColumn("_at", F.monotonically_increasing_id())
    from millrace.llm.common import materialize

    placed = resampling.radix_places(materialize(df), [F.col("a"), F.col("b").bitwiseXOR(F.lit(-(1 << 63)))]).collect()
    want = sorted(rows, key=lambda r: (r[0], r[1]))
    assert [r["i"] for r in sorted(placed, key=lambda r: r["_at"])] == [r[2] for r in want]
    assert sorted(r["_at"] for r in placed) == list(range(300))


def test_resampling_of_empty_tables_and_the_draw(spark):
    target = spark.createDataFrame([], "text string")
    assert resampling.resample(table(spark, []), target).count() == 0
    got = resampling.draw(table(spark), target, percent=50)
    chosen = {r["doc_id"] for r in resampling.resample(table(spark), target, percent=50).collect() if r["rank"]}
    assert got.columns == table(spark).columns and {r["doc_id"] for r in got.collect()} == chosen and {r["score"] for r in got.collect()} == {"mine"}


# exact top-k search


def best_by_brute_force(rows, asked, k=5, scale=256):
    usable = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v) and len(v) == 8
    whole = {(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows if i is not None and usable(v)}
    out = []
    for i, v in sorted({x for x in whole if asked(x[0])}):
        found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in whole if j != i)[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_top_k_of_odd_vectors(spark, seed):
    """Clusters, a vector that a third of all share, copies, zero vectors, other lengths, nulls; small leaves, chunks and bundles."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, [4, 1, 0.02][seed], (6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(0, 0.05, 8)).astype(np.float32).tolist()) for i in range(600)]
    rows += [(600 + i, [0.5] * 8) for i in range(300)] + [(i, rows[i][1]) for i in range(0, 40, 5)] + [(900 + i, [0.0] * 8) for i in range(4)]
    rows += [(950, None), (951, [None] + [1.0] * 7), (952, [float("nan")] + [1.0] * 7), (953, [float("inf")] + [1.0] * 7), (954, [1.0]), (None, [1.0] * 8), (10, [3.0] * 8), (955, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"score": F.lit("mine"), "leaf": F.lit(1)})
    got = cover_tree.top_k(df, df.filter("vec_id % 10 = 0"), k=4, leaves=40, rows=64, part=16)
    assert sorted(map(tuple, got.collect())) == best_by_brute_force(rows, lambda i: i % 10 == 0, 4)


def test_top_k_of_few_and_of_large_numbers(spark):
    schema = "vec_id long, embedding array<double>"
    assert cover_tree.top_k(spark.createDataFrame([], schema), spark.createDataFrame([], schema)).count() == 0
    one = spark.createDataFrame([(50, [1.0, 2.0])], schema)
    assert cover_tree.top_k(one, one).count() == 0
    rows = [(i, [float(2_000_000 + i * 0.004), float(-1_999_999 + i), 1e6]) for i in range(30)]
    df = spark.createDataFrame(rows, schema)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in cover_tree.top_k(df, df.filter("vec_id % 7 = 0"), k=3).collect()}
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    for i in range(0, 30, 7):
        found = sorted((-sum(a * b for a, b in zip(whole[i], w, strict=True)), j) for j, w in whole.items() if j != i)[:3]
        assert [got[i, n + 1] for n in range(3)] == [(j, -s) for s, j in found]


def test_cover_tree_holds_its_promises_and_prunes():
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(c, 0.1, (100, 4)) for c in rng.normal(0, 9, (8, 4))])
    tree = cover_tree.Tree.over(points, 64)
    base = np.linalg.norm(tree.centres[1] - tree.centres[0])
    for level in range(1, int(tree.level.max()) + 1):
        at = tree.centres[tree.level <= level]
        apart = np.linalg.norm(at[:, None] - at[None], axis=2) + np.eye(len(at)) * 1e9
        assert apart.min() > base / 2**level
    for c in np.flatnonzero(tree.level > 0):
        assert np.linalg.norm(tree.centres[c] - tree.centres[tree.parent[c]]) <= base / 2.0 ** (tree.level[c] - 1) + 1e-9 and tree.level[tree.parent[c]] < tree.level[c]
    leaf = tree.nearest(points)
    far, n = np.full(len(tree.centres), -np.inf), np.zeros(len(tree.centres))
    np.maximum.at(far, leaf, np.linalg.norm(points - tree.centres[leaf], axis=1))
    np.maximum.at(n, leaf, np.linalg.norm(points, axis=1))
    scores = points @ points.T
    kth = np.sort(scores, axis=1)[:, -5]
    worst = np.full(len(tree.centres), np.inf)
    np.minimum.at(worst, leaf, kth)
    pairs = {tuple(p) for p in tree.pairs(far, far, n, worst).tolist()}
    needed = {(leaf[i], leaf[j]) for i, j in zip(*np.nonzero(scores >= kth[:, None]), strict=True)}
    assert needed <= pairs and len(pairs) < len(tree.centres) ** 2 / 3


# collocations


def phrases_by_brute_force(docs, shortest=2, longest=3, least=10, subsumed=50):
    f = {}
    for _, text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, longest + 1):
                f.setdefault(lang or "und", Counter()).update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if shortest <= len(p) and a >= least}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and inside(p, q) and 100 * b >= subsumed * a for q, b in cand.items()):
                continue
            score, _, l, r = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        n = sum(b for p, b in c.items() if len(p) == 1)
        out += [(lang, k + 1, x[2].decode(), -x[1], x[3], x[4], n, -x[0]) for k, x in enumerate(sorted(rows))]
    return sorted(out)


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_collocations_of_odd_texts(spark, longest, monkeypatch):
    """Portions of a few words, hot prefixes in shards, and buckets that Spark merges."""
    monkeypatch.setattr(collocations, "HOT", 30)
    docs = ODD + [(100 + i, f"new york city number{i % 3} is new york; New York \t new york city {i} new york", "en") for i in range(40)]
    df = table(spark, docs)
    got = collocations.mine(df, longest=longest, portion=50, top=None)
    assert sorted(map(tuple, got.collect())) == phrases_by_brute_force(docs, longest=longest)
    top = collocations.mine(df, longest=longest, top=3)
    assert sorted(map(tuple, top.collect())) == [r for r in phrases_by_brute_force(docs, longest=longest) if r[1] <= 3]


def test_a_bucket_over_its_bound_is_merged_by_spark(spark):
    docs = [(i, f"w{i % 7} w{i % 5} w{i % 3} z", "en") for i in range(300)]
    texts = spark.createDataFrame(docs, "i long, text string, lang string").repartition(7).select("lang", "text")
    packed = collocations.count_stripes(texts, [], {}, 2, 100)
    one, two = ({tuple(r) for r in collocations.merge_stripes(packed, 10, most).groupBy("lang", "prefix", "next").agg(F.sum("n")).collect()} for most in (4_000_000, 3))
    assert one == two and ("en", "", None, 1200) in one and ("en", "", "z", 300) in one


def test_texts_in_parts_and_no_words(spark):
    text = "aa bb, cc dd " * 30
    tokens = b"".join(collocations.parts(text.encode(), 10)).split()
    assert tokens == b"".join(collocations.parts(text.encode())).split() and tokens[-1] == b"\xff"
    assert collocations.mine(table(spark, [])).count() == 0
    assert collocations.mine(table(spark, [(1, None, None), (2, " ;; ", "en")])).count() == 0


def test_the_three_queries_have_their_columns(spark, sf_dir):
    assert queries.op11_resampling(spark, sf_dir).columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert queries.op12_top_k(spark, sf_dir).columns == ["query_id", "rank", "vec_id", "score"]
    assert queries.op13_collocations(spark, sf_dir).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
