"""Quality, SimHash, neighbours, BPE, token files, pipeline: edge cases, brute force, round trips and held-out accuracy."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import ann, bpe, quality, queries, simhash, token_files
from millrace.llm.components import components

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["", None, " ", "one", "a b c", "x" * 30_000, "w " * 30_000, "Ä é 中 \U0001f600 \n\n  two  blanks \t", "it's, don't.", "<|endoftext|> x", "\x1c\x85\u00a0y\0z", "same text here now", "same text here now"]


def odd(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(ODD)] + [(None, "nameless text", "en", "s", 1), (3, "one", "en", "s", 1)]
    return spark.createDataFrame(rows, DOCS).withColumns({"Score": F.lit("mine"), "n": F.lit(1)})


def test_quality_holds_out_and_generalises(spark):
    got = queries.op2_quality(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows) / len(rows)
    assert right > 0.85 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got.collect())


def test_quality_rules_compile_and_odd_rows(spark):
    train = spark.createDataFrame([([float(i % 10)] * len(quality.STATISTICS), float(i % 10 > 4)) for i in range(200)], "stats array<double>, label double")
    model = quality.train(train, trees=3, depth=2)
    assert model.rules and str(model)
    for x, s in [(r["stats"], r["s"]) for r in train.select("stats", model.score(F.col("stats")).alias("s")).limit(20).collect()]:
        assert abs(model.score_one(x) - s) < 1e-9
    out = quality.classify(odd(spark), model).collect()
    assert len(out) == len(ODD) + 2 and all(isinstance(r["score"], float) for r in out)
    constant = quality.learn(odd(spark), spark.createDataFrame([], "doc_id long, quality int"))
    assert not constant.rules and abs(quality.classify(odd(spark), constant).first()["score"] - 0.5) < 1e-9
    assert quality.classify(odd(spark).limit(0), constant).count() == 0


def by_hand(text, width):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + width]), 42) for i in range(max(1, len(w) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_is_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").limit(250).collect()
    r, data = random.Random(1), [(x["doc_id"], x["text"]) for x in rows]
    for i, (_, t) in enumerate(data[:60]):  # near copies by a word or two
        w = t.split(" ")
        w[r.randrange(len(w))] = "changed"
        data.append((5000 + i, " ".join(w)))
    data += [(9000 + i, t) for i, t in enumerate(ODD)] + [(None, "x y z")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    prints = {(d, t): by_hand(t, 4) for d, t in data}
    parent = {f: f for f in prints.values()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fs = sorted(parent)
    links = set()
    for i, a in enumerate(fs):
        for b in fs[:i]:
            if (a ^ b).bit_count() <= 4:
                links.add((a, b))
                parent[root(a)] = root(b)
    least = {}
    for (d, _), f in prints.items():
        if d is not None:
            least[root(f)] = min(d, least.get(root(f), d))
    got = simhash.near_duplicates(docs, width=4).collect()
    assert sorted((x["doc_id"] or -1, x["fingerprint"], x["component_id"] or -1) for x in got) == sorted((d or -1, f"{f:016x}", least.get(root(f)) or -1) for (d, _), f in prints.items())
    signed = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fs], "fp long")
    assert simhash.links(signed).count() == len(links)


def test_every_pair_within_the_distance_is_linked(spark):
    r, fps = random.Random(2), set()
    for _ in range(40):
        base = r.getrandbits(64)
        fps |= {base} | {base ^ sum(1 << b for b in r.sample(range(64), r.randrange(1, 7))) for _ in range(12)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    for distance in (4, 5):
        want = {(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance}
        got = [tuple(x) for x in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), distance).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_keep_one(spark):
    words = [f"w{i}" for i in range(4000)]
    r, rows = random.Random(3), []
    for g in range(30):
        base = r.sample(words, 120)
        rows.append((g * 100, " ".join(base)))
        for k in range(1, 4):
            near = list(base)
            near[r.randrange(120)] = "other"  # five of 116 shingles change
            rows.append((g * 100 + k, " ".join(near)))
    alone = [(100_000 + i, " ".join(r.sample(words, 60))) for i in range(200)]
    docs = spark.createDataFrame([*rows, *alone, (0, rows[0][1]), (None, "no id"), (None, "no id"), (None, rows[0][1])], "doc_id long, text string")
    got = simhash.keep_one(docs).collect()
    ids = [x["doc_id"] for x in got]
    assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None}) and ids.count(None) == 1
    assert {i for i, _ in alone} <= set(ids)
    firsts = [i for i in ids if i is not None and i < 100_000]
    assert {g * 100 for g in range(30)} <= set(firsts) and len(firsts) <= 31
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(-200, 200), r.randrange(-200, 200)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7777, 7777)]
    p = {}

    def root(x):
        p.setdefault(x, x)
        while p[x] != x:
            x = p[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        p[y] = x
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(p)}


def test_neighbours(spark):
    got = queries.op7_ann(spark, SF).collect()
    rows = [(x["vec_id"], np.array(x["embedding"], float)) for x in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    ids, x = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hits = 0
    for q in ids[ids % 50 == 0]:
        s = x @ x[ids == q][0]
        s[ids == q] = -9
        best = set(ids[np.argsort(-s)[:5]])
        mine = found[q]
        assert sorted(mine) == [1, 2, 3, 4, 5] and all(abs(s[ids == v][0] - score) < 1e-9 for v, score in mine.values())
        hits += len(best & {v for v, _ in mine.values()})
    assert hits / (5 * len(found)) >= 0.9


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [0.0, 3.0]), (50, [1.0, 0.0]), (None, [1.0, 1.0]), (9, [1.0, 0.0, 2.0]), (8, [0.0, 3.0])]
    rows += [(1000 + i, [1.0, 0.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.nearest(df, df.filter("vec_id = 50"), k=5).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(1, 1.0), (2, 1.0), (1000, 1.0), (1001, 1.0), (1002, 1.0)]
    few = df.filter("vec_id in (8, 50)")
    assert [(r["vec_id"], r["score"]) for r in ann.nearest(few, few.filter("vec_id = 50")).collect()] == [(8, 0.0)]
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))


def test_transducer_is_the_library(spark, ranks):
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = bpe.Codec(ranks, P.PATTERN, most_words=50)
    coder.transducer.most_states = 300  # the bounded tables overflow
    texts = [t for t in ODD if t] + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    r = random.Random(6)
    texts += ["".join(r.choice(" \n\t  abé中\U0001f60019.,!'s\x85\x1c <|>theoftion") for _ in range(r.randrange(60))) for _ in range(1500)]
    for t in texts:
        ids = coder.encode(t)
        assert ids == lib.encode_ordinary(t), t[:80]
        assert "".join(x for _, x in coder.decode_stream(ids, 3)) == t
    assert coder.encode("") == []


def test_pair_rule_is_merging(ranks):
    t, r = bpe.Transducer(ranks), random.Random(7)
    ids = [i for i in range(30_000) if t.reachable(i)]
    for _ in range(3000):
        a, b = r.choice(ids), r.choice(ids)
        assert t.follows(a, b) == (bpe.merge(t.token[a] + t.token[b], ranks) == [t.token[a], t.token[b]])


def test_encode_and_decode_tables(spark, ranks):
    path = str(P.path("byte_bpe_multi_50k.tiktoken"))
    out = bpe.decode_documents(bpe.encode_documents(odd(spark), path, P.PATTERN), path, P.PATTERN).collect()
    assert len(out) == len(ODD) + 2 and all(r["decoded"] == (r["text"] or "") and r["n_tokens"] == len(r["ids"]) and r["Score"] == "mine" for r in out)
    for r in bpe.round_trip(odd(spark), path, P.PATTERN).filter("doc_id is not null").collect():
        assert r["decoded_sha256"] == hashlib.sha256((ODD[r["doc_id"]] or "").encode()).hexdigest()
    assert base64 and bpe.round_trip(odd(spark).limit(0), path, P.PATTERN).count() == 0


def test_token_files(spark):
    from tokenizers import Tokenizer

    lib, path = Tokenizer.from_file(P.path("byte_bpe_50k.json")), P.path("byte_bpe_50k.json")
    folder = token_files.new_folder(spark)
    encode = lambda texts: token_files.word_encoder(path).encode_batch(texts)
    manifest = token_files.write(odd(spark), encode, 2, folder, files=3)
    got = sorted(token_files.read(manifest, zlib.crc32).collect(), key=lambda r: r["start"])
    order = sorted([(i, t or "") for i, t in enumerate(ODD)] + [(-1, "nameless text"), (3, "one")], key=lambda x: (x[0], x[1].encode()))
    at = 0
    for r, (i, text) in zip(got, order, strict=True):
        ids = [*lib.encode(text, add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["value"]) == (None if i < 0 else i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), text[:40]
        at += len(ids)
    uri = manifest.orderBy("file").first()["uri"]
    reader = token_files.Reader(uri)
    raw = open(uri.removeprefix("file://"), "rb").read()
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert whole == b"".join(reader.read(k) for k in range(len(reader)))
    bad = bytearray(raw)
    bad[len(token_files.frame(reader.read(0))[0]) - 1] ^= 1
    broken = uri.removeprefix("file://") + ".bad"
    open(broken, "wb").write(bad)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.Reader("file://" + broken).read(0)
    assert token_files.read(token_files.write(odd(spark).limit(0), encode, 2, token_files.new_folder(spark), files=2), zlib.crc32).count() == 0


def test_pipeline(spark, tmp_path):
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet").limit(300), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs.count())
        assert name == "bpe" or docs.columns == DOCS.replace(",", "").split()[::2]
    assert 300 > kept[0] >= kept[1] == kept[2] and kept[3] == kept[4] > 0
    coder = bpe.codec(str(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)
    before = {r["doc_id"]: r["text"] for r in spark.read.parquet(str(tmp_path / "mixing")).collect()}
    assert all("".join(t for _, t in coder.decode_stream(r["ids"])) == before[r["doc_id"]] for r in docs.limit(20).collect())
