"""SimHash near-duplicates: one-wildcard segment signatures, equality join, exact check.

A 64-bit fingerprint is cut into three segments. Two fingerprints that differ in at most four bits differ in at most one
bit in one of the segments, so they share that segment with some single bit deleted. Every distinct fingerprint is indexed
under its 64 one-wildcard segment variants; an equality join on the variants finds all candidates, and the join condition
checks the full distance and accepts a pair at its first meeting place alone, so that only true links leave the join, each
once. Components of the links follow.

Copies collapse first: one row stands for all documents of a fingerprint, so a group of thousands of copies costs one.
Candidates per fingerprint grow with the number of fingerprints over 2**20; README says what that means at 10**9 documents.

Defined results: a null text counts as empty; a text without words has fingerprint zero, linked like any other; fewer words
than a shingle make one shingle. Null ids are never the smallest; a component of null ids alone has component_id null.
Repeated rows stay, with equal results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, bounded_broadcast, free_name, materialize, skew_join, text_or_empty
from millrace.llm.components import components, look_up
from millrace.workspace import release

WIDTH, SEED, DISTANCE = 5, 42, 4
#: Offset and width of each segment.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: Shingles hashed at once: bounds the memory that a very long text takes.
BLOCK = 65_536


def simhash(text: str, width: int = WIDTH, seed: int = SEED) -> int:
    """The fingerprint as a signed 64-bit number: A-Z lowered, words between ASCII blanks, xxh64 of each shingle, majority bits."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    ends = (ends - 1)[min(width, len(words)) - 1 :].tolist()
    starts = starts[: len(ends)].tolist()
    digest, votes = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(ends), BLOCK):
        h = np.array([digest(joined[s:e], seed) for s, e in zip(starts[k : k + BLOCK], ends[k : k + BLOCK], strict=True)], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(ends), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column, width: int = WIDTH) -> Column:
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([simhash(t, width) for t in batch], dtype="int64")

    return of(text)


def _variants(fp: Column) -> Column:
    """The 64 keys of a fingerprint: segment and wildcard position above the segment without that bit."""
    keys = []
    for s, (at, width) in enumerate(SEGMENTS):
        part = F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1))
        keys += [part.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << b))) + F.lit(((s << 5) | b) << 22) for b in range(width)]
    return F.array(*keys)


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b), a < b, for every two different fingerprints of prints (column fp, distinct) within the distance.

    Three segments with one wildcard each hold for distances up to five.
    """
    if not 0 <= distance <= 2 * len(SEGMENTS) - 1:
        raise ValueError("three segments find distances up to 5")
    index = prints.select(F.explode(_variants(F.col("fp"))).alias("key"), "fp")
    a, b = index.select("key", F.col("fp").alias("a")), index.select("key", F.col("fp").alias("b"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    parts = [F.shiftrightunsigned(x, at).bitwiseAND(F.lit((1 << width) - 1)) for at, width in SEGMENTS]
    segment, wild = F.shiftright(F.col("key"), 27), F.shiftright(F.col("key"), 22).bitwiseAND(F.lit(31))
    own = F.when(segment == 0, parts[0]).when(segment == 1, parts[1]).otherwise(parts[2])
    bit = F.expr("shiftleft(1L, cast(shiftright(key, 22) & 31 as int))")
    # the first meeting place: this wildcard is the differing bit, or the lowest of an equal segment, and no earlier segment meets
    place = ((own == bit) | ((own == 0) & (wild == 0))) & ((segment == 0) | (F.bit_count(parts[0]) > 1)) & ((segment < 2) | (F.bit_count(parts[1]) > 1))
    met = (F.col("a") < F.col("b")) & (F.bit_count(x) <= distance) & place
    b = b.withColumnRenamed("key", "key_b")
    bit_free = a.join(b, (a["key"] == b["key_b"]) & met)
    return bit_free.select("a", "b")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, distance: int = DISTANCE
) -> DataFrame:
    """(id, fingerprint hex, component_id) for each row of docs; component_id is the smallest id reachable by links."""
    bound_batches(docs.sparkSession)
    prints = docs.select(F.col(id_col).alias("id"), fingerprint(text_or_empty(text_col), width).alias("fp"))
    prints = materialize(prints)
    unique = materialize(prints.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")))
    found = components(materialize(links(unique.select("fp"), distance)))
    rooted = materialize(unique.join(found, unique["fp"] == found["node"], "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n"))
    named = skew_join(rooted.withColumnRenamed("n", "copies"), smallest, "root", rooted.count()).select("fp", "component_id", F.col("copies").alias("n"))
    return skew_join(prints, named, "fp", prints.count()).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


#: The near-copy stage: bits of its fingerprint, the least similarity, and the share of such pairs that some band must meet.
WIDE, SIMILAR, RECALL = 1024, 0.8, 0.98
#: Part of the bits that a pair of the least similarity differs in, and how many of 64 and of all bits it exceeds in one case of
#: a million at most (5 deviations above the mean).
MOVED = math.acos(2 * SIMILAR / (1 + SIMILAR)) / math.pi
WORD_DISTANCE, WIDE_DISTANCE = (math.ceil(n * MOVED + 5 * math.sqrt(n * MOVED * (1 - MOVED))) for n in (64, WIDE))
#: Bits of the parity sketch, the part of two sets' sizes that pairs of the least similarity differ in at most, and the most
#: nodes of very many links whose fingerprints with sketches are broadcast (4 MB); all others are joined by a shuffle.
PARITY, DIFFERENT, HOT_ROWS = 2048, (1 - SIMILAR) / (1 + SIMILAR), 10_000


def _normal(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def node_of(text: str) -> int:
    """A signed 64-bit number for the words of a text; texts of equal words are one node."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(b" ".join(_normal(text)), SEED)).view(np.int64))


def shingle_set(text: str, width: int = WIDTH) -> np.ndarray:
    """The sorted 64-bit hashes of the different shingles."""
    words = _normal(text)
    if not words:
        return np.empty(0, "<u8")
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    ends = (ends - 1)[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[s:e], SEED) for s, e in zip(starts[: len(ends)].tolist(), ends, strict=True)], "<u8"))


def parity_sketch(shingles: np.ndarray) -> bytes:
    """Which of 2,048 cells hold an odd number of the shingles. Two sets differ in at least as many shingles as sketches in bits."""
    cells = np.bincount((shingles & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY)
    return np.packbits((cells & 1).astype(bool), bitorder="little").tobytes()


def wide_print(text: str, width: int = WIDTH) -> bytes:
    """The SimHash of 1,024 bits over the different shingles; each hash is stretched by splitmix64."""
    return print_of(shingle_set(text, width))


def print_of(shingles: np.ndarray) -> bytes:
    votes = np.zeros(WIDE, np.int64)
    steps = np.arange(1, WIDE // 64 + 1, dtype="<u8") * np.uint64(0x9E3779B97F4A7C15)
    for k in range(0, len(shingles), 4096):
        h = shingles[k : k + 4096, None] + steps
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        votes += np.unpackbits(h.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.uint16)
    return np.packbits(2 * votes > len(shingles), bitorder="little").tobytes()


def bands(nodes: int, recall: float = RECALL) -> np.ndarray:
    """The bits of each band: keys two bits longer than log2 of the nodes, so unrelated ones share few, and as many as recall takes."""
    bits = max(12, math.ceil(math.log2(max(nodes, 2))) + 2)
    count = math.ceil(math.log(1 - recall) / math.log1p(-((1 - MOVED) ** bits)))
    random = np.random.RandomState(SEED)
    return np.stack([random.choice(WIDE, bits, replace=False) for _ in range(count)])


def meetings(prints: DataFrame, nodes: int) -> DataFrame:
    """(key, node, f0) for each band in which a node of prints (node, f) is not alone."""
    chosen = bands(nodes)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = np.int64(1) << np.arange(chosen.shape[1], dtype="int64")
        top = np.arange(len(chosen), dtype="int64") << 48
        for batch in batches:
            for k in range(0, len(batch), 256):
                part = batch.iloc[k : k + 256]
                raw = np.frombuffer(b"".join(part["f"]), np.uint8).reshape(len(part), -1)
                bits = np.unpackbits(raw, axis=1, bitorder="little")
                keys = np.stack([bits[:, c].astype("int64") @ powers for c in chosen], axis=1) + top
                first = np.ascontiguousarray(raw[:, :8]).view("<i8")[:, 0]
                yield pd.DataFrame({"key": keys.ravel(), "node": np.repeat(part["node"].to_numpy(), len(chosen)), "f0": np.repeat(first, len(chosen))})

    index = prints.mapInPandas(of, "key long, node long, f0 long")
    index = index.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("key")))
    return materialize(index.filter("m > 1").drop("m"))


def verified(pairs: DataFrame, docs: DataFrame, width: int = WIDTH, similarity: float = SIMILAR) -> DataFrame:
    """The pairs (a, b) whose shingle sets have a Jaccard similarity of at least `similarity`; docs holds node and text."""
    pairs = materialize(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    needed = materialize(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    texts = docs.join(bounded_broadcast(needed, needed.count()), "node", "left_semi")

    @F.pandas_udf("array<long>")
    def shingles(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shingle_set(t, width).view("<i8") for t in batch], dtype=object)

    # texts of one node have equal words: any of them
    sets = materialize(texts.groupBy("node").agg(F.first("text").alias("text")).select("node", shingles("text").alias("set")))
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
    both = both.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("c"))
    return materialize(both.filter(F.col("c") >= F.lit(similarity) * (F.col("na") + F.col("nb") - F.col("c")) - 1e-9).select("a", "b"))


def similar(prints: DataFrame, docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(a, b): verified links between nodes of prints (node, f); their components are those of all pairs that meet in a band.

    First every node meets the least node of each of its buckets. Members that these links already join need not meet again,
    so of each bucket only those outside its largest component meet all members of other components, none left out but the
    least node, which has met them all. A group of thousands of near-copies costs its size that way, and only buckets of many
    unlinked texts cost their square. Pairs leave the join if their whole fingerprints are no further apart than
    WIDE_DISTANCE, and only these have their shingle sets brought together. Where prints also has s (a parity sketch) and n
    (the number of different shingles), pairs that differ in too many shingles by these leave no join either: a bound that
    never rejects a pair of the least similarity, and holds off nearly all others of up to some 2,000 shingles.
    """

    @F.pandas_udf("array<long>")
    def longs(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([np.frombuffer(f, "<i8") for f in batch], dtype=object)

    shared = meetings(prints, prints.count())
    met_any = shared.select("node").distinct()
    sketched = {"s", "n"} <= set(prints.columns)
    more = [longs("s").alias("s"), "n"] if sketched else []
    wide = materialize(prints.join(met_any, "node", "left_semi").select("node", longs("f").alias("w"), *more))
    release(docs.sparkSession)
    # never broadcast: some 400 bytes a node, in the driver's memory several times for each of four joins
    whole = lambda node, w: wide.select(F.col("node").alias(node), *[F.col(c).alias(c + w[1:]) for c in wide.columns[1:]])
    bits = lambda x, y: F.bit_count(F.col(x).bitwiseXOR(F.col(y)))
    distance = lambda x, y, longs: reduce(add, (F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(longs)))
    near = distance("wa", "wb", WIDE // 64) <= WIDE_DISTANCE
    if sketched:
        most = F.lit(DIFFERENT) * (F.col("na") + F.col("nb")) + 1e-6
        near = (F.abs(F.col("na") - F.col("nb")) <= most) & near & (distance("sa", "sb", PARITY // 64) <= most)
    key = Window.partitionBy("key")
    star = shared.withColumn("least", F.min(F.struct("node", "f0")).over(key)).select(F.col("node").alias("a"), F.col("least.node").alias("b"), "f0", F.col("least.f0").alias("g0"))
    star = star.filter("a <> b").filter(bits("f0", "g0") <= WORD_DISTANCE).select("a", "b").distinct()
    star = materialize(star)
    # a node can be the least of many buckets, of thousands of members each
    with_b = look_up(star, whole("b", "wb"), "b", max(1_000, star.count() // HOT_ROWS))
    star = with_b.join(whole("a", "wa"), "a").filter(near)
    links = verified(star.select("a", "b"), docs, width)
    found = components(links)
    release(docs.sparkSession)
    rooted = shared.join(bounded_broadcast(found, found.count()), "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = rooted.repartition(F.col("key"))  # for both windows and the join
    # the least node goes first, so buckets of two, which are most of those that chance fills, carry no fingerprint any further
    rooted = rooted.withColumn("least", F.min("node").over(key)).filter("node <> least")
    rooted = rooted.withColumns({"low": F.min("root").over(key), "high": F.max("root").over(key)}).filter("low <> high")
    rooted = rooted.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("key", "root"))).withColumn("most", F.max(F.struct("m", "root")).over(key)["root"])
    rooted = rooted.select("key", "node", "f0", "root", (F.col("root") != F.col("most")).alias("minor"))
    # rows without any partner by the first 64 bits, as chance fills buckets with, take no fingerprint along either
    partner = rooted.select(F.col("key").alias("met"), F.col("f0").alias("g0"), F.col("root").alias("ra"), F.col("minor").alias("also"))
    partnered = (F.col("key") == F.col("met")) & (F.col("ra") != F.col("root")) & (F.col("minor") | F.col("also")) & (bits("f0", "g0") <= WORD_DISTANCE)
    rooted = materialize(rooted.join(partner, partnered, "left_semi"))
    release(docs.sparkSession)
    x = rooted.filter("minor").select("key", F.col("node").alias("a"), F.col("f0").alias("g0"), F.col("root").alias("ra")).join(whole("a", "wa"), "a")
    met = x.join(
        rooted.join(whole("node", "wb"), "node"),
        (x["key"] == rooted["key"]) & (F.col("ra") != F.col("root")) & (~F.col("minor") | (F.col("a") < F.col("node"))) & (bits("f0", "g0") <= WORD_DISTANCE) & near,
    )
    return links.unionByName(verified(met.select("a", F.col("node").alias("b")), docs, width))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """The rows of docs of which each group of near-copies keeps one: that of its smallest id, of equal ids the smaller node.

    Near-copies are components of similar(): texts whose shingle sets have a similarity of 0.8 or more. A row is known by its
    id and its text, so rows of one id and unrelated texts all stay; of rows equal in both, the first by its JSON stays. A
    group whose ids are all null keeps one row too.
    """

    @F.pandas_udf("long")
    def number(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([node_of(t) for t in batch], dtype="int64")

    # else joins on it filter null ones below, by a Python process of their own that numbers every text again
    number = number.asNondeterministic()

    @F.pandas_udf("node long, f binary, s binary, n long")
    def known(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = ((node_of(t), shingle_set(t, width)) for t in batch)
            rows = [(node, print_of(shingles), parity_sketch(shingles), len(shingles)) for node, shingles in sets]
            yield pd.DataFrame(rows, columns=["node", "f", "s", "n"])

    bound_batches(docs.sparkSession)
    text = text_or_empty(text_col)
    prints = materialize(docs.select(F.col(id_col).alias("id"), known(text).alias("of")).select("id", "of.*"))
    unique = materialize(prints.groupBy("node").agg(*[F.first(c).alias(c) for c in ("f", "s", "n")], F.min("id").alias("least")))
    found = components(similar(unique.select("node", "f", "s", "n"), docs.select(number(text).alias("node"), text.alias("text")), width))
    release(docs.sparkSession)
    rooted = unique.join(found, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    best = rooted.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("nameless"), "least", "node")).alias("best"))
    key, node, again = (free_name(docs, n) for n in ("_kept_id", "_kept_node", "_node"))
    kept = materialize(best.select(F.col("best.least").alias(key), F.col("best.node").alias(node)))
    same = lambda left, i, n: left[i].eqNullSafe(F.col(key)) & (left[n] == F.col(node))
    repeated = prints.groupBy("id", "node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = materialize(kept.join(repeated, same(repeated, "id", "node"), "left_semi"))
    keyed = docs.withColumn(again, number(text))
    out = keyed.join(bounded_broadcast(kept, kept.count()), same(keyed, id_col, again), "left_semi")
    if repeated.isEmpty():
        return out.drop(again)
    repeated = bounded_broadcast(repeated, repeated.count())
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row = free_name(docs, "_row")
    many = out.join(repeated, same(out, id_col, again), "left_semi")
    many = many.groupBy(id_col, again).agg(F.min_by(F.struct(*columns), F.to_json(F.struct(*columns))).alias(row)).select(f"{row}.*")
    return out.join(repeated, same(out, id_col, again), "left_anti").drop(again).unionByName(many)
