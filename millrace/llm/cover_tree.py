"""Exact top-k search by inner product: one cover tree over queries and data, searched by pairs of nodes.

The tree is built on a bounded sample (default 20,000 vectors, those of the smallest hash of their id): centres are taken
farthest first, so that every level's centres lie apart by more than its radius, cover the next level within it, and stay
centres further down. Every query and every row of data belongs to the leaf of its nearest centre, and a leaf's radii are
the true distances of all its members, so the sample decides how much is pruned, never what is found.

Queries first visit the leaves whose centres score best, which gives each a kth score. Then the tree is walked by pairs
(query node, data node) from the root: a pair is given up when no vectors within the two radii can score what the worst
query of the query node has as its kth. Surviving pairs of leaves are searched by Spark: a leaf's data in chunks, its
queries in bundles, and within a chunk once more by nodes and radii. Every bound has room for rounding; ties are kept.

Of vectors that are equal in every component only the k + 1 of smallest id are searched: no other can be among the k best
of any query. So a vector that a third of all rows share is no large group, and a full leaf is many chunks.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do vectors of another length
than most (of lengths equally frequent the shorter counts), null ids, and vectors so long (2^62 or more as a squared length)
that products would not fit 64 bits. Zero vectors do take part. Repeated rows count once; rows of one id and different
vectors are rows of their own, and a query passes over all rows of its id. With fewer than k rows all are returned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialize

SCALE, SAMPLE, LEAVES, ROWS, PART, BUNDLES = 256, 20_000, 256, 16_384, 1_024, 64
#: Rows of a chunk that are scored at once, and of a node within a chunk.
AT_ONCE, NODE = 2_048, 256


def farthest_first(points: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, gaps): centres in order, each the farthest from those before, and its distance to them; no two are equal."""
    at = int(np.argmin(((points - points.mean(0)) ** 2).sum(1)))
    chosen, gaps, near = [at], [np.inf], np.linalg.norm(points - points[at], axis=1)
    while len(chosen) < most and near.max() > 0:
        at = int(np.argmax(near))
        chosen.append(at)
        gaps.append(float(near[at]))
        near = np.minimum(near, np.linalg.norm(points - points[at], axis=1))
    return np.array(chosen), np.array(gaps)


@dataclass
class Tree:
    """Centres with the level at which each appears, and the parent of each among the centres of lower levels."""

    centres: np.ndarray
    level: np.ndarray
    parent: np.ndarray

    @classmethod
    def over(cls, points: np.ndarray, leaves: int = LEAVES) -> Tree:
        chosen, gaps = farthest_first(points, leaves)
        centres = points[chosen]
        level = np.zeros(len(chosen), int)
        level[1:] = np.floor(np.log2(gaps[1] / gaps[1:])).astype(int) + 1 if len(chosen) > 1 else 0
        parent = np.zeros(len(chosen), int)
        for j in range(1, len(chosen)):
            above = np.searchsorted(level, level[j])  # levels rise in the order of the centres
            parent[j] = int(np.argmin(((centres[:above] - centres[j]) ** 2).sum(1)))
        return cls(centres, level, parent)

    def nearest(self, x: np.ndarray) -> np.ndarray:
        c = self.centres
        return np.argmin((c * c).sum(1)[None, :] - 2 * (x @ c.T), axis=1)

    def radii(self, leaf: np.ndarray) -> list[np.ndarray]:
        """For each level the radius of each of its nodes, -inf where nothing is below, from those of the leaves."""
        out, depth = [leaf], int(self.level.max())
        for level in range(depth, 0, -1):
            below, here = out[0], out[0].copy()
            for c in np.flatnonzero(self.level == level):
                p = self.parent[c]
                here[p] = max(here[p], np.linalg.norm(self.centres[c] - self.centres[p]) + below[c])
            out.insert(0, here)
        return out

    def lowest(self, leaf: np.ndarray) -> list[np.ndarray]:
        """For each level the least value below each of its nodes."""
        out = [leaf]
        for level in range(int(self.level.max()), 0, -1):
            here = out[0].copy()
            mine = np.flatnonzero(self.level == level)
            np.minimum.at(here, self.parent[mine], out[0][mine])
            out.insert(0, here)
        return out

    def pairs(self, query_radius: np.ndarray, data_radius: np.ndarray, longest: np.ndarray, worst: np.ndarray) -> np.ndarray:
        """The (query leaf, data leaf) pairs that may hold a score of at least the worst kth score of the query leaf.

        A leaf without queries or data has radius -inf. Both sides go down one level at a time.
        """
        c = self.centres.astype(float)
        norm = np.linalg.norm(c, axis=1)
        q_radii, d_radii, worsts = self.radii(query_radius), self.radii(data_radius), self.lowest(worst)
        lengths = [-x for x in self.lowest(-longest)]
        live = np.array([[0, 0]])
        for level in range(int(self.level.max()) + 1):
            if level:
                new = np.flatnonzero(self.level == level)
                live = _below(_below(live, 0, self.parent[new], new), 1, self.parent[new], new)
            q, d = live.T
            rq, rd = q_radii[level][q], d_radii[level][d]
            there = np.isfinite(rq) & np.isfinite(rd)
            q, d, rq, rd = q[there], d[there], rq[there], rd[there]
            most = most_score((c[q] * c[d]).sum(1), norm[q], rq, norm[d], rd, lengths[level][d])
            live = np.stack((q, d), 1)[most >= worsts[level][q]]
        return live


def _below(live: np.ndarray, side: int, parent: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The pairs one level further down on one side: a node goes on as its own child, beside its new ones."""
    out = [live]
    order = np.argsort(parent, kind="stable")
    parent, new = parent[order], new[order]
    first, last = np.searchsorted(parent, live[:, side], "left"), np.searchsorted(parent, live[:, side], "right")
    again = np.repeat(live, last - first, axis=0)
    if len(again):
        again = again.copy()
        again[:, side] = np.concatenate([new[a:b] for a, b in zip(first, last, strict=True)])
        out.append(again)
    return np.concatenate(out)


def most_score(dot: np.ndarray, norm_q: np.ndarray, rq: np.ndarray, norm_d: np.ndarray, rd: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """No vector within rq of the one centre and within rd of the other has a higher product; with room for rounding."""
    by_radius = dot + rq * norm_d + rd * norm_q + rq * rd
    return np.minimum(by_radius, (norm_q + rq) * longest) + 1e-9 * (norm_q + rq) * (norm_d + rd) + 1e-3


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: by doubles where these hold all partial sums, else in 64-bit integers."""
    longest = lambda x: np.sqrt((x.astype(float) ** 2).sum(1).max(initial=0.0))
    if longest(a) * longest(b) < 2.0**52:
        return np.rint(a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def scan(q_ids: np.ndarray, q: np.ndarray, kth: np.ndarray, ids: np.ndarray, data: np.ndarray, k: int, nodes: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position in q, id, score) of each query's k best rows of data that reach its kth score; own ids are passed over.

    nodes: (node of each row, centres, radii) of the data; nodes in which no query can reach its kth score are left out.
    """
    if nodes is not None and len(nodes[1]) > 1:
        of, centres, radii = nodes
        x, none = q.astype(float), np.zeros((len(q), 1))
        most = most_score(x @ centres.T, np.linalg.norm(x, axis=1)[:, None], none, np.linalg.norm(centres, axis=1)[None, :], radii[None, :], np.full((1, 1), np.inf))
        live = (most >= kth[:, None]).any(0)
        ids, data = ids[live[of]], data[live[of]]
    kth, found = kth.copy(), []
    for a in range(0, len(data), AT_ONCE):
        part, own = ids[a : a + AT_ONCE], q_ids[:, None] == ids[None, a : a + AT_ONCE]
        score = products(q, data[a : a + AT_ONCE])
        ranked = np.where(own, -np.inf, score.astype(float))  # only to find where to look: rounding keeps the order, and the scores stay whole numbers
        if len(part) > k:
            kth = np.maximum(kth, np.partition(ranked, len(part) - k, axis=1)[:, len(part) - k])
        i, j = np.nonzero((ranked >= kth[:, None]) & ~own)
        found.append((i, part[j], score[i, j]))
    if not found:
        return np.empty(0, int), np.empty(0, np.int64), np.empty(0, np.int64)
    i, at, score = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((at, -score, i))
    i, at, score = i[order], at[order], score[order]
    rank = np.arange(len(i)) - np.searchsorted(i, i)
    return i[rank < k], at[rank < k], score[rank < k]


def split(data: np.ndarray, node: int = NODE) -> tuple | None:
    """Nodes within a chunk: centres taken farthest first on some of its rows, every row at its nearest, true radii."""
    if len(data) < 2 * node:
        return None
    centres = data[: 8 * node].astype(float)
    centres = centres[farthest_first(centres, len(data) // node)[0]]
    x = data.astype(float)
    of = np.argmin((centres * centres).sum(1)[None, :] - 2 * (x @ centres.T), axis=1)
    radii = np.full(len(centres), -np.inf)
    np.maximum.at(radii, of, np.linalg.norm(x - centres[of], axis=1))
    return of, centres, np.where(np.isfinite(radii), radii, 0.0)


def whole(vector: Column, scale: int = SCALE) -> Column:
    """The components as whole numbers, or null for a vector that takes no part."""
    x = F.transform(vector.cast("array<double>"), lambda v: v * float(scale))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) >= 2.0**31))
    length = F.aggregate(x, F.lit(0.0), lambda s, v: s + F.floor(v).cast("double") * F.floor(v).cast("double"))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.when(length < 2.0**62, F.transform(x, lambda v: F.floor(v).cast("long"))))


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, sample: int = SAMPLE, leaves: int = LEAVES,
    rows: int = ROWS, part: int = PART,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries the k rows of vectors of the highest product, but none of its id."""
    spark = vectors.sparkSession
    pick = lambda df: df.select(F.col(id_col).cast("long").alias("id"), whole(F.col(vector_col), scale).alias("v")).filter("id is not null and v is not null")
    good = pick(vectors)
    sizes = good.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    good = good.filter(F.size("v") == sizes["d"])
    asked = pick(queries).filter(F.size("v") == sizes["d"]).dropDuplicates(["id", "v"])

    sampled = materialize(good.orderBy(F.xxhash64("id"), "id").limit(sample)).select("v").toPandas()["v"]
    points = np.stack(sampled.to_list()).astype(float)
    tree = Tree.over(points, int(min(leaves, max(1, len(points) // 16))))
    shared = spark.sparkContext.broadcast(tree)
    n_leaves = len(tree.centres)

    @F.pandas_udf("leaf int, far double, norm double")
    def placed(v: pd.Series) -> pd.DataFrame:
        if not len(v):
            return pd.DataFrame({"leaf": [], "far": [], "norm": []})
        x = np.stack(v.to_list()).astype(float)
        leaf = shared.value.nearest(x)
        return pd.DataFrame({"leaf": leaf.astype(np.int32), "far": np.linalg.norm(x - shared.value.centres[leaf], axis=1), "norm": np.linalg.norm(x, axis=1)})

    same = Window.partitionBy("v").orderBy("id")
    index = good.withColumn("n", F.dense_rank().over(same)).filter(F.col("n") <= k + 1).drop("n").dropDuplicates(["v", "id"])
    index = materialize(index.withColumn("p", placed("v")).select("id", "v", "p.*"))
    asked = materialize(asked.withColumn("p", placed("v")).select("id", F.xxhash64("v").alias("print"), "v", "p.*"))
    per = lambda df: df.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far"), F.max("norm").alias("norm"))  # noqa: E731  a row for each leaf
    data_stats, query_stats = per(index), per(asked)

    def of_leaves(rows_: list, column: str, nothing: float) -> np.ndarray:
        out = np.full(n_leaves, nothing)
        for r in rows_:
            out[r["leaf"]] = r[column]
        return out

    d_rows, q_rows = data_stats.collect(), query_stats.collect()
    data_n, data_far, data_norm = of_leaves(d_rows, "n", 0), of_leaves(d_rows, "far", -np.inf), of_leaves(d_rows, "norm", 0.0)
    query_far = of_leaves(q_rows, "far", -np.inf)

    # for each leaf of queries the best-scoring leaves of data, until they hold enough rows
    dots = tree.centres @ tree.centres.T
    seeds = []
    for j in range(n_leaves):
        order = [int(i) for i in np.argsort(-dots[j], kind="stable") if data_n[i]]
        held = np.cumsum(data_n[order])
        seeds.append(order[: int(np.searchsorted(held, 4 * (k + 1))) + 1])

    chunks = data_stats.select("leaf", F.ceil(F.col("n") / rows).cast("int").alias("chunks"))
    bundles = query_stats.select(F.col("leaf").alias("own"), F.ceil(F.col("n") / part).cast("int").alias("bundles"))
    deal_all = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = ["leaf", "chunk", "part"]

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, data = right["id"].to_numpy(np.int64), np.stack(right["v"].to_list()).astype(np.int64)
            nodes = split(data)
            for q_ids, prints, v, kth in zip(left["ids"], left["prints"], left["vs"], left["kth"], strict=True):
                q_ids = np.asarray(q_ids, np.int64)
                i, at, score = scan(q_ids, np.asarray(v, np.int64).reshape(len(q_ids), -1), np.asarray(kth, float), ids, data, k, nodes)
                out.append(pd.DataFrame({"query_id": q_ids[i], "print": np.asarray(prints, np.int64)[i], "vec_id": at, "score": score}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({c: np.empty(0, np.int64) for c in ("query_id", "print", "vec_id", "score")})

    def visit(asks: DataFrame, visited: list[list[int]]) -> DataFrame:
        """The k best of each query (id, print, v, own, kth) in the leaves that its own leaf visits."""
        where = spark.sparkContext.broadcast(visited)

        @F.pandas_udf("array<int>")
        def leaves_of(own: pd.Series) -> pd.Series:
            return pd.Series([where.value[i] for i in own], dtype=object)

        packed = asks.join(F.broadcast(bundles), "own").groupBy("own", F.pmod(F.xxhash64("id", "print"), "bundles").alias("bundle"))
        packed = packed.agg(F.collect_list(F.struct("id", "print", "v", "kth")).alias("q"))
        packed = packed.select(
            "own", "bundle", F.col("q.id").alias("ids"), F.col("q.print").alias("prints"), F.flatten("q.v").alias("vs"), F.col("q.kth").alias("kth"), F.explode(leaves_of("own")).alias("leaf")
        )
        parts = packed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BUNDLES).cast("int").alias("parts"))
        deal = F.broadcast(chunks.join(parts, "leaf"))  # a row for each leaf
        held = index.join(deal, "leaf").select("leaf", F.pmod(F.xxhash64("id"), "chunks").cast("int").alias("chunk"), deal_all("parts").alias("part"), "id", "v")
        ask = packed.join(deal, "leaf").select("leaf", deal_all("chunks").alias("chunk"), F.pmod(F.xxhash64("own", "bundle"), "parts").cast("int").alias("part"), "ids", "prints", "vs", "kth")
        return ask.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(search, "query_id long, print long, vec_id long, score long")

    asks = asked.select("id", "print", "v", F.col("leaf").alias("own"))
    first = materialize(visit(asks.withColumn("kth", F.lit(float("-inf"))), seeds))
    best = Window.partitionBy("query_id", "print").orderBy(F.desc("score"), "vec_id")
    last = first.withColumn("n", F.row_number().over(best)).filter(F.col("n") == k).select(F.col("query_id").alias("id"), "print", F.col("score").cast("double").alias("kth"))
    asks = materialize(asks.join(last, ["id", "print"], "left").withColumn("kth", F.coalesce("kth", F.lit(float("-inf")))))
    worst = of_leaves(asks.groupBy(F.col("own").alias("leaf")).agg(F.min("kth").alias("kth")).collect(), "kth", np.inf)
    visited: list[list[int]] = [[] for _ in range(n_leaves)]
    for a, b in tree.pairs(query_far, data_far, data_norm, worst).tolist():
        if b not in seeds[a]:
            visited[a].append(b)
    found = first.unionByName(visit(asks, visited))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
