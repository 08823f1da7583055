"""Approximate nearest neighbours by cosine: inverted lists, scanned block by block of dimensions with early abandonment.

Vectors are scaled to length one and rotated by a random orthogonal matrix, so that any block of columns is a fair sample
of the whole and the partial squared distance over d of D columns estimates the full one. Within each probed list a
candidate is abandoned as soon as its partial distance, scaled to D, exceeds the present bound (the k-th best found) by
more than a test at level `slack` allows; what survives all blocks gets its exact cosine on the original vectors.

Index: the centroids are fitted on a bounded sample (default 20,000 vectors, those of the smallest hash of their id), the
number of probed lists is set on the same sample so that `recall` of the true neighbours of up to 200 of its members lie
in the probed lists, and every vector is indexed. Lists over `rows` vectors are split into chunks, and queries of a list
into parts, so a list with a third of all vectors is many tasks, and nothing is left out.

Of vectors that are equal in every component only the k + 1 of smallest id are searched: no other can be among the k
nearest of any query. Equal queries are searched once.

Defined results: null, zero, and vectors with null or non-finite components take no part, nor do vectors of another length
than most. Repeated rows count once. With fewer than k other vectors all are returned; ties go to the smaller id. Rows of a null id take no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialize

SAMPLE, ROWS, PART, SEED = 20_000, 4_096, 1_024, 11
RECALL, SLACK, BLOCKS, AT_ONCE = 0.97, 2.1, 4, 256
MOST_LISTS = 4_096


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one, whatever their scale."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row in double precision."""
    scale_a, scale_b = np.abs(a).max(axis=-1, keepdims=True), np.abs(b).max(axis=-1, keepdims=True)
    a, b = a / scale_a, b / scale_b
    return (a * b).sum(-1) / (np.sqrt((a * a).sum(-1)) * np.sqrt((b * b).sum(-1)))


def probes_for(sample: np.ndarray, centres: np.ndarray, k: int, recall: float) -> int:
    """How many lists to probe: as many as hold the given share of the k nearest of up to 200 members of the sample."""
    some = sample[: min(200, len(sample))]
    near = some @ sample.T
    near[np.arange(len(some)), np.arange(len(some))] = -2
    top = np.argsort(-near, axis=1)[:, : min(k, max(len(sample) - 1, 1))]
    home = np.argmax(sample @ centres.T, axis=1)
    rank = np.argsort(np.argsort(-(some @ centres.T), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(rank, home[top], axis=1).ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1


def scan(queries: pd.DataFrame, rows: pd.DataFrame, k: int, blocks: int = BLOCKS, slack: float = SLACK, at_once: int = AT_ONCE) -> pd.DataFrame:
    """The k best of rows (id, v, y) for each of queries (q, v, y, bound): (query, vec_id, score).

    Rows come in portions. A candidate is given up in the block of dimensions in which its partial distance shows it to be
    over the bound, the k-th best found so far: that of the query's earlier lists at first, and lower after each portion.
    """
    y, ids, v = np.stack(rows["y"].to_list()).astype(float), rows["id"].to_numpy(), np.stack(rows["v"].to_list()).astype(float)
    dims, found = y.shape[1], []
    cuts = np.linspace(0, dims, min(blocks, dims) + 1).astype(int)
    for q, own, x, bound in zip(queries["q"], queries["v"], queries["y"], queries["bound"].to_numpy(float), strict=True):
        x = np.asarray(x, float)
        best_at, best = np.empty(0, int), np.empty(0)
        for first in range(0, len(y), at_once):
            live, part = np.arange(first, min(first + at_once, len(y))), 0.0
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = part + ((y[live, a:b] - x[a:b]) ** 2).sum(1)
                over = bound + 1e-6 if b == dims else bound * (1 + slack / np.sqrt(b)) ** 2 * b / dims + 1e-6
                live, part = live[part <= over], part[part <= over]
            best_at, best = np.concatenate((best_at, live)), np.concatenate((best, part))
            if len(best) > k:
                bound = min(bound, np.partition(best, k - 1)[k - 1])
                best_at, best = best_at[best <= bound + 1e-6], best[best <= bound + 1e-6]
        score = cosine(v[best_at], np.asarray(own, float)[None, :])
        order = np.lexsort((ids[best_at], -score))[:k]
        found.append(pd.DataFrame({"query": q, "vec_id": ids[best_at][order], "score": score[order]}))
    return pd.concat(found, ignore_index=True) if found else pd.DataFrame({"query": [], "vec_id": [], "score": []})


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE, rows: int = ROWS, part: int = PART, recall: float = RECALL, seed: int = SEED) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries its k nearest rows of vectors but itself."""
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    pick = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter(F.col("id").isNotNull() & usable(F.col("v")))
    good = pick(vectors)
    sizes = good.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], result)
    dims, total = int(sizes["d"]), int(sizes["n"])
    good = good.filter(F.size("v") == dims)
    asked = pick(queries).filter(F.size("v") == dims).dropDuplicates(["id", "v"])

    # of equal vectors the k + 1 smallest ids
    order = Window.partitionBy("v").orderBy("id")
    index = good.withColumn("n", F.dense_rank().over(order)).filter(F.col("n") <= k + 1).drop("n").dropDuplicates(["v", "id"])
    learnt = materialize(good.orderBy(F.xxhash64("id"), "id").limit(sample))
    points = unit(np.array([r["v"] for r in learnt.select("v").toLocalIterator()]))
    lists = int(min(MOST_LISTS, max(1, np.sqrt(total)), max(1, len(np.unique(points, axis=0)) // 4)))
    if lists > 1:
        norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
        scaled = learnt.select(array_to_vector(F.transform("v", lambda x: x / norm)).alias("features"))
        centres = unit(np.array(KMeans(k=lists, maxIter=8, seed=seed, initMode="random").fit(scaled).clusterCenters()) + 1e-12)
        probes = probes_for(points, centres, k, recall)
    else:
        centres, probes = points[:1], 1
    del points
    shared = spark.sparkContext.broadcast((centres, rotation(dims, seed)))

    @F.pandas_udf("lists array<int>, y array<float>")
    def placed(v: pd.Series, n: pd.Series) -> pd.DataFrame:
        if not len(v):
            return pd.DataFrame({"lists": [], "y": []}, dtype=object)
        x = unit(np.stack(v.to_list()))
        near, wanted = x @ shared.value[0].T, int(n.iloc[0])
        top = np.argmax(near, axis=1)[:, None] if wanted == 1 else np.argsort(-near, axis=1)[:, :wanted]
        return pd.DataFrame({"lists": list(top.astype(np.int32)), "y": list((x @ shared.value[1]).astype(np.float32))})

    # the index: every vector with its list, turned once
    index = index.select("id", "v", placed("v", F.lit(1)).alias("p"))
    index = materialize(index.select("id", "v", "p.y", F.get("p.lists", 0).alias("list")))
    unique = asked.groupBy("v").agg(F.min("id").alias("q")).select("q", "v", placed("v", F.lit(probes)).alias("p"))
    unique = materialize(unique.select("q", "v", "p.y", F.posexplode("p.lists").alias("at", "list")))
    sizes = index.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("chunks"))
    deal_all = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = ["list", "chunk", "part"]

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query": [], "vec_id": [], "score": []}).astype({"query": "int64", "vec_id": "int64"})
        return scan(left, right, k + 1)

    def visit(queries: DataFrame) -> DataFrame:
        """The k + 1 best of each query in each of its lists. A list is dealt in chunks, its queries in parts."""
        parts = queries.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / part).cast("int").alias("parts"))
        deal = F.broadcast(sizes.join(parts, "list"))  # a row for each list, MOST_LISTS at most
        held = index.join(deal, "list").select("list", F.pmod(F.xxhash64("id"), "chunks").cast("int").alias("chunk"), deal_all("parts").alias("part"), "id", "v", "y")
        ask = queries.join(deal, "list").select("list", deal_all("chunks").alias("chunk"), F.pmod(F.xxhash64("q"), "parts").cast("int").alias("part"), "q", "v", "y", "bound")
        return ask.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(search, "query long, vec_id long, score double")

    # the nearest list first; the k-th best found there bounds the search of all others
    nearest_list = materialize(visit(unique.filter("at = 0").withColumn("bound", F.lit(float("inf")))))
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    last = nearest_list.withColumn("n", F.row_number().over(by_score)).filter(F.col("n") == k + 1).select(F.col("query").alias("q"), (F.lit(2.0) - 2 * F.col("score") + 1e-6).alias("bound"))
    others = unique.filter("at > 0").join(last, "q", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    found = nearest_list.unionByName(visit(others))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).select("query", "vec_id", "score")
    # back to every query of the same vector, without its own row
    same = asked.join(unique.select("q", "v").distinct(), "v").select(F.col("id").alias("query_id"), "q")
    out = same.join(found, same["q"] == found["query"]).filter(F.col("vec_id") != F.col("query_id"))
    rank = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    out = out.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
