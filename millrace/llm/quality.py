"""Quality classifier: a sparse rule ensemble over text statistics.

Trees are grown on a bounded sample of labelled rows; every path from a root is a conjunctive rule on the statistics; a
lasso logistic regression on the rules keeps few of them; what is left compiles to one Spark column expression. The
statistics come from one pass over each whole text (Arrow batches); scoring moves no row.

Bound: at most `sample` labelled rows are fitted on (default 20,000), those of the smallest hash of their id.

Defined results: a null text counts as empty and gets a score like any other; without labels of both kinds the score is the
share of label 1 (0.5 without labels). Labels that are null are left out, and a doc_id labelled more than once counts with
its mean. Repeated rows get equal scores. Columns of the input named held_out, score or predicted are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import eq, mul

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, free_name, materialize, text_or_empty

STATISTICS = [
    "log_chars", "log_words", "word_length", "longest_word", "distinct_words", "repeated_next", "top_word", "upper",
    "digits", "marks", "signs", "bars", "bangs", "line_words", "repeated_lines", "short_words", "wide_chars",
]
SAMPLE = 20_000
TREES, DEPTH, SEED, LASSO = 24, 4, 7, 0.002

_bytes_of = lambda s: np.array([b in s for b in range(256)])
_UPPER, _LETTER = _bytes_of(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _bytes_of(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_DIGIT, _MARK, _SIGN = _bytes_of(b"0123456789"), _bytes_of(b".,;:?'\"()-"), _bytes_of(b"*$%&#@~^=+<>{}[]\\/_`")
_WIDE = np.array([b >= 0xC0 for b in range(256)])


def statistics(text: str) -> list[float]:
    """The numbers of STATISTICS for one whole text; 0 where a share has no base."""
    raw = text.encode("utf-8", "surrogatepass")
    words, n = text.split(), max(len(text), 1)
    if not words:
        return [float(np.log1p(len(text)))] + [0.0] * (len(STATISTICS) - 1)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    w = len(words)
    seen: dict[str, int] = {}
    for x in words:
        seen[x] = seen.get(x, 0) + 1
    lengths = list(map(len, words))
    lines = [x for x in text.split("\n") if x]
    return [
        float(np.log1p(len(text))), float(np.log1p(w)), sum(lengths) / w, float(np.log1p(max(lengths))), len(seen) / w,
        sum(map(eq, words, words[1:])) / w, max(seen.values()) / w, counts[_UPPER].sum() / max(counts[_LETTER].sum(), 1),
        counts[_DIGIT].sum() / n, counts[_MARK].sum() / n, counts[_SIGN].sum() / n, counts[124] / n, counts[33] / n,
        float(np.log1p(w / max(len(lines), 1))), 1 - len(set(lines)) / max(len(lines), 1), sum(x <= 3 for x in lengths) / w,
        counts[_WIDE].sum() / n,
    ]


def statistics_column(text: Column) -> Column:
    """array<double> of STATISTICS."""

    @F.pandas_udf("array<double>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([statistics(t) for t in batch], dtype=object)

    return of(text)


Condition = tuple[int, bool, float]  # statistic, whether it is at most the threshold, the threshold
Rule = tuple[Condition, ...]


def paths(described: str) -> list[Rule]:
    """Every path from a root in the printed form of a tree model, as a conjunction with one bound a side for each statistic."""
    rules: set[Rule] = set()
    stack: list[tuple[int, Condition]] = []
    for line in described.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\deE]+)\)", line)
        if not found:
            if re.match(r" *Tree ", line):
                stack = []
            continue
        depth = len(found[1])
        stack = [x for x in stack if x[0] < depth] + [(depth, (int(found[2]), found[3] == "<=", float(found[4])))]
        tight: dict[tuple[int, bool], float] = {}
        for _, (f, below, at) in stack:
            tight[f, below] = (min if below else max)(at, tight.get((f, below), at))
        rules.add(tuple(sorted((f, below, at) for (f, below), at in tight.items())))
    return sorted(rules)


def rule_column(rule: Rule, stats: Column) -> Column:
    tests = [(F.get(stats, f) <= at) if below else (F.get(stats, f) > at) for f, below, at in rule]
    return reduce(lambda a, b: a & b, tests).cast("double")


class RuleModel:
    """Weighted rules and an intercept, compiled to a column with score()."""

    def __init__(self, rules: list[Rule], weights: list[float], intercept: float):
        kept = [(r, float(w)) for r, w in zip(rules, weights, strict=True) if w]
        self.rules, self.weights, self.intercept = [r for r, _ in kept], [w for _, w in kept], float(intercept)

    def score(self, stats: Column) -> Column:
        total = sum((F.when(rule_column(r, stats) > 0, w).otherwise(0.0) for r, w in zip(self.rules, self.weights, strict=True)), F.lit(self.intercept))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def score_one(self, stats: list[float]) -> float:
        """The same for one row, to check the compiled form against."""
        fits = [all((stats[f] <= at) == below for f, below, at in r) for r in self.rules]
        return float(1 / (1 + np.exp(-self.intercept - sum(map(mul, self.weights, fits)))))

    def __str__(self) -> str:
        show = lambda r: " and ".join(f"{STATISTICS[f]} {'<=' if b else '>'} {at:.4g}" for f, b, at in r)
        return "\n".join([f"{self.intercept:+.3f}", *(f"{w:+.3f} if {show(r)}" for r, w in zip(self.rules, self.weights, strict=True))])


def train(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, seed: int = SEED) -> RuleModel:
    """Fit on (stats array<double>, label double); labelled is small and read several times, so materialize it first."""
    share = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(share) != {0.0, 1.0}:
        p = (share.get(1.0, 0) + 0.5) / (sum(share.values()) + 1)
        return RuleModel([], [], np.log(p / (1 - p)))
    rows = labelled.select("label", "stats", array_to_vector("stats").alias("features"))
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, maxBins=64, minInstancesPerNode=5, subsamplingRate=0.7, featureSubsetStrategy="0.5"
    ).fit(rows)
    rules = paths(forest.toDebugString)
    if not rules:
        p = share[1.0] / sum(share.values())
        return RuleModel([], [], np.log(p / (1 - p)))
    spec = np.array([[i, f, below, at] for i, r in enumerate(rules) for f, below, at in r])

    @F.pandas_udf("array<double>")
    def fits(stats: pd.Series) -> pd.Series:
        x = np.stack(stats.to_list())[:, spec[:, 1].astype(int)]
        held = (x <= spec[:, 3]) == (spec[:, 2] == 1)
        out = np.ones((len(x), len(rules)))
        np.minimum.at(out.T, spec[:, 0].astype(int), held.T.astype(float))
        return pd.Series(list(out), dtype=object)

    rows = materialize(rows.select("label", fits("stats").alias("fits"))).select("label", array_to_vector("fits").alias("features"))
    fit = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=False).fit(rows)
    return RuleModel(rules, list(fit.coefficients.toArray()), fit.intercept)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", sample: int = SAMPLE) -> RuleModel:
    """The model of the labelled rows that are not held out."""
    bound_batches(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")).dropna()
    known = known.filter(~held_out(F.col("id"))).groupBy("id").agg((F.avg("label") >= 0.5).cast("double").alias("label"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty("text").alias("text")).join(F.broadcast(known), "id")
    rows = rows.select("label", statistics_column(F.col("text")).alias("stats"))
    return train(materialize(rows).coalesce(max(1, docs.sparkSession.sparkContext.defaultParallelism)))


def classify(docs: DataFrame, model: RuleModel, id_col: str = "doc_id") -> DataFrame:
    """docs with held_out, score and predicted."""
    bound_batches(docs.sparkSession)
    stats = free_name(docs, "_stats")
    out = docs.withColumn(stats, statistics_column(text_or_empty("text")))
    out = out.withColumns({"score": model.score(F.col(stats)), "held_out": held_out(F.col(id_col))}).drop(stats)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
