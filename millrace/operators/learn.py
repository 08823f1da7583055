"""The model's life: labels, data set, split, weights, training, metrics, shadow traffic, the gate and the guard."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.review import id_hash
from millrace.operators.rules import action_for
from millrace.settings import LIVE, MODEL_FEATURES, MODEL_FLAGS, Settings
from millrace.workspace import materialize

PER_SOURCE, HOLDOUT, SPLIT_SEED = 5, 0.2, 13
MIN_ROWS, MIN_INCIDENTS = 2_000, 200
SHADOW = {"hours": 6, "percent": 2, "per_runner": 50, "rows": 20_000}
GATE = {"tolerance": 0.005, "alert_share": 0.005, "growth": 1.5}
GUARD = {"reviewed": 20, "false_share": 0.5}


# labels and data set


def per_runner_sample(normals: DataFrame, n: int = PER_SOURCE, key: str = "runner_ip") -> DataFrame:
    """Up to n events of each runner with weight, the number of its events that each stands for; repeatable, by a hash of the id."""
    order = Window.partitionBy(key).orderBy(id_hash(), "event_id")
    count = F.count(F.lit(1)).over(Window.partitionBy(key))
    out = normals.withColumns({"_n": F.row_number().over(order), "_all": count}).filter(F.col("_n") <= n)
    return out.withColumn("weight", F.col("_all") / F.least("_all", F.lit(n))).drop("_n", "_all")


def collect_labels(truth: DataFrame, n: int = PER_SOURCE) -> DataFrame:
    """(event_id, label, source, weight, detail): every incident event, and the sample of normal ones."""
    scenario = F.coalesce(F.nullif("scenario", F.lit("")), F.lit("normal"))
    truth = truth.withColumn("scenario", scenario)
    shape = lambda df, label: df.select("event_id", F.lit(label).alias("label"), F.lit("simulator").alias("source"), F.col("weight").cast("double").alias("weight"), F.col("scenario").alias("detail"))
    incidents = shape(truth.filter("scenario <> 'normal'").withColumn("weight", F.lit(1.0)), 1)
    return incidents.unionByName(shape(per_runner_sample(truth.filter("scenario = 'normal'"), n), 0))


def latest_labels(labels: DataFrame) -> DataFrame:
    """One label for each event: a reviewer's before any other, the newest first."""
    rank = F.struct((F.col("source") == "reviewer").alias("a"), F.col("labeled_ms").alias("b"), F.col("label").alias("c"))
    best = labels.groupBy("event_id").agg(F.max_by(F.struct("label", "weight", "source"), rank).alias("best"))
    return best.select("event_id", "best.label", "best.weight", (F.col("best.source") == "reviewer").alias("reviewed"))


def training_dataset(events: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored features of the labelled events. Spark picks the side to broadcast by its size."""
    stored = [c for c in MODEL_FEATURES if c not in MODEL_FLAGS]
    return events.select("event_id", "event_type", *stored).join(latest_labels(labels), "event_id")


def vector() -> Column:
    """The model's input as an array of doubles, missing values as 0."""
    flag = lambda t: F.coalesce((F.col("event_type") == t).cast("double"), F.lit(0.0))
    return F.array(*[flag(MODEL_FLAGS[c]) if c in MODEL_FLAGS else F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in MODEL_FEATURES])


def bucket_crc(event_id: Column, seed: int = SPLIT_SEED) -> Column:
    return F.crc32(F.concat(F.lit(f"{seed}:"), event_id).cast("binary")) % 1000 / 1000


def bucket_md5(event_id: Column, seed: int = SPLIT_SEED) -> Column:
    """The same split by a hash that any SQL engine has."""
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), event_id)), 1, 8)
    return F.conv(digest, 16, 10).cast("long") % 1000 / 1000


def split(rows: DataFrame, bucket: Column | None = None, holdout: float = HOLDOUT) -> DataFrame:
    """rows with part: train or holdout. What a reviewer labelled only trains."""
    b = bucket_crc(F.col("event_id")) if bucket is None else bucket
    return rows.withColumn("part", F.when(F.col("reviewed") | (b >= holdout), "train").otherwise("holdout"))


def weights(rows: DataFrame) -> DataFrame:
    """rows with train_weight: a reviewed row counts its weight times the median weight of the sampled normal ones."""
    typical = rows.filter("label = 0 and not reviewed").agg(F.coalesce(F.median("weight"), F.lit(1.0)).alias("_typical"))
    out = rows.crossJoin(F.broadcast(typical))
    return out.withColumn("train_weight", F.when(F.col("reviewed"), F.col("weight") * F.col("_typical")).otherwise(F.col("weight"))).drop("_typical")


class TooFewRows(ValueError):
    """There is not enough to train on."""


def train_gbt(rows: DataFrame, trees: int = 120, depth: int = 4, rate: float = 0.08, seed: int = 7, min_rows: int = MIN_ROWS, min_incidents: int = MIN_INCIDENTS):
    """A gradient-boosted model of Spark ML on (vector, label, train_weight); TooFewRows under the least rows or incidents."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("incidents")).first()
    if seen["n"] < min_rows or seen["incidents"] < min_incidents:
        raise TooFewRows(f"{seen['n']} rows with {seen['incidents']} incidents; {min_rows} and {min_incidents} are needed")
    data = rows.select(array_to_vector(vector()).alias("features"), F.col("label").cast("double").alias("label"), "train_weight")
    return GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed, weightCol="train_weight").fit(data)


def score_gbt(rows: DataFrame, model, out: str = "ml_score") -> DataFrame:
    from pyspark.ml.functions import array_to_vector, vector_to_array

    scored = model.transform(rows.withColumn("features", array_to_vector(vector())))
    return scored.withColumn(out, F.get(vector_to_array("probability"), 1)).drop("features", "rawPrediction", "probability", "prediction")


def export_trees(spark, model, folder: str) -> list[dict]:
    """A trained model as a dump's trees, read from its saved form at folder. Leaves add up to the log-odds: Spark's margin twice."""
    nodes: dict[int, dict[int, dict]] = {}
    for r in spark.read.parquet(f"{folder}/data").select("treeID", "nodeData.*").toLocalIterator():  # trees x nodes of the model
        nodes.setdefault(r["treeID"], {})[r["id"]] = r
    weights = dict(enumerate(model.treeWeights))

    def node(tree: int, k: int) -> dict:
        r, value = nodes[tree][k], 2.0 * weights[tree] * nodes[tree][k]["prediction"]
        if r["leftChild"] < 0:
            return {"leaf": value}
        if r["split"]["numCategories"] != -1:
            raise ValueError("a split on categories: only numbers are known here")
        return {"feature": r["split"]["featureIndex"], "at": r["split"]["leftCategoriesOrThreshold"][0], "value": value, "left": node(tree, r["leftChild"]), "right": node(tree, r["rightChild"])}

    return [node(t, 0) for t in sorted(nodes)]


def dump_ensemble(trees: list[dict]) -> str:
    """The text that load_ensemble() reads."""
    return json.dumps({"objective": "binary", "features": MODEL_FEATURES, "trees": trees})


# ensembles from a dump: a list of trees, a node being {feature, at, value, left, right} or {leaf}


def load_ensemble(text: str) -> list[dict]:
    """The trees of a dump; ValueError if it is no binary model of these features, or no node in it could be walked."""
    dump = json.loads(text)
    if not isinstance(dump, dict) or dump.get("objective") != "binary" or dump.get("features") != MODEL_FEATURES:
        raise ValueError("not a binary model of these features: train it again")

    def sound(node) -> bool:
        if not isinstance(node, dict):
            return False
        if "leaf" in node:
            return isinstance(node["leaf"], (int, float))
        f = node.get("feature")
        return isinstance(f, int) and 0 <= f < len(MODEL_FEATURES) and isinstance(node.get("at"), (int, float)) and sound(node.get("left")) and sound(node.get("right"))

    if not dump.get("trees") or not all(map(sound, dump["trees"])):
        raise ValueError("the model's trees are not whole: export it again")
    return dump["trees"]


def _tree(node: dict, x: Column) -> Column:
    if "leaf" in node:
        return F.lit(float(node["leaf"]))
    return F.when(F.get(x, node["feature"]) <= node["at"], _tree(node["left"], x)).otherwise(_tree(node["right"], x))


def ensemble_score(trees: list[dict], x: Column) -> Column:
    """Probability of an incident: nested conditions, for some twenty trees; larger ones go through score_nodes()."""
    raw = sum((_tree(t, x) for t in trees), F.lit(0.0))
    return F.when(raw > -700, 1.0 / (1.0 + F.exp(-raw))).otherwise(0.0)


def node_table(trees: list[dict]):
    """The trees as arrays (feature, threshold, left, right, value, roots) for vectorised walking."""
    feature, at, left, right, value, roots = [], [], [], [], [], []

    def add(node: dict) -> int:
        k = len(feature)
        for column in (feature, at, left, right, value):
            column.append(0)
        if "leaf" in node:
            feature[k], value[k], left[k], right[k] = -1, node["leaf"], k, k
        else:
            feature[k], at[k], value[k] = node["feature"], node["at"], node.get("value", 0.0)
            left[k], right[k] = add(node["left"]), add(node["right"])
        return k

    roots = [add(t) for t in trees]
    return tuple(map(np.array, (feature, at, left, right, value, roots)))


def score_nodes(trees: list[dict], x: Column) -> Column:
    """Scores of an ensemble of any size: all trees walked together in Arrow batches."""
    table = node_table(trees)

    @F.pandas_udf("double")
    def of(batch: pd.Series) -> pd.Series:
        feature, at, left, right, value, roots = table
        if not len(batch):
            return pd.Series([], dtype="float64")
        rows = np.stack(batch.to_list())
        node = np.tile(roots, (len(rows), 1))
        who = np.arange(len(rows))[:, None]
        while (feature[node] >= 0).any():
            f = feature[node]
            go = np.where(rows[who, np.maximum(f, 0)] <= at[node], left[node], right[node])
            node = np.where(f >= 0, go, node)
        raw = value[node].sum(1)
        return pd.Series(np.where(raw > -700, 1 / (1 + np.exp(-np.maximum(raw, -700))), 0.0))

    return of(x)


def explain(trees: list[dict], x: Column, top: int = 3) -> Column:
    """"ml: a, b, c": the features whose splits raised the score most. Only for rows whose action changed."""
    @F.pandas_udf("string")
    def of(batch: pd.Series) -> pd.Series:
        out = []
        for row in batch:
            credit = np.zeros(len(MODEL_FEATURES))
            for node in trees:
                while "leaf" not in node:
                    child = node["left"] if row[node["feature"]] <= node["at"] else node["right"]
                    credit[node["feature"]] += child.get("leaf", child.get("value", 0.0)) - node.get("value", 0.0)
                    node = child
            best = sorted((i for i in range(len(credit)) if credit[i] > 0), key=lambda i: (-credit[i], -i))[:top]
            out.append("ml: " + ", ".join(MODEL_FEATURES[i] for i in best))
        return pd.Series(out)

    return of(x)


# metrics, shadow traffic, gate, guard


def average_precision(rows: DataFrame, score: str = "score", keys: list[str] | None = None) -> DataFrame:
    """Area under precision and recall over the ranked scores; ties by event_id, null scores last. null without positives.

    No ranking in one task: rows are dealt to ranges of (keys, score, event_id) itself, as many as shuffle partitions, so
    equal scores spread over ranges too. The counts of the ranges, a small table, say how many rows and hits come before
    each, and ranks run within the ranges.
    """
    keys = keys or []
    order = [F.desc(score), F.col("event_id")]
    ranges = rows.select(*keys, score, "event_id", "label").repartitionByRange(*keys, *order)
    rows = materialize(ranges.withColumn("_range", F.spark_partition_id()))
    counts = rows.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"), F.coalesce(F.sum("label"), F.lit(0)).alias("_h"))
    ahead = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*[F.col(c).alias(f"_b{c}") for c in [*keys, "_range"]], F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_rows"), F.coalesce(F.sum("_h").over(ahead), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_range").orderBy(*order)
    rows = rows.withColumns({"_rank": F.row_number().over(inside), "_hits": F.sum("label").over(inside.rowsBetween(Window.unboundedPreceding, 0))})
    rows = rows.join(before, _same([*keys, "_range"]), "inner")
    value = F.sum(F.when(F.col("label") == 1, (F.col("_hits") + F.col("_before")) / (F.col("_rank") + F.col("_rows")))) / F.nullif(F.sum("label"), F.lit(0))
    return rows.groupBy(*keys).agg(value.alias("average_precision")) if keys else rows.agg(value.alias("average_precision"))


def _same(part: list[str]) -> Column:
    met = F.lit(True)
    for c in part:
        met = met & F.col(c).eqNullSafe(F.col(f"_b{c}"))
    return met


def holdout_metrics(rows: DataFrame, score: str = "score", at: float = 0.65, keys: list[str] | None = None) -> DataFrame:
    flagged, hit = F.col(score) >= at, F.col("label") == 1
    n = lambda c: F.count_if(c)
    over = lambda a, b: a / F.nullif(b, F.lit(0))
    return rows.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("rows"), n(hit).alias("incidents"), n(~hit).alias("normal"), n(flagged & ~hit).alias("false_positives"),
        over(n(flagged & hit), n(hit)).alias("recall_at_alert"), over(n(flagged & ~hit), n(~hit)).alias("false_positive_rate_at_alert"),
        over(n(flagged & hit), n(flagged)).alias("precision_at_alert"),
    )


def false_alarm_bound(n: Column) -> Column:
    """The count that chance explains over n: the upper end of a Poisson interval, one expected at least."""
    expected = F.greatest(n, F.lit(1)).cast("double")
    return expected + 1.96 * F.sqrt(expected) + 1.92


def wrong(score: str, at: float = 0.65) -> Column:
    return F.count_if((F.col(score) >= at) != (F.col("label") == 1))


def shadow_sample(events: DataFrame, hours: int = SHADOW["hours"], percent: int = SHADOW["percent"], per_runner: int = SHADOW["per_runner"], rows: int = SHADOW["rows"]) -> DataFrame:
    """Recent traffic with every runner in it: a hashed share of the newest hours, so many of each runner, so many in all."""
    newest = events.agg(F.max("ts_ms").alias("_newest"))
    recent = events.crossJoin(F.broadcast(newest)).filter((F.col("ts_ms") > F.col("_newest") - hours * 3_600_000) & (id_hash() % 100 < percent)).drop("_newest")
    order = Window.partitionBy("runner_ip").orderBy(id_hash(), "event_id")
    kept = recent.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_runner).drop("_n")
    return kept.orderBy(id_hash(), "event_id").limit(rows)


def shadow_alerts(rows: DataFrame, score: str, settings: Settings = LIVE) -> DataFrame:
    """(alerts, runners): events without a rule whose action the score would raise."""
    share = F.least(F.col(score), F.lit(settings.quarantine - 1e-4))
    raised = (F.col("rule_hits") == "") & (action_for(F.greatest("rule_score", share), settings) != action_for(F.col("rule_score"), settings))
    return rows.filter(raised).agg(F.count(F.lit(1)).alias("alerts"), F.countDistinct("runner_ip").alias("runners"))


def promotion_gate(candidate: DataFrame, incumbent: DataFrame, wrong_on: DataFrame, shadow: DataFrame) -> DataFrame:
    """One row (promote, reason, candidate_ap, incumbent_ap) from one-row frames.

    candidate, incumbent: average_precision, false_positives; an empty incumbent is no active model. wrong_on: candidate_wrong, incumbent_wrong.
    shadow: rows, candidate_alerts, candidate_runners, incumbent_alerts, incumbent_runners.
    """
    c = candidate.select(F.col("average_precision").alias("c_ap"), F.col("false_positives").alias("c_fp"))
    i = incumbent.select(F.coalesce("average_precision", F.lit(0.0)).alias("i_ap"), F.col("false_positives").alias("i_fp"))
    # without an active model there is nothing to be worse than
    one = c.join(i, F.lit(True), "left").crossJoin(wrong_on).crossJoin(shadow)
    first = F.col("i_fp").isNull()
    allowed = lambda n: F.greatest(F.col(n) * GATE["growth"], false_alarm_bound(F.col(n)))
    checks = [
        ("ranks worse", F.col("c_ap") + GATE["tolerance"] >= F.col("i_ap")),
        ("more false alarms than chance allows", F.col("c_fp") <= false_alarm_bound(F.col("i_fp"))),
        ("wrong on more reviewed events", F.col("candidate_wrong") <= F.col("incumbent_wrong")),
        ("alone it alerts on too much", F.col("candidate_alerts") <= GATE["alert_share"] * F.col("rows")),
        ("more alerts than the active model", F.col("candidate_alerts") <= allowed("incumbent_alerts")),
        ("alerts on more runners", F.col("candidate_runners") <= allowed("incumbent_runners")),
    ]
    found = F.when(first, "").otherwise(F.concat_ws("; ", *[F.when(~ok, F.lit(text)) for text, ok in checks]))
    reason = F.when(F.col("c_ap").isNull(), "holdout has no incidents").when(first, "the first model").when(found == "", "at least as good").otherwise(F.concat(F.lit("not better: "), found))
    return one.select((F.col("c_ap").isNotNull() & (found == "")).alias("promote"), reason.alias("reason"), F.col("c_ap").alias("candidate_ap"), F.col("i_ap").alias("incumbent_ap"))


def register(spark, path: str, version: str, model, trained_rows: int, metrics: dict, created_ms: int) -> None:
    """Keep a trained model beside the table of models, and append its row with the dump that scoring jobs load."""
    folder = path.rstrip("/")
    model.write().overwrite().save(f"{folder}/files/{version}")
    dump = dump_ensemble(export_trees(spark, model, f"{folder}/files/{version}"))
    load_ensemble(dump)  # what can't be loaded isn't registered
    row = [(version, created_ms, trained_rows, json.dumps(metrics, sort_keys=True), f"{folder}/files/{version}", dump)]
    spark.createDataFrame(row, "version string, created_ms long, trained_rows long, metrics string, model string, dump string").write.mode("append").parquet(f"{folder}/models")


def load_active(spark, path: str) -> tuple[str, Column] | None:
    """(version, score) of the active model at path, for a scoring job that asks again and again; None while none is active."""
    folder = path.rstrip("/")
    active = active_model(spark.read.parquet(f"{folder}/activations"), spark.read.parquet(f"{folder}/models")).first()
    return None if active is None else (active["version"], score_nodes(load_ensemble(active["dump"]), vector()))


def activate(spark, path: str, version: str, reason: str, activated_ms: int) -> None:
    """Append an activation; the newest one names the active model, so going back is an activation too."""
    row = spark.createDataFrame([(version, activated_ms, reason)], "version string, activated_ms long, reason string")
    row.write.mode("append").parquet(f"{path.rstrip('/')}/activations")


def active_model(activations: DataFrame, models: DataFrame) -> DataFrame:
    """The newest activation with its model."""
    newest = activations.orderBy(F.desc("activated_ms"), F.desc("version")).limit(1)
    return newest.join(models, "version")


def guard_rollback(activations: DataFrame, reviews: DataFrame, since_ms: Column, reviewed: int = GUARD["reviewed"], false_share: float = GUARD["false_share"]) -> DataFrame:
    """At most one row (from_version, to_version, reviewed, false_alarms): roll back, if most of the active model's reviewed alerts were false."""
    newest = activations.orderBy(F.desc("activated_ms"), F.desc("version")).limit(1).select(F.col("version").alias("from_version"))
    others = activations.crossJoin(F.broadcast(newest)).filter(F.col("version") != F.col("from_version"))
    earlier = others.groupBy("from_version").agg(F.max_by("version", F.struct("activated_ms", "version")).alias("to_version"))
    own = reviews.filter((F.col("reviewed_ms") > since_ms) & (F.col("why_selected") == "model_alert"))
    stats = own.groupBy(F.col("ml_model").alias("from_version")).agg(F.count(F.lit(1)).alias("reviewed"), F.count_if((F.col("verdict") == "normal") & (F.col("confidence") >= 0.8)).alias("false_alarms"))
    out = earlier.join(stats, "from_version")
    return out.filter((F.col("reviewed") >= reviewed) & (F.col("false_alarms") / F.col("reviewed") > false_share))
