"""A trained model's exported trees: equal scores, explanations, validity, and a stream that changes models between batches."""

import json
import random

import pytest

from millrace.operators import learn
from millrace.settings import MODEL_FEATURES, MODEL_FLAGS
from millrace.streaming import job

STORED = [c for c in MODEL_FEATURES if c not in MODEL_FLAGS]


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(5)
    out = []
    for i in range(600):
        bad = r.random() < 0.3
        x = {c: float(r.randrange(4)) for c in STORED}
        x["failed_builds_5m"] = r.gauss(9 if bad else 4, 3)
        x["slow_steps_5m"] = r.gauss(3 if bad else 1, 2)
        out.append((f"e{i}", r.choice(["BUILD_FAILURE", "BUILD_SUCCESS", "OTHER"]), int(bad), 1.0 + i % 3, *[x[c] for c in STORED]))
    return spark.createDataFrame(out, "event_id string, event_type string, label int, train_weight double, " + ", ".join(f"{c} double" for c in STORED)).cache()


def train(rows, seed, trees=12):
    return learn.train_gbt(rows, trees=trees, seed=seed, min_rows=100, min_incidents=10)


def test_exported_scores_are_the_models(spark, rows, tmp_path):
    model = train(rows, 1)
    model.write().save(str(tmp_path / "model"))
    trees = learn.load_ensemble(learn.dump_ensemble(learn.export_trees(spark, model, str(tmp_path / "model"))))
    assert len(trees) == 12
    x = learn.vector()
    scored = learn.score_gbt(rows, model).withColumns({"nodes": learn.score_nodes(trees, x), "columns": learn.ensemble_score(trees, x), "why": learn.explain(trees, x)})
    got = scored.select("ml_score", "nodes", "columns", "why", "label").collect()
    assert max(max(abs(r["ml_score"] - r["nodes"]), abs(r["ml_score"] - r["columns"])) for r in got) < 1e-9
    assert len({round(r["nodes"], 6) for r in got}) > 20
    sure = [r["why"] for r in got if r["nodes"] > 0.9]
    assert sure and sum("failed_builds_5m" in w for w in sure) > len(sure) / 2


@pytest.mark.parametrize(
    "broken",
    [{"objective": "regression"}, {"features": ["a"]}, {"trees": []}, {"trees": [{"feature": 99, "at": 1.0, "left": {"leaf": 0}, "right": {"leaf": 1}}]}, {"trees": [{"feature": 0, "at": 1.0, "left": {"leaf": 0}}]}, {"trees": [{"leaf": "x"}]}],
)
def test_a_dump_that_is_no_model_is_refused(broken):
    whole = json.loads(learn.dump_ensemble([{"leaf": 0.5}]))
    assert learn.load_ensemble(json.dumps(whole)) == [{"leaf": 0.5}]
    with pytest.raises(ValueError):
        learn.load_ensemble(json.dumps(whole | broken))


def test_a_stream_changes_models_between_batches(spark, rows, tmp_path):
    """Two registered models; the second becomes active after the first batch; a failing store keeps the last one."""
    path, source = str(tmp_path / "models"), str(tmp_path / "events")
    for version, seed, trees in (("v1", 1, 2), ("v2", 2, 9)):
        learn.register(spark, path, version, train(rows, seed, trees), 600, {"ap": 0.9}, 1)
    learn.activate(spark, path, "v1", "promoted", 1)
    asked = []

    def load():
        asked.append(1)
        if len(asked) == 3:
            raise OSError("the store is away")
        return learn.load_active(spark, path)

    hot, seen = job.HotModel(load, every=1), {}

    def score(batch, batch_id):
        version, column = hot.at(batch_id)
        seen[batch_id] = (version, [r["s"] for r in batch.orderBy("event_id").select(column.alias("s")).collect()])
        if batch_id == 0:
            learn.activate(spark, path, "v2", "promoted", 2)

    for i in range(3):
        rows.limit(50).coalesce(1).write.parquet(f"{source}/part={i}")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(source)
    query = stream.writeStream.foreachBatch(score).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    assert query.awaitTermination(240) and query.exception() is None
    assert [seen[i][0] for i in range(3)] == ["v1", "v2", "v2"]
    assert seen[0][1] != seen[1][1] and seen[1][1] == seen[2][1]
    stored = spark.read.parquet(f"{path}/models").filter("version = 'v2'").first()
    again = rows.limit(50).orderBy("event_id").select(learn.score_nodes(learn.load_ensemble(stored["dump"]), learn.vector()).alias("s")).collect()
    assert [r["s"] for r in again] == seen[1][1]
