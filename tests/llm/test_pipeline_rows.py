"""Odd rows through all stages of the pipeline, and columns of clashing names."""

import corpus_pipeline
from pyspark.sql import functions as F

from millrace.llm import mixing

CLASHES = ["size", "source_size", "target", "copies", "score", "predicted", "held_out", "node", "key", "spans"]


def odd(spark):
    good = "The committee met on Tuesday and agreed that the plan for the new school should go ahead, because parents had asked for it. "
    rows = [(i, good + f"Note {i} was added by hand number{i} and word{i} tells it apart from others here. " * 3, "en", f"s{i % 3}", 300) for i in range(40)]
    rows += [(100, None, "en", "s1", 0), (101, "", None, None, 0), (102, good * 2000, "en", "s2", 0), (None, good + "no id at all", "en", "s0", 1), (5, rows[5][1], "en", "s2", 300), (103, "mail me at bob@site.org " + good, "en", None, 9)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit("mine") for c in CLASHES})


def test_the_stages_keep_columns_and_rows(spark, sf_dir):
    docs = odd(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        had = docs.count()
        docs = stage(spark, docs, sf_dir)
        if name != "bpe":
            assert docs.columns == columns, name
            docs = spark.createDataFrame(docs.collect(), docs.schema)
            assert {r[c] for r in docs.collect() for c in CLASHES} == {"mine"} or not docs.count(), name
            assert name == "mixing" or docs.count() <= had
    ids = [r["doc_id"] for r in docs.collect()]
    assert len(set(ids)) > 20 and {"doc_id", "source", "n_tokens", "ids"} == set(docs.columns)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd(spark).limit(0), sf_dir).count() == 0


def test_mix_keeps_columns_of_its_own_names(spark):
    docs = odd(spark).filter("text is not null")
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and {r[c] for r in mixed.collect() for c in CLASHES} == {"mine"}
