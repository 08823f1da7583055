"""A stage of the pipeline asks for one Python process a task: each holds its own tables for as long as it lives."""

import gc

import pandas as pd
import public_tokenizers
from pyspark.sql import functions as F

from millrace.llm import bpe, pii, simhash


def test_redaction_is_one_python_step(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.select(*[F.when(F.col("doc_id") % 20 != 3, F.col(c)).alias(c) if c == "text" else c for c in docs.columns])  # some texts are null
    flagged = spark.createDataFrame([("the", "remove"), ("was", "generalise")], "group string, action string").withColumn("term", F.col("group")).withColumns({"entity": F.lit("any ip"), "disclosed": F.lit(1.0)})
    monkeypatch.setattr(pii, "disclosed_groups", lambda *_: (flagged, None))
    one = pii.sanitise(docs)
    assert one._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    # the same as by the spans, which is the way where the terms are too many to broadcast
    monkeypatch.setattr(pii, "BROADCAST_ROWS", 0)
    two = pii.sanitise(docs)
    assert one.columns == two.columns == docs.columns
    rows = lambda df: sorted(map(str, df.select("doc_id", "text").collect()))
    assert rows(one) == rows(two) and rows(one) != rows(docs)


def test_encoding_leaves_no_codec_behind(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(4)
    path, bound = str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), 1_234
    encoded = bpe.encode_documents(docs, path, public_tokenizers.PATTERN, verify=True, most_words=bound)
    assert encoded.select("doc_id", "n_tokens").count() == docs.count()

    def left(batches):
        for _ in batches:
            yield pd.DataFrame({"n": [sum(isinstance(x, bpe.Codec) and x.most_words == bound for x in gc.get_objects())]})

    # later tasks get the same processes; before, each kept its codec, some 70 MB
    assert spark.range(0, 64, 1, 8).mapInPandas(left, "n long").agg(F.sum("n")).first()[0] == 0


def test_keeping_one_of_near_copies_is_one_python_step(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # before, the join numbered every text a second time for a filter
    assert simhash.keep_one(docs)._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
