"""The corpus pipeline: documents through five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe, mixing, pii, quality, simhash
from millrace.llm.common import set_aside, shared_dir


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, with all their columns as they are.

    Null and empty texts are judged like any other; repeated rows alike; a row without an id is judged, but teaches nothing.
    """
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    own, back = set_aside(docs, ("held_out", "score", "predicted"))
    return back(quality.classify(own, model).filter("predicted = 1"))


def keep_first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies."""
    return simhash.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without personal data; a null text stays null, other columns stay as they are."""
    return pii.sanitise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources, each document as often as it is taken; documents without words and null texts are taken alike."""
    return mixing.mix(docs)


def to_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    # every text is decoded again in its task
    encoded = bpe.encode_documents(docs, path, public_tokenizers.PATTERN, most_words=30_000, most_states=30_000, verify=True)
    return encoded.select("doc_id", "source", "n_tokens", "ids")


STAGES = [
    ("quality classifier", keep_good),
    ("simhash near-dedup", keep_first_of_near_copies),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("bpe", to_token_ids),
]

#: The quality model and the fingerprints cannot be said in SQL; tests/llm has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; those before it are kept as Parquet in the shared folder."""
    base = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
