"""The corpus operators as queries over the whole driver tables, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import ann, bpe, collocations, cover_tree, digest, mixing, pii, quality, resampling, sharding, simhash, token_files, url_filter
from millrace.llm.common import documents, materialize, text_or_empty

Query = Callable[[SparkSession, str], DataFrame]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_filter.filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "score")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classify(docs, quality.learn(docs, labels)).select("doc_id", "held_out", "score", "predicted")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), width=4, distance=4)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", "n_chars")
    return sharding.shard(docs).select("doc_id", "source", "n_chars", "slot", "shard")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "spans")
    base = pii.base_of(F.col("spans"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans")
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.nearest(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(documents(spark, sf_dir), str(path), public_tokenizers.PATTERN)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    encode = lambda texts: token_files.word_encoder(path).encode_batch(texts)
    manifest = token_files.write(documents(spark, sf_dir), encode, end_id=2, folder=token_files.new_folder(spark))
    return token_files.read(manifest, zlib.crc32).withColumnRenamed("value", "ids_crc32")


def op10_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", text_or_empty("text").alias("text"))
    docs = docs.withColumn("fingerprint", digest.fingerprint(F.col("text")))
    groups = digest.exact_groups(docs, materialize(docs.select(F.col("doc_id").alias("id"), "fingerprint")))
    groups = groups.groupBy("doc_id", "fingerprint").agg(F.min("group_id").alias("group_id"), F.max("group_size").alias("group_size"))
    pairs = digest.next_document(docs, ["text", "fingerprint"]).withColumn("n_chars", F.length("text").cast("long"))
    pairs = pairs.withColumn("edited", digest.edited(F.col("text"), F.col("n_chars"), F.col("next_text")))
    pairs = pairs.withColumn("edited_fingerprint", digest.fingerprint(F.col("edited")))

    def likeness(other_print: str, other: str):
        """1 if the fingerprints are equal and so are the canonical bytes, which are compared then only."""
        same = digest.canonical(F.col("text")) == digest.canonical(F.col(other))
        return F.when(F.col("fingerprint") == F.col(other_print), F.when(same, 1.0).otherwise(0.0)).otherwise(0.0)

    pairs = pairs.select(
        F.col("doc_id").alias("id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.col("fingerprint").alias("own"), "edited_fingerprint",
        likeness("edited_fingerprint", "edited").alias("near_edited"), likeness("next_fingerprint", "next_text").alias("near_next"),
    )
    met = pairs["id"].eqNullSafe(groups["doc_id"]) & (pairs["own"] == groups["fingerprint"])
    return pairs.join(groups, met, "left").select(
        pairs["id"].alias("doc_id"), "n_chars", "edited_sha256", pairs["own"].alias("fingerprint"), "edited_fingerprint", "near_edited", "near_next", "group_id", "group_size"
    )


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resampling.resample(documents(spark, sf_dir), target).select("doc_id", "n_features", "weight", "score", "rank")


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return cover_tree.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(documents(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_url_filter, op2_quality, op3_simhash, op4_sharding, op5_pii, op6_mixing, op7_ann, op8_bpe, op9_token_files, op10_digest,
            op11_resampling, op12_top_k, op13_collocations,
        )
    }


def _op4_sql() -> str:
    table = ",".join(map(str, sharding.fill(sharding.SHARDS)))
    return f"""
        WITH filled AS (SELECT string_split('{table}', ',') AS t),
        placed AS (SELECT doc_id, source, n_chars, CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::UBIGINT % {sharding.SLOTS} AS BIGINT) AS slot FROM documents)
        SELECT doc_id, source, n_chars, slot, printf('shard-%03d', CAST(t[slot + 1] AS INTEGER)) AS shard FROM placed, filled"""


OP6_SQL = rf"""
    WITH sized AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
    per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM sized GROUP BY source),
    weighed AS (SELECT *, CAST([5, 2, 1][(i - 1) % 3 + 1] AS DOUBLE) AS weight, source_size * 2.0::DOUBLE AS cap FROM per),
    levels AS (SELECT *,
        ((SELECT sum(source_size) FROM per) * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
    target AS (SELECT source, source_size, CAST(least(cap, coalesce((SELECT max(level) FROM levels WHERE level <= cap / weight) * weight, cap)) AS DOUBLE) AS target FROM levels),
    rated AS (SELECT s.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
        CAST(('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::UBIGINT AS DOUBLE) / {float(1 << 52)!r}::DOUBLE AS u
        FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target, CAST((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM rated"""


#: crc32 in SQL: the table of a byte's remainders, then one step for each byte of a word.
OP11_SQL = r"""
    WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
    corpus AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    goal AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    per AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(w) AS w FROM corpus) GROUP BY ALL),
    per_goal AS (SELECT w, count(*) AS n FROM (SELECT unnest(w) AS w FROM goal) GROUP BY ALL),
    bytes AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM per UNION SELECT w FROM per_goal)),
    coded AS (SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket FROM bytes, tab),
    s AS (SELECT bucket, sum(n) AS s FROM per JOIN coded USING (w) GROUP BY 1), t AS (SELECT bucket, sum(n) AS t FROM per_goal JOIN coded USING (w) GROUP BY 1),
    gain AS (SELECT b AS bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS g
        FROM (SELECT unnest(range(10000)) AS b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b),
    means AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * g) / sum(n)::DOUBLE) AS BIGINT) AS weight FROM per JOIN coded USING (w) JOIN gain USING (bucket) GROUP BY 1),
    scored AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
        + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM documents LEFT JOIN means USING (doc_id)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <= (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20) THEN r END AS rank FROM ranked"""


OP12_SQL = """
    WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    met AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM met)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


OP13_SQL = r"""
    WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
    worded AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
    grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded, (SELECT unnest([1, 2, 3]) AS k))),
    f AS MATERIALIZED (SELECT lang, k AS words, phrase, count(*) AS n FROM grams GROUP BY ALL),
    words AS (SELECT lang, sum(n) AS n FROM f WHERE words = 1 GROUP BY 1),
    cand AS (SELECT * FROM f WHERE words >= 2 AND n >= 10),
    inner_ AS (SELECT lang, unnest([substr(phrase, 1, length(phrase) - strpos(reverse(phrase), ' ')), substr(phrase, strpos(phrase, ' ') + 1)]) AS phrase, n AS longer FROM cand WHERE words = 3),
    kept AS (SELECT c.* FROM cand c WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.longer >= 50 * c.n)),
    cuts AS (SELECT lang, phrase, n AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS first, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest FROM (SELECT *, unnest(range(1, words)) AS k FROM kept)),
    scored AS (SELECT c.lang, c.phrase, c.a, x.n AS l, y.n AS r, CAST(1000000::HUGEINT * c.a * c.a // (x.n::HUGEINT * y.n) AS BIGINT) AS score, c.k FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    ranked AS (SELECT b.*, w.n, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best b JOIN words w USING (lang))
    SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked WHERE rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express; the others are tested against brute force in tests/llm."""
    return {"op4_sharding": _op4_sql(), "op6_mixing": OP6_SQL, "op11_resampling": OP11_SQL, "op12_top_k": OP12_SQL, "op13_collocations": OP13_SQL}
