"""Target-distribution importance resampling: documents drawn by how much more their words are the target's than the corpus's.

Features (runs of consecutive words) fall into a fixed number of buckets. Both sides are counted over all their texts, a
bucket's gain is the scaled logarithm of the ratio of the smoothed shares, and a document's weight is the mean of its
gains, looked up in one array. Gumbel noise hashed from the id turns the highest scores into a draw without replacement.

The draw is a distributed radix sort, least significant digit first. Every row has a place in the present order; places
are cut into blocks of equal size. A pass counts each block's digits, turns the counts into offsets (of a digit among all,
of a block within a digit), and sends each row to its offset plus its rank within its block, which keeps the order of
equal digits. One exchange on the block serves a pass, blocks are of one size whatever the keys, and digits in which all
rows agree take no pass. The last places are the ranks. Every pass ends in a reliable checkpoint, so places stay as they
are when an executor is lost.

Defined results: a null text has no words; a document without features has weight 0; ids are integers or null, null last
among equal scores; rows of one id and score rank by n_features. Repeated rows all count and rank side by side. Empty tables
give empty results; an empty target or corpus counts zero in every bucket. Columns of the input other than id and text
play no part, and draw() keeps them all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.llm.common import bound_batches, materialize, text_or_empty

RUNS, BUCKETS, SCALE, SEED, LEAST_WORDS, PERCENT = (1, 1), 10_000, 1000, 2024, 20, 10
#: Bits of a digit, and the binary logarithm of a block's rows.
DIGIT, BLOCK = 8, 14
#: Bytes of a text that are cut into words at once, and the features whose buckets a task remembers.
PART, REMEMBERED = 1 << 20, 200_000

#: ASCII letters lower-cased, everything else below 0x80 but digits a blank.
_WORD_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def features(text: bytes, runs: tuple[int, int] = RUNS, part: int = PART) -> Iterator[tuple[int, list[bytes]]]:
    """(new words, features that end in them) for one part of a text after another."""
    text, at, low, high = text.translate(_WORD_BYTES), 0, *runs
    before: list[bytes] = []
    while at < len(text):
        end = text.find(b" ", at + part)
        end = len(text) if end < 0 else end
        new, at = text[at:end].split(), end
        if high == 1:
            yield len(new), new
            continue
        words = before + new
        yield len(new), [b" ".join(words[i - n : i]) for i in range(len(before) + 1, len(words) + 1) for n in range(low, min(high, i) + 1)]
        before = words[len(words) - high + 1 :] if len(words) >= high else words


class _Buckets(dict):
    """Feature -> bucket; the first REMEMBERED are kept."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        found = crc32(feature) % self.buckets
        if len(self) < REMEMBERED:
            self[feature] = found
        return found

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


def bucket_counts(texts: DataFrame, runs: tuple[int, int] = RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts (one column) fall into each bucket; each task sends one row for each of its buckets."""
    bound_batches(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n = _Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                for _, found in features(text.as_py(), runs):
                    n += np.bincount(known.of(found), minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["bucket", "n"])

    counted = texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[counted["bucket"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    return out


def gains(corpus: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))) of each bucket, in doubles."""
    s_all, t_all, n = int(corpus.sum()), int(target.sum()), len(corpus)
    ratio = lambda s, t: float(t + 1) * float(s_all + n) / (float(s + 1) * float(t_all + n))
    return np.array([math.floor(scale * math.log(ratio(s, t))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(id_col: Column, seed: int = SEED, scale: int = SCALE) -> Column:
    """floor(-scale * ln(-ln(u))), u from the first 32 bits of sha256(seed:id)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-float(scale) * F.log(-F.log(u)))


def _pass(rows: DataFrame, at: str, digit: Column) -> DataFrame:
    """rows at their places after one stable counting sort by a digit."""
    block = F.shiftright(at, BLOCK)
    rows = rows.withColumns({"_digit": digit, "_block": block})
    counts = rows.groupBy("_block", "_digit").agg(F.count(F.lit(1)).alias("_n"))
    # where a digit begins among all rows, where a block's share of it begins, and where it begins within the block
    totals = counts.groupBy("_digit").agg(F.sum("_n").alias("_all"))  # a row for each value of a digit: 256 at most
    first = totals.select("_digit", (F.sum("_all").over(Window.orderBy("_digit")) - F.col("_all")).alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("_digit").orderBy("_block")) - F.col("_n")
    inside = F.sum("_n").over(Window.partitionBy("_block").orderBy("_digit")) - F.col("_n")
    moves = counts.withColumn("_before", before).join(F.broadcast(first), "_digit").withColumn("_inside", inside)
    moves = moves.groupBy("_block").agg(F.map_from_entries(F.collect_list(F.struct("_digit", F.col("_first") + F.col("_before") - F.col("_inside")))).alias("_move"))
    rank = F.row_number().over(Window.partitionBy("_block").orderBy("_digit", at)) - 1
    placed = rows.join(moves, "_block").withColumn("_rank", rank)
    return materialize(placed.withColumn(at, F.element_at("_move", F.col("_digit")) + F.col("_rank")).drop("_digit", "_block", "_move", "_rank"))


def radix_places(rows: DataFrame, keys: list[Column], at: str = "_at") -> DataFrame:
    """rows with the column `at` set to their places, from 0, in ascending order of the keys, which are unsigned longs.

    rows are materialised and hold a unique number in `at`, rising from block to block of 2^BLOCK numbers; it orders rows
    that are equal in all keys.
    """
    which = [F.bit_or(k).bitwiseXOR(F.bit_and(k)).alias(f"k{i}") for i, k in enumerate(keys)]
    varying = [(v or 0) % (1 << 64) for v in rows.agg(*which).first()]
    mask, passed = (1 << DIGIT) - 1, False
    for key, bits in reversed(list(zip(keys, varying, strict=True))):
        for shift in range(0, 64, DIGIT):
            if bits >> shift & mask:
                rows, passed = _pass(rows, at, F.shiftrightunsigned(key, shift).bitwiseAND(F.lit(mask)).cast("int")), True
    return rows if passed else _pass(rows, at, F.lit(0))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, runs: tuple[int, int] = RUNS, buckets: int = BUCKETS,
    scale: int = SCALE, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row of docs; rank is null for what is not drawn.

    Drawn are the floor(percent * N / 100) highest scores of the N documents with enough words.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    gain = gains(bucket_counts(texts.select("text"), runs, buckets), bucket_counts(target.select(text_or_empty(target_text).alias("text")), runs, buckets), scale)
    shared = spark.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, gain = _Buckets(buckets), shared.value
        for batch in batches:
            n_words, n_features, weight = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                words = found = total = 0
                for new, some in features(text.as_py(), runs):
                    words, found, total = words + new, found + len(some), total + int(gain[known.of(some)].sum())
                n_words.append(words)
                n_features.append(found)
                weight.append(total // found if found else 0)
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in (n_words, n_features, weight))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_features", "weight"])

    scored = texts.mapInArrow(weigh, "id long, n_words long, n_features long, weight long")
    scored = scored.withColumns({"score": F.col("weight") + noise(F.col("id"), seed, scale), "_at": F.monotonically_increasing_id()})
    scored = materialize(scored)
    enough = scored.filter(F.col("n_words") >= least_words)
    seen = enough.agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("top")).first()
    drawn = seen["n"] * percent // 100
    # highest score first, then the smaller id, null after all; ids as unsigned numbers in their signed order
    signed = F.coalesce("id", F.lit(0)).bitwiseXOR(F.lit(-(1 << 63)))
    placed = radix_places(enough, [F.lit(seen["top"] or 0) - F.col("score"), F.col("id").isNull().cast("long"), signed, F.col("n_features")])
    rank = F.when(F.col("_at") < drawn, F.col("_at") + 1)
    out = placed.withColumn("rank", rank).unionByName(scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", "rank")


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The rows of docs whose id is drawn, with all their columns; the rows of an id go together."""
    chosen = resample(docs, target, id_col=id_col, **how).filter("rank is not null").select(F.col(id_col).alias("_drawn_id")).distinct()
    return docs.join(chosen, docs[id_col].cast("long").eqNullSafe(F.col("_drawn_id")), "left_semi")
