"""Phrase collocation mining by stripes: each prefix keys an associative counter of the words that follow it.

Level m counts what follows the prefixes of m words, level 0 what follows nothing. A task counts a bounded portion of text
at a time: words become numbers of a local vocabulary, n-grams become pairs of numbers that are sorted and counted, and a
prefix leaves the task as one stripe (its next words and their counts). Stripes of a prefix are merged element by element
behind one exchange, on which they travel packed and compressed by buckets of prefixes, and what is kept of a merged stripe
gives everything at once: the extensions of at least the least count, the prefix's total, and its largest extension, the
subsumption maximum on its right.

A phrase is only counted where both phrases of one word less in it reach the least count, which loses nothing, for a phrase
is never more frequent than its parts. Words that end a piece or lead to rare phrases are counted together as "other", so
that totals stay exact. The tasks look frequent phrases up in a bit filter of bounded size (16 MB), which takes rare
phrases for frequent ones now and then and costs only their counting, never the reverse.

Hot prefixes, those of more than max(100,000, all words / 100,000) occurrences, of which there are at most 100,000 a level,
have their stripes cut by the hash of the next word into as many parts as they have times that many occurrences. The empty
prefix is always cut. The arithmetic is in decimals of 38 digits.

Defined results: a null text is empty, a null language `und`; only A-Z are lower-cased; words are cut at blanks and tabs
alone, so they may hold any other character. Repeated rows all count. Texts without words and empty tables give no rows.
Ties rank by the phrase's bytes. Texts of any length are cut into parts at blanks; phrases across the cuts are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, materialize

SHORTEST, LONGEST, LEAST, SUBSUMED, TOP = 2, 3, 10, 50, 2_000
#: Words that a task counts at once, the bytes of a part of a text, and the shards of the empty prefix.
PORTION, PART, SHARDS = 4_000_000, 1 << 20, 256
#: Words for each bucket of prefixes, the least and most buckets, and the entries of a bucket that a task merges.
BUCKET_WORDS, LEAST_BUCKETS, MOST_BUCKETS, MERGED = 1_000_000, 512, 8_192, 4_000_000
#: A prefix is hot over this many occurrences or this part of all; bits of the filter for each phrase, and at most.
HOT, HOT_PART, BITS, MOST_BITS = 100_000, 100_000, 16, 1 << 27
#: Parts in which the best phrases of a language are ranked first.
SALTS = 16

#: A-Z lower-cased, marks that end a piece as a line feed, a tab as a blank.
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
#: The end of a piece; no UTF-8 text holds this byte.
_END = b"\xff"

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def parts(text: bytes, part: int = PART) -> Iterator[bytes]:
    """A text with its pieces' ends marked, in parts cut at blanks; the last one ends a piece."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + part)
        end = len(text) if end < 0 else end
        yield text[at:end].translate(_BYTES).replace(b"\n", b" \xff ") + (b" \xff " if end == len(text) else b" ")
        at = end


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[1]
    h = (h ^ (h >> np.uint64(27))) * _MIX[2]
    return h ^ (h >> np.uint64(31))


def _longer(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those of their first words and of their last word."""
    return _mixed(prefix * _MIX[0] + word)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def _of_lang(lang: bytes) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(lang, 7)], np.uint64)


class PhraseFilter:
    """A bit filter of phrases; has() is never false for one that was put in."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    @staticmethod
    def _bits(h: np.ndarray, mask: np.uint64) -> list[np.ndarray]:
        step = _mixed(h + _MIX[0]) | np.uint64(1)
        return [(h + np.uint64(i) * step) & mask for i in range(3)]

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for bit in self._bits(h, self.mask):
            out &= (self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) != 0
        return out

    @classmethod
    def of(cls, phrases: DataFrame, n: int) -> PhraseFilter:
        """From (lang, phrase); each task sends the words of the filter that it sets, and these are joined by or."""
        size = min(MOST_BITS, max(1 << 12, 1 << int(n * BITS).bit_length()))
        mask = np.uint64(size - 1)

        def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = np.zeros(size // 64, np.uint64)
            for batch in batches:
                langs, texts = batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
                if not texts:
                    continue
                split = [t.split(b" ") for t in texts]
                starts = {lang: _of_lang(lang)[0] for lang in set(langs)}
                h = np.array([starts[lang] for lang in langs], np.uint64)
                for i in range(len(split[0])):
                    h = _longer(h, _word_hashes([s[i] for s in split]))
                for bit in cls._bits(h, mask):
                    np.bitwise_or.at(words, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
            at = np.flatnonzero(words)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at].view(np.int64))], ["at", "bits"])

        set_ = phrases.mapInArrow(put, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
        words = np.zeros(size // 64, np.uint64)
        words[set_["at"].to_numpy(np.int64)] = set_["bits"].to_numpy(np.int64).view(np.uint64)
        return cls(words)


#: Stripes as they leave a task: a batch of these for each bucket, compressed.
_STRIPES = pa.schema([("prefix", pa.binary()), ("next", pa.list_(pa.binary())), ("n", pa.list_(pa.int64()))])


class _Numbers(dict):
    """Word -> its number, in the order in which words are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


class Portion:
    """Text of one language as numbers of a local vocabulary, and the stripes of one level in it."""

    def __init__(self, lang: bytes, filters: list[PhraseFilter], words: list[bytes] = ()):
        self.lang, self.filters, self.level = lang, filters, len(filters)
        self.number = _Numbers({_END: 0})  # number 0, the end of a piece, stands for "other" too
        self.ids, self.size = [], 0
        self.add(words)

    def add(self, words: list[bytes]) -> None:
        self.ids.append(np.fromiter(map(self.number.__getitem__, words), np.int64, len(words)))
        self.size += len(words)

    def last_words(self) -> list[bytes]:
        """The words in which phrases begin that may go on in the next portion: none, if this one ends a piece."""
        if not self.level or not self.ids or not len(self.ids[-1]) or self.ids[-1][-1] == 0:
            return []
        words = list(self.number)
        return [words[i] for i in np.concatenate(self.ids)[-self.level :]]

    def stripes(self, hot: dict[tuple[str, str], int], buckets: int) -> Iterator[tuple[int, pa.RecordBatch]]:
        """(bucket, stripes): a stripe holds a prefix, its next words or null for "other", and their counts."""
        ids, words, m = np.concatenate(self.ids), list(self.number), self.level
        hashes, bits = _word_hashes(words), max(1, (len(words) - 1).bit_length())
        mask = (1 << bits) - 1
        if m == 0:
            n = np.bincount(ids, minlength=len(words))
            key, n = np.arange(1, len(words)), n[1:]
        else:
            # where the phrases of one to m words that begin at a position are all frequent
            h = _longer(np.repeat(_of_lang(self.lang), len(words)), hashes)
            good = (self.filters[0].has(h) & (np.arange(len(words)) != 0))[ids]
            h = h[ids]
            for length in range(2, m + 1):
                begins = np.flatnonzero(good[:-1] & good[1:])
                longer = _longer(h[begins], hashes[ids[begins + length - 1]])
                good = np.zeros(len(ids), bool)
                good[begins] = self.filters[length - 1].has(longer)
                h = h.copy()
                h[begins] = longer
            begins = np.flatnonzero(good)
            begins = begins[begins + m < len(ids)]
            # a prefix goes on to a word if the phrase of its last m - 1 words and that word is frequent too, else to "other"
            key = ids[begins]
            for j in range(1, m):
                key = key << bits | ids[begins + j]
            key, n = np.unique(key << bits | np.where(good[begins + 1], ids[begins + m], 0), return_counts=True)
        if not len(key):
            return
        prefix, nexts = key >> bits, key & mask
        first = np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1])))
        size = np.diff(np.append(first, len(key)))
        own = [prefix[first] >> bits * (m - 1 - j) & mask for j in range(m)]
        h = np.repeat(_of_lang(self.lang), len(first))
        for w in own:
            h = _longer(h, hashes[w])
        # a hot prefix has a stripe for each shard of the hash of the next word
        shard = np.zeros(len(key), np.uint64)
        if m == 0:
            shard = hashes[nexts] % np.uint64(SHARDS)
        for (lang, text), cuts in hot.items():
            split = [self.number.get(w) for w in text.encode().split(b" ")] if lang.encode() == self.lang else [None]
            if None not in split:
                code = 0
                for w in split:
                    code = code << bits | w
                a, b = np.searchsorted(prefix, [code, code + 1])
                shard[a:b] = hashes[nexts[a:b]] % np.uint64(cuts)
        bucket = (_longer(np.repeat(h, size), shard) % np.uint64(buckets)).astype(np.uint16)
        order = np.argsort(bucket, kind="stable")
        bucket, prefix, nexts, n = bucket[order], prefix[order], nexts[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], (prefix[1:] != prefix[:-1]) | (bucket[1:] != bucket[:-1]))))
        vocabulary = pa.array([None, *words[1:]], pa.binary())
        at = pa.array(np.append(first, len(n)), pa.int32())
        named = [vocabulary.take(pa.array(prefix[first] >> bits * (m - 1 - j) & mask)) for j in range(m)]
        names = pc.binary_join_element_wise(*named, b" ") if m else pa.array([b""] * len(first), pa.binary())
        table = pa.RecordBatch.from_arrays([names, pa.ListArray.from_arrays(at, vocabulary.take(pa.array(nexts))), pa.ListArray.from_arrays(at, pa.array(n, pa.int64()))], schema=_STRIPES)
        edges = np.append(np.flatnonzero(np.concatenate(([True], bucket[first][1:] != bucket[first][:-1]))), len(first))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield int(bucket[first[a]]), table.slice(a, b - a)


def count_stripes(docs: DataFrame, filters: list[PhraseFilter], hot: dict[tuple[str, str], int], buckets: int, portion: int = PORTION) -> DataFrame:
    """(lang, bucket, size, stripes) of documents (lang, text): what each task counted, packed for each bucket of prefixes."""
    shared, level = docs.sparkSession.sparkContext.broadcast((filters, hot)), len(filters)
    most_words = 1 << 63 // (level + 1)  # so that a prefix and its next word fit one number
    step = min(20_000, most_words // 2)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, hot = shared.value
        held: dict[bytes, Portion] = {}

        def flush(done: Portion) -> Iterator[pa.RecordBatch]:
            found = [(bucket, table.serialize()) for bucket, table in done.stripes(hot, buckets)] if done.size else []
            rows = [pa.array([done.lang] * len(found), pa.binary()).cast(pa.string()), pa.array([b for b, _ in found], pa.int32()), pa.array([t.size for _, t in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([*rows, pa.array([pa.compress(t, "zstd", asbytes=True) for _, t in found], pa.binary())], ["lang", "bucket", "size", "stripes"])

        for batch in batches:
            for lang, text in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                own = held.setdefault(lang, Portion(lang, filters))
                for part in parts(text.as_py()):
                    words = part.split()
                    for a in range(0, len(words), step):
                        if own.size >= portion or len(own.number) + step >= most_words:
                            yield from flush(own)
                            own = held[lang] = Portion(lang, filters, own.last_words())
                        own.add(words[a : a + step])
            if sum(p.size for p in held.values()) >= 2 * portion:  # many languages
                for own in held.values():
                    yield from flush(own)
                held.clear()
        for own in held.values():
            yield from flush(own)

    return docs.mapInArrow(count, "lang string, bucket int, size long, stripes binary")


def merge_stripes(packed: DataFrame, least: int = LEAST, most: int = MERGED) -> DataFrame:
    """(lang, prefix, next, n): stripes merged element by element. A prefix's total is in its rows without a next word.

    Extensions of less than the least count go, but for the totals. A task merges a few buckets at a time; what has more than
    `most` entries even so is merged by Spark's own aggregation instead.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, tables, rows, whole = None, [], 0, True
        names = ["lang", "prefix", "next", "n"]

        def summed(keys: list[str], table: pa.Table) -> pa.Table:
            return table.group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns([*keys, "n"])

        def out(table: pa.Table, partial: bool) -> Iterator[pa.RecordBatch]:
            for batch in table.select(names).to_batches(100_000):
                columns = [*(batch[c].cast(pa.string()) for c in names[:3]), batch["n"].cast(pa.int64()), pa.array([partial] * len(batch))]
                yield pa.RecordBatch.from_arrays(columns, [*names, "partial"])

        def done() -> Iterator[pa.RecordBatch]:
            if tables:
                table = summed(names[:3], pa.concat_tables(tables))
                if whole:
                    totals = summed(names[:2], table)
                    yield from out(totals.append_column("next", pa.nulls(len(totals), pa.binary())), False)
                    table = table.filter(pc.and_(pc.is_valid(table["next"]), pc.greater_equal(table["n"], least)))
                yield from out(table, not whole)

        for batch in batches:
            for lang, bucket, size, blob in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if bucket != of and (rows > most // 8 or not whole):
                    yield from done()
                    tables, rows, whole = [], 0, True
                of = bucket
                stripes = pa.ipc.read_record_batch(pa.decompress(blob, size, "zstd"), _STRIPES)
                entries = [stripes["prefix"].take(pc.list_parent_indices(stripes["next"])), stripes["next"].flatten(), stripes["n"].flatten()]
                tables.append(pa.table([pa.repeat(pa.scalar(lang.encode(), pa.binary()), len(entries[0])), *entries], names))
                rows += len(entries[0])
                if rows > most:
                    table = summed(names[:3], pa.concat_tables(tables))
                    if len(table) > most // 2:
                        yield from out(table, True)
                        tables, rows, whole = [], 0, False
                    else:
                        tables, rows = [table.select(names).cast(tables[0].schema)], len(table)
        yield from done()

    spread = packed.repartition("bucket").sortWithinPartitions("bucket")
    merged = materialize(spread.select("lang", "bucket", "size", "stripes").mapInArrow(merge, "lang string, prefix string, next string, n long, partial boolean"))
    whole, left = merged.filter("not partial").drop("partial"), merged.filter("partial")
    if left.isEmpty():
        return whole
    again = left.groupBy("lang", "prefix", "next").agg(F.sum("n").alias("n"))
    totals = left.groupBy("lang", "prefix").agg(F.sum("n").alias("n")).select("lang", "prefix", F.lit(None).cast("string").alias("next"), "n")
    return materialize(whole.unionByName(totals).unionByName(again.filter((F.col("next").isNotNull()) & (F.col("n") >= least))))


def phrase(prefix: str = "prefix", next_: str = "next") -> Column:
    return F.when(F.col(prefix) == "", F.col(next_)).otherwise(F.concat_ws(" ", prefix, next_))


def mine(
    docs: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, least: int = LEAST, subsumed: int = SUBSUMED, top: int | None = TOP, text_col: str = "text",
    lang_col: str = "lang", portion: int = PORTION,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases, by their lowest-scoring cut.

    a, l, r: how often the phrase, its first and its second part occur; n: all words; score: floor(10^6 a^2 / (l r)). A phrase
    goes if a longer one that holds it occurs in at least `subsumed` of 100 of its places. top None: all phrases.
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    levels, filters, buckets = [], [], LEAST_BUCKETS
    hot: dict[tuple[str, str], int] = {}
    for m in range(longest):
        levels.append(merge_stripes(count_stripes(texts, filters, hot, buckets, portion), least))
        if m + 1 < longest:
            found = levels[m].filter("next is not null").select("lang", phrase().alias("phrase"), "n")
            if m == 0:
                words = levels[0].filter("next is null").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
                limit, buckets = max(HOT, words // HOT_PART), min(MOST_BUCKETS, max(LEAST_BUCKETS, words // BUCKET_WORDS))
            hot = {(r["lang"], r["phrase"]): -(-r["n"] // limit) for r in found.filter(F.col("n") > limit).toLocalIterator()}
            filters.append(PhraseFilter.of(found.select("lang", "phrase"), found.count()))

    everything = levels[0].withColumn("words", F.lit(1))
    for m, level in enumerate(levels[1:], 2):
        everything = everything.unionByName(level.withColumn("words", F.lit(m)))
    prefixes = everything.filter("words > 1").groupBy("lang", F.col("prefix").alias("first"))
    totals = prefixes.agg(F.sum(F.when(F.col("next").isNull(), F.col("n"))).alias("l"), F.max(F.when(F.col("next").isNotNull(), F.col("n"))).alias("right"))
    all_words = everything.filter("words = 1 and next is null").groupBy("lang").agg(F.sum("n").alias("n"))  # a row for each language
    everything = everything.filter("next is not null").select("lang", phrase().alias("phrase"), "words", "n")

    # longer phrases: the right maximum is the stripe's, the left one that of the phrases that end so
    found = everything.filter(F.col("words") >= shortest)
    tail = everything.filter(F.col("words") > shortest).select("lang", F.expr("substring(phrase, instr(phrase, ' ') + 1)").alias("phrase"), F.col("n").alias("left"))
    ends = tail.groupBy("lang", "phrase").agg(F.max("left").alias("left"))
    starts = totals.select("lang", F.col("first").alias("phrase"), "right")
    around = found.join(ends, ["lang", "phrase"], "left").join(starts, ["lang", "phrase"], "left")
    widest = F.greatest(F.coalesce("left", F.lit(0)), F.coalesce("right", F.lit(0)))
    alone = around.filter((widest < least) | (widest * 100 < F.col("n") * subsumed)).select("lang", "phrase", "words", F.col("n").alias("a"))

    cut = alone.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
    parts_ = everything.filter(F.col("words") < longest).select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    cut = cut.join(totals.select("lang", "first", "l"), ["lang", "first"]).join(parts_, ["lang", "rest"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cut = cut.withColumns({"aa": (wide("a") * wide("a") * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)"), "lr": (wide("l") * wide("r")).cast("decimal(38,0)")})
    cut = cut.withColumn("score", F.expr("aa div lr"))
    scored = cut.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("best"))
    scored = scored.select("lang", "phrase", "a", "best.l", "best.r", "best.score").join(all_words, "lang")
    best_first = [F.desc("score"), F.desc("a"), F.col("phrase")]
    if top is not None:  # what leads its language leads its part of it
        scored = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
        scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best_first))).filter(F.col("rank") <= top).drop("rank", "salt")
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best_first)).cast("long"))
    ranked = ranked if top is None else ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
