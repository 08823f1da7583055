"""Token-id files: one zstandard frame for each document, a checksum for each frame, and a seek table at the end.

Layout: the frames, each a document's ids as little-endian unsigned 32-bit integers; a skippable frame with the index of
doc_ids and null marks; a skippable frame with the seek table of the public seekable format (compressed size, plain size,
low 32 bits of the xxh64 of the plain bytes for each frame, then the footer). A reader takes the two tables from the end of
the file and then only the byte ranges of the documents asked for. Any zstandard decoder reads the file from the start.

Files hold ascending, disjoint ranges of doc_id; file k ends where file k + 1 begins. A writing task puts its file under a
name of its own attempt and moves it into place whole, so a task run again replaces equal bytes. Files go to the folder
given, or a new one below spark.checkpoint.dir, through Arrow's file systems: no local paths.

Defined results: a null text counts as empty; every document ends with the end id, so no frame is empty. Null doc_ids come
first; equal ids follow each other ordered by text. An empty table writes no files.
"""

from __future__ import annotations

import os
import re
import uuid
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialize, shared_dir, text_or_empty

#: Fixed values of the public formats: skippable frames, and the footer of the seek table.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
LEVEL = 3
MOST_WORDS = 300_000
#: Texts with a blank that is not between two other characters, or with white space other than the blank and the line end.
ODD_BLANKS = r"^ | $|  | \n|\n |[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: A word of letters with signs or digits after it: Latin letters, which every pattern takes for such, and no apostrophe.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_SIMPLE = re.compile(f"([{LETTERS}]+)([!-&(-@\\[-`{{-~]*)")
#: Rows and bytes of text that are encoded at once, but for a longer single text.
AT_ONCE, BYTES_AT_ONCE = 1_024, 4 << 20


class WordEncoder:
    """Whole texts through the tokenizers library, words remembered (bounded).

    A byte-level pattern always starts a new match at a blank between two other characters, so texts are cut there. Arrow
    cuts a batch and finds its different words, and the ids of the texts are gathered from those of the words. Of a new word
    of letters with marks after it the letters go straight to the library's model, for a match ends where letters end; all
    else goes through the library as it is, many words in one call. Of remembered words those not met lately are forgotten.
    """

    def __init__(self, path: str, most_words: int = MOST_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.library, self.most_words = Tokenizer.from_file(path), most_words
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.token_bytes = np.zeros(self.library.get_vocab_size(with_added_tokens=True), np.int64)
        for token, i in self.library.get_vocab(with_added_tokens=True).items():
            self.token_bytes[i] = len(token) if token in vocabulary else len(token.encode())  # a character of a token is a byte
        for i, token in self.library.get_added_tokens_decoder().items():
            self.token_bytes[i] = len(token.content.encode())
        added = [t.content for t in self.library.get_added_tokens_decoder().values() if t.content]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        seen = lambda text: [piece for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(text)] if self.library.pre_tokenizer else []
        latin = [chr(c) for c in range(0xC0, 0x250) if chr(c).isalpha()]
        self.letters = str.maketrans({c: "".join(seen(c)) for c in [" ", *latin]})
        self.cuttable = self.library.normalizer is None and seen(" ab.c1 d\u00e9e,") == [x.translate(self.letters) for x in (" ab", ".", "c", "1", " d\u00e9e", ",")]
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _encode(self, chunks: list[str], at_once: int = 2_000) -> list[bytes]:
        """The ids of each chunk, which the library takes as words cut before; they end where their bytes do."""
        out: list[bytes] = []
        parts = [chunks[k : k + at_once] for k in range(0, len(chunks), at_once)]
        for part, e in zip(parts, self.library.encode_batch_fast(parts, is_pretokenized=True, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            token_ends = np.cumsum(self.token_bytes[ids])
            ends = np.cumsum([len(c.encode()) for c in part])
            at = np.searchsorted(token_ends, ends, "right")
            if not np.array_equal(np.concatenate(([0], token_ends))[at], ends):  # a library that does not keep bytes
                out += [np.array(x.ids, "<u4").tobytes() for x in self.library.encode_batch_fast(part, add_special_tokens=False)]
                continue
            raw, at = ids.tobytes(), (4 * at).tolist()
            out += [raw[a:b] for a, b in zip([0, *at[:-1]], at, strict=True)]
        return out

    def _new_words(self, words: list[str]) -> list[bytes]:
        """The ids of words with a blank before each."""
        out, tokenize, letters, marks = [b""] * len(words), self.library.model.tokenize, self.letters, self.marks
        simple, blank, whole = _SIMPLE.fullmatch if self.cuttable else (lambda w: None), self.letters[32], []
        for k, word in enumerate(words):
            found = simple(word)
            if found is None or self.added.search(word):
                whole.append(k)
                continue
            run, after = found.groups()
            run = blank + (run if run.isascii() else run.translate(letters))
            ids = array("I", [t.id for t in tokenize(run)]).tobytes()
            if after:
                if after not in marks:
                    marks[after] = self._encode([after])[0]
                ids += marks[after]
            out[k] = ids
        for k, ids in zip(whole, self._encode([" " + words[k] for k in whole]), strict=True):
            out[k] = ids
        if len(marks) > 100_000:
            marks.clear()
        return out

    @staticmethod
    def cut(text: str) -> list[str]:
        """Pieces whose encodings join to that of the text; all but the first begin with a blank that is left out here."""
        parts = text.split(" ")
        out = parts[:1]
        for p in parts[1:]:
            if p and out[-1] and not p[0].isspace() and not out[-1][-1].isspace():
                out.append(p)
            else:
                out[-1] += " " + p
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of each word with a blank before it."""
        known, older = self.recent, self.older
        out = list(map(known.get, words))
        missing = [k for k, ids in enumerate(out) if ids is None]
        for k in missing:
            out[k] = older.get(words[k])
        new = [k for k in missing if out[k] is None]
        for k, ids in zip(new, self._new_words([words[k] for k in new]), strict=True):
            out[k] = ids
        known.update({words[k]: out[k] for k in missing})
        return out

    def _forget(self) -> None:
        if len(self.recent) > self.most_words:
            self.recent, self.older = {}, {w: i for w, i in self.recent.items() if len(w) <= 64}

    def encode_batch(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(texts):
            return []
        odd = np.asarray(pc.match_substring_regex(texts, ODD_BLANKS))
        plain = texts if not odd.any() else pc.if_else(pa.array(odd), pa.scalar("", texts.type), texts)
        split = pc.split_pattern(plain, " ")
        at = np.asarray(split.offsets) - split.offsets[0].as_py()
        words = pc.dictionary_encode(split.flatten())
        listed, index = words.dictionary.to_numpy(zero_copy_only=False).tolist(), np.asarray(words.indices).astype(np.int64)
        first = [listed[k] for k in index[at[:-1]]]
        index[at[:-1]] = len(listed) + np.arange(len(first))  # a text's first word has no blank before it
        ids = [*self._words(listed), *self._encode(first)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts, flat = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(ids), "<u4")
        n = lengths[index]
        ends = np.concatenate(([0], np.cumsum(n)))
        gathered = flat[np.repeat(starts[index] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
        bounds = (4 * ends[at]).tolist()
        out = [gathered[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        for k in np.flatnonzero(odd).tolist():
            head, *rest = self.cut(texts[k].as_py())
            different = list(dict.fromkeys(rest))
            of = dict(zip(different, self._words(different), strict=True))
            out[k] = self._encode([head])[0] + b"".join([of[w] for w in rest])
        self._forget()
        return out


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@lru_cache(maxsize=1)
def _compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)


def frame(ids: bytes) -> tuple[bytes, int]:
    """A document's frame, and its checksum: the low 32 bits of xxh64."""
    return _compressor().compress(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF


def slices(batch: pa.RecordBatch, column: int, rows: int = AT_ONCE, most: int = BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """batch in slices of at most so many rows, and bytes of a text column but for a single longer text."""
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)))
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        end = min(at + rows, max(at + 1, int(np.searchsorted(size, before + most, "right"))))
        yield batch.slice(at, end - at)
        at = end


def _skippable(magic: int, body: bytes) -> bytes:
    return np.array([magic, len(body)], "<u4").tobytes() + body


def trailer(doc_ids: list[int | None], sizes: list[tuple[int, int, int]]) -> bytes:
    """What follows the frames. sizes: (compressed, plain, checksum) of each."""
    index = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes() + np.array([d is None for d in doc_ids], np.uint8).tobytes()
    table = np.array(sizes, "<u4").reshape(-1, 3).tobytes()
    footer = np.array([len(sizes)], "<u4").tobytes() + b"\x80" + np.array([SEEK_FOOTER], "<u4").tobytes()
    return _skippable(SKIPPABLE_INDEX, index) + _skippable(SKIPPABLE_SEEK, table + footer)


class Reader:
    """Random access to one file: read(k) decompresses the frame of document k alone and checks it."""

    def __init__(self, uri: str):
        fs, path = pa.fs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        end = self.file.size()
        footer = self.file.read_at(9, end - 9)
        if int.from_bytes(footer[5:], "little") != SEEK_FOOTER or footer[4] != 0x80:
            raise ValueError(f"{uri} has no seek table with checksums at its end")
        n = int.from_bytes(footer[:4], "little")
        begin = end - 9 - 12 * n
        self.sizes = np.frombuffer(self.file.read_at(12 * n, begin), "<u4").reshape(-1, 3)
        begin -= 8 + 9 * n
        index = self.file.read_at(9 * n, begin)
        nulls = np.frombuffer(index, np.uint8, n, 8 * n)
        self.doc_ids = [None if null else int(d) for d, null in zip(np.frombuffer(index, "<i8", n), nulls, strict=True)]
        self.at = np.concatenate(([0], np.cumsum(self.sizes[:, 0], dtype=np.int64)))
        self.decompressor = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.sizes)

    def read(self, k: int) -> bytes:
        compressed, plain, check = map(int, self.sizes[k])
        ids = self.decompressor.decompress(self.file.read_at(compressed, int(self.at[k])), max_output_size=plain)
        if len(ids) != plain or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != check:
            raise ValueError(f"document {k} of the file is damaged")
        return ids

    def find(self, doc_id: int) -> list[int]:
        return [k for k, d in enumerate(self.doc_ids) if d == doc_id]

    def close(self) -> None:
        self.file.close()


def new_folder(spark: SparkSession) -> str:
    """A new folder below the shared one, as a URI; a folder without a scheme is one of Spark's default file system."""
    base = shared_dir(spark)
    if ":" not in base.split("/")[0]:
        default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
        base = f"{default.rstrip('/')}{base}" if not default.startswith("file:") else f"file://{base}"
    return f"{base.rstrip('/')}/tokens-{uuid.uuid4().hex}"


def write(docs: DataFrame, encode: Callable[[pa.Array], list[bytes]], end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text", files: int | None = None) -> DataFrame:
    """Write docs to files in folder; the manifest (file int, uri string, n_docs long, n_ids long), one row for each file.

    The rows are dealt by ranges of doc_id as text and encoded after that, so the costly step runs once and evenly, and
    only text is shuffled. encode is called in the tasks with the texts of a batch.
    """
    files = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    end = np.array([end_id], "<u4").tobytes()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, root = pa.fs.FileSystem.from_uri(folder)
        part, attempt = task.partitionId(), task.taskAttemptId()
        doc_ids, sizes, n_ids, out, mine = [], [], 0, None, f"{root}/.writing-{part:06d}-{attempt}"
        for batch in batches:
            for few in slices(batch, 1):
                doc_ids += few.column(0).to_pylist()
                for ids in encode(few.column(1)):
                    ids += end
                    raw, check = frame(ids)
                    if out is None:
                        fs.create_dir(root, recursive=True)
                        out = fs.open_output_stream(mine)
                    out.write(raw)
                    sizes.append((len(raw), len(ids), check))
                    n_ids += len(ids) // 4
        if out is not None:
            out.write(trailer(doc_ids, sizes))
            out.close()
            fs.move(mine, f"{root}/{part:06d}.ids.zst")
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([f"{folder}/{part:06d}.ids.zst"]), pa.array([len(doc_ids)], pa.int64()), pa.array([n_ids], pa.int64())], ["file", "uri", "n_docs", "n_ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    rows = rows.repartitionByRange(files, "id").sortWithinPartitions("id", "text")
    return materialize(rows.mapInArrow(of, "file int, uri string, n_docs long, n_ids long"))


def read(manifest: DataFrame, visit: Callable[[bytes], int], id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, value) of every document, from the files of a manifest; visit turns a document's bytes to a long.

    start counts the ids of all documents before. The window runs over one row for each file.
    """
    before = F.sum("n_ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    listed = manifest.withColumn("base", F.coalesce(before, F.lit(0).cast("long"))).select("file", "uri", "base")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                reader = Reader(uri)
                counts = (reader.sizes[:, 1] // 4).astype(np.int64)
                starts = base + np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else counts
                for k in range(0, len(reader), 4096):
                    those = range(k, min(k + 4096, len(reader)))
                    values = [visit(reader.read(i)) for i in those]
                    yield pa.RecordBatch.from_arrays([pa.array(reader.doc_ids[k : k + 4096], pa.int64()), pa.array(starts[k : k + 4096], pa.int64()), pa.array(counts[k : k + 4096], pa.int64()), pa.array(values, pa.int64())], ["id", "start", "n_tokens", "value"])
                reader.close()

    spread = listed.repartition(max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "file")
    return spread.mapInArrow(of, "id long, start long, n_tokens long, value long").withColumnRenamed("id", id_col)
