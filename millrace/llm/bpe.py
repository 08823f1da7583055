"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decoding.

The nondeterministic transducer reads bytes and guesses token ends; a hypothesis is a place in the token trie plus the
tokens before it, and a token may follow another only if merging the bytes of both leaves exactly the two. For every prefix
of the input one hypothesis ends there, that of the prefix's own encoding. Sets of live hypotheses, cut at their common
prefix, are the states of the deterministic transducer; a state or transition is made when input first reaches it, and
tokens are emitted once all hypotheses agree, so after a bounded lookahead. Time is linear in the input, for long runs too.

Results for text between blanks are remembered (bounded): a single blank between two other characters always starts a new
match of the pattern, so texts are cut there. All state lives in a worker process and is rebuilt anywhere from the ranks.

Defined results: a null text counts as empty and has no tokens. Every row is encoded on its own; nothing is shuffled.
"""

from __future__ import annotations

import base64
import codecs
import gc
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import bound_batches, text_or_empty

#: States, and recent words (twice as many with the ones before), that a process remembers; what is over that is worked out anew.
MOST_STATES, MOST_WORDS = 200_000, 150_000

_SAFE_BLANK = re.compile(r"(?<=\S) (?=\S)")
_MISSING = object()
_HYPOTHESES, _FINAL = -1, -2


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int], under: int | None = None) -> list[bytes]:
    """BPE by its definition: join the adjacent pair of the lowest rank (below under), the leftmost first, while there is one."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = under, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if at < 0:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    def __init__(self, ranks: dict[bytes, int], most_states: int = MOST_STATES):
        self.ranks, self.most_states = ranks, most_states
        self.token = {r: t for t, r in ranks.items()}
        self._split: dict[int, tuple[int, int] | None] = {}
        self._follows: dict[int, bool] = {}
        # trie: (node << 8 | byte) -> node; ends[node] is the token that ends there; a token that merging never makes has no end
        self.trie: dict[int, int] = {}
        self.ends, self.inner = [-1], [False]
        for t, r in ranks.items():
            node = 0
            for b in t:
                key = node << 8 | b
                if key not in self.trie:
                    self.inner[node] = True
                    self.trie[key] = len(self.ends)
                    self.ends.append(-1)
                    self.inner.append(False)
                node = self.trie[key]
            self.ends[node] = r
        self._reachable: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        # a state is a dictionary byte -> (state, emitted tokens); at HYPOTHESES what it stands for, at FINAL the tokens if input ends
        start = ((-1, 0, ()),)
        self.start = {_HYPOTHESES: start, _FINAL: ()}
        self.states = {start: self.start}

    def reachable(self, r: int) -> bool:
        """Whether the bytes of token r encode to r alone."""
        known = self._reachable.get(r)
        if known is None:
            known = self._reachable[r] = len(self.token[r]) == 1 or len(merge(self.token[r], self.ranks)) == 1
        return known

    def split(self, r: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes r; None for a single byte."""
        if r not in self._split:
            t = self.token[r]
            two = merge(t, self.ranks, r) if len(t) > 1 else []
            self._split[r] = (self.ranks[two[0]], self.ranks[two[1]]) if len(two) == 2 else None
        return self._split[r]

    def follows(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b leaves exactly a and b.

        Walk back in merging time along the right edge of a and the left edge of b: the two parts that touch at a time
        must not join before either is taken into its own parent.
        """
        known = self._follows.get(a << 32 | b)
        if known is not None:
            return known
        left, right, until_left, until_right, ok = a, b, None, None, True
        while True:
            joined = self.ranks.get(self.token[left] + self.token[right])
            if joined is not None and (until_left is None or joined < until_left) and (until_right is None or joined <= until_right):
                ok = False
                break
            ls, rs = self.split(left), self.split(right)
            if ls is None and rs is None:
                break
            if rs is None or (ls is not None and left > right):
                until_left, left = left, ls[1]
            else:
                until_right, right = right, rs[0]
        if len(self._follows) > 4 * self.most_states:
            self._follows.clear()
        self._follows[a << 32 | b] = ok
        return ok

    def _step(self, state: dict, byte: int) -> tuple[dict, tuple[int, ...]] | None:
        live, ended, trie, inner = [], None, self.trie, self.inner
        for hypothesis in state[_HYPOTHESES]:
            last, node, pending = hypothesis
            nxt = trie.get(node << 8 | byte)
            if nxt is None:
                continue
            if inner[nxt]:
                live.append((last, nxt, pending))
            if ended is None:
                t = self.ends[nxt]
                if t >= 0 and self.reachable(t) and (last < 0 or self.follows(last, t)):
                    ended = (t, 0, (*pending, t))
        if ended is None:
            return None
        live.append(ended)
        n, common = 0, live[0][2]
        for _, _, pending in live:  # the common prefix
            k = 0
            for x, y in zip(common, pending, strict=False):
                if x != y:
                    break
                k += 1
            common = common[:k]
            if not k:
                break
        n = len(common)
        key = tuple([(last, node, pending[n:]) for last, node, pending in live]) if n else tuple(live)
        new = self.states.get(key)
        if new is None:
            new = {_HYPOTHESES: key, _FINAL: key[-1][2]}
            if len(self.states) >= self.most_states:
                return new, common  # the tables are full: a state for this time only
            self.states[key] = new
        if state[_HYPOTHESES] in self.states:
            state[byte] = (new, common)
        return new, common

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """The tokens of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        state, out = self.start, []
        for b in piece:
            found = state.get(b) or self._step(state, b)
            if found is None:  # no hypothesis: the ranks are not those of trained merges
                return tuple([self.ranks[t] for t in merge(piece, self.ranks)])
            state, emitted = found
            if emitted:
                out += emitted
        return (*out, *state[_FINAL]) if out else state[_FINAL]


class Codec:
    """Texts to token ids and back, as the ranks and the pattern say, without special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, most_words: int = MOST_WORDS, most_states: int = MOST_STATES):
        self.transducer, self.pattern, self.most_words = Transducer(ranks, most_states), regex.compile(pattern), most_words
        self.letters = r" ?\p{L}+" in pattern.split("|")
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.bytes_of[r] = t
        self.digits = [str(i) for i in range(len(self.bytes_of))]
        self.words: dict[str, tuple[int, ...] | None] = {}
        self.older: dict[str, tuple[int, ...] | None] = {}

    def _pieces(self, chunk: str) -> tuple[int, ...]:
        encode, out = self.transducer.encode, []
        for piece in self.pattern.findall(chunk):
            out += encode(piece.encode("utf-8", "surrogatepass"))
        return tuple(out)

    def _word(self, word: str) -> tuple[int, ...] | None:
        """The tokens of a blank and the word; None if the blank is not between two other characters."""
        known = self.older.get(word, _MISSING)
        if known is _MISSING:
            if word.isalpha():  # one match of the pattern's letters
                known = self.transducer.encode(b" " + word.encode()) if self.letters else self._pieces(" " + word)
            elif not word or word[0].isspace() or word[-1].isspace():
                known = None
            else:
                known = self._pieces(" " + word)
        if len(word) <= 64:
            if len(self.words) >= self.most_words:
                self.words, self.older = {}, self.words
            self.words[word] = known
        return known

    def encode(self, text: str) -> list[int]:
        first, *rest = text.split(" ")
        if rest and (not first or first[-1].isspace()):
            return self._slow(text)
        out = list(self._pieces(first))
        for word in rest:
            ids = self.words.get(word, _MISSING)
            if ids is _MISSING:
                ids = self._word(word)
            if ids is None:
                return self._slow(text)
            out += ids
        return out

    def _slow(self, text: str) -> list[int]:
        first, *rest = _SAFE_BLANK.split(text)
        out = list(self._pieces(first))
        for chunk in rest:
            out += self._pieces(" " + chunk)
        return out

    def decode_stream(self, ids: Iterable[int], at_once: int = 8192) -> Iterator[tuple[bytes, str]]:
        """Bytes taken in and text given out by and by; a character split over two steps is held back by the UTF-8 state machine
        until it is whole. A byte that is no UTF-8 comes out as a lone surrogate, so that none is lost."""
        machine, ids, of = codecs.getincrementaldecoder("utf-8")("surrogateescape"), list(ids), self.bytes_of
        for k in range(0, len(ids), at_once):
            raw = b"".join([of[i] for i in ids[k : k + at_once]])
            yield raw, machine.decode(raw, k + at_once >= len(ids))

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; bytes that are no UTF-8 as the replacement character."""
        text = "".join([t for _, t in self.decode_stream(ids)])
        return text if text.isascii() else text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str, pattern: str, most_words: int = MOST_WORDS, most_states: int = MOST_STATES) -> Codec:
    """The codec of a ranks file, one for each process."""
    return Codec(load_ranks(path), pattern, most_words, most_states)


def encode_documents(docs: DataFrame, path: str, pattern: str, text_col: str = "text", at_once: int = 256, verify: bool = False, **bounds: int) -> DataFrame:
    """docs with n_tokens (long) and ids (array<int>). A task holds the ids of `at_once` documents at a time; bounds are those of codec().

    The codec lives as long as its task: processes are used again by other steps, whose memory it would take. With verify each document is decoded again in the same task, and one that does not come back as it was ends the job.
    """
    bound_batches(docs.sparkSession)
    docs = docs.drop("n_tokens", "ids")
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Codec(load_ranks(path), pattern, **bounds)
        try:
            for batch in batches:
                for k in range(0, batch.num_rows, at_once):
                    part = batch.slice(k, at_once)
                    texts = [t or "" for t in part.column(at).to_pylist()]
                    found = [np.array(coder.encode(t), np.int32) for t in texts]
                    if verify and any(coder.decode(ids.tolist()) != t for ids, t in zip(found, texts, strict=True)):
                        raise ValueError("a document does not decode to its text")
                    n = np.array([len(x) for x in found], np.int64)
                    ends = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n), ids], [*part.schema.names, "n_tokens", "ids"])
        finally:
            del coder
            gc.collect()  # its states refer to each other
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(of, schema)


def decode_documents(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """encoded with decoded (string); null ids give null, and bytes that are no UTF-8 the replacement character."""

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = codec(path, pattern)
        for batch in batches:
            yield pd.Series([None if x is None else coder.decode(x) for x in batch], dtype=object)

    return encoded.withColumn("decoded", of(F.col(ids_col)))


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): each whole text encoded, its ids digested, decoded again and digested.

    Ids stay within a task; only the digests leave it.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern)
        digits = coder.digits.__getitem__
        for batch in batches:
            n, ids_hash, text_hash = [], [], []
            for text in batch.column(1):
                ids = coder.encode(text.as_py())
                raw = hashlib.sha256()
                for _, part in coder.decode_stream(ids):
                    raw.update(part.encode("utf-8", "surrogateescape"))
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(",".join(map(digits, ids)).encode()).hexdigest())
                text_hash.append(raw.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(of, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
