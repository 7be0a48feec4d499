"""Encoding of whole texts with a public byte-level BPE tokenizer, and decoding of its ids.

Scale: a narrow map over the rows, without a shuffle.  The vocabulary is read by the driver and broadcast (a file of up to a few megabytes), so that
executors need no file of their own; each Python worker compiles it once.  Words recur, so that most of a text is found in a bounded memory of encoded
words and only new words go through the transducer.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from brezza.llm.batches import in_parts
from brezza.llm.transducer import PIECES, Transducer, decode_stream, read_ranks

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k"
MOST_BYTES = 32 * 1024 * 1024
REMEMBERED_WORDS = 200_000
REMEMBERED_STEPS = 400_000

_PIECES = regex.compile(PIECES)
_CUTS = re.compile(r"(?<=\S) (?=\S)")
_encoders: dict[str, Encoder] = {}


def vocabulary_path(name: str = VOCABULARY, folder: str | None = None) -> str:
    """Where the ranks of a public vocabulary lie; the folder is a parameter, never copied from."""
    return os.path.join(folder or TOKENIZERS, f"{name}.tiktoken")


class Encoder:
    """Texts to token ids.  Names of special tokens in a text are ordinary text.

    A single space between two characters that are no white space always begins a piece, so that a text may be cut before it.
    Such words recur and are remembered: the newest ``remembered`` and, of those before them, the ones met again since.
    """

    def __init__(self, data: bytes, remembered: int = REMEMBERED_WORDS):
        self.ranks = read_ranks(data)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self._transducer = Transducer(self.ranks, REMEMBERED_STEPS)
        self._remembered = remembered
        self._first: dict[str, tuple[int, ...]] = {}
        self._after_space: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    def _pieces(self, text: str) -> tuple[int, ...]:
        encode = self._transducer.encode_piece
        return tuple(i for piece in _PIECES.findall(text) for i in encode(piece.encode()))

    def _word_after_space(self, word: str) -> tuple[int, ...]:
        ids = self._older.get(word)
        if ids is None:
            ids = self._pieces(" " + word)
        if len(word) <= 64:
            if len(self._after_space) >= self._remembered:
                self._older, self._after_space = self._after_space, {}
            self._after_space[word] = ids
        return ids

    def _first_word(self, word: str) -> tuple[int, ...]:
        ids = self._pieces(word)
        if len(word) <= 64:
            if len(self._first) >= self._remembered:
                self._first.clear()
            self._first[word] = ids
        return ids

    def words(self, text: str) -> list[tuple[int, ...]]:
        """The ids of a text, word by word."""
        parts = text.split(" ")
        out = list(map(self._after_space.get, parts))
        out[0] = self._first.get(parts[0])
        if None not in out:
            return out
        for k, ids in enumerate(out):
            if ids is None:
                word = parts[k]
                # Only words without white space at their ends are ever remembered, so that a miss is the only place to look.
                if not word or word[0].isspace() or word[-1].isspace():
                    return self._words_with_white_space(text)
                out[k] = self._word_after_space(word) if k else self._first_word(word)
        return out

    def _words_with_white_space(self, text: str) -> list[tuple[int, ...]]:
        first, *rest = _CUTS.split(text)
        out = [self._pieces(first)]
        for word in rest:
            ids = self._after_space.get(word)
            if ids is None:
                ids = self._pieces(" " + word) if word[-1].isspace() or word[0].isspace() else self._word_after_space(word)
            out.append(ids)
        return out

    def encode(self, text: str | None) -> list[int]:
        """Token ids; none for a null or empty text."""
        return list(chain.from_iterable(self.words(text))) if text else []

    def count(self, text: str | None) -> int:
        return sum(map(len, self.words(text))) if text else 0

    def decode(self, ids: list[int]) -> str:
        return "".join(decode_stream(ids, self.tokens))


def encoder(data: bytes) -> Encoder:
    """The encoder of this process for a vocabulary (the content of its file)."""
    name = hashlib.sha256(data).hexdigest()
    if name not in _encoders:
        _encoders[name] = Encoder(data)
    return _encoders[name]


def read_vocabulary(path: str) -> bytes:
    """The content of a vocabulary file; one beyond ``MOST_BYTES`` is an error, as it is broadcast."""
    with open(path, "rb") as file:
        data = file.read(MOST_BYTES + 1)
    if len(data) > MOST_BYTES:
        raise ValueError(f"{path} has more than {MOST_BYTES} bytes")
    return data


def _shipped(df: DataFrame, path: str) -> Broadcast[bytes]:
    return df.sparkSession.sparkContext.broadcast(read_vocabulary(path))


def encode_texts(documents: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """``key, ids``: the token ids of each text, an empty list for a null or empty one.  Each row gives one row, whatever its key."""
    column, shipped = documents.schema[key], _shipped(documents, path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(shipped.value).words
        for b in in_parts(batches):
            found = [words(t) if t else () for t in b.column(1).to_pylist()]
            ends = np.zeros(len(found) + 1, dtype=np.int32)
            np.cumsum([sum(map(len, f)) for f in found], out=ends[1:])
            flat = np.fromiter(chain.from_iterable(chain.from_iterable(found)), dtype=np.int32, count=int(ends[-1]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], [key, "ids"])

    return documents.select(key, text).mapInArrow(encode, T.StructType([column, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def count_tokens(documents: DataFrame, kept: list[str], text: str, path: str) -> DataFrame:
    """``kept, tokens``: the number of tokens of each text, 0 for a null or empty one."""
    shipped = _shipped(documents, path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = encoder(shipped.value).count
        for b in in_parts(batches):
            sizes = pa.array([number(t) for t in b.column(b.num_columns - 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], sizes], [*kept, "tokens"])

    schema = T.StructType([documents.schema[c] for c in kept] + [T.StructField("tokens", T.LongType())])
    return documents.select(*kept, documents[text].alias("_text")).mapInArrow(count, schema)


def round_trips(documents: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """``key, tokens, exact``: whether decoding the encoded text gives the text back (a null text counts as empty)."""
    shipped = _shipped(documents, path)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shipped.value)
        for b in in_parts(batches):
            ids = [own.encode(t) for t in b.column(1).to_pylist()]
            exact = [own.decode(i) == (t or "") for i, t in zip(ids, b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(i) for i in ids], pa.int64()), pa.array(exact)], [key, "tokens", "exact"])

    schema = T.StructType([documents.schema[key], T.StructField("tokens", T.LongType()), T.StructField("exact", T.BooleanType())])
    return documents.select(key, text).mapInArrow(check, schema)
