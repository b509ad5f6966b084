"""SentencePiece encoding and decoding on an Aho-Corasick automaton over the pieces.

One pass over a text's bytes: at each position the automaton's state and the output
links behind it name every piece that ends there, and each relaxes the best score at
that position from the best score at the piece's start. A model of the unigram kind
scores a path by the sum of its pieces' scores. A model of the merge (BPE) kind has one
valid path: a piece may follow another only if merging the two strings' characters
gives exactly these two pieces, and a path that breaks this scores minus infinity.
The longest valid piece then fixes the path, so the same pass gives the library's own
encoding.

Spaces become the mark U+2581, and a mark is put in front. No piece holds a mark after
another character, which is checked when the model is loaded, so a text falls apart at
its marks and a worker encodes each distinct word once. Characters no piece covers
become byte pieces. Null texts have no ids; an empty text has none either.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby
from pathlib import Path

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT = "piece_bpe_32k.model"
MARK = "▁"
# Words in each of the two generations a worker remembers.
REMEMBERED = 200_000
# Rows coded and handed on together.
BATCH_ROWS = 1000
# Longer words are encoded anew each time.
LONG_WORD = 100
# Fixed value: how far below the least score of a piece an unknown character is scored.
UNKNOWN_PENALTY = 10.0
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def default_path() -> str:
    return str(public_tokenizers.path(DEFAULT))


class Codec:
    """Pieces with their scores, the automaton over them, and the words met so far."""

    def __init__(
        self,
        pieces: list[str],
        scores: list[float],
        bytes_of: dict[int, int],
        unknown: int,
        merges: bool,
    ):
        self.scores = scores
        self.merges = merges
        self.byte_id = {value: piece for piece, value in bytes_of.items()}
        self.unknown = unknown
        self.ids = {p: i for i, p in enumerate(pieces) if p and i not in bytes_of}
        self.pieces = pieces
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece holds a mark after another character")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.characters = frozenset(p for p in self.ids if len(p) == 1)
        self.single = [np.float32(score) for score in scores]
        least = min((self.single[i] for i in self.ids.values()), default=np.float32(0))
        self.unknown_score = least - np.float32(UNKNOWN_PENALTY)
        self.raw = [
            bytes([bytes_of[i]]) if i in bytes_of else p.replace(MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self._pairs: dict[int, bool] = {}
        self._words: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    def merged(self, text: str) -> list[int]:
        """Merge the two neighbours of best score, leftmost first, as long as any merge."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best):
                    best, at = self.scores[i], k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids[p] for p in parts]

    def _may_follow(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= REMEMBERED:
                self._pairs.clear()
            both = self.pieces[left] + self.pieces[right]
            known = self._pairs[key] = self.merged(both) == [left, right]
        return known

    def path(self, text: str) -> list[int]:
        """The only valid path of merges through ``text``, all of whose characters are pieces."""
        n = len(text)
        last: list[int] = [-1] * (n + 1)
        size = [0] * (n + 1)
        pairs, follows = self._pairs.get, self._may_follow
        for at, (length, i) in self.automaton.iter(text):
            end = at + 1
            if last[end] >= 0:
                continue  # only one path to this place is valid
            start = end - length
            if start:
                left = last[start]
                if left < 0:
                    continue
                known = pairs(left << 32 | i)
                if not (follows(left, i) if known is None else known):
                    continue
            elif length > 1 and not self._whole(i):
                continue
            last[end], size[end] = i, length
        out = []
        while n:
            out.append(last[n])
            n -= size[n]
        return out[::-1]

    def scored(self, text: str) -> list[int]:
        """The path of best summed score through any ``text``.

        A character that is no piece may be unknown, at a score below all pieces; it
        then stands for its bytes, or, without byte pieces, with its unknown neighbours
        for one unknown piece.
        """
        n = len(text)
        # In single precision, as scores are stored, so that equal sums are equal here, too.
        best = [np.float32(0)] + [np.float32(-math.inf)] * n
        scores = self.single
        last: list[int] = [self.unknown] * (n + 1)
        size = [1] * (n + 1)
        final = 0

        def settle(upto: int) -> None:
            nonlocal final
            while final < upto:
                final += 1
                if text[final - 1] not in self.characters:
                    score = best[final - 1] + self.unknown_score
                    if score > best[final]:
                        best[final], last[final], size[final] = score, self.unknown, 1

        for at, (length, i) in self.automaton.iter(text):
            end = at + 1
            settle(end - 1)
            score = best[end - length] + scores[i]
            if score > best[end]:
                best[end], last[end], size[end] = score, i, length
        settle(n)
        parts: list[list[int]] = []
        while n:
            i, n = last[n], n - size[n]
            if i == self.unknown and self.byte_id:
                parts.append([self.byte_id[byte] for byte in text[n].encode()])
            elif i != self.unknown or not parts or parts[-1] != [i]:
                parts.append([i])
        return list(chain.from_iterable(reversed(parts)))

    def _whole(self, i: int) -> bool:
        """Whether a piece's own characters merge into it."""
        key = -1 - i
        known = self._pairs.get(key)
        if known is None:
            known = self._pairs[key] = self.merged(self.pieces[i]) == [i]
        return known

    def word(self, text: str) -> tuple[int, ...]:
        """Ids of a piece of text between two cuts, characters without a piece as bytes."""
        if not self.merges:
            return tuple(self.scored(text))
        if self.characters.issuperset(text):
            return tuple(self.path(text))
        out: list[int] = []
        for known, part in groupby(text, self.characters.__contains__):
            if known:
                out += self.path("".join(part))
            else:
                for byte in "".join(part).encode():
                    out.append(self.byte_id.get(byte, self.unknown))
        return tuple(out)

    def __getitem__(self, text: str) -> tuple[int, ...]:
        found = self._words.get(text)
        if found is None:
            found = self._older.get(text)
            if found is None:
                found = self.word(text)
            if len(text) <= LONG_WORD:
                if len(self._words) >= REMEMBERED:
                    self._older, self._words = self._words, {}
                self._words[text] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        words = _WORD.findall(MARK + text.replace(" ", MARK))
        return np.fromiter(chain.from_iterable(map(self.__getitem__, words)), np.int32)

    def decode(self, ids) -> str:
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


# Where a model file keeps its kind, and the two kinds read here.
_TRAINER, _MODEL_TYPE = 2, 3
UNIGRAM, MERGES = 1, 2


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message's fields."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            value, at, shift = value | (byte & 127) << shift, at + 1, shift + 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        wire = key & 7
        if wire == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(wire) or number()
        yield key >> 3, raw[at : at + size]
        at += size


def kind_of(raw: bytes) -> int:
    """The kind of a model file; the format's default where it says none."""
    trainer = dict(_fields(raw)).get(_TRAINER, b"")
    return dict(_fields(trainer)).get(_MODEL_TYPE, UNIGRAM)


def merging(path: str) -> bool:
    """Whether a model file is of merges; if not, of scored pieces."""
    kind = kind_of(Path(path).read_bytes())
    if kind not in (UNIGRAM, MERGES):
        raise ValueError(f"{path}: neither a model of scored pieces nor one of merges")
    return kind == MERGES


@lru_cache(maxsize=2)
def load(path: str) -> Codec:
    """Read a model file; once per process. Scored and merge models are read, no others."""
    merges = merging(path)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    probe = "ﬁ  Å a "
    if model.normalize(probe) != MARK + probe.replace(" ", MARK):
        raise ValueError(f"{path}: the model changes texts before it encodes them")
    n = model.get_piece_size()
    named = [model.id_to_piece(i) for i in range(n)]
    bytes_of = {i: int(p[1:-1], 16) for i, p in enumerate(named) if model.is_byte(i)}
    pieces = [
        "" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else p
        for i, p in enumerate(named)
    ]
    scores = [model.get_score(i) for i in range(n)]
    return Codec(pieces, scores, bytes_of, model.unk_id(), merges)


def _ids_array(parts: list[np.ndarray], missing: list[bool]) -> pa.Array:
    index = np.concatenate([[0], np.cumsum([p.size for p in parts])])
    values = pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32), pa.int32())
    return pa.ListArray.from_arrays(pa.array(index, pa.int32()), values, mask=pa.array(missing))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    path: str | None = None,
) -> DataFrame:
    """(id, ids, ids_crc32, decoded) per row; other columns are ignored.

    The file says itself whether its pieces are scored or merged; other kinds raise.

    ``ids_crc32`` is over the ids as little-endian unsigned 32-bit numbers, and
    ``decoded`` is what they stand for. Encoding and decoding share a worker's codec.
    """
    path = path or default_path()
    merging(path)

    def coded(batches):
        codec = load(path)
        for batch in _slices(batches):
            texts = batch.column(1).to_pylist()
            parts = [codec.encode(t or "") for t in texts]
            missing = [t is None for t in texts]
            decoded = [None if t is None else codec.decode(p) for t, p in zip(texts, parts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    _ids_array(parts, missing),
                    pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in parts], pa.int64()),
                    pa.array(decoded, pa.string()),
                ],
                names=["id", "ids", "ids_crc32", "decoded"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kept = rows.schema["id"]
    fields = [
        T.StructField("id", kept.dataType),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("decoded", T.StringType()),
    ]
    return rows.mapInArrow(coded, T.StructType(fields))


def decode(
    encoded: DataFrame, id_col: str = "id", ids: str = "ids", path: str | None = None
) -> DataFrame:
    """(id, text) of rows with ids; null ids give a null text."""
    path = path or default_path()

    def texts(batches):
        codec = load(path)
        for batch in _slices(batches):
            values = [None if i is None else codec.decode(i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.string())], names=["id", "text"]
            )

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids).alias("ids"))
    fields = [rows.schema["id"], T.StructField("text", T.StringType())]
    return rows.mapInArrow(texts, T.StructType(fields))
