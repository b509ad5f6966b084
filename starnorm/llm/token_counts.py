"""Token counts with a shortcut for pre-tokens that are one token.

Offline, once on the driver, every string of the vocabulary is merged by itself; those
that come out as one token are proven whole. A text is cut into pre-tokens; a proven
one counts 1 by lookup, and only the rest is merged. The proven set is part of the
vocabulary, so what each task receives is bounded by the vocabulary's size.

Null texts count as empty: 0 tokens. Strings of special tokens inside a text are one
token each, the default of the file's library. Texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starnorm.llm import vocabulary

CONTEXT = 1024
# Merged pre-tokens remembered per worker, and the characters of one; beyond the number
# the memory starts afresh, and longer ones are merged whenever they are met.
REMEMBERED = 400_000
REMEMBERED_CHARS = 100


@lru_cache(maxsize=4)
def whole_tokens(path: str) -> frozenset[str]:
    """Strings of the vocabulary that are one pre-token and encode as one token."""
    known = vocabulary.load(path)
    proven = []
    for raw in known.ranks:
        try:
            string = raw.decode("utf-8")
        except UnicodeDecodeError:
            continue  # part of a character: no pre-token ends there
        if known.pre_token.fullmatch(string) and len(known.pre_token.findall(string)) == 1:
            if len(known.encoding.encode_ordinary(string)) == 1:
                proven.append(string)
    return frozenset(proven)


class _Counts(dict):
    """Tokens per pre-token: the proven ones from the start, the rest merged when met."""

    def __init__(self, whole: frozenset[str], merged: Callable[[str], list[int]]):
        super().__init__(dict.fromkeys(whole, 1))
        self._whole = whole
        self._limit = len(whole) + REMEMBERED
        self._merged = merged

    def __missing__(self, pre_token: str) -> int:
        if len(pre_token) > REMEMBERED_CHARS:
            return len(self._merged(pre_token))
        if len(self) >= self._limit:
            self.clear()
            self.update(dict.fromkeys(self._whole, 1))
        count = self[pre_token] = len(self._merged(pre_token))
        return count


@lru_cache(maxsize=1)
def _worker(path: str, whole: frozenset[str]) -> tuple[vocabulary.Vocabulary, _Counts]:
    known = vocabulary.load(path)
    return known, _Counts(whole, known.merged)


def token_counter(spark, path: str | None = None):
    """A function from a text column to its token counts (long)."""
    path = path or vocabulary.default_path()
    shared = spark.sparkContext.broadcast(whole_tokens(path))

    @F.arrow_udf("long")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, table = _worker(path, shared.value)
        cut, count, special = known.pre_token.findall, table.__getitem__, known.special

        def of(text: str) -> int:
            if special is None or not special.search(text):
                return sum(map(count, cut(text)))
            parts = special.split(text)
            return len(parts) - 1 + sum(sum(map(count, cut(part))) for part in parts)

        for batch in batches:
            texts = (s.as_py() for s in batch)
            yield pa.array([0 if t is None else of(t) for t in texts], pa.int64())

    return counts


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    limit: int = CONTEXT,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row; other columns are ignored."""
    counter = token_counter(docs.sparkSession, path)
    n_bytes: Column = F.coalesce(F.octet_length(F.col(text)).cast("long"), F.lit(0).cast("long"))
    return (
        docs.select(F.col(id_col), F.col(text))
        .select(F.col(id_col).alias("id"), n_bytes.alias("n_bytes"), counter(text).alias("n_tokens"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
