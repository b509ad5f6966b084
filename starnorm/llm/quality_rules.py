"""Quality rules as a ledger of failure bits and measurements.

Every rule is evaluated once per text. The ledger keeps what was measured and one bit
per failed rule; a policy is a named set of rules, so its verdict is one bitwise test,
and the effect of leaving a rule out of a policy is one aggregation over the bits. New
policies need no second look at the texts.

Words are runs of anything but ASCII white space. A null text has no words and one
empty line; it fails the rules that an empty text fails.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starnorm.llm.blocks import unused_name
from starnorm.llm.spans import (
    IS_SPACE,
    SEEDS,
    covered,
    hash_spans,
    line_spans,
    mixed,
    per_row,
    row_slices,
    text_bytes,
    window_hash,
    windows_inside,
    word_spans,
)

REPEAT_WINDOW = 3
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
# Texts whose bytes are looked at together.
SLICE_BYTES = 1 << 20

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

Measure = Callable[[str], Column]

# Rule name -> condition under which a text fails, given its measurements. A rule's bit
# is its place here; new rules go to the end, so that stored ledgers stay readable.
RULES: dict[str, Callable[[Measure], Column]] = {
    "few_words": lambda m: m("n_words") < 50,
    "repeated_words": lambda m: 100 * m("n_repeat_words") > 50 * m("n_words"),
    "short_words": lambda m: m("word_chars") < 2 * m("n_words"),
    "long_words": lambda m: m("word_chars") > 20 * m("n_words"),
    "symbols": lambda m: 10 * m("n_symbols") > m("n_words"),
    "repeated_lines": lambda m: (m("n_dup_lines") >= 3)
    & (100 * m("n_dup_lines") > 30 * m("n_lines")),
    "many_words": lambda m: m("n_words") > 100_000,
}

# Versions of the policy; "base" holds in all of them.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "short_words", "long_words"),
    "v2": (
        "few_words",
        "repeated_words",
        "short_words",
        "long_words",
        "symbols",
        "repeated_lines",
    ),
}
CURRENT = "v2"


def mask(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in set(rules))


def _repeated(h: np.ndarray, g: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: has its owner the same value elsewhere; is it the first of them."""
    key = h + mixed(owner.astype(np.uint64) + np.uint64(SEEDS[0]))
    order = np.argsort(key, kind="stable")
    key, g = key[order], g[order]
    new = np.ones(h.size, bool)
    new[1:] = (key[1:] != key[:-1]) | (g[1:] != g[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, h.size))
    several, leading = np.empty(h.size, bool), np.zeros(h.size, bool)
    several[order] = np.repeat(size > 1, size)
    leading[order[first]] = True
    return several, leading


def _slice(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    rows = np.arange(offsets.size - 1)
    starts, ends, bounds = word_spans(data, offsets)
    n_words = np.diff(bounds)
    h, g = hash_spans(data, starts, ends, SEEDS)
    at = windows_inside(bounds, REPEAT_WINDOW)
    owner = np.repeat(rows, np.maximum(0, n_words - REPEAT_WINDOW + 1))
    wh, wg = window_hash(h, REPEAT_WINDOW)[at], window_hash(g, REPEAT_WINDOW, SEEDS[1])[at]
    several, _ = _repeated(wh, wg, owner)
    begins = at[several]
    repeat_words = covered(begins, begins + REPEAT_WINDOW, starts.size)

    first, last, lines = line_spans(data, offsets)
    words_to = np.searchsorted(starts, last) - np.searchsorted(starts, first)
    worded = words_to > 0
    line_h, line_g = hash_spans(data, first[worded], last[worded], SEEDS)
    line_owner = np.repeat(rows, np.diff(lines))[worded]
    duplicate = np.zeros(first.size, bool)
    duplicate[worded] = ~_repeated(line_h, line_g, line_owner)[1]

    code_points = ((data & 0xC0) != 0x80) & ~IS_SPACE[data]
    return [
        n_words,
        per_row(code_points, offsets),
        per_row(SYMBOLS[data], offsets),
        per_row(duplicate, lines),
        per_row(repeat_words, bounds),
        per_row(worded, lines),
    ]


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in MEASURES]))
def measured(texts: pa.Array) -> pa.Array:
    """All measurements of each text."""
    data, offsets = text_bytes(texts)
    parts = [
        _slice(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        for lo, hi in row_slices(offsets, SLICE_BYTES)
    ]
    columns = [
        np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64)
        for k in range(len(MEASURES))
    ]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], MEASURES)


def _failed(measure: Measure) -> Column:
    bits = [
        F.when(fails(measure), F.lit(1 << k)).otherwise(F.lit(0))
        for k, fails in enumerate(RULES.values())
    ]
    return sum(bits[1:], bits[0]).cast("long")


def ledger(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, measurements, failed): one row per input row; other columns are ignored."""
    return (
        docs.select(F.col(id_col).alias("id"), measured(F.col(text)).alias("m"))
        .select("id", "m.*")
        .withColumn("failed", _failed(F.col))
    )


def passes(failed: Column, policy: str = CURRENT) -> Column:
    """The verdict of a policy on failure bits."""
    return failed.bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablations(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """(rule, n_failed, n_only, n_kept_without): what each rule of a policy does.

    ``n_only`` texts are rejected by this rule alone. One aggregation over the bits.
    """
    whole = mask(POLICIES[policy])
    failed = F.col("failed").bitwiseAND(F.lit(whole))
    rules = POLICIES[policy]
    sums = [F.count_if(failed == 0).alias("kept")]
    for rule in rules:
        bit = mask((rule,))
        sums.append(F.count_if(failed.bitwiseAND(F.lit(bit)) != 0).alias(f"failed_{rule}"))
        sums.append(F.count_if(failed == bit).alias(f"only_{rule}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.col(f"failed_{rule}").alias("n_failed"),
                F.col(f"only_{rule}").alias("n_only"),
                (F.col("kept") + F.col(f"only_{rule}")).alias("n_kept_without"),
            )
            for rule in rules
        ]
    )
    return entries.agg(*sums).select(F.inline(rows))


def keep_good(docs: DataFrame, text: str = "text", policy: str = CURRENT) -> DataFrame:
    """The rows a policy keeps, with all their columns."""
    taken = unused_name("measured", docs.columns)
    frame = docs.withColumn(taken, measured(F.col(text)))
    failed = _failed(lambda name: F.col(taken)[name])
    return frame.where(passes(failed, policy)).drop(taken)
