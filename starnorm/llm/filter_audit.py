"""What several filters do to a corpus in every order, from one table of coalitions.

Every filter is evaluated once per text, as one bit. Bits are counted per part and
pattern; from these few counts the removals of all ``2 ** n`` coalitions of filters
follow, and nothing else is needed. What a filter removes at a step of an order is the
difference of two coalitions. Its Shapley value is the answer of a least-squares
problem: the additive function that is closest to the removals of all coalitions, each
weighted by the Shapley kernel, and equal to them on the coalition of all filters. Its
normal equations depend on the number of filters alone and are solved exactly, in
rationals; the answer is linear in the removals, so it becomes whole-number weights.

Rows are texts by their SHA-256 digest when they are compared with each other. A text
that many rows share is one row per task before anything is shuffled.

A null text counts as empty and equals an empty one; a null part counts as the empty
string. A null id is larger than all others. Rows with equal id and text do not repeat
each other, as neither id is smaller. A document with several labels is good (toxic) if
any of them says so; labels with a null id belong to no document. An empty table has no
parts and gives no rows. Other columns are ignored. Texts are taken whole.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping
from fractions import Fraction
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starnorm.staging import staged

WORD = r"[^\x20\x09-\x0D]+"

# What the conditions read of a text, evaluated once.
MEASURES: dict[str, Callable[[Column], Column]] = {
    "words": lambda text: F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
    "capitals": lambda text: F.length(F.regexp_replace(text, "[^A-Z]", "")),
    "code_points": F.length,
    "marked": lambda text: text.rlike(r"[#$%&*|]"),
}

Measured = Callable[[str], Column]

# Filter -> condition under which a text fails, given its measures.
FILTERS: dict[str, Callable[[Measured], Column]] = {
    "A": lambda m: F.size(m("words")) < 100,
    "B": lambda m: 100 * F.size(F.array_distinct(m("words"))) < 80 * F.size(m("words")),
    "C": lambda m: 100 * m("capitals").cast("long") > 10 * m("code_points").cast("long"),
    "D": lambda m: m("marked"),
}
# The filter that fails texts a smaller id has, too.
REPEATED = "E"
COUNTS = ("n", "good", "toxic")


def solved(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """The solution of a regular system of equations, exactly."""
    rows = [[*row, value] for row, value in zip(matrix, right, strict=True)]
    for k in range(len(rows)):
        pivot = next(i for i in range(k, len(rows)) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i, row in enumerate(rows):
            if i != k and row[k]:
                rows[i] = [x - row[k] * y for x, y in zip(row, rows[k], strict=True)]
    return [row[-1] for row in rows]


def shapley_weights(n: int) -> list[list[int]]:
    """Whole numbers w: filter i's Shapley value times n! is the sum of w[i][S] removed[S].

    The kernel-weighted normal equations, bordered by the multiplier of the efficiency
    constraint, are solved for the unit vector of every coalition S.
    """
    everything = (1 << n) - 1
    kernel = {
        s: Fraction(n - 1, math.comb(n, s.bit_count()) * s.bit_count() * (n - s.bit_count()))
        for s in range(1, everything)
    }
    normal = [
        [sum((k for s, k in kernel.items() if s >> i & s >> j & 1), Fraction()) for j in range(n)]
        + [Fraction(1)]
        for i in range(n)
    ]
    bordered = [*normal, [Fraction(1)] * n + [Fraction()]]
    orders = math.factorial(n)
    columns = []
    for s in range(1 << n):
        right = [kernel.get(s, Fraction()) * (s >> i & 1) for i in range(n)]
        answer = solved(bordered, [*right, Fraction(s == everything)])
        scaled = [value * orders for value in answer[:n]]
        if any(value.denominator != 1 for value in scaled):
            raise ArithmeticError("weights are multiples of one part in n!")
        columns.append([int(value) for value in scaled])
    return [list(row) for row in zip(*columns, strict=True)]


def steps(names: str) -> list[dict]:
    """Every step of every order: the coalition before it and the filter's place."""
    found = []
    for order in permutations(range(len(names))):
        before = 0
        for k, i in enumerate(order):
            spelled = "".join(names[j] for j in order)
            found.append({"filter_order": spelled, "step": k + 1, "before": before, "place": i})
            before |= 1 << i
    return found


def patterns(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Callable[[Measured], Column]] = FILTERS,
    id_col: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of filters they fail.

    Bit i of ``mask`` is the i-th filter, the last bit that the text is repeated.
    """
    raw = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    measured = raw.select(
        "id",
        "part",
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        *[measure(F.col("text")).alias(name) for name, measure in MEASURES.items()],
    )
    bits = [
        F.when(fails(F.col), F.lit(1 << k)).otherwise(F.lit(0))
        for k, fails in enumerate(filters.values())
    ]
    marked = measured.select("id", "part", "digest", sum(bits, F.lit(0)).alias("mask"))
    # Equal texts fail alike, so all but the id is settled by part and digest.
    rows = marked.groupBy("digest", "part", "mask", "id").agg(F.count(F.lit(1)).alias("n"))
    judged = (
        labels.select(
            F.col("doc_id").cast("long").alias("labelled"),
            F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int").alias("good"),
            F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int").alias("toxic"),
        )
        .where("labelled IS NOT NULL")
        .groupBy("labelled")
        .agg(F.max("good").alias("is_good"), F.max("toxic").alias("is_toxic"))
    )
    # Rows without an id meet no label; a hash of their text spreads them over all tasks.
    key = F.coalesce("id", F.xxhash64("digest", "part"))
    met = (
        rows.withColumn("key", key)
        .join(judged, (F.col("key") == F.col("labelled")) & F.col("id").isNotNull(), "left")
        .select(
            "digest",
            "part",
            "mask",
            F.col("id").isNull().alias("none"),
            "id",
            "n",
            (F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"),
            (F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"),
        )
    )
    first = F.min(F.struct("none", "id", *COUNTS)).alias("first")
    sums = [F.sum(c).alias(c) for c in COUNTS]
    # One row for each text of a part; read twice, and what a lost task falls back to.
    texts = staged(met.groupBy("digest", "part", "mask").agg(first, *sums), "audited-texts")
    least = texts.groupBy("digest").agg(F.min(F.struct("first.none", "first.id")).alias("least"))
    leads = F.struct("first.none", "first.id").eqNullSafe(F.col("least"))
    passing = {c: F.when(leads, F.col(f"first.{c}")).otherwise(F.lit(0)) for c in COUNTS}
    repeated = F.lit(1 << len(filters))
    split = F.array(
        F.struct(F.col("mask"), *[passing[c].alias(c) for c in COUNTS]),
        F.struct(
            F.col("mask").bitwiseOR(repeated).alias("mask"),
            *[(F.col(c) - passing[c]).alias(c) for c in COUNTS],
        ),
    )
    return (
        texts.join(least, "digest")
        .select("part", F.inline(split))
        .groupBy("part", "mask")
        .agg(*sums)
    )


def coalitions(found: DataFrame, n_filters: int) -> DataFrame:
    """(part, total, removed, good, toxic): arrays over all coalitions, by their number."""
    every = F.explode(F.sequence(F.lit(0), F.lit((1 << n_filters) - 1))).alias("coalition")
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    removed = [F.sum(F.when(hit, F.col(c)).otherwise(F.lit(0))).alias(c) for c in COUNTS]
    table = (
        found.select("*", every)
        .groupBy("part", "coalition")
        .agg(F.sum("n").alias("total"), *removed)
    )
    # As many entries as there are coalitions.
    entries = F.array_sort(F.collect_list(F.struct("coalition", *COUNTS))).alias("entries")
    return table.groupBy("part").agg(F.max("total").alias("total"), entries).select(
        "part",
        "total",
        F.col("entries.n").alias("removed"),
        F.col("entries.good").alias("good"),
        F.col("entries.toxic").alias("toxic"),
    )


def audit(found: DataFrame, names: str) -> DataFrame:
    """Per part, order and step what the step's filter does, from ``patterns``."""
    n = len(names)
    weights = shapley_weights(n)
    constant = json.dumps(
        [
            {**step, "after": step["before"] | 1 << step["place"], "alone": 1 << step["place"]}
            for step in steps(names)
        ]
    )
    schema = (
        "array<struct<filter_order: string, step: int, before: int, place: int, "
        "after: int, alone: int>>"
    )
    values = F.array(
        *[
            F.aggregate(
                F.zip_with(
                    "removed", F.array(*[F.lit(w).cast("long") for w in row]), lambda a, b: a * b
                ),
                F.lit(0).cast("long"),
                lambda total, x: total + x,
            )
            for row in weights
        ]
    )

    def at(counts: str, coalition: str) -> Column:
        return F.element_at(counts, F.col(f"s.{coalition}") + 1)

    def gone(counts: str) -> Column:
        return at(counts, "after") - at(counts, "before")

    every = (1 << n) - 1
    others = F.element_at("removed", F.lit(every).bitwiseXOR(F.col("s.alone")) + 1)
    return (
        coalitions(found, n)
        .withColumn("shapleys", values)
        .select("*", F.explode(F.from_json(F.lit(constant), schema)).alias("s"))
        .select(
            "part",
            "s.filter_order",
            "s.step",
            (F.col("total") - at("removed", "after")).alias("kept"),
            gone("removed").alias("removed"),
            (at("removed", "alone") - gone("removed")).alias("redundant"),
            (F.element_at("removed", every + 1) - others).alias("unique_fails"),
            gone("good").alias("good_lost"),
            gone("toxic").alias("toxic_lost"),
            F.element_at("shapleys", F.col("s.place") + 1).alias("shapley"),
        )
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All orders of the five filters over whole documents, per language."""
    return audit(patterns(docs, labels), "".join(FILTERS) + REPEATED)
