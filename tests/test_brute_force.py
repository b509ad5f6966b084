"""Operators against a few lines of Python, on random rows full of nulls and ties."""

import random
from collections import Counter

import pytest

from starnorm.operators import (
    Attach,
    attach_keys,
    column_profile,
    count_by_dimension,
    fk_check,
    fk_orphans,
    keyed_dim,
    natural_dim,
    one_row_per_key,
)

SCHEMA = "id int, k string, a int, b string"


def make(seed: int) -> list[tuple]:
    pick = random.Random(seed)
    some = [None, "", "x", "y", "zz", "é", "Z"]
    return [
        (i % 37, pick.choice(some), pick.choice([None, 0, 1, 2]), pick.choice(some))
        for i in range(pick.randint(1, 120))
    ]


def low(value):
    """Sorts nulls first and text by its bytes."""
    if value is None:
        return (0, b"")
    return (1, value.encode() if isinstance(value, str) else value)


def ordered(rows):
    return sorted(rows, key=lambda row: [low(v) for v in row])


def collected(frame):
    return ordered(map(tuple, frame.collect()))


@pytest.fixture(scope="module", params=[1, 2, 3, 4])
def case(spark, request):
    rows = make(request.param)
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(request.param * 2)


def test_dedupe(case):
    rows, frame = case
    first, last = {}, {}
    for row in ordered((r[1], r[0], r[2], r[3]) for r in rows):
        first.setdefault(row[0], row)
        last[row[0]] = row
    narrow = frame.select("k", "id", "a", "b")
    assert collected(one_row_per_key(narrow, ["k"])) == ordered(first.values())
    assert collected(one_row_per_key(narrow, ["k"], keep="last")) == ordered(last.values())


@pytest.mark.parametrize("drop", [False, True])
def test_natural_keys_and_fact(case, drop):
    rows, frame = case
    keys = ordered({(r[2], r[3]) for r in rows if not drop or (r[2], r[3]) != (None, None)})
    ids = {key: i for i, key in enumerate(keys)}
    dim = natural_dim(frame, ["a", "b"], "key", drop_all_null=drop, row_count="n")
    sizes = Counter((r[2], r[3]) for r in rows)
    assert collected(dim) == ordered((i, *key, sizes[key]) for key, i in ids.items())
    for null_safe in (False, True):
        expected = ordered(
            (r[0], ids.get((r[2], r[3])) if null_safe or None not in (r[2], r[3]) else None)
            for r in rows
        )
        for limit in (0, 1 << 20):
            got = attach_keys(
                frame,
                [Attach(dim, ("a", "b"), "key", "n")],
                null_safe=null_safe,
                broadcast_bytes=limit,
            )
            assert collected(got.select("id", "key")) == expected


def test_keyed_dim(case):
    rows, frame = case
    winners = {}
    for row in ordered((r[1], r[2], r[3]) for r in rows):
        if row != (None, None, None):
            winners.setdefault(row[0], row)
    assert collected(keyed_dim(frame, "k", ["a", "b"], drop_all_null=True)) == ordered(
        winners.values()
    )


def test_foreign_keys(case):
    rows, frame = case
    known = {"x", "zz"}
    dim = frame.sparkSession.createDataFrame([(k,) for k in known], "key string")
    nulls = sum(r[1] is None for r in rows)
    lost = [r for r in rows if r[1] is not None and r[1] not in known]
    report = fk_check(frame, dim, "k", "key", "dim").first()
    assert (report.null_count, report.mismatch_count) == (nulls, len(lost))
    strict = fk_check(frame, dim, "k", "key", "dim", nullable=False).first()
    assert (strict.null_count, strict.mismatch_count) == (nulls, nulls + len(lost))
    assert collected(fk_orphans(frame, dim, "k", "key")) == ordered(lost)


def test_counts_by_dimension(case):
    rows, frame = case
    dim = frame.sparkSession.createDataFrame(
        [("x", "one"), ("y", "one"), ("zz", "two"), ("unused", "three")], "key string, g string"
    )
    group = {"x": "one", "y": "one", "zz": "two"}
    visits = Counter()
    for r in rows:
        visits[group.get(r[1])] += r[2] is not None
    keys = Counter(group.get(k) for k in {r[1] for r in rows} - {None})
    expected = ordered((g, n, keys[g]) for g, n in visits.items())
    got = count_by_dimension(
        frame, dim, "k", "key", ["g"], "a", name="n", distinct_name="n_keys"
    )
    assert collected(got) == expected


def test_profile(case):
    rows, frame = case
    names = frame.columns
    expected = [
        (name, len({r[i] for r in rows}), sum(r[i] is None for r in rows))
        for i, name in enumerate(names)
    ]
    assert collected(column_profile(frame)) == ordered(expected)
