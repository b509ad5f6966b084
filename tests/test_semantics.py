"""Edge cases of the operators: nulls, ties, cutoffs, types."""

from datetime import datetime

import pytest

from starnorm.operators import (
    Attach,
    JoinEdge,
    approximate_profile,
    attach_keys,
    build_fact,
    column_profile,
    count_by_dimension,
    dense_key,
    fk_check,
    fk_orphans,
    keyed_dim,
    lookup,
    natural_dim,
    one_row_per_key,
    star_join,
    status_dim,
    with_share,
)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_dense_key_numbers_nulls_first(spark):
    keys = spark.createDataFrame(
        [("b", 1), ("a", None), (None, 2), ("a", 3), (None, None)], "k string, n int"
    )
    numbered = sorted(dense_key(keys, ["k", "n"], "id").collect())
    assert [tuple(r) for r in numbered] == [
        (0, None, None), (1, None, 2), (2, "a", None), (3, "a", 3), (4, "b", 1)]


def test_dense_key_of_nothing(spark):
    assert dense_key(spark.createDataFrame([], "k string"), ["k"], "id").collect() == []


def test_dense_key_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        keys = spark.range(20_000).selectExpr("id * 7919 % 20011 AS k").distinct()
        numbered = dense_key(keys, ["k"], "id").orderBy("k").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [r.id for r in numbered] == list(range(20_000))


def test_dedupe_takes_smallest_then_largest(spark):
    frame = spark.createDataFrame(
        [(1, "b", 1), (1, "a", 9), (1, None, 5), (2, "x", None), (None, "n", 1), (None, "m", 2)],
        "k int, s string, n int",
    )
    assert rows(one_row_per_key(frame, ["k"])) == [(1, None, 5), (2, "x", None), (None, "m", 2)]
    last = one_row_per_key(frame, ["k"], order_by=["n"], keep="last")
    assert rows(last) == [(1, "a", 9), (2, "x", None), (None, "m", 2)]
    with pytest.raises(ValueError):
        one_row_per_key(frame, ["k"], keep="any")


def test_keyed_dim_null_keys(spark):
    frame = spark.createDataFrame(
        [("r1", "x"), ("r1", "w"), (None, None), (None, "left over")], "k string, v string"
    )
    assert rows(keyed_dim(frame, "k", ["v"])) == [("r1", "w"), (None, None)]
    kept = keyed_dim(frame, "k", ["v"], drop_all_null=True)
    assert rows(kept) == [("r1", "w"), (None, "left over")]
    assert rows(keyed_dim(frame, "k", ["v"], drop_null_key=True)) == [("r1", "w")]


def test_natural_dim_all_null_row(spark):
    frame = spark.createDataFrame([(None, None), ("a", None), ("a", None)], "x string, y string")
    assert rows(natural_dim(frame, ["x", "y"], "id")) == [(0, None, None), (1, "a", None)]
    assert rows(natural_dim(frame, ["x", "y"], "id", drop_all_null=True)) == [(0, "a", None)]
    counted = natural_dim(frame, ["x", "y"], "id", row_count="n")
    assert rows(counted) == [(0, None, None, 1), (1, "a", None, 2)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "string"])
def test_status_cutoff(spark, kind):
    frame = spark.createDataFrame(
        [
            ("at", "2021-12-31 00:00:00"),
            ("after", "2021-12-31 00:00:01"),
            ("both", "2020-01-01 00:00:00"),
            ("both", "2022-06-01 00:00:00"),
            ("old", "2020-01-01 00:00:00"),
            ("none", None),
            (None, "2020-01-01 00:00:00"),
        ],
        "k string, ts string",
    )
    frame = frame.withColumn("name", frame.k).withColumn("ts", frame.ts.cast(kind))
    status = {r.k: r.status for r in status_dim(frame, "k", ["name"], "ts").collect()}
    assert status == {
        "at": "Inactive",
        "after": "Active",
        "both": "Active",
        "old": "Inactive",
        "none": "Active",
        None: "Active",
    }


def test_status_parameters(spark):
    frame = spark.createDataFrame([("a", datetime(2030, 1, 1), 2)], "k string, ts timestamp, v int")
    dim = status_dim(
        frame, "k", ["v"], "ts", status="s", cutoff="2031-01-01", inactive="off", active="on"
    )
    assert rows(dim) == [("a", 2, "off")]


NULL_KEYS = [(1, "a", "x"), (2, "a", None), (3, None, None), (4, "b", "y"), (5, "b", "y")]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
@pytest.mark.parametrize("row_count", [None, "n"])
def test_null_parts_of_a_natural_key(spark, broadcast_bytes, row_count):
    facts = spark.createDataFrame(NULL_KEYS, "id int, p string, q string")
    dim = natural_dim(facts, ["p", "q"], "key", row_count=row_count)
    attach = [Attach(dim, ("p", "q"), "key", row_count)]
    plain = attach_keys(facts, attach, broadcast_bytes=broadcast_bytes).select("id", "key")
    assert rows(plain) == [(1, 2), (2, None), (3, None), (4, 3), (5, 3)]
    safe = attach_keys(facts, attach, null_safe=True, broadcast_bytes=broadcast_bytes)
    assert rows(safe.select("id", "key")) == [(1, 2), (2, 1), (3, 0), (4, 3), (5, 3)]


def test_fact_has_one_row_per_grain(spark):
    flat = spark.createDataFrame(
        [("v1", "d", "late"), ("v1", "d", "early"), ("v2", None, "x")], "v string, d string, w string"
    )
    dim = natural_dim(flat, ["d"], "d_id", drop_all_null=True)
    fact = build_fact(flat, [Attach(dim, ("d",), "d_id")], ["v", "d_id", "w"], ["v"])
    assert rows(fact) == [("v1", 0, "early"), ("v2", None, "x")]


def test_lookup_keeps_false_and_null_payloads(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,), (1,)], "k int")
    table = spark.createDataFrame([(1, False, None), (2, True, "t")], "id int, flag boolean, t string")
    for limit in (0, 1 << 20):
        found = lookup(facts, table, {"k": "id"}, {"flag": "flag", "text": "t"}, broadcast_bytes=limit)
        assert rows(found) == [(1, False, None), (1, False, None), (2, True, "t"), (3, None, None)]


FK_ROWS = [("a",), ("a",), ("zz",), ("zz",), (None,)]


def test_fk_check_counts_rows_and_nulls(spark):
    facts = spark.createDataFrame(FK_ROWS, "fk string")
    dim = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    nullable = fk_check(facts, dim, "fk", "k", "Dim", nullable=True).first()
    assert tuple(nullable) == ("Dim", "fk", 1, 2, False)
    required = fk_check(facts, dim, "fk", "k", "Dim", nullable=False).first()
    assert tuple(required) == ("Dim", "fk", 1, 3, False)


def test_fk_check_of_empty_fact(spark):
    empty, dim = spark.createDataFrame([], "fk string"), spark.createDataFrame([("a",)], "k string")
    assert tuple(fk_check(empty, dim, "fk", "k", "Dim").first()) == ("Dim", "fk", 0, 0, True)


def test_fk_check_of_unlike_types(spark):
    facts = spark.createDataFrame([("5",), ("x",)], "fk string")
    dim = spark.createDataFrame([(5,)], "k bigint")
    assert fk_check(facts, dim, "fk", "k", "Dim").first().mismatch_count == 1
    wide = spark.createDataFrame([(5,), (5_000_000_000,)], "fk bigint")
    narrow = spark.createDataFrame([(5,)], "k int")
    assert fk_check(wide, narrow, "fk", "k", "Dim").first().mismatch_count == 1


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_orphans(spark, broadcast_bytes):
    facts = spark.createDataFrame(FK_ROWS, "fk string")
    dim = spark.createDataFrame([("a",), (None,)], "k string")
    found = fk_orphans(facts, dim, "fk", "k", broadcast_bytes=broadcast_bytes)
    assert rows(found) == [("zz",), ("zz",)]
    strict = fk_orphans(facts, dim, "fk", "k", nullable=False, broadcast_bytes=broadcast_bytes)
    assert rows(strict) == [("zz",), ("zz",), (None,)]


def test_star_join_rejects_two_roads(spark):
    frame = spark.range(1)
    edges = [JoinEdge("a", "id", "c", "id"), JoinEdge("b", "id", "c", "id")]
    with pytest.raises(ValueError):
        star_join({"a": frame, "b": frame, "c": frame}, "a", edges, {"id": ("a", "id")})


def test_star_join_skips_tables_nobody_asked_for(spark):
    facts = spark.createDataFrame([(1, 7)], "id int, fk int")
    edges = [JoinEdge("facts", "fk", "dim", "k")]
    # The dimension is not even looked up.
    only = star_join({"facts": facts}, "facts", edges, {"id": ("facts", "id")})
    assert rows(only) == [(1,)]


def test_share_adds_up(spark):
    facts = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1), (None, 1)], "g string, v int")
    shares = with_share(facts.groupBy("g").count(), "count", "part")
    assert rows(shares) == [("x", 2, 0.5), ("y", 1, 0.25), (None, 1, 0.25)]


def test_count_by_dimension_null_group(spark):
    facts = spark.createDataFrame([("a", 1), ("a", None), ("lost", 1), (None, 1)], "fk string, v int")
    dim = spark.createDataFrame([("a", "A"), ("unused", "U")], "k string, g string")
    counted = count_by_dimension(
        facts, dim, "fk", "k", ["g"], "v", name="n", distinct_name="keys"
    )
    assert rows(counted) == [("A", 1, 1), (None, 2, 1)]


def test_profile_counts_null_as_a_value(spark):
    frame = spark.createDataFrame(
        [("a", 1.5, None), ("b", 0.0, None), (None, -0.0, None)], "s string, d double, n int"
    )
    assert rows(column_profile(frame)) == [("d", 2, 0), ("n", 1, 3), ("s", 3, 1)]
    assert rows(approximate_profile(frame)) == [("d", 2, 0), ("n", 1, 3), ("s", 3, 1)]
