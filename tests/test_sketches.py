"""Stored distinct-count sketches against exact counts."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starnorm.operators import (
    approximate_profile,
    column_profile,
    column_sketches,
    estimated,
    group_sketches,
    merged,
    relative_error,
    rolled_up,
)
from starnorm.staging import staged


@pytest.fixture(scope="module")
def visits(spark):
    number = F.col("id")
    return spark.range(0, 60_000, numPartitions=6).select(
        number,
        (number % 7).cast("int").alias("n"),
        F.when(number % 3 > 0, F.concat(F.lit("k"), number % 20_011)).alias("k"),
        F.when(number % 3 == 0, F.lit("hot")).otherwise(number.cast("string")).alias("skewed"),
        (number % 50 / 4).alias("d"),
        F.timestamp_seconds(number % 9_000).alias("t"),
        F.lit(None).cast("double").alias("nothing"),
        F.array(number % 5).alias("list"),
        F.lit(1).alias("__group"),
    )


def within(estimate: int, exact: int) -> bool:
    return abs(estimate - exact) <= 5 * relative_error() * exact


def test_merged_loads_estimate_the_whole(visits):
    columns = [c for c in visits.columns if c != "list"]
    exact = {r.column_name: (r.n_distinct, r.n_null) for r in column_profile(visits, columns).collect()}
    loads = [staged(column_sketches(visits.filter(F.col("id") % 4 == k), columns)) for k in range(4)]
    whole = merged(*loads)
    assert {r.column_name: r.n_rows for r in whole.collect()} == dict.fromkeys(columns, 60_000)
    for source in (estimated(whole), approximate_profile(visits, columns)):
        found = {r.column_name: (r.n_distinct, r.n_null) for r in source.collect()}
        assert found.keys() == exact.keys()
        for name, (n_distinct, n_null) in exact.items():
            assert found[name][1] == n_null
            assert within(found[name][0], n_distinct)


def test_merging_a_load_twice_changes_no_estimate(visits):
    once = staged(column_sketches(visits, ["k", "d"]))
    twice = merged(once, once)
    first, second = ({r.column_name: r.n_distinct for r in estimated(s).collect()} for s in (once, twice))
    assert first["d"] == second["d"] and within(second["k"], first["k"])


def test_one_zero_and_nested_values(spark, visits):
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (None,)], "d double")
    assert approximate_profile(zeros).first().n_distinct == 3
    assert approximate_profile(visits, ["list"]).first().n_distinct == 5
    with pytest.raises(ValueError, match="no hash"):
        approximate_profile(spark.sql("SELECT map(1, 2) AS m"))


def test_no_rows(spark):
    nothing = spark.createDataFrame([], "a int, b string")
    for profile in (column_profile, approximate_profile):
        assert sorted(map(tuple, profile(nothing).collect())) == [("a", 0, 0), ("b", 0, 0)]


def test_groups_roll_up(visits):
    daily = staged(group_sketches(visits, ["n", (F.col("id") % 10).alias("day")], "k"))
    assert daily.count() == 70
    exact = visits.groupBy("n").agg(F.countDistinct("k").alias("e"), F.count("k").alias("r"))
    exact = {r.n: (r.r, r.e) for r in exact.collect()}
    found = {r.n: (r.n_rows, r.n_distinct) for r in rolled_up(daily, ["n"]).collect()}
    assert found.keys() == exact.keys()
    assert all(found[n][0] == exact[n][0] and within(found[n][1], exact[n][1]) for n in exact)


def test_values_of_every_type_keep_their_type(spark):
    rows = [
        (1, 2.5, "1", date(2024, 1, 1), datetime(2024, 1, 1), True, b"x", 1.5),
        (1, 2.5, "01", date(2024, 1, 1), datetime(2024, 1, 2), False, b"x", 1.5),
        (None, -0.0, "1", None, None, None, None, None),
        (2**40, 0.0, "", date(2024, 1, 2), datetime(2024, 1, 1), True, b"", 2.5),
    ]
    schema = "l long, d double, s string, a date, t timestamp, b boolean, y binary, f float"
    frame = spark.createDataFrame(rows, schema).withColumn("c", F.col("d").cast("decimal(9,3)"))
    frame = frame.withColumn("u", F.col("t").cast("timestamp_ntz")).withColumn("v", F.lit(None))
    frame = frame.withColumn("i", F.col("l").cast("string").try_cast("smallint"))
    got = {r.column_name: (r.n_distinct, r.n_null) for r in column_profile(frame).collect()}
    expected = dict(l=(3, 1), d=(2, 0), s=(3, 0), a=(3, 1), t=(3, 1), b=(3, 1), y=(3, 1), f=(3, 1))
    expected |= dict(c=(2, 0), u=(3, 1), v=(1, 4), i=(2, 2))
    assert got == expected
