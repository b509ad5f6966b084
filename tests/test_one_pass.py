"""Dimensions numbered in one pass, and joins planned from recorded sizes."""

import pytest
from compare import plan
from pyspark.sql import functions as F

from starnorm import catalogue
from starnorm.catalogue import TableSizes, sizes_of, staged_with_sizes
from starnorm.operators import JoinEdge, Numbered, dense_keys, natural_dim, natural_dims, star_join
from starnorm.operators.dimensions import in_one_order
from starqueries.frames import flat

SF_DIR = "/root/testdata/sf0.001"


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture(scope="module")
def source(spark):
    number = F.col("id")
    return spark.range(0, 9_000, numPartitions=5).select(
        F.when(number % 3 > 0, "hot").otherwise((number % 40).cast("string")).alias("a"),
        F.when(number % 7 > 0, number % 11).alias("b"),
        F.when(number % 5 > 2, F.to_date(F.timestamp_seconds(number * 9_000))).alias("c"),
        F.when(number % 2 > 0, number % 300 / 4).alias("d"),
        F.lit(0).alias("__set"),
    )


DIMS = {
    "one": Numbered(("a",), "one_id"),
    "two": Numbered(("b", "c"), "two_id"),
    "strict": Numbered(("c", "d"), "strict_id", drop_all_null=True),
    "three": Numbered(("a", "b", "d"), "three_id"),
}


def assert_as_single(source, dims):
    built = natural_dims(source, dims, "n")
    assert list(built) == list(dims)
    for name, dim in dims.items():
        single = natural_dim(
            source, dim.natural_key, dim.id_name, drop_all_null=dim.drop_all_null, row_count="n"
        )
        assert built[name].columns == single.columns
        assert rows(built[name]) == rows(single)
    return built


def test_dimensions_of_one_pass(spark, source):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    for adaptive in ("true", "false"):  # without it, sets spread over many partitions
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        try:
            built = assert_as_single(source, DIMS)
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len({tuple(frame.inputFiles()) for frame in built.values()}) == 1


def test_no_rows(source):
    assert_as_single(source.limit(0), DIMS)


@pytest.mark.parametrize(
    "keys",
    [
        {"x": ("a", "b"), "y": ("b", "a")},
        {"x": ("a", "b"), "y": ("b", "c"), "z": ("c", "a")},
        {"x": ("a", "b"), "y": ("a", "b")},
        {"x": ("a",)},
    ],
)
def test_orders_that_contradict_and_equal_keys(source, keys):
    assert_as_single(source, {n: Numbered(k, f"{n}_id", n == "y") for n, k in keys.items()})


def test_in_one_order():
    order = in_one_order([("a", "c"), ("b", "c"), ("d", "b")])
    assert order.index("a") < order.index("c") and order.index("d") < order.index("b") < order.index("c")
    assert in_one_order([("a", "b"), ("b", "a")]) is None


def test_sets_are_numbered_apart(spark):
    keys = spark.createDataFrame(
        [("x", 2), ("x", None), ("y", 1), (None, 5), ("y", 0), (None, 4)], "s string, k int"
    )
    assert rows(dense_keys(keys, ["s"], ["k"], "id")) == [
        (0, "x", None), (0, "y", 0), (0, None, 4), (1, "x", 2), (1, "y", 1), (1, None, 5)
    ]


def jobs_of(spark, make):
    """How many jobs ``make`` runs."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
        made = make()
        return made, len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_wide_rows_are_planned_without_a_job(spark):
    columns = ("l_orderkey", "o_orderstatus", "c_mktsegment", "p_brand", "s_name", "r_name")
    first = flat(spark, SF_DIR, *columns)
    frame, jobs = jobs_of(spark, lambda: flat(spark, SF_DIR, *columns))
    assert jobs == 0
    assert plan(frame).count("BroadcastHashJoin") == 6
    assert frame.count() == first.count()


def test_sizes_follow_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(1, "ab", b"xyz", [1]), (2, None, None, None)], "n int, s string, b binary, l array<int>")
    frame.write.parquet(path)
    expected = TableSizes(2, {"s": 2, "b": 3}, {"s": 2, "b": 3}, frozenset({"l"}))
    assert sizes_of(spark, [path]) == {path: expected}
    assert jobs_of(spark, lambda: sizes_of(spark, [path]))[1] == 0
    frame.union(frame).withColumn("s", F.lit("longer")).write.mode("overwrite").parquet(path)
    assert sizes_of(spark, [path])[path].total == {"s": 24, "b": 6}
    stored, sizes = staged_with_sizes(frame)
    assert sizes == expected and rows(stored) == rows(frame)
    assert staged_with_sizes(frame.limit(0))[1].rows == 0
    # Too many rows to be small: text is not looked at.
    large = sizes_of(spark, [path], limit_bytes=8)
    assert large[path].rows == 4
    catalogue._KNOWN.clear()
    assert sizes_of(spark, [path], limit_bytes=8)[path].unbounded == {"s", "b", "l"}


def test_bounds():
    sizes = TableSizes(10, {"s": 50}, {"s": 20}, frozenset({"u"}))
    assert sizes.bound(["n"]) == 80 and sizes.bound(["n", "s"]) == 210
    assert sizes.bound(["s"], rows=3) == 84 and sizes.bound(["u"]) is None


def test_sizes_that_prove_nothing_are_measured(spark, tmp_path):
    facts = spark.range(50).select("id", (F.col("id") % 5).alias("k"))
    dim = spark.range(5).select("id", F.lit("text").alias("v"), (F.col("id") % 2).alias("f"))
    far = spark.range(2).select("id", F.lit("far").alias("w"))
    edges = [JoinEdge("facts", "k", "dim", "id"), JoinEdge("dim", "f", "far", "id")]
    tables = {"facts": facts, "dim": dim, "far": far}
    columns = {"id": ("facts", "id"), "v": ("dim", "v"), "w": ("far", "w")}
    expected = rows(star_join(tables, "facts", edges, columns))
    known = {"dim": TableSizes(5, {"v": 20}, {"v": 4}), "far": TableSizes(2, {"w": 6}, {"w": 3})}
    huge = {**known, "dim": TableSizes(10**9, {"v": 10**10}, {"v": 10**9})}
    for sizes in (known, huge, {"far": known["far"]}):
        joined, jobs = jobs_of(spark, lambda s=sizes: star_join(tables, "facts", edges, columns, sizes=s))
        assert rows(joined) == expected
        assert (jobs == 0) == (sizes is known)
