"""Plans and placement: what must hold for the operators to work on large data."""

import re
import sys

import pytest
from compare import plan
from pyspark.sql import functions as F

from starnorm.operators import (
    Attach,
    FkEdge,
    attach_keys,
    column_profile,
    count_by_dimension,
    dense_key,
    fk_check,
    fk_orphans,
    fk_suite,
    lookup,
    natural_dim,
    one_row_per_key,
    row_counts,
    status_dim,
    with_share,
)
from starnorm.plans.normalize import normalize
from starnorm.sizing import fits, sized_shuffles
from starqueries.frames import STAR, star_input, table
from starqueries.spark import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def settings(spark):
    """Change settings for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def skewed(spark):
    """A third of the rows under one key, a third under null, the rest spread."""
    kind = F.pmod(F.col("id"), F.lit(3))
    return spark.range(30_000).select(
        F.col("id"),
        F.when(kind == 0, "hot").when(kind == 1, F.concat(F.lit("k"), F.col("id"))).alias("k"),
    )


def largest_share(frame) -> float:
    sizes = [r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


@pytest.mark.parametrize("row_count", [None, "n"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_lookup_spreads_hot_and_null_keys(spark, settings, skewed, row_count, null_safe):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="16",
    )
    dim = natural_dim(skewed, ["k"], "key", row_count=row_count)
    rows = attach_keys(
        skewed, [Attach(dim, ("k",), "key", row_count)], null_safe=null_safe, broadcast_bytes=0
    )
    assert "SortMergeJoin" in plan(rows)
    assert rows.count() == 30_000
    assert largest_share(rows) < 0.12
    # Same result as the plain join.
    ours = skewed.alias("f").join(
        dim.alias("d"), F.col("f.k").eqNullSafe(F.col("d.k")), "left"
    ).select("f.id", F.when(F.col("f.k").isNotNull() | F.lit(null_safe), F.col("key")).alias("key"))
    assert rows.select("id", "key").exceptAll(ours).count() == 0


def test_copies_of_one_row_are_spread(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="16",
    )
    facts = spark.range(0, 32_000, numPartitions=64).select(F.lit("same").alias("k"))
    dim = spark.createDataFrame([("same", 1), ("other", 2)], "k string, v int")
    found = lookup(facts, dim, {"k": "k"}, {"v": "v"}, broadcast_bytes=0)
    assert found.filter("v = 1").count() == 32_000
    assert largest_share(found) < 0.3


def test_wide_hot_keys_are_salted(spark, monkeypatch, settings, skewed):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="16",
    )
    module = sys.modules["starnorm.operators.lookup"]
    monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(module, "HOT_PARTS", 100)
    dim = natural_dim(skewed, ["k"], "key", drop_all_null=True)
    whole = lookup(skewed, dim, {"k": "k"}, {"key": "key"}, broadcast_bytes=1 << 30)
    split = lookup(skewed, dim, {"k": "k"}, {"key": "key"}, broadcast_bytes=0)
    assert largest_share(split) < 0.2
    assert whole.exceptAll(split).count() == split.exceptAll(whole).count() == 0


@pytest.mark.parametrize(
    ("fact", "key", "matches"),
    [
        ("int", "bigint", 40_000),
        ("int", "double", 40_000),
        ("double", "decimal(12,2)", 40_000),
        ("decimal(10,0)", "bigint", 40_000),
        ("int", "string", 40_000),
        ("double", "string", 40_000),
        ("date", "timestamp", 40_000),
        ("timestamp", "timestamp_ntz", 40_000),
    ],
)
def test_lookup_is_the_same_at_any_size(spark, settings, fact, key, matches):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    stamp = "date" in fact or "time" in fact

    def typed(kind):
        if stamp:
            return F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).cast(kind)
        text = F.lpad(F.col("id").cast("string"), 9, "0")
        return text if kind == "string" else F.col("id").cast(kind)

    facts = spark.range(60_000).select("id", typed(fact).alias("k"))
    table = spark.range(40_000).select(typed(key).alias("key"), F.col("id").alias("v"))
    found = [
        lookup(facts, table, {"k": "key"}, {"v": "v"}, broadcast_bytes=limit)
        for limit in (0, 1 << 30)
    ]
    assert "SortMergeJoin" in plan(found[0])
    assert [f.filter("v = id").count() for f in found] == [matches, matches]
    assert [f.filter("v IS NULL").count() for f in found] == [60_000 - matches] * 2
    check = fk_check(facts, table, "k", "key", "table").first()
    assert check.mismatch_count == 60_000 - matches and check.null_count == 0


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("route", ["broadcast", "shuffled", "hot", "salted", "counted"])
def test_keys_that_become_one_are_one_row(spark, monkeypatch, settings, route, null_safe):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    module = sys.modules["starnorm.operators.lookup"]
    if route in ("hot", "salted"):
        monkeypatch.setattr(module, "HOT_PARTS", 3)
    if route == "salted":
        monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    facts = spark.createDataFrame([(i, i % 4 or None) for i in range(40)], "id int, k int")
    table = spark.createDataFrame(
        [("1", "b", 9), ("01", "a", 1), (" 1", "c", 1), ("2", "d", 5), ("x", "e", 0), (None, "n", 10)],
        "key string, v string, n long",
    )
    limit = 1 << 30 if route == "broadcast" else 0
    counted = "n" if route == "counted" else None
    found = lookup(
        facts, table, {"k": "key"}, {"v": "v"}, null_safe=null_safe, broadcast_bytes=limit, row_count=counted
    )
    # The first of ' 1', '01' and '1' as text; 'x' is no number, and not a null either.
    expected = {0: "n" if null_safe else None, 1: "c", 2: "d", 3: None}
    assert {r.id: r.v for r in found.collect()} == {i: expected[i % 4] for i in range(40)}
    assert found.count() == 40


def test_text_that_is_no_number_matches_no_null(spark):
    facts = spark.createDataFrame([("x",), ("01",), (None,)], "k string")
    table = spark.createDataFrame([(1, "one"), (None, "none")], "key int, v string")
    for limit in (0, 1 << 30):
        found = lookup(facts, table, {"k": "key"}, {"v": "v"}, null_safe=True, broadcast_bytes=limit)
        assert {r.k: r.v for r in found.collect()} == {"x": None, "01": "one", None: "none"}


def test_kinds_that_do_not_compare_are_refused(spark):
    facts = spark.createDataFrame([(1,)], "k int")
    table = spark.createDataFrame([], "key date")
    with pytest.raises(ValueError, match="do not compare"):
        lookup(facts, table, {"k": "key"}, {"v": "key"})


def test_share_of_nothing_is_null(spark):
    grouped = spark.createDataFrame([("a", 0)], "g string, n long")
    assert with_share(grouped).first().share is None


def test_profile_tells_instants_apart(spark, settings):
    settings(spark__sql__session__timeZone="America/New_York")
    stamps = spark.sql("SELECT explode(array(timestamp_seconds(1730611800), timestamp_seconds(1730615400))) AS t")
    assert column_profile(stamps).first().n_distinct == 2
    with pytest.raises(ValueError, match="nested"):
        column_profile(spark.createDataFrame([(["a"],)], "a array<string>"))


def test_broadcast_follows_measured_size(spark, settings, skewed):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    dim = natural_dim(skewed, ["k"], "key")
    fitting = lookup(skewed, dim, {"k": "k"}, {"key": "key"})
    assert "SortMergeJoin" not in plan(fitting)
    assert "SortMergeJoin" in plan(
        lookup(skewed, dim, {"k": "k"}, {"key": "key"}, broadcast_bytes=200_000)
    )
    assert fits(dim, 1 << 20)
    assert not fits(dim, 200_000)
    assert not fits(dim, 0)
    assert not fits(spark.createDataFrame([([1],)], "a array<int>"), 1 << 20)


def test_fits_counts_text(spark):
    frame = spark.createDataFrame([("x" * 1000,), (None,)], "s string")
    assert fits(frame, 1016) and not fits(frame, 1015)


def test_dedupe_limits_before_the_shuffle(spark):
    text = plan(one_row_per_key(table(spark, SF_DIR, "lineitem"), ["l_orderkey"]))
    before, after = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
    assert before < text.index("Exchange hashpartitioning") < after
    assert text.count("Exchange") == 1


def test_status_takes_one_shuffle(spark):
    orders = table(spark, SF_DIR, "orders")
    text = plan(status_dim(orders, "o_custkey", ["o_orderstatus"], "o_orderdate"))
    assert text.count("Exchange") == 1
    assert "partial_max" in text and "partial_min" in text
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_orderdate", text)


def test_fk_check_counts_before_the_join(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(
        fk_check(
            table(spark, SF_DIR, "lineitem"), table(spark, SF_DIR, "orders"),
            "l_orderkey", "o_orderkey", "orders",
        )
    )
    # One shuffle per side, none between count and join, one for the single report row.
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("Exchange") == 3
    assert "ReadSchema: struct<l_orderkey:bigint>" in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_mart_counts_before_the_join(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(
        count_by_dimension(
            table(spark, SF_DIR, "orders"), table(spark, SF_DIR, "customer"),
            "o_custkey", "c_custkey", ["c_mktsegment"], "o_custkey",
        )
    )
    join = text.index("SortMergeJoin")
    assert "partial_count" in text[join:]
    assert text.count("Exchange hashpartitioning") == 3


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["filter_eq"](spark, SF_DIR))
    assert "EqualTo(c_mktsegment,BUILDING)" in text
    text = plan(QUERIES["project_dim"](spark, SF_DIR))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_mktsegment:string>" in text


@pytest.mark.parametrize("partitions, adaptive", [("1", "true"), ("7", "false"), ("200", "true")])
def test_star_does_not_depend_on_partitioning(spark, settings, partitions, adaptive):
    flat = star_input(spark, SF_DIR)
    usual = normalize(flat, STAR, stage_input=True)
    settings(
        spark__sql__shuffle__partitions=partitions,
        spark__sql__adaptive__enabled=adaptive,
        spark__sql__autoBroadcastJoinThreshold="-1",
    )
    other = normalize(flat, STAR, stage_input=True, broadcast_bytes=0)
    for name, expected in usual.items():
        assert sorted(expected.collect(), key=repr) == sorted(other[name].collect(), key=repr)


def test_surrogates_are_stable_between_actions(spark):
    part = table(spark, SF_DIR, "part")
    dim = natural_dim(part, ["p_brand", "p_type", "p_size"], "id")
    assert sorted(dim.collect()) == sorted(dim.collect())
    again = natural_dim(part.repartition(5), ["p_brand", "p_type", "p_size"], "id")
    assert sorted(dim.collect()) == sorted(again.collect())


def test_numbering_uses_many_partitions(spark, settings):
    settings(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="16")
    keys = spark.range(16_000).select(F.col("id").alias("k"))
    assert largest_share(dense_key(keys, ["k"], "id")) < 0.3


def test_orphans_and_counts_agree(spark):
    orders, customer = table(spark, SF_DIR, "orders"), table(spark, SF_DIR, "customer")
    some = customer.filter("c_custkey % 3 = 0")
    orphans = fk_orphans(orders, some, "o_custkey", "c_custkey")
    report = fk_check(orders, some, "o_custkey", "c_custkey", "customer").first()
    sizes = {r.table_name: r.n_rows for r in row_counts({"orphans": orphans}).collect()}
    assert sizes == {"orphans": report.mismatch_count}


def test_shuffles_grow_with_the_input(spark, settings):
    settings(spark__sql__shuffle__partitions="8")
    for size, partitions in ((1000, 8), (10**12, 7451), (10**14, 745_059)):
        with sized_shuffles(spark, size) as chosen:
            assert chosen == partitions
            assert spark.conf.get("spark.sql.shuffle.partitions") == str(partitions)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_suite_agrees_with_single_checks_and_reads_each_table_once(spark, tmp_path):
    facts = spark.createDataFrame(
        [(1, "01", 1.5, "2024-01-01", None), (2, "x", -0.0, "2024-02-30", 1), (None, None, None, None, None)] * 3,
        "a int, b string, c double, d string, e int",
    ).withColumn("a2", F.col("a"))
    dim = spark.createDataFrame([(1, "1", 0.0), (7, None, 1.5), (None, "2", None)], "k long, s string, f double")
    dim = dim.withColumn("day", F.make_date(F.lit(2024), F.lit(1), F.lit(1)))
    names = {"facts": facts, "dim": dim, "none": dim.limit(0), "empty": facts.limit(0)}
    tables = {}
    for name, frame in names.items():
        frame.write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    pairs = [("a", "k"), ("b", "k"), ("a", "s"), ("c", "f"), ("d", "day"), ("a2", "k"), ("e", "k"), ("b", "s")]
    edges = [
        FkEdge(table, fk, to, key, nullable)
        for fk, key in pairs
        for table, to, nullable in (("facts", "dim", False), ("facts", "dim", True), ("facts", "none", False), ("empty", "dim", True))
    ]
    suite = fk_suite(tables, edges)
    text = plan(suite)
    assert text.count(f"{tmp_path}/facts") == text.count(f"{tmp_path}/dim") == 1
    expected = [
        fk_check(tables[e.table], tables[e.dim], e.fk, e.dim_key, e.dim, nullable=e.nullable)
        .select(F.lit(e.table).alias("table_name"), "*")
        .first()
        for e in edges
    ]
    assert sorted(map(tuple, suite.collect())) == sorted(map(tuple, expected))


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_distinct_values_by_fact_and_dimension_columns(spark, settings, limit):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    number = F.col("id")
    facts = spark.range(6_000).select(
        F.when(number % 3 == 0, "01").when(number % 3 == 1, (number % 9).cast("string")).alias("fk"),
        F.when(number % 2 == 0, "hot").when(number % 4 == 1, (number % 700).cast("string")).alias("who"),
        (number % 5).alias("day"),
        F.when(number % 8 > 0, 1).alias("n"),
    )
    dim = spark.createDataFrame([(i, "g" if i % 2 else None) for i in range(6)], "k int, g string")
    rows = facts.collect()
    group = {i: "g" if i % 2 else None for i in range(6)}
    for distinct in ("who", "fk", None):
        got = count_by_dimension(
            facts, dim, "fk", "k", ["g"], "n",
            by=[(F.col("day") % 2).alias("odd")], name="rows", distinct_name="values", distinct=distinct,
            broadcast_bytes=limit,
        )
        assert got.columns == ["odd", "g", "rows", "values"]
        expected = {}
        for r in rows:
            key = (r.day % 2, group.get(int(r.fk)) if r.fk is not None else None)
            entry = expected.setdefault(key, [0, set()])
            entry[0] += r.n is not None
            entry[1].add(r[distinct or "fk"])
        expected = {k: (n, len(v - {None})) for k, (n, v) in expected.items()}
        assert {(r.odd, r.g): (r.rows, r["values"]) for r in got.collect()} == expected
