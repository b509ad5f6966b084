"""What queries shuffle, store and write: each column once, each frame once."""

import importlib
import re
from pathlib import Path

from pyspark.sql import functions as F

from starnorm.operators import JoinEdge, column_profile, lookup, star_join
from starnorm.operators.codes import few_values
from starqueries import visits
from starqueries.spark import QUERIES, _run_visits_job

SF = "/root/testdata/sf0.001"


MODULE = importlib.import_module("starnorm.operators.lookup")


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_large_lookup_shuffles_the_key_once_and_no_hash(spark):
    facts = spark.range(1000).select((F.col("id") % 400).alias("k"), F.col("id").alias("v"))
    facts = facts.withColumn("k", F.when(F.col("k") != 7, F.col("k")))
    dim = spark.range(300).select(F.col("id").alias("d"), (F.col("id") * 2).alias("x"))
    found = lookup(facts, dim, {"k": "d"}, {"x": "x"}, broadcast_bytes=0)
    text = _optimized(found)
    assert "__salt" in text and "__slot" not in text and "__fk0" not in text
    expected = facts.join(dim, F.col("k") == F.col("d"), "left").select("k", "v", "x")
    assert found.count() == 1000
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_the_salt_is_a_column_of_the_shuffle(spark):
    # As a constant it would leave all rows of a null key in one task.
    dim = spark.range(300).select(F.col("id").alias("d"), (F.col("id") * 2).alias("x"))
    facts = spark.range(5000).select(F.when(F.col("id") % 9 == 0, F.col("id")).alias("k"), "id")
    found = lookup(facts, dim, {"k": "d"}, {"x": "x"}, broadcast_bytes=0)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\((__salt#\d+L, k#\d+L|k#\d+L, __salt#\d+L), ", text)
    assert found.count() == 5000


def test_hot_keys_are_found_through_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(MODULE, "HOT_PARTS", 10)
    monkeypatch.setattr(MODULE, "BUCKETS", 64)
    rows = spark.range(6000).select(
        F.when(F.col("id") < 1000, 3).when(F.col("id") < 1900, None).otherwise(F.col("id")).alias("k")
    )
    counted = rows.groupBy("k").count().filter(F.col("count") * 10 > 6000).select("k")
    expected = {r.k for r in counted.collect()}
    assert expected == {3, None}
    assert {r[0] for r in MODULE._hot_keys(rows, [F.col("k")]).collect()} == expected
    even = spark.range(6000).select((F.col("id") % 600).alias("k"))
    assert MODULE._hot_keys(even, [F.col("k")]).collect() == []


def test_star_join_shuffles_each_column_once_and_wide_tables_last(spark):
    n = spark.range(200)
    tables = {
        "f": n.select((F.col("id") % 50).alias("a"), (F.col("id") % 40).alias("b"), "id"),
        "wide": spark.range(50).select(F.col("id").alias("wk"), *[F.col("id").alias(f"w{i}") for i in range(3)]),
        "slim": spark.range(40).select(F.col("id").alias("sk"), (F.col("id") + 1).alias("s0")),
    }
    edges = [JoinEdge("f", "a", "wide", "wk"), JoinEdge("f", "b", "slim", "sk")]
    columns = {"id": ("f", "id"), "a": ("f", "a"), "s0": ("slim", "s0"), "twice": ("f", "id")}
    columns |= {f"w{i}": ("wide", f"w{i}") for i in range(3)}
    out = star_join(tables, "f", edges, columns, spread_by=["id"], broadcast_bytes=0)
    text = _optimized(out)
    assert "__spread_" not in text
    joins = [line for line in text.splitlines() if "Join LeftOuter" in line and "__salt" in line]
    assert [bool(re.search(r"__f_a#", line)) for line in joins] == [True, False]
    grain = star_join(tables, "f", edges, columns, spread_by=["b"], broadcast_bytes=0)
    joins = [line for line in _optimized(grain).splitlines() if "Join LeftOuter" in line and "__salt" in line]
    assert [bool(re.search(r"__f_b#", line)) for line in joins] == [True, False]
    rows = {r.id: r for r in out.collect()}
    assert len(rows) == 200
    assert all(r.twice == i and r.w2 == i % 50 and r.s0 == i % 40 + 1 for i, r in rows.items())


def _parts(spark):
    """Facts and a table of 3,000 parts in 12 makes, one of them null throughout."""
    n = F.col("id")
    make = F.when(n % 12 > 0, F.concat(F.lit("a make of some length "), n % 12))
    size = F.when(n % 12 > 1, (n % 3).cast("int"))
    parts = spark.range(3000).select(
        F.when(n != 5, n).alias("pk"), make.alias("make"), size.alias("size"), (n * -0.0).alias("zero")
    )
    parts = parts.union(parts.filter("pk = 7"))  # a key that comes twice gives two rows
    facts = spark.range(8000).select(n.alias("line"), F.when(n % 9 > 0, n % 3500).alias("pk"))
    return {"facts": facts, "parts": parts}


def _plain(tables, *columns):
    parts = tables["parts"].withColumnRenamed("pk", "__pk")
    return tables["facts"].join(parts, F.col("pk") == F.col("__pk"), "left").select(*columns)


def _same(a, b):
    assert a.schema == b.schema and a.count() == b.count()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _moved(df):
    """The columns of each shuffle for a large join."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    found = re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning[^\n]*salt", text)
    return [columns.split(", ") for columns in found]


def _codes(df):
    return len({f.rsplit("/", 1)[0] for f in df.inputFiles() if "/dense-key-" in f})


def test_columns_of_few_values_are_shuffled_as_one_number(spark, monkeypatch):
    monkeypatch.setattr(MODULE, "HOT_PARTS", 1)
    tables = _parts(spark)
    edges = [JoinEdge("facts", "pk", "parts", "pk")]
    columns = {c: ("facts" if c == "line" else "parts", c) for c in ("line", "make", "size")}
    out = star_join(tables, "facts", edges, columns, spread_by=["line"], broadcast_bytes=20_000)
    _same(out, _plain(tables, *columns))
    moved = _moved(out)
    assert sorted(map(len, moved)) == [3, 3]
    # Longs are marked so; texts and ints would not be.
    assert all(c.endswith("L") for columns in moved for c in columns)


def test_a_table_that_fits_with_a_number_is_broadcast(spark):
    tables = _parts(spark)
    edges = [JoinEdge("facts", "pk", "parts", "pk")]
    columns = {c: ("facts" if c == "line" else "parts", c) for c in ("line", "make", "size")}
    out = star_join(tables, "facts", edges, columns, spread_by=["line"], broadcast_bytes=60_000)
    _same(out, _plain(tables, *columns))
    assert _codes(out) == 1 and _moved(out) == []
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_numbers_stand_for_exact_values_that_are_few(spark):
    parts = _parts(spark)["parts"]
    found = few_values(parts, "n", 1 << 20)
    assert found.columns == ("make", "size")
    _same(found.decode(found.encode(parts)).select(*parts.columns), parts)
    assert few_values(parts, "n", 100) is None
    assert few_values(parts, "n", 0) is None
    assert few_values(parts.select("pk", "zero"), "n", 1 << 20) is None
    unlike = spark.range(400).select(F.col("id").cast("string").alias("a"), (F.col("id") % 2).alias("b"))
    assert few_values(unlike, "n", 1 << 20) is None


def test_numbers_go_through_chains_and_two_large_tables(spark):
    n = F.col("id")
    tables = {
        "f": spark.range(9000).select(n.alias("line"), (n % 2000).alias("a"), (n % 1500).alias("b")),
        "o": spark.range(1900).select(n.alias("ok"), (n % 1200).alias("c"), F.concat(F.lit("state "), n % 3).alias("state")),
        "c": spark.range(1100).select(n.alias("ck"), F.concat(F.lit("kind "), n % 4).alias("kind"), n.cast("string").alias("name")),
        "p": spark.range(1500).select(n.alias("pk"), F.concat(F.lit("make "), n % 5).alias("make")),
    }
    edges = [JoinEdge("f", "a", "o", "ok"), JoinEdge("o", "c", "c", "ck"), JoinEdge("f", "b", "p", "pk")]
    columns = {"line": ("f", "line"), "kind": ("c", "kind"), "name": ("c", "name")}
    columns |= {"state": ("o", "state"), "make": ("p", "make"), "state2": ("o", "state")}
    expected = tables["f"]
    for a, to, key in (("a", "o", "ok"), ("c", "c", "ck"), ("b", "p", "pk")):
        expected = expected.join(tables[to], F.col(a) == F.col(key), "left")
    expected = expected.withColumn("state2", F.col("state")).select(*columns)
    for limit in (4_000, 25_000, 1 << 25):
        out = star_join(tables, "f", edges, columns, spread_by=["line"], broadcast_bytes=limit)
        _same(out, expected)
        assert _codes(out) == (0 if limit > 1 << 20 else 3)


def test_profiles_read_a_stored_frame(spark):
    for name in ("column_profile", "visits_profile"):
        files = QUERIES[name](spark, SF).inputFiles()
        assert files and all("/star-input-" in f or "/FactVisit-" in f for f in files)


def test_a_worksheet_builds_the_tables_it_reads(spark):
    QUERIES["worksheet_yearly_visits_by_clinic"](spark, SF)
    folder = visits._STORED[spark.sparkContext.applicationId, SF, ("FactVisit", "DimLocation")][1]
    made = {p.name for p in Path(folder.removeprefix("file://")).iterdir() if p.is_dir()}
    assert made == {"FactVisit", "DimLocation"}


def test_the_job_reads_compressed_input(spark):
    output, _ = _run_visits_job(spark, SF, output_format="parquet")
    folder = Path(output.removeprefix("file://")).parent / "visits.csv"
    parts = [p.name for p in folder.iterdir() if p.name.startswith("part-")]
    assert parts and all(p.endswith(".csv.gz") for p in parts)


def test_the_stored_star_is_compressed_as_staged_tables_are(spark):
    star = visits.stored_star(spark, SF, "DimTreatment")
    files = star["DimTreatment"].inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_a_profile_moves_no_counts_but_of_nulls(spark):
    frame = spark.createDataFrame([(1, "a"), (1, None), (2, None), (None, "b")], "n int, s string")
    profile = column_profile(frame)
    assert "AS rows#" not in _optimized(profile)
    found = {r.column_name: (r.n_distinct, r.n_null) for r in profile.collect()}
    assert found == {"n": (3, 1), "s": (3, 2)}


def test_the_session_shuffles_with_zstd_and_plans_name_whole_paths(spark, tmp_path):
    assert spark.sparkContext.getConf().get("spark.io.compression.codec") == "zstd"
    path = f"{tmp_path}/{'long' * 30}"
    spark.range(3).write.parquet(path)
    assert path in spark.read.parquet(path)._jdf.queryExecution().executedPlan().toString()
