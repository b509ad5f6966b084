"""Sources, sinks and the batch job."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from samples import VISITS

from starnorm.hadoop import recover_tree
from starnorm.job import malformed_counts, parse_args, run
from starnorm.plans.visits import FLAT_SCHEMA, star_schemas
from starnorm.sinks import write_csv, write_parquet, write_table
from starnorm.sources import (
    count_malformed,
    from_rows,
    preview,
    read_checked,
    read_flat,
    read_star_csv,
    read_star_parquet,
)
from starnorm.staging import clear_staged, shared_folder, staged


@pytest.fixture(scope="module")
def visits_csv(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("input")
    return write_csv(from_rows(spark, VISITS, FLAT_SCHEMA), str(folder), "visits")


def test_input_round_trip(spark, visits_csv):
    again = read_flat(spark, visits_csv, FLAT_SCHEMA)
    given = from_rows(spark, VISITS, FLAT_SCHEMA)
    assert sorted(again.collect(), key=repr) == sorted(given.collect(), key=repr)


def test_explicit_schema_keeps_zip(spark, visits_csv):
    zips = {r["patient_zip"] for r in VISITS}
    assert {r.patient_zip for r in read_flat(spark, visits_csv, FLAT_SCHEMA).collect()} == zips
    assert {r.patient_zip for r in read_flat(spark, visits_csv).collect()} == set(map(int, zips))


@pytest.mark.parametrize("output_format", ["csv", "parquet", "both"])
def test_job(spark, visits_csv, tmp_path, output_format):
    output = str(tmp_path / "out")
    tables, report = run(spark, visits_csv, output, output_format=output_format, show=True)
    assert report.count() == 12
    expected = {name: sorted(t.collect(), key=repr) for name, t in tables.items()}
    written = []
    if output_format in ("csv", "both"):
        assert all(Path(f"{output}/csv/{name}.csv").is_dir() for name in tables)
        written.append(read_star_csv(spark, f"{output}/csv", star_schemas()))
    if output_format in ("parquet", "both"):
        written.append(read_star_parquet(spark, f"{output}/parquet", tables))
    for copy in written:
        assert {n: sorted(t.collect(), key=repr) for n, t in copy.items()} == expected


def test_job_with_inferred_schema(spark, visits_csv, tmp_path):
    tables, report = run(spark, visits_csv, str(tmp_path), infer_schema=True)
    assert tables["FactVisit"].count() == len(VISITS)
    assert report.count() == 12


def test_columns_are_found_by_name(spark, tmp_path):
    given = from_rows(spark, VISITS, FLAT_SCHEMA)
    mixed = given.select(*sorted(given.columns)).withColumn("further", F.lit("x"))
    path = write_csv(mixed, str(tmp_path), "mixed")
    tables, _ = run(spark, path, str(tmp_path / "mixed-out"))
    plain, _ = run(spark, write_csv(given, str(tmp_path), "plain"), str(tmp_path / "plain-out"))
    for name, table in plain.items():
        assert sorted(tables[name].collect(), key=repr) == sorted(table.collect(), key=repr)
    short = write_csv(given.drop("visit_type"), str(tmp_path), "short")
    with pytest.raises(ValueError, match="visit_type"):
        run(spark, short, str(tmp_path / "short-out"))


def test_text_comes_back_as_it_was(spark, tmp_path):
    values = [" a ", "", None, 'say "hi"', "two\nlines", "back\\", "a,b", "'", "NULL", "\t"]
    frame = spark.createDataFrame(list(enumerate(values)), "n int, s string")
    for layout in ("parts", "single"):
        write_csv(frame, str(tmp_path), layout, layout=layout)
        again = read_star_csv(spark, str(tmp_path), {layout: frame.schema})[layout]
        assert {r.n: r.s for r in again.collect()} == dict(enumerate(values))


@pytest.mark.parametrize("timestamps", ["us", "ms"])
def test_timestamps_come_back_without_a_format(spark, tmp_path, timestamps):
    micros = 824916 if timestamps == "us" else 824000
    values = [datetime(2024, 5, 14, 8, 30, 0, micros), datetime(2024, 5, 14), None]
    frame = spark.createDataFrame([(v, v) for v in values], "t timestamp, u timestamp_ntz")
    write_csv(frame, str(tmp_path), "t", timestamps=timestamps)
    again = read_star_csv(spark, str(tmp_path), {"t": frame.schema})["t"]
    assert sorted(again.collect(), key=repr) == sorted(frame.collect(), key=repr)


def test_malformed_values_are_counted(spark, tmp_path):
    path = write_csv(spark.createDataFrame([("1", "x"), ("no", "y")], "n string, s string"), str(tmp_path), "bad")
    schema = "n int, s string"
    schema = spark.createDataFrame([], schema).schema
    assert count_malformed(spark, path, schema) == 1
    assert {r.n for r in read_flat(spark, path, schema).collect()} == {1, None}
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        read_flat(spark, path, schema, mode="FAILFAST").collect()


def test_arguments():
    args = parse_args(["--input", "a", "--output", "b"])
    assert args.output_format == "csv"
    with pytest.raises(SystemExit):
        parse_args(["--input", "a", "--output", "b", "--output-format", "orc"])


def test_millisecond_timestamps(spark, tmp_path):
    frame = spark.createDataFrame([(datetime(2024, 5, 14, 8, 30, 0, 824916),)], "ts timestamp")
    exact = Path(write_csv(frame, str(tmp_path), "us", layout="single")).read_text().split()
    path = write_csv(frame, str(tmp_path), "ms", layout="single", timestamps="ms")
    short = Path(path).read_text().split()
    assert exact == ["ts", "2024-05-14T08:30:00.824916Z"]
    assert short == ["ts", "2024-05-14T08:30:00.824Z"]


def test_csv_replaces_and_leaves_nothing_behind(spark, tmp_path):
    frame = spark.createDataFrame([(1, 'say "hi", twice'), (2, None)], "n int, s string")
    write_csv(frame, str(tmp_path), "t")
    write_csv(frame.limit(0), str(tmp_path), "t", layout="single")
    path = write_csv(frame, str(tmp_path), "t", layout="single")
    assert sorted(read_flat(spark, path, frame.schema).collect(), key=repr) == sorted(
        frame.collect(), key=repr
    )
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["t.csv"]


def test_empty_csv_has_a_header(spark, tmp_path):
    path = write_csv(spark.createDataFrame([], "a int, b string"), str(tmp_path), "empty", layout="single")
    assert Path(path).read_text() == "a,b\n"


def test_layout_is_the_callers_choice(spark, tmp_path):
    frame = spark.range(0, 1000, numPartitions=4)
    path = write_csv(frame, str(tmp_path), "big")
    assert len(list(Path(path).glob("part-*.csv"))) == 4
    assert read_flat(spark, path, frame.schema).count() == 1000
    with pytest.raises(ValueError, match="too many"):
        write_csv(frame, str(tmp_path), "one", layout="single", single_file_bytes=1000)
    with pytest.raises(ValueError, match="layout"):
        write_csv(frame, str(tmp_path), "one", layout="both")


def test_parquet_partitions(spark, tmp_path):
    frame = spark.createDataFrame([(1, 2023), (2, 2024)], "id int, year int")
    path = write_parquet(frame, str(tmp_path), "fact", partition_by=["year"])
    plan = spark.read.parquet(path).filter("year = 2024")
    assert [r.id for r in plan.collect()] == [2]
    assert {p.name for p in Path(path).glob("year=*")} == {"year=2023", "year=2024"}


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        write_table(spark.range(1), "t", output_format="orc", csv_folder=str(tmp_path))


def test_preview(spark):
    assert preview(spark.range(100)).count() == 20


def test_shared_folder_is_the_clusters(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_staged_tables_can_be_cleared(spark, monkeypatch):
    import starnorm.staging as staging

    folder = f"{shared_folder(spark)}/cleared-here"
    monkeypatch.setattr(staging, "_app_folder", lambda _: folder)
    assert staged(spark.range(3)).count() == 3
    clear_staged(spark)
    assert not Path(folder).exists()


def test_every_malformed_value_is_accounted_for(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(
        "s,b,a,t,further\n"
        "x,2.5,1,2024-01-01T00:00:00Z,f\n"
        '"q ""u"", z",bad,no,2024-01-01,f\n'
        ",,,,\n"
        "short,4\n"
        "long,6,5,2020-01-01,f,extra\n"
        '"",,7,soon,f\n'
        "nan,NaN,9,2024-02-30,f\n"
    )
    schema = spark.createDataFrame([], "a int, b double, t timestamp, s string").schema
    read = read_checked(spark, str(path), schema)
    assert read.rows.columns == read.good.columns == ["a", "b", "t", "s"]
    assert read.rows.count() == 7
    assert sorted((r.a, r.b, r.s) for r in read.rows.where("s IS NOT NULL").collect() if r.a) == [
        (1, 2.5, "x"), (5, 6.0, "long"), (7, None, ""), (9, pytest.approx(float("nan"), nan_ok=True), "nan")
    ]
    assert sorted(map(str, (r.s for r in read.good.collect()))) == ["None", "x"]
    assert sorted((r.record, r.columns) for r in read.rejected.collect()) == [
        ('"",,7,soon,f', ["t"]),
        ('"q ""u"", z",bad,no,2024-01-01,f', ["a", "b"]),
        ("long,6,5,2020-01-01,f,extra", []),
        ("nan,NaN,9,2024-02-30,f", ["t"]),
        ("short,4", []),
    ]
    counts = {r.column_name: r.n_malformed for r in read.counts.collect()}
    assert counts == {"a": 1, "b": 1, "t": 2, "s": 0, None: 2}


def test_nothing_malformed(spark, visits_csv):
    read = read_checked(spark, visits_csv, FLAT_SCHEMA)
    given = from_rows(spark, VISITS, FLAT_SCHEMA)
    for rows in (read.rows, read.good):
        assert sorted(rows.collect(), key=repr) == sorted(given.collect(), key=repr)
    assert read.rejected.count() == 0
    assert {r.n_malformed for r in read.counts.collect()} == {0}
    assert read.counts.count() == len(FLAT_SCHEMA) + 1


@pytest.mark.parametrize("malformed", ["null", "reject"])
def test_job_reports_malformed_values(spark, tmp_path, malformed):
    given = from_rows(spark, VISITS, FLAT_SCHEMA).coalesce(1)
    first = given.agg(F.min("visit_id")).first()[0]
    spoiled = given.withColumn(
        "billing_total_charge",
        F.when(F.col("visit_id") == first, "a lot").otherwise(F.col("billing_total_charge").cast("string")),
    )
    path = write_csv(spoiled, str(tmp_path), "visits")
    tables, _ = run(spark, path, str(tmp_path / "out"), malformed=malformed)
    counts = malformed_counts(spark, str(tmp_path / "out")).collect()
    assert [(r.column_name, r.n_malformed) for r in counts] == [("billing_total_charge", 1)]
    (rejected,) = spark.read.parquet(str(tmp_path / "out/malformed/rejected")).collect()
    assert rejected.columns == ["billing_total_charge"] and "a lot" in rejected.record
    assert tables["FactVisit"].count() == len(VISITS) - (malformed == "reject")
    with pytest.raises(ValueError, match="malformed"):
        run(spark, path, str(tmp_path / "out"), malformed="ignore")


AWKWARD = [" a ", "", None, 'say "hi"', "two\nlines", "back\\", "\\n", "\\\\s\\", "a,b", "\r\n", "\n"]
AWKWARD += ["", "\\e", "\\n"]


@pytest.mark.parametrize("layout", ["parts", "single"])
def test_escaped_lines_are_records(spark, tmp_path, layout):
    frame = spark.createDataFrame(list(enumerate(AWKWARD)), "n int, s string")
    path = write_csv(frame, str(tmp_path), "t", layout=layout, line_breaks="escaped")
    assert spark.read.text(path).where("value <> 'n,s'").count() == len(AWKWARD)
    again = read_star_csv(spark, str(tmp_path), {"t": frame.schema}, line_breaks="escaped")["t"]
    assert {r.n: r.s for r in again.collect()} == dict(enumerate(AWKWARD))
    with pytest.raises(ValueError, match="line_breaks"):
        write_csv(frame, str(tmp_path), "t", line_breaks="none")


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    words = F.concat_ws("\n", F.col("id").cast("string"), F.repeat(F.lit("word\\ "), 40))
    frame = spark.range(20_000).select("id", words.alias("s"))
    write_csv(frame, str(tmp_path), "t", layout="single", line_breaks="escaped")
    schemas = {"t": frame.schema}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(512 * 1024))
    try:
        split = read_star_csv(spark, str(tmp_path), schemas, line_breaks="escaped")["t"]
        tasks = split.select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks >= 8
        assert split.exceptAll(frame).count() == frame.exceptAll(split).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _failing(frame):
    """A frame whose last rows raise, after others are written."""
    return frame.withColumn("id", F.when(F.col("id") < 990, F.col("id")).otherwise(F.raise_error(F.lit("midway")).cast("long")))


@pytest.mark.parametrize("layout", ["parts", "single", "parquet"])
def test_a_job_that_fails_leaves_the_old_table(spark, tmp_path, layout):
    def write(frame):
        if layout == "parquet":
            return write_parquet(frame, str(tmp_path), "t")
        return write_csv(frame, str(tmp_path), "t", layout=layout)

    def read(path):
        frame = spark.read.parquet(path) if layout == "parquet" else read_flat(spark, path, schema)
        return frame.count()

    old, new = spark.range(10), spark.range(0, 1000, numPartitions=8)
    schema = old.schema
    path = write(old)
    with pytest.raises(Exception, match="midway"):
        write(_failing(new))
    assert read(path) == 10
    assert read(write(new)) == 1000
    left = [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")]
    assert left == ["t" if layout == "parquet" else "t.csv"]


def test_a_replacement_cut_off_is_undone(spark, tmp_path):
    path = Path(write_parquet(spark.range(10), str(tmp_path), "t"))
    path.rename(tmp_path / ".t.replaced")  # as if the process had died between two renames
    recover_tree(spark, str(path))
    assert spark.read.parquet(str(path)).count() == 10
    again = write_parquet(spark.read.parquet(str(path)).limit(3), str(tmp_path), "t")
    assert spark.read.parquet(again).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
