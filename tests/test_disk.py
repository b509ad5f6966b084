"""What stays on disk: no shuffle of a finished step, no column that can be computed."""

import threading
import time
from pathlib import Path

from pyspark.sql import functions as F

from starnorm.job import run
from starnorm.operators import Attach, build_fact, natural_dim
from starnorm.plans.normalize import normalize
from starnorm.plans.spec import FactSpec, KeyedDim, NaturalDim, StarSpec
from starnorm.sinks import write_csv, write_parquet
from starnorm.staging import _FREE_SHUFFLES, freed_shuffles, shared_folder, staged
from starqueries import visits

SF = "/root/testdata/sf0.001"

SPEC = StarSpec(
    dims=(
        NaturalDim("Color", "color_id", ("color", "shade")),
        KeyedDim("Item", "item_id", ("weight",)),
    ),
    fact=FactSpec("Sale", ("sale_id",), ("sale_id", "color_id", "item_id")),
)


def _sales(spark):
    n = F.col("id")
    return spark.range(600).select(
        F.concat(F.lit("S"), n % 500).alias("sale_id"),
        F.when(n % 7 > 0, F.concat(F.lit("color "), n % 5)).alias("color"),
        F.when(n % 11 > 0, (n % 3).cast("int")).alias("shade"),
        F.concat(F.lit("I"), n % 40).alias("item_id"),
        (n % 9).alias("weight"),
    )


def _same(a, b):
    assert a.dtypes == b.dtypes and a.count() == b.count()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


def _left(spark, before):
    for _ in range(100):  # files are deleted behind the query
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def test_a_stored_frame_leaves_no_shuffle(spark, tmp_path):
    def dealt():
        return spark.range(3000).repartition(5, "id")

    for store in (
        staged,
        lambda df: write_parquet(df, str(tmp_path), "t"),
        lambda df: write_csv(df, str(tmp_path), "t"),
    ):
        before = _shuffle_files(spark)
        store(dealt())
        assert not _left(spark, before)
    assert staged(dealt()).count() == 3000


def test_overlapping_blocks_leave_the_setting_as_it_was(spark):
    was = spark.conf.get(_FREE_SHUFFLES)
    first, second = threading.Event(), threading.Event()

    def inner():
        with freed_shuffles(spark):
            first.set()
            second.wait(10)

    thread = threading.Thread(target=inner)
    with freed_shuffles(spark):
        thread.start()
        first.wait(10)
    assert spark.conf.get(_FREE_SHUFFLES) == "true"
    second.set()
    thread.join()
    assert spark.conf.get(_FREE_SHUFFLES) == was


def test_derived_columns_are_not_stored(spark):
    sales = _sales(spark)
    base = sales.selectExpr("sale_id", "color", "shade", "substring(item_id, 2) AS item", "weight")
    derived = {c: c for c in sales.columns} | {"item_id": "'I' || item"}
    plain = normalize(sales, SPEC, stage_input=True)
    made = normalize(base, SPEC, stage_input=True, derived=derived)
    for name, table in plain.items():
        _same(made[name], table)
    (file, *_) = made["Item"].inputFiles()
    assert spark.read.parquet(file).columns == base.columns


def test_the_visit_star_stores_order_lines(spark):
    (file, *_) = visits.tables(spark, SF)["DimBilling"].inputFiles()
    stored = set(spark.read.parquet(file).columns)
    assert "o_orderkey" in stored and not stored & set(visits.VISIT_COLUMNS)


def test_a_fact_is_staged_between_its_two_shuffles(spark):
    sales = _sales(spark)
    dim = staged(natural_dim(sales, ("color", "shade"), "color_id", row_count="n"))
    attach = [Attach(dim, ("color", "shade"), "color_id", "n")]
    columns = SPEC.fact.columns
    small = build_fact(sales, attach, columns, ["sale_id"])
    large = build_fact(sales, attach, columns, ["sale_id"], broadcast_bytes=0)
    _same(large, small)
    assert large.count() == 500
    assert not any("/attached-" in f for f in small.inputFiles())
    assert large.inputFiles() and all("/attached-" in f for f in large.inputFiles())


def test_the_job_deletes_its_copy_of_the_input(spark, tmp_path):
    visits.visits(spark, SF).limit(50).write.csv(f"{tmp_path}/in", header=True)
    folder = Path(f"{shared_folder(spark).removeprefix('file://')}/starnorm-{spark.conf.get('spark.app.id')}")
    before = {p.name for p in folder.iterdir()}
    tables, report = run(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    made = {p.name.rpartition("-")[0] for p in folder.iterdir() if p.name not in before}
    assert made == {*tables, "fk-report"}
    assert tables["FactVisit"].count() > 0 and report.count() == 12
