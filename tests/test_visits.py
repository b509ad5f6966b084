"""The clinic-visit star on a small sample."""

from datetime import datetime
from pathlib import Path

import pytest
from samples import ON_THE_CUTOFF, TWICE, VISITS, visit

from starnorm.operators import fk_check, fk_suite, star_join
from starnorm.plans.normalize import normalize
from starnorm.plans.spec import NaturalDim
from starnorm.plans.visits import FLAT_SCHEMA, STAR, dimension, fact_visit, star_schemas
from starnorm.plans.worksheets import WORKSHEETS
from starnorm.sources import from_rows
from starnorm.staging import staged


@pytest.fixture(scope="module")
def flat(spark):
    return from_rows(spark, VISITS, FLAT_SCHEMA)


@pytest.fixture(scope="module")
def tables(flat):
    return normalize(flat, STAR, keep=staged)


def test_input_has_47_columns():
    assert len(FLAT_SCHEMA) == 47


def test_tables_and_columns(tables):
    schemas = star_schemas()
    assert list(tables) == list(schemas)
    for name, table in tables.items():
        assert table.columns == schemas[name].fieldNames()
        assert [f.dataType for f in table.schema] == [f.dataType for f in schemas[name]]


def keys_of(dim, rows) -> set:
    """The keys a dimension must have, from its definition."""
    natural = isinstance(dim, NaturalDim)
    columns = dim.natural_key if natural else (dim.key, *dim.attributes)
    values = [tuple(row[c] for c in columns) for row in rows]
    if getattr(dim, "drop_all_null", False):
        values = [v for v in values if any(x is not None for x in v)]
    keys = {v if natural else v[0] for v in values}
    return keys - {None} if getattr(dim, "drop_null_key", False) else keys


def test_one_row_per_key(tables):
    for dim in STAR.dims:
        columns = dim.natural_key if isinstance(dim, NaturalDim) else (dim.key,)
        rows = [tuple(r) for r in tables[dim.name].select(*columns).collect()]
        keys = {k if isinstance(dim, NaturalDim) else (k,) for k in keys_of(dim, VISITS)}
        assert len(rows) == len(keys) and set(rows) == keys
    assert tables["FactVisit"].count() == len(VISITS)


def test_a_visit_given_twice_is_one_fact(spark):
    made = normalize(from_rows(spark, TWICE, FLAT_SCHEMA), STAR)
    assert made["FactVisit"].count() == len(VISITS)
    assert made["DimBilling"].filter("billing_id = 'billed again'").count() == 1


def test_patient_status(tables):
    last: dict[str, datetime] = {}
    for row in VISITS:
        seen = last.get(row["patient_id"], datetime.min)
        last[row["patient_id"]] = max(seen, row["visit_datetime"])
    expected = {p: "Inactive" if t <= ON_THE_CUTOFF else "Active" for p, t in last.items()}
    status = {r.patient_id: r.patient_status for r in tables["DimPatient"].collect()}
    assert status == expected and status["long ago"] == "Inactive"


def test_provider_keys_are_dense(tables):
    ids = sorted(r.provider_id for r in tables["DimProvider"].collect())
    assert ids == list(range(len(ids)))


def test_fact_keeps_optional_keys_null(tables):
    rows = {r.visit_id: r for r in tables["FactVisit"].collect()}
    with_secondary = {v for v, r in rows.items() if r.secondary_diagnosis_id is not None}
    # A null part of a natural key has no partner.
    assert with_secondary == set()
    for row in VISITS:
        assert rows[row["visit_id"]].prescription_id == row["prescription_id"]


def test_suite_counts_nulls(tables):
    report = fk_suite(tables, STAR.fk_edges).collect()
    assert len(report) == 12
    nulls = {(r.table_name, r.fk_col): r.null_count for r in report}
    assert nulls["FactVisit", "lab_order_id"] == sum(r["lab_order_id"] is None for r in VISITS)
    without_title = sum(r["doctor_title"] is None for r in VISITS)
    assert nulls["FactVisit", "provider_id"] == without_title
    # A provider without a title gets no surrogate, and that key may not be null.
    failed = {r.fk_col for r in report if not r.passed}
    assert failed <= {"provider_id"}


def test_check_passes(flat, tables):
    report = fk_check(
        flat, tables["DimPatient"], "patient_id", "patient_id", "DimPatient", nullable=False
    ).first()
    assert report.passed and report.mismatch_count == 0


def test_check_counts_unmatched(spark, tables):
    broken = spark.createDataFrame([("V9", "nobody")], "visit_id string, patient_id string")
    report = fk_check(
        broken, tables["DimPatient"], "patient_id", "patient_id", "DimPatient", nullable=False
    ).first()
    assert not report.passed and report.mismatch_count == 1


def test_check_allows_expected_nulls(spark, tables):
    facts = spark.createDataFrame([("V1", None)], "visit_id string, secondary_diagnosis_id string")
    report = fk_check(
        facts,
        tables["DimSecondaryDiagnosis"],
        "secondary_diagnosis_id",
        "secondary_diagnosis_id",
        "DimSecondaryDiagnosis",
    ).first()
    assert report.passed and report.null_count == 1 and report.mismatch_count == 0


def test_tables_one_by_one(flat, tables):
    dims = {dim.name: dimension(flat, dim.name) for dim in STAR.dims}
    for name, table in dims.items():
        assert sorted(table.collect(), key=repr) == sorted(tables[name].collect(), key=repr)
    fact = fact_visit(flat, dims)
    assert sorted(fact.collect(), key=repr) == sorted(tables["FactVisit"].collect(), key=repr)


def test_attributes_come_back_by_joining(spark, flat, tables):
    wanted = ["visit_id", "clinic_name", "room_number", "insurance_payer_name"]
    wanted += ["billing_total_charge", "treatment_desc", "primary_diagnosis_desc"]
    owners = {c: name for name, t in tables.items() if name != "FactVisit" for c in t.columns}
    wide = star_join(
        tables,
        "FactVisit",
        STAR.join_edges,
        {c: (owners.get(c, "FactVisit"), c) for c in wanted},
    )
    assert sorted(wide.collect()) == sorted(flat.select(*wanted).collect())


def test_worksheets(spark):
    paid = {"billing_id": "x", "billing_payment_status": "Paid", "clinic_name": "C"}
    rows = [
        visit(1, **paid, patient_id="a", patient_gender="M", visit_type="t",
              visit_datetime=datetime(2024, 5, 12, 0, 10)),
        visit(2, **paid, patient_id="a", patient_gender="M", visit_type="t",
              visit_datetime=datetime(2024, 5, 13, 0, 20)),
        visit(3, billing_id="y", billing_payment_status="Open", clinic_name="C", patient_id="b",
              patient_gender="F", visit_type="u", visit_datetime=datetime(2023, 5, 13, 13, 0)),
        visit(4, billing_id=None, clinic_name="C", patient_id="c", patient_gender="F",
              billing_payment_status=None, visit_type="t",
              visit_datetime=datetime(2024, 5, 13, 0, 59)),
    ]
    tables = normalize(from_rows(spark, rows, FLAT_SCHEMA), STAR)
    results = {name: sorted(map(tuple, q(tables).collect()), key=repr)
               for name, q in WORKSHEETS.items()}
    assert results == {
        "patients_by_gender": [("F", 2, 2), ("M", 2, 1)],
        "payment_status_distribution": [("Open", 1, 0.25), ("Paid", 2, 0.5), (None, 1, 0.25)],
        "visit_type_distribution": [("t", 3, 0.75), ("u", 1, 0.25)],
        "visits_by_weekday_and_hour": [
            (1, "Sunday", 0, 1), (2, "Monday", 0, 2), (7, "Saturday", 13, 1)],
        "yearly_visits_by_clinic": [(2023, "C", 1, 1), (2024, "C", 3, 2)],
    }


def test_a_part_of_the_star(flat, tables):
    """Only what is asked for, with the same rows; other columns are not needed."""
    needed = flat.select("visit_type", *STAR.sources(["DimPatient", "DimProvider"]))
    made = normalize(needed, STAR, only=["DimProvider", "DimPatient"])
    assert list(made) == ["DimPatient", "DimProvider"]
    for name, table in made.items():
        assert sorted(table.collect(), key=repr) == sorted(tables[name].collect(), key=repr)
    alone = normalize(flat.select(*STAR.sources(["FactVisit"])), STAR, only=["FactVisit"])
    assert list(alone) == ["FactVisit"]
    rows = [sorted(t["FactVisit"].collect(), key=repr) for t in (alone, tables)]
    assert rows[0] == rows[1]
    with pytest.raises(ValueError, match="DimNothing"):
        normalize(flat, STAR, only=["DimNothing"])


def test_only_kept_tables_stay_staged(spark, flat, monkeypatch, tmp_path):
    import starnorm.staging as staging

    monkeypatch.setattr(staging, "_app_folder", lambda _: str(tmp_path))
    kept = normalize(flat, STAR, keep=staged, stage_input=True)
    left = sorted(path.name.rsplit("-", 1)[0] for path in tmp_path.iterdir())
    assert left == sorted(kept)
    assert kept["FactVisit"].count() == len(VISITS)


def test_a_stored_star_follows_its_input(spark, tmp_path):
    from starqueries import visits
    from starqueries.frames import SOURCES

    for name in SOURCES:
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    first = visits.stored_star(spark, str(tmp_path))["FactVisit"]
    n, files = first.count(), first.inputFiles()
    assert visits.stored_star(spark, str(tmp_path))["FactVisit"].inputFiles() == files
    half = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").where("l_orderkey % 2 = 0")
    half.write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    again = visits.stored_star(spark, str(tmp_path))["FactVisit"]
    assert again.count() == half.select("l_orderkey", "l_linenumber").distinct().count() < n
    assert not any(Path(f.removeprefix("file://")).exists() for f in files)
