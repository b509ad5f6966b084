"""The clinic-visit star, fed with visits derived from the order lines."""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession

from starnorm.catalogue import TableSizes, staged_with_sizes
from starnorm.operators import (
    column_profile,
    fk_suite,
    profile_tables,
    row_counts,
    star_join,
)
from starnorm.plans import visits as plan
from starnorm.plans.normalize import normalize
from starnorm.plans.visits import STAR
from starnorm.hadoop import delete_tree, stored_bytes, stored_version
from starnorm.sinks import write_parquet
from starnorm.sources import read_star_parquet
from starnorm.staging import COMPRESSION, staged, staging_path
from starqueries.frames import SOURCES, flat

# Every visit column as an expression over an order line and what surrounds it, in
# words both engines read alike.
VISIT_COLUMNS: dict[str, str] = {
    "visit_id": "'V' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
    "visit_datetime": (
        "l_shipdate + INTERVAL '20' YEAR + INTERVAL '100' DAY "
        "+ (l_partkey % 24) * INTERVAL '1' HOUR"
    ),
    "visit_type": "l_returnflag || l_linestatus",
    "patient_id": "'P' || CAST(c_custkey AS STRING)",
    "patient_first_name": "c_name",
    "patient_last_name": "c_mktsegment",
    "patient_date_of_birth": "CAST('1980-02-29' AS DATE)",
    "patient_gender": "CASE WHEN c_custkey % 3 = 0 THEN 'M' ELSE 'F' END",
    "patient_address_line1": "n_name",
    "patient_address_line2": "CAST(NULL AS STRING)",
    "patient_city": "n_name",
    "patient_state": "r_name",
    "patient_zip": "'0' || CAST(c_custkey AS STRING)",
    "patient_phone": "CASE WHEN c_acctbal > 0 THEN CAST(c_nationkey AS STRING) END",
    "patient_email": "c_name || '@example.com'",
    "insurance_id": "'I' || CAST(c_custkey AS STRING)",
    "insurance_payer_name": "n_name",
    "insurance_policy_number": "'POL' || CAST(c_custkey AS STRING)",
    "insurance_group_number": "'GRP' || CAST(c_nationkey AS STRING)",
    "insurance_plan_type": "r_name",
    "billing_id": "'B' || CAST(o_orderkey AS STRING)",
    "billing_total_charge": "o_totalprice",
    "billing_amount_paid": "l_extendedprice",
    "billing_date": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "billing_payment_status": "o_orderstatus",
    "doctor_name": "s_name",
    "doctor_title": "p_brand",
    "doctor_department": "CASE WHEN p_size > 5 THEN p_type END",
    "clinic_name": "p_type",
    "room_number": "p_size",
    "primary_diagnosis_code": "o_orderpriority",
    "primary_diagnosis_desc": "o_orderpriority || ' ' || l_returnflag",
    "secondary_diagnosis_code": "CASE WHEN l_returnflag <> 'N' THEN o_orderpriority END",
    "secondary_diagnosis_desc": "CASE WHEN l_returnflag = 'R' THEN o_orderstatus END",
    "treatment_code": "l_linestatus",
    "treatment_desc": "l_linestatus || l_returnflag",
    "prescription_id": "CASE WHEN l_discount >= 0.05 THEN 'RX' || CAST(p_partkey AS STRING) END",
    "prescription_drug_name": "CASE WHEN l_discount >= 0.05 THEN p_name END",
    "prescription_dosage": "CASE WHEN l_discount >= 0.05 THEN p_brand END",
    "prescription_frequency": "CASE WHEN l_discount >= 0.02 THEN l_returnflag END",
    "prescription_duration_days": "CASE WHEN l_discount >= 0.05 THEN CAST(p_size AS DOUBLE) END",
    "lab_order_id": "CASE WHEN l_tax >= 0.04 THEN 'L' || CAST(l_suppkey AS STRING) END",
    "lab_test_code": "CASE WHEN l_tax >= 0.04 THEN l_linestatus END",
    "lab_name": "CASE WHEN l_tax >= 0.04 THEN s_name END",
    "lab_result_value": "CASE WHEN l_tax >= 0.04 THEN l_quantity END",
    "lab_result_units": "CASE WHEN l_tax >= 0.04 THEN l_returnflag END",
    "lab_result_date": "CASE WHEN l_tax >= 0.04 THEN l_shipdate END",
}

WIDE = {
    "visit_id": "FactVisit",
    "visit_datetime": "FactVisit",
    "patient_status": "DimPatient",
    "billing_payment_status": "DimBilling",
    "insurance_plan_type": "DimInsurance",
    "doctor_name": "DimProvider",
    "clinic_name": "DimLocation",
    "primary_diagnosis_desc": "DimPrimaryDiagnosis",
    "secondary_diagnosis_desc": "DimSecondaryDiagnosis",
    "treatment_desc": "DimTreatment",
    "prescription_drug_name": "DimPrescription",
    "lab_result_value": "DimLabOrder",
}


def _lines(spark: SparkSession, sf_dir: str, names: Collection[str]) -> DataFrame:
    """The order lines, with what the named visit columns are made from."""
    words = re.findall(r"\b[locnrps]_[a-z]+\b", " ".join(VISIT_COLUMNS[n] for n in names))
    return flat(spark, sf_dir, *dict.fromkeys(words))


def visits(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """One visit per order line, with the named columns (all by default)."""
    names = names or tuple(VISIT_COLUMNS)
    lines = _lines(spark, sf_dir, names)
    return lines.selectExpr(*[f"{VISIT_COLUMNS[name]} AS {name}" for name in names])


def _star(
    spark: SparkSession, sf_dir: str, names: Collection[str] = STAR.tables, **options
) -> dict[str, DataFrame]:
    """The named tables of the visits; what is staged are the order lines they are made from."""
    lines = _lines(spark, sf_dir, STAR.sources(names))
    return normalize(
        lines, STAR, only=names, stage_input=True, derived=VISIT_COLUMNS, **options
    )


def dimension(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One dimension, from the columns it needs."""
    dim = next(d for d in STAR.dims if d.name == name)
    return plan.dimension(visits(spark, sf_dir, *dim.sources), name)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All tables, computed when they are read."""
    return _star(spark, sf_dir)


def stored_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All tables, computed once for queries that read them several times."""
    return _star(spark, sf_dir, keep=staged)


# By session, input and tables: the version of the input's files, and the folder of the star.
_STORED: dict[tuple[str, str, tuple[str, ...]], tuple[tuple, str]] = {}


def stored_star(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named tables (default: all) as Parquet, written by the first query of a session
    that asks for them.

    Only these are built, so a query costs what its tables do, whichever ran before. They
    are built anew when a file of the input has changed, and the old ones deleted.
    """
    names = names or STAR.tables
    key = spark.sparkContext.applicationId, sf_dir, names
    version = tuple(stored_version(spark, f"{sf_dir}/{name}.parquet") for name in SOURCES)
    known, folder = _STORED.get(key, (None, None))
    if known != version or not stored_bytes(spark, folder):
        if folder:
            delete_tree(spark, folder)
        folder = staging_path(spark, "visit-star")

        def keep(table: DataFrame, name: str) -> DataFrame:
            write_parquet(table, folder, name, compression=COMPRESSION)
            return spark.read.schema(table.schema).parquet(f"{folder}/{name}")

        _star(spark, sf_dir, names, keep=keep)
        _STORED[key] = version, folder
    return read_star_parquet(spark, folder, names)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact alone, from the columns it needs."""
    name = STAR.fact.name
    return _star(spark, sf_dir, [name])[name]


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(tables(spark, sf_dir))


def suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fk_suite(stored_tables(spark, sf_dir), STAR.fk_edges)


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes: dict[str, TableSizes] = {}

    def keep(table: DataFrame, name: str) -> DataFrame:
        stored, sizes[name] = staged_with_sizes(table, name)
        return stored

    star = _star(spark, sf_dir, keep=keep)
    return star_join(
        star,
        STAR.fact.name,
        STAR.join_edges,
        {column: (owner, column) for column, owner in WIDE.items()},
        spread_by=STAR.fact.grain,
        sizes=sizes,
    )


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The profile scans its input once a type.
    return column_profile(staged(fact(spark, sf_dir), STAR.fact.name))


def star_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of every table of the star."""
    return profile_tables(stored_star(spark, sf_dir))
