"""The clinic-visit star: input schema, dimensions, fact and edges."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starnorm.operators.fact import Attach, build_fact
from starnorm.operators.integrity import FkEdge
from starnorm.operators.star_join import JoinEdge
from starnorm.plans.normalize import ROW_COUNT, build_dimension
from starnorm.plans.spec import FactSpec, KeyedDim, NaturalDim, StarSpec, StatusDim

STRING, INT, DOUBLE = T.StringType(), T.IntegerType(), T.DoubleType()
DATE, TIMESTAMP = T.DateType(), T.TimestampType()

# Names and types of the 47 input columns, grouped as they are used.
VISIT = {
    "visit_id": STRING,
    "visit_datetime": TIMESTAMP,
    "visit_type": STRING,
}
PATIENT = {
    "patient_id": STRING,
    "patient_first_name": STRING,
    "patient_last_name": STRING,
    "patient_date_of_birth": DATE,
    "patient_gender": STRING,
    "patient_address_line1": STRING,
    "patient_address_line2": STRING,
    "patient_city": STRING,
    "patient_state": STRING,
    "patient_zip": STRING,
    "patient_phone": STRING,
    "patient_email": STRING,
}
INSURANCE = {
    "insurance_id": STRING,
    "insurance_payer_name": STRING,
    "insurance_policy_number": STRING,
    "insurance_group_number": STRING,
    "insurance_plan_type": STRING,
}
BILLING = {
    "billing_id": STRING,
    "billing_total_charge": DOUBLE,
    "billing_amount_paid": DOUBLE,
    "billing_date": STRING,
    "billing_payment_status": STRING,
}
PROVIDER = {
    "doctor_name": STRING,
    "doctor_title": STRING,
    "doctor_department": STRING,
}
LOCATION = {
    "clinic_name": STRING,
    "room_number": INT,
}
PRIMARY_DIAGNOSIS = {
    "primary_diagnosis_code": STRING,
    "primary_diagnosis_desc": STRING,
}
SECONDARY_DIAGNOSIS = {
    "secondary_diagnosis_code": STRING,
    "secondary_diagnosis_desc": STRING,
}
TREATMENT = {
    "treatment_code": STRING,
    "treatment_desc": STRING,
}
PRESCRIPTION = {
    "prescription_id": STRING,
    "prescription_drug_name": STRING,
    "prescription_dosage": STRING,
    "prescription_frequency": STRING,
    "prescription_duration_days": DOUBLE,
}
LAB_ORDER = {
    "lab_order_id": STRING,
    "lab_test_code": STRING,
    "lab_name": STRING,
    "lab_result_value": DOUBLE,
    "lab_result_units": STRING,
    "lab_result_date": TIMESTAMP,
}

FLAT_SCHEMA = T.StructType(
    [
        T.StructField(name, kind)
        for group in (
            VISIT,
            PATIENT,
            INSURANCE,
            BILLING,
            PROVIDER,
            LOCATION,
            PRIMARY_DIAGNOSIS,
            SECONDARY_DIAGNOSIS,
            TREATMENT,
            PRESCRIPTION,
            LAB_ORDER,
        )
        for name, kind in group.items()
    ]
)


# Tables, keys, column order, and which keys may be null.
STAR = StarSpec(
    dims=(
        StatusDim(
            "DimPatient", "patient_id", tuple(PATIENT)[1:], "visit_datetime", "patient_status"
        ),
        KeyedDim("DimInsurance", "insurance_id", ("patient_id", *tuple(INSURANCE)[1:])),
        KeyedDim("DimBilling", "billing_id", ("insurance_id", *tuple(BILLING)[1:])),
        NaturalDim("DimProvider", "provider_id", tuple(PROVIDER)),
        NaturalDim("DimLocation", "location_id", tuple(LOCATION)),
        NaturalDim("DimPrimaryDiagnosis", "primary_diagnosis_id", tuple(PRIMARY_DIAGNOSIS)),
        NaturalDim(
            "DimSecondaryDiagnosis",
            "secondary_diagnosis_id",
            tuple(SECONDARY_DIAGNOSIS),
            drop_all_null=True,
        ),
        NaturalDim("DimTreatment", "treatment_id", tuple(TREATMENT)),
        KeyedDim(
            "DimPrescription", "prescription_id", tuple(PRESCRIPTION)[1:], drop_all_null=True
        ),
        KeyedDim("DimLabOrder", "lab_order_id", tuple(LAB_ORDER)[1:], drop_all_null=True),
    ),
    fact=FactSpec(
        "FactVisit",
        ("visit_id",),
        (
            "visit_id",
            "patient_id",
            "insurance_id",
            "billing_id",
            "provider_id",
            "location_id",
            "primary_diagnosis_id",
            "secondary_diagnosis_id",
            "treatment_id",
            "prescription_id",
            "lab_order_id",
            "visit_datetime",
            "visit_type",
        ),
    ),
    fk_edges=(
        FkEdge("FactVisit", "patient_id", "DimPatient", "patient_id"),
        FkEdge("FactVisit", "insurance_id", "DimInsurance", "insurance_id"),
        FkEdge("FactVisit", "billing_id", "DimBilling", "billing_id"),
        FkEdge("FactVisit", "provider_id", "DimProvider", "provider_id"),
        FkEdge("FactVisit", "location_id", "DimLocation", "location_id"),
        FkEdge("FactVisit", "treatment_id", "DimTreatment", "treatment_id"),
        FkEdge(
            "FactVisit", "primary_diagnosis_id", "DimPrimaryDiagnosis", "primary_diagnosis_id"
        ),
        FkEdge(
            "FactVisit",
            "secondary_diagnosis_id",
            "DimSecondaryDiagnosis",
            "secondary_diagnosis_id",
            nullable=True,
        ),
        FkEdge(
            "FactVisit", "prescription_id", "DimPrescription", "prescription_id", nullable=True
        ),
        FkEdge("FactVisit", "lab_order_id", "DimLabOrder", "lab_order_id", nullable=True),
        FkEdge("DimInsurance", "patient_id", "DimPatient", "patient_id"),
        FkEdge("DimBilling", "insurance_id", "DimInsurance", "insurance_id"),
    ),
    join_edges=(
        JoinEdge("FactVisit", "billing_id", "DimBilling", "billing_id"),
        JoinEdge("DimBilling", "insurance_id", "DimInsurance", "insurance_id"),
        JoinEdge("FactVisit", "lab_order_id", "DimLabOrder", "lab_order_id"),
        JoinEdge("FactVisit", "location_id", "DimLocation", "location_id"),
        JoinEdge("FactVisit", "patient_id", "DimPatient", "patient_id"),
        JoinEdge("FactVisit", "prescription_id", "DimPrescription", "prescription_id"),
        JoinEdge(
            "FactVisit", "primary_diagnosis_id", "DimPrimaryDiagnosis", "primary_diagnosis_id"
        ),
        JoinEdge("FactVisit", "provider_id", "DimProvider", "provider_id"),
        JoinEdge(
            "FactVisit",
            "secondary_diagnosis_id",
            "DimSecondaryDiagnosis",
            "secondary_diagnosis_id",
        ),
        JoinEdge("FactVisit", "treatment_id", "DimTreatment", "treatment_id"),
    ),
)


def star_schemas() -> dict[str, T.StructType]:
    """Types of the written tables, for a typed scan."""
    flat = {f.name: f.dataType for f in FLAT_SCHEMA}

    def typed(names: tuple[str, ...]) -> T.StructType:
        # Surrogates are the only columns the input does not have, but for the status.
        kinds = {**flat, "patient_status": STRING}
        return T.StructType([T.StructField(n, kinds.get(n, T.LongType())) for n in names])

    schemas = {}
    for dim in STAR.dims:
        if isinstance(dim, NaturalDim):
            schemas[dim.name] = typed((dim.id_name, *dim.natural_key))
        elif isinstance(dim, StatusDim):
            schemas[dim.name] = typed((dim.key, *dim.attributes, dim.status))
        else:
            schemas[dim.name] = typed((dim.key, *dim.attributes))
    schemas[STAR.fact.name] = typed(STAR.fact.columns)
    return schemas


def dimension(flat: DataFrame, name: str) -> DataFrame:
    """One dimension of the star by its table name."""
    dim = next(dim for dim in STAR.dims if dim.name == name)
    return build_dimension(flat, dim).drop(ROW_COUNT)


def fact_visit(flat: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The fact, with the surrogates of dimensions built before."""
    natural = [dim for dim in STAR.dims if isinstance(dim, NaturalDim)]
    attach = [Attach(tables[dim.name], dim.natural_key, dim.id_name) for dim in natural]
    return build_fact(flat, attach, STAR.fact.columns, STAR.fact.grain)
