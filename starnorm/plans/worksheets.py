"""The five questions asked of the visit star."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starnorm.functions.calendar import hour_of_day, weekday_name, weekday_number, year_of
from starnorm.operators.counts import count_by, count_by_dimension, with_share

Tables = Mapping[str, DataFrame]


def patients_by_gender(tables: Tables) -> DataFrame:
    """Visits per gender, and the distinct patients behind them."""
    return count_by_dimension(
        tables["FactVisit"],
        tables["DimPatient"],
        "patient_id",
        "patient_id",
        ["patient_gender"],
        "patient_id",
        name="n_visits",
        distinct_name="n_patients",
    )


def payment_status_distribution(tables: Tables) -> DataFrame:
    """Visits per payment status with their share of all visits."""
    return with_share(
        count_by_dimension(
            tables["FactVisit"],
            tables["DimBilling"],
            "billing_id",
            "billing_id",
            ["billing_payment_status"],
            "patient_id",
            name="n_visits",
        ),
        "n_visits",
    )


def visit_type_distribution(tables: Tables) -> DataFrame:
    """Visits per visit type with their share of all visits."""
    counts = count_by(tables["FactVisit"], ["visit_type"], "patient_id", "n_visits")
    return with_share(counts, "n_visits")


def visits_by_weekday_and_hour(tables: Tables) -> DataFrame:
    """Visits per weekday and hour; a cell without visits is absent."""
    ts = F.col("visit_datetime")
    by = [
        weekday_number(ts).alias("weekday_no"),
        weekday_name(ts).alias("weekday"),
        hour_of_day(ts).alias("hour"),
    ]
    return count_by(tables["FactVisit"], by, "visit_id", "n_visits")


def yearly_visits_by_clinic(tables: Tables) -> DataFrame:
    """Visits per year and clinic, and the distinct patients behind them."""
    return count_by_dimension(
        tables["FactVisit"],
        tables["DimLocation"],
        "location_id",
        "location_id",
        ["clinic_name"],
        "visit_id",
        by=[year_of(F.col("visit_datetime")).alias("year")],
        name="n_visits",
        distinct_name="n_patients",
        distinct="patient_id",
    )


WORKSHEETS = {
    "patients_by_gender": patients_by_gender,
    "payment_status_distribution": payment_status_distribution,
    "visit_type_distribution": visit_type_distribution,
    "visits_by_weekday_and_hour": visits_by_weekday_and_hour,
    "yearly_visits_by_clinic": yearly_visits_by_clinic,
}

# The tables a worksheet reads; no other need be built for it.
TABLES = {
    "patients_by_gender": ("FactVisit", "DimPatient"),
    "payment_status_distribution": ("FactVisit", "DimBilling"),
    "visit_type_distribution": ("FactVisit",),
    "visits_by_weekday_and_hour": ("FactVisit",),
    "yearly_visits_by_clinic": ("FactVisit", "DimLocation"),
}
