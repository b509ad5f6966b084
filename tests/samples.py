"""Visits made from their number, with the cases a star has to cope with."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from starnorm.functions.activity import CUTOFF
from starnorm.plans.visits import FLAT_SCHEMA

FIRST_DAY = datetime(2022, 3, 1, 6, 30, 15, 120034)
ON_THE_CUTOFF = datetime.fromisoformat(CUTOFF)


def visit(number: int, **changes) -> dict:
    """Visit ``number``: every text field says whose it is, every other follows the number.

    Three patients and three clinics take turns; insurance, billing and the rest go
    with them. Secondary diagnoses are rare.
    """
    turn = number % 3
    row = {}
    for field in FLAT_SCHEMA:
        kind = field.dataType.typeName()
        if kind == "string":
            row[field.name] = f"{field.name}-{turn}"
        elif kind == "double":
            row[field.name] = turn + 0.25
        elif kind == "integer":
            row[field.name] = 100 + turn
        elif kind == "date":
            row[field.name] = date(1960 + turn, 2, 28)
        else:
            row[field.name] = FIRST_DAY + timedelta(days=turn)
    row |= {
        "visit_id": f"visit-{number}",
        "visit_datetime": FIRST_DAY + timedelta(days=40 * number, hours=number),
        "patient_zip": f"0{number % 3}042",
        "secondary_diagnosis_code": None,
        "secondary_diagnosis_desc": None,
    }
    return {**row, **changes}


# A clinic nearly everybody goes to, and one visit elsewhere.
_HOT = {"clinic_name": "everyone, here", "room_number": 7}
VISITS = [
    visit(0, **_HOT),
    visit(1, **_HOT, patient_id="long ago", visit_datetime=ON_THE_CUTOFF),
    visit(2, **_HOT, patient_id="long ago", visit_datetime=ON_THE_CUTOFF - timedelta(days=9)),
    visit(3, **_HOT, patient_id="just after", visit_datetime=ON_THE_CUTOFF + timedelta(seconds=1)),
    # A null part of a natural key, and a null key that has attributes.
    visit(4, **_HOT, doctor_title=None, lab_order_id=None),
    visit(5, secondary_diagnosis_code="rare", secondary_diagnosis_desc=None),
    # No lab order and no prescription at all.
    visit(6, **_HOT, **{n: None for n in FLAT_SCHEMA.names if n.startswith(("lab_", "prescription_"))}),
]
# The same visit twice, apart from what it cost.
TWICE = [*VISITS, {**VISITS[0], "billing_id": "billed again"}]
