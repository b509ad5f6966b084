"""Column expressions shared by the operators; every one is a Catalyst built-in."""

from starnorm.functions.activity import ACTIVE, CUTOFF, INACTIVE, activity_status
from starnorm.functions.calendar import hour_of_day, weekday_name, weekday_number, year_of
from starnorm.functions.nulls import all_null, any_null

__all__ = [
    "ACTIVE",
    "CUTOFF",
    "INACTIVE",
    "activity_status",
    "all_null",
    "any_null",
    "hour_of_day",
    "weekday_name",
    "weekday_number",
    "year_of",
]
