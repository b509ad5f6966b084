"""Operators of dimensional modelling, each a composition of DataFrame operations."""

from starnorm.operators.counts import count_by, count_by_dimension, row_counts, with_share
from starnorm.operators.dedupe import one_row_per_key
from starnorm.operators.dense_key import dense_key, dense_keys
from starnorm.operators.dimensions import (
    Numbered,
    keyed_dim,
    last_activity,
    natural_dim,
    natural_dims,
    status_dim,
)
from starnorm.operators.fact import Attach, attach_keys, build_fact
from starnorm.operators.integrity import FkEdge, fk_check, fk_orphans, fk_suite
from starnorm.operators.lookup import lookup
from starnorm.operators.profile import approximate_profile, column_profile, profile_tables
from starnorm.operators.sketches import (
    column_sketches,
    estimated,
    group_sketches,
    merged,
    relative_error,
    rolled_up,
)
from starnorm.operators.star_join import JoinEdge, star_join

__all__ = [
    "Attach",
    "FkEdge",
    "JoinEdge",
    "Numbered",
    "approximate_profile",
    "attach_keys",
    "build_fact",
    "column_profile",
    "column_sketches",
    "count_by",
    "count_by_dimension",
    "dense_key",
    "dense_keys",
    "estimated",
    "fk_check",
    "fk_orphans",
    "fk_suite",
    "group_sketches",
    "keyed_dim",
    "last_activity",
    "lookup",
    "merged",
    "natural_dim",
    "natural_dims",
    "one_row_per_key",
    "profile_tables",
    "relative_error",
    "rolled_up",
    "row_counts",
    "star_join",
    "status_dim",
    "with_share",
]
