"""Dimensions some other build of the star exported: ours from the same rows are the same.

Set STAR_EXPORT to the folder with the CSV tables, and STAR_EXPORT_ROWS to rows per table,
as ``DimTreatment=5,DimProvider=181``. The folder is read only.
"""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starnorm.operators import column_profile, dense_key, keyed_dim
from starnorm.plans.spec import NaturalDim
from starnorm.plans.visits import STAR, star_schemas
from starnorm.sources import read_checked, read_star_csv

FOLDER = os.environ.get("STAR_EXPORT", "")
ROWS = dict(pair.split("=") for pair in os.environ.get("STAR_EXPORT_ROWS", "").split(",") if pair)
DIMS = [d for d in STAR.dims if FOLDER and Path(FOLDER, f"{d.name}.csv").exists()]

pytestmark = pytest.mark.skipif(not DIMS, reason="STAR_EXPORT names no folder with a star")


@pytest.fixture(scope="module")
def exported(spark):
    schemas = star_schemas()
    return read_star_csv(spark, FOLDER, {d.name: schemas[d.name] for d in DIMS})


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("dim", DIMS, ids=lambda d: d.name)
def test_an_exported_dimension_comes_out_again(spark, exported, dim):
    table = exported[dim.name]
    key = dim.id_name if isinstance(dim, NaturalDim) else dim.key
    n = table.count()
    assert n == int(ROWS.get(dim.name, n))
    checked = read_checked(
        spark, f"{FOLDER}/{dim.name}.csv", star_schemas()[dim.name], timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
    )
    assert checked.rejected.count() == 0
    if not isinstance(dim, NaturalDim):
        again = keyed_dim(table, dim.key, dim.attributes, drop_all_null=dim.drop_all_null)
        assert rows(again) == rows(table)
        return
    # Surrogates are dense, one a natural key; ours number the same keys in another order.
    names = list(dim.natural_key)
    assert [r[0] for r in table.select(key).orderBy(key).collect()] == list(range(n))
    ours = dense_key(table.select(*names).distinct(), names, "own")
    both = ours.alias("o").join(
        table.alias("t"), [F.col(f"o.{c}").eqNullSafe(F.col(f"t.{c}")) for c in names]
    )
    found = both.select("own", f"t.{key}").collect()
    assert len(found) == n == len({r.own for r in found}) == len({r[key] for r in found})
    profile = {r.column_name: r.n_distinct for r in column_profile(table).collect()}
    assert profile[key] == n and all(v <= n for v in profile.values())
