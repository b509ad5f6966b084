"""The supplied tables, and the flat order lines the star is made from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starnorm.catalogue import scan, sizes_of
from starnorm.operators import FkEdge, JoinEdge, star_join
from starnorm.plans.spec import FactSpec, KeyedDim, NaturalDim, StarSpec, StatusDim

GRAIN = ("l_orderkey", "l_linenumber")
CUTOFF = "2001-07-20 00:00:00"

EDGES = (
    JoinEdge("lineitem", "l_orderkey", "orders", "o_orderkey"),
    JoinEdge("orders", "o_custkey", "customer", "c_custkey"),
    JoinEdge("customer", "c_nationkey", "nation", "n_nationkey"),
    JoinEdge("nation", "n_regionkey", "region", "r_regionkey"),
    JoinEdge("lineitem", "l_partkey", "part", "p_partkey"),
    JoinEdge("lineitem", "l_suppkey", "supplier", "s_suppkey"),
)

_OWNERS = {
    "l": "lineitem",
    "o": "orders",
    "c": "customer",
    "n": "nation",
    "r": "region",
    "p": "part",
    "s": "supplier",
}


SOURCES = tuple(_OWNERS.values())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet")


def _derived() -> dict[str, tuple[Column, tuple[str, ...]]]:
    """Nullable columns the tables lack, with the columns each is made from."""
    returned = F.col("l_returnflag") != "N"
    open_return = (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O")
    discounted = F.col("l_discount") >= 0.05
    return {
        "second_priority": (
            F.when(returned, F.col("o_orderpriority")),
            ("l_returnflag", "o_orderpriority"),
        ),
        "second_status": (
            F.when(returned & ~open_return, F.col("o_orderstatus")),
            ("l_returnflag", "l_linestatus", "o_orderstatus"),
        ),
        "promo_key": (F.when(discounted, F.col("p_partkey")), ("l_discount", "p_partkey")),
        "promo_name": (F.when(discounted, F.col("p_name")), ("l_discount", "p_name")),
        "promo_size": (F.when(discounted, F.col("p_size")), ("l_discount", "p_size")),
    }


def flat(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Order lines with the requested columns of everything around them."""
    derived = {name: made for name, made in _derived().items() if name in columns}
    needed = [c for c in columns if c not in derived]
    needed += [c for _, sources in derived.values() for c in sources]
    needed = list(dict.fromkeys(needed))
    tables = {name: table(spark, sf_dir, name) for name in SOURCES}
    paths = {f"{sf_dir}/{name}.parquet": name for name in tables if name != "lineitem"}
    wide = star_join(
        tables,
        "lineitem",
        EDGES,
        {c: (_OWNERS[c[0]], c) for c in needed},
        spread_by=GRAIN,
        sizes={paths[path]: sizes for path, sizes in sizes_of(spark, paths).items()},
    )
    return wide.select(
        *[derived[c][0].alias(c) if c in derived else F.col(c) for c in columns]
    )


STAR = StarSpec(
    dims=(
        StatusDim(
            "DimCustomer",
            "c_custkey",
            ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
            "o_orderdate",
            "customer_status",
            cutoff=CUTOFF,
        ),
        KeyedDim(
            "DimOrder",
            "o_orderkey",
            ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
        ),
        NaturalDim("DimProduct", "product_id", ("p_brand", "p_type", "p_size")),
        NaturalDim("DimPlace", "place_id", ("n_name", "r_name")),
        NaturalDim("DimPriority", "priority_id", ("o_orderpriority", "o_orderstatus")),
        NaturalDim(
            "DimSecondPriority",
            "second_priority_id",
            ("second_priority", "second_status"),
            drop_all_null=True,
        ),
        NaturalDim("DimReturn", "return_id", ("l_returnflag", "l_linestatus")),
        KeyedDim("DimPromo", "promo_key", ("promo_name", "promo_size"), drop_all_null=True),
    ),
    fact=FactSpec(
        "FactLine",
        GRAIN,
        (
            "l_orderkey",
            "l_linenumber",
            "c_custkey",
            "product_id",
            "place_id",
            "priority_id",
            "second_priority_id",
            "return_id",
            "promo_key",
            "l_shipdate",
            "l_quantity",
        ),
    ),
    fk_edges=(
        FkEdge("FactLine", "l_orderkey", "DimOrder", "o_orderkey"),
        FkEdge("FactLine", "c_custkey", "DimCustomer", "c_custkey"),
        FkEdge("FactLine", "product_id", "DimProduct", "product_id"),
        FkEdge("FactLine", "place_id", "DimPlace", "place_id"),
        FkEdge("FactLine", "priority_id", "DimPriority", "priority_id"),
        FkEdge(
            "FactLine",
            "second_priority_id",
            "DimSecondPriority",
            "second_priority_id",
            nullable=True,
        ),
        FkEdge("FactLine", "return_id", "DimReturn", "return_id"),
        FkEdge("FactLine", "promo_key", "DimPromo", "promo_key", nullable=True),
        FkEdge("DimOrder", "o_custkey", "DimCustomer", "c_custkey"),
    ),
)


def star_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat columns the star above is made from."""
    return flat(spark, sf_dir, *STAR.sources())
