"""One query per operator, as DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starnorm.functions import (
    activity_status,
    hour_of_day,
    weekday_name,
    weekday_number,
    year_of,
)
from starnorm.operators import (
    Attach,
    FkEdge,
    attach_keys,
    column_profile,
    column_sketches,
    count_by,
    count_by_dimension,
    dense_key,
    estimated,
    fk_check,
    fk_orphans,
    fk_suite,
    group_sketches,
    keyed_dim,
    last_activity,
    lookup,
    merged,
    natural_dim,
    one_row_per_key,
    profile_tables,
    relative_error,
    rolled_up,
    row_counts,
    star_join,
    status_dim,
    with_share,
)
from starnorm.plans.normalize import normalize
from starnorm.sinks import write_csv, write_table
from starnorm.sources import (
    CheckedRead,
    read_checked,
    read_flat,
    read_star_csv,
    read_star_parquet,
)
from starnorm.staging import freed_shuffles, staged, staging_path
from starnorm.job import run as run_job
from starnorm.plans.visits import STAR as VISIT_STAR
from starnorm.plans.visits import star_schemas
from starnorm.plans.worksheets import TABLES as WORKSHEET_TABLES
from starnorm.plans.worksheets import WORKSHEETS
from starqueries import visits
from starqueries.frames import CUTOFF, EDGES, STAR, flat, star_input, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name, less the suffix that keeps it off an operator."""
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


# Sources and sinks


@query
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = staging_path(spark, "scan-csv")
    orders.write.option("header", True).csv(path)
    return read_flat(spark, path, orders.schema)


@query
def scan_csv_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file whose columns stand in another order than the schema's, one of them unknown."""
    orders = table(spark, sf_dir, "orders")
    path = staging_path(spark, "scan-csv")
    backwards = orders.select(*reversed(orders.columns), F.lit("?").alias("further"))
    backwards.write.option("header", True).csv(path)
    return read_flat(spark, path, orders.schema)


def _spoiled_orders(spark: SparkSession, sf_dir: str) -> CheckedRead:
    """The orders from a CSV in which some prices and dates are words."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    price, day = F.col("o_totalprice").cast("string"), F.col("o_orderdate").cast("string")
    path = staging_path(spark, "scan-csv")
    orders.withColumns(
        {
            "o_totalprice": F.when(key % 97 == 0, "none").otherwise(price),
            "o_orderdate": F.when(key % 89 == 0, "soon, they said").otherwise(day),
        }
    ).write.option("header", True).csv(path)
    return read_checked(spark, path, orders.schema)


@query
def scan_csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that do not parse, by column."""
    return _spoiled_orders(spark, sf_dir).counts


@query
def scan_csv_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records left out, by what is wrong with them; and those that stay."""
    read = _spoiled_orders(spark, sf_dir)
    wrong = F.array_join("columns", ",").alias("malformed")
    out = read.rejected.groupBy(wrong).agg(F.count("record").alias("n_rows"))
    return out.unionByName(
        read.good.agg(F.count("o_orderkey").alias("n_rows")).select(F.lit("").alias("malformed"), "n_rows")
    )


@query
def scan_csv_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spoiled_orders(spark, sf_dir).good


@query
def csv_text_roundtrip_escaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As below, in lines that readers may split anywhere."""
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = staging_path(spark, "csv-text")
    write_csv(texts, folder, "documents", line_breaks="escaped")
    schemas = {"documents": texts.schema}
    return read_star_csv(spark, folder, schemas, line_breaks="escaped")["documents"]


@query
def csv_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks, quotes and spaces, written and read with the defaults."""
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = staging_path(spark, "csv-text")
    write_csv(texts, folder, "documents")
    return read_star_csv(spark, folder, {"documents": texts.schema})["documents"]


@query
def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = staging_path(spark, "scan-csv")
    customer.write.option("header", True).csv(path)
    inferred = read_flat(spark, path)
    return inferred.select(*[F.col(f.name).cast(f.dataType) for f in customer.schema])


@query
def scan_star_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = staging_path(spark, "star-csv")
    schemas = {}
    for name in ("orders", "customer", "nation"):
        frame = table(spark, sf_dir, name)
        stamps = [f.name for f in frame.schema if isinstance(f.dataType, T.TimestampNTZType)]
        frame = frame.withColumns({c: F.col(c).cast("timestamp") for c in stamps})
        write_csv(frame, folder, name)
        schemas[name] = frame.schema
    star = read_star_csv(spark, folder, schemas)
    wide = star_join(
        star,
        "orders",
        EDGES,
        {
            "o_orderkey": ("orders", "o_orderkey"),
            "o_orderdate": ("orders", "o_orderdate"),
            "o_totalprice": ("orders", "o_totalprice"),
            "c_name": ("customer", "c_name"),
            "n_name": ("nation", "n_name"),
        },
    )
    return wide.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@query
def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = write_csv(customer, staging_path(spark, "sink-csv"), "customer", layout="single")
    return read_flat(spark, path, customer.schema)


@query
def sink_csv_parts_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    folder = staging_path(spark, "sink-csv")
    path = write_csv(lineitem, folder, "lineitem")
    return read_flat(spark, path, lineitem.schema)


@query
def sink_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = staging_path(spark, "sink-parquet")
    customer = table(spark, sf_dir, "customer")
    write_table(customer, "customer", output_format="parquet", parquet_folder=folder)
    return read_star_parquet(spark, folder, ["customer"])["customer"]


@query
def sink_both_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = staging_path(spark, "sink-both")
    customer = table(spark, sf_dir, "customer")
    write_table(
        customer,
        "customer",
        output_format="both",
        csv_folder=f"{folder}/csv",
        parquet_folder=f"{folder}/parquet",
    )
    copies = {
        "csv": read_flat(spark, f"{folder}/csv/customer.csv", customer.schema),
        "parquet": read_star_parquet(spark, f"{folder}/parquet", ["customer"])["customer"],
    }
    labelled = [df.withColumn("copy", F.lit(name)) for name, df in copies.items()]
    return labelled[0].unionByName(labelled[1])


# Projections, filters and nulls


@query
def project_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")


@query
def filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")


@query
def filter_fk_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = flat(spark, sf_dir, "l_orderkey", "l_linenumber", "promo_key")
    return lines.filter(F.col("promo_key").isNotNull())


@query
def fk_null_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = flat(spark, sf_dir, "promo_key", "second_priority", "second_status")
    return lines.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in lines.columns]
    )


@query
def dropna_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(spark, sf_dir, "second_priority", "second_status").dropna(how="all")


# Latest activity and status


@query
def last_activity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_activity(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


@query
def last_activity_joinback(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    latest = staged(last_activity(orders, "o_custkey", "o_orderdate"), "last-activity")
    return lookup(
        orders, latest, {"o_custkey": "o_custkey"}, {"last_activity": "last_activity"}
    )


@query
def patient_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = last_activity(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")
    status = activity_status(
        F.col("last_activity"),
        cutoff=CUTOFF,
        data_type=latest.schema["last_activity"].dataType,
    )
    return latest.select("o_custkey", status.alias("customer_status"))


@query
def dim_patient_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = STAR.dims[0]
    rows = flat(spark, sf_dir, dim.key, *dim.attributes, dim.ts)
    return status_dim(
        rows, dim.key, dim.attributes, dim.ts, status=dim.status, cutoff=dim.cutoff
    )


# Keys and dimensions


@query
def distinct_natural_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_brand", "p_type", "p_size").distinct()


@query
def dense_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = flat(spark, sf_dir, "promo_name", "second_priority").distinct()
    return dense_key(keys, keys.columns, "key_id")


@query
def dim_natural_3col(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return natural_dim(part, ["p_brand", "p_type", "p_size"], "product_id")


@query
def dim_natural_2col(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = star_join(
        {name: table(spark, sf_dir, name) for name in ("customer", "nation", "region")},
        "customer",
        [e for e in EDGES if e.table in ("customer", "nation")],
        {"n_name": ("nation", "n_name"), "r_name": ("region", "r_name")},
    )
    return natural_dim(places, ["n_name", "r_name"], "place_id")


@query
def dim_natural_nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = flat(spark, sf_dir, "second_priority", "second_status")
    return natural_dim(lines, lines.columns, "second_priority_id", drop_all_null=True)


@query
def dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_row_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dedupe_keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_row_per_key(
        table(spark, sf_dir, "orders"), ["o_custkey"], order_by=["o_orderdate"], keep="last"
    )


@query
def dim_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = STAR.dims[1]
    return keyed_dim(flat(spark, sf_dir, dim.key, *dim.attributes), dim.key, dim.attributes)


@query
def dim_keyed_nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = flat(spark, sf_dir, "promo_key", "promo_name", "second_priority")
    return keyed_dim(lines, "promo_key", ["promo_name", "second_priority"], drop_all_null=True)


@query
def dim_keyed_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = flat(spark, sf_dir, "promo_key", "promo_name", "second_priority")
    return keyed_dim(lines, "promo_key", ["promo_name", "second_priority"], drop_null_key=True)


# The fact and the whole star


def _attach(spark: SparkSession, sf_dir: str, null_safe: bool) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "second_priority", "second_status"]
    keys = ("p_brand", "p_type", "p_size"), ("second_priority", "second_status")
    lines = staged(flat(spark, sf_dir, *columns, *keys[0]), "flat")
    product = natural_dim(lines, keys[0], "product_id", row_count="n")
    second = natural_dim(lines, keys[1], "second_priority_id", row_count="n")
    rows = attach_keys(
        lines,
        [
            Attach(product, keys[0], "product_id", "n"),
            Attach(second, keys[1], "second_priority_id", "n"),
        ],
        null_safe=null_safe,
        spread_by=["l_orderkey", "l_linenumber"],
    )
    return rows.select("l_orderkey", "l_linenumber", "product_id", "second_priority_id")


@query
def fact_attach_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attach(spark, sf_dir, null_safe=False)


@query
def fact_attach_keys_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attach(spark, sf_dir, null_safe=True)


@query
def fact_attach_keys_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result by the route taken when the dimension is too large to broadcast."""
    keys = ("second_priority", "second_status", "p_type")
    lines = staged(flat(spark, sf_dir, "l_orderkey", "l_linenumber", *keys), "flat")
    dim = natural_dim(lines, keys, "key_id", row_count="n")
    rows = attach_keys(
        lines,
        [Attach(dim, keys, "key_id", "n")],
        spread_by=["l_orderkey", "l_linenumber"],
        broadcast_bytes=0,
    )
    return rows.select("l_orderkey", "l_linenumber", "key_id")


@query
def fact_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = STAR.fact.name
    return normalize(star_input(spark, sf_dir), STAR, only=[name], stage_input=True)[name]


@query
def normalize_rowcounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(normalize(star_input(spark, sf_dir), STAR, stage_input=True))


@query
def normalize_fk_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = normalize(star_input(spark, sf_dir), STAR, keep=staged, stage_input=True)
    return fk_suite(tables, STAR.fk_edges)


# Integrity

SOURCE_EDGES = (
    FkEdge("lineitem", "l_orderkey", "orders", "o_orderkey"),
    FkEdge("lineitem", "l_partkey", "part", "p_partkey"),
    FkEdge("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    FkEdge("orders", "o_custkey", "customer", "c_custkey"),
    FkEdge("customer", "c_nationkey", "nation", "n_nationkey"),
    FkEdge("supplier", "s_nationkey", "nation", "n_nationkey"),
    FkEdge("nation", "n_regionkey", "region", "r_regionkey"),
    FkEdge("events", "user_id", "customer", "c_custkey"),
)


@query
def fk_orphans_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    in_credit = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0)
    return fk_orphans(table(spark, sf_dir, "orders"), in_credit, "o_custkey", "c_custkey")


@query
def fk_check_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return fk_check(lineitem, orders, "l_orderkey", "o_orderkey", "orders", nullable=False)


def _graded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents with a nullable label key, and the labels of good quality."""
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents").select("doc_id")
    facts = documents.join(
        labels.select(F.col("doc_id").alias("label_id")),
        F.col("doc_id") == F.col("label_id"),
        "left",
    )
    return facts, labels.filter(F.col("quality") == 1)


@query
def fk_check_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, good = _graded(spark, sf_dir)
    return fk_check(facts, good, "label_id", "doc_id", "labels", nullable=False)


@query
def fk_check_nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, good = _graded(spark, sf_dir)
    return fk_check(facts, good, "label_id", "doc_id", "labels", nullable=True)


@query
def fk_suite_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {e.table for e in SOURCE_EDGES} | {e.dim for e in SOURCE_EDGES}
    return fk_suite({name: table(spark, sf_dir, name) for name in names}, SOURCE_EDGES)


# Wide rows


@query
def star_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(
        spark,
        sf_dir,
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "o_orderstatus",
        "c_mktsegment",
        "p_brand",
        "s_name",
    )


@query
def snowflake_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(spark, sf_dir, "l_orderkey", "l_linenumber", "c_name", "n_name", "r_name")


# Sizes, profiles and grouped counts

_SIZED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query
def row_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts({name: table(spark, sf_dir, name) for name in _SIZED})


@query
def column_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The profile scans its input once a type.
    return column_profile(staged(star_input(spark, sf_dir), "star-input"))


# How far an estimate may be off, in standard errors.
TOLERANCE = 5


def _within(estimate: Column, exact: Column) -> Column:
    return F.abs(estimate - exact) <= TOLERANCE * relative_error() * exact


@query
def approximate_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of two loads of the lines, stored apart and merged, against exact counts."""
    lines = table(spark, sf_dir, "lineitem")
    returned = F.col("l_returnflag") == "N"
    loads = [
        staged(column_sketches(lines.filter(part)), "sketches") for part in (returned, ~returned)
    ]
    whole = merged(*loads)
    estimates = estimated(whole).select("column_name", F.col("n_distinct").alias("estimate"))
    exact = column_profile(lines)
    return (
        exact.join(estimates, "column_name")
        .join(whole.select("column_name", "n_rows"), "column_name")
        .select(
            "column_name",
            "n_rows",
            "n_distinct",
            "n_null",
            _within(F.col("estimate"), F.col("n_distinct")).alias("within"),
        )
    )


@query
def mart_users_rolled_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users per event type, from stored sketches per day and type."""
    events = table(spark, sf_dir, "events")
    day = F.to_date("ts").alias("day")
    daily = staged(group_sketches(events, [day, "event_type"], "user_id"), "daily-users")
    users = rolled_up(daily, ["event_type"], "estimate")
    exact = events.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    exact = exact.groupBy("event_type").agg(F.count("user_id").alias("n_users"))
    return users.join(exact, "event_type").select(
        "event_type",
        F.col("n_rows").alias("n_events"),
        "n_users",
        _within(F.col("estimate"), F.col("n_users")).alias("within"),
    )


@query
def mart_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_dimension(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "customer"),
        "o_custkey",
        "c_custkey",
        ["c_mktsegment"],
        "o_custkey",
        name="n_visits",
        distinct_name="n_patients",
    )


@query
def mart_payment_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_dimension(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "orders"),
        "l_orderkey",
        "o_orderkey",
        ["o_orderstatus"],
        "l_partkey",
        name="n_visits",
    )


@query
def mart_payment_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_share(mart_payment_status(spark, sf_dir), "n_visits")


@query
def mart_visit_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(table(spark, sf_dir, "events"), ["event_type"], "user_id", "n_visits")


@query
def mart_weekday_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    by = [
        weekday_number(ts).alias("weekday_no"),
        weekday_name(ts).alias("weekday"),
        hour_of_day(ts).alias("hour"),
    ]
    return count_by(table(spark, sf_dir, "events"), by, "event_id", "n_visits")


@query
def mart_year_clinic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_dimension(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "customer"),
        "o_custkey",
        "c_custkey",
        ["c_mktsegment"],
        "o_orderkey",
        by=[year_of(F.col("o_orderdate")).alias("year")],
        name="n_visits",
        distinct_name="n_patients",
    )


@query
def mart_year_status_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and distinct parts per year and order status: neither column is the key."""
    return count_by_dimension(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "orders"),
        "l_orderkey",
        "o_orderkey",
        ["o_orderstatus"],
        "l_linenumber",
        by=[year_of(F.col("l_shipdate")).alias("year")],
        name="n_lines",
        distinct_name="n_parts",
        distinct="l_partkey",
    )


# The flagship: one natural dimension, attached and counted


@query
def lines_per_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ("p_brand", "p_type", "p_size")
    product = natural_dim(table(spark, sf_dir, "part"), keys, "product_id")
    lines = attach_keys(
        flat(spark, sf_dir, "l_orderkey", "l_linenumber", *keys),
        [Attach(product, keys, "product_id")],
        spread_by=["l_orderkey", "l_linenumber"],
    )
    return count_by(lines, ["product_id", *keys], "l_orderkey", "n_lines")


# The clinic-visit star, end to end


def _snake(name: str) -> str:
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name).lstrip("_")


def _dimension(name: str) -> Query:
    return lambda spark, sf_dir: visits.dimension(spark, sf_dir, name)


def _worksheet(name: str) -> Query:
    tables = WORKSHEET_TABLES[name]
    return lambda spark, sf_dir: WORKSHEETS[name](visits.stored_star(spark, sf_dir, *tables))


QUERIES |= {f"visits_{_snake(d.name)}": _dimension(d.name) for d in VISIT_STAR.dims}
QUERIES |= {
    "visits_fact": visits.fact,
    "visits_row_counts": visits.sizes,
    "visits_fk_suite": visits.suite,
    "visits_wide": visits.wide,
    "visits_profile": visits.profile,
    "visits_star_profile": visits.star_profile,
}
QUERIES |= {f"worksheet_{name}": _worksheet(name) for name in WORKSHEETS}


def _run_visits_job(spark: SparkSession, sf_dir: str, **options) -> tuple[str, DataFrame]:
    """The batch job over a CSV of the visits, writing both formats; output and key report."""
    folder = staging_path(spark, "visits-job")
    source = visits.visits(spark, sf_dir).write.options(header=True, compression="gzip")
    # A compressed file is read by one task, so none may be large.
    with freed_shuffles(spark):
        source.option("maxRecordsPerFile", 500_000).csv(f"{folder}/visits.csv")
    options = {"output_format": "both", **options}
    _, report = run_job(spark, f"{folder}/visits.csv", f"{folder}/out", **options)
    return f"{folder}/out", report


def _with_local_time(table: DataFrame) -> DataFrame:
    """Timestamps as the supplied tables have them, without a zone."""
    zoned = [f.name for f in table.schema if isinstance(f.dataType, T.TimestampType)]
    return table.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


@query
def visits_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_visits_job(spark, sf_dir)[1]


@query
def visits_job_fact_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as the job wrote it, read from its CSV."""
    output, _ = _run_visits_job(spark, sf_dir)
    return _with_local_time(read_star_csv(spark, f"{output}/csv", star_schemas())["FactVisit"])


@query
def visits_job_inferred_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of a job that infers the types of all 47 columns."""
    output, _ = _run_visits_job(spark, sf_dir, output_format="parquet", infer_schema=True)
    name = VISIT_STAR.fact.name
    return _with_local_time(read_star_parquet(spark, f"{output}/parquet", [name])[name])


@query
def visits_job_escaped_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing as the job wrote it in lines that readers may split."""
    output, _ = _run_visits_job(spark, sf_dir, output_format="csv", line_breaks="escaped")
    star = read_star_csv(spark, f"{output}/csv", star_schemas(), line_breaks="escaped")
    return star["DimBilling"]


@query
def visits_job_profile_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of every table the job wrote, read from its Parquet."""
    output, _ = _run_visits_job(spark, sf_dir)
    return profile_tables(read_star_parquet(spark, f"{output}/parquet", VISIT_STAR.tables))
