"""CSV with a header row, by schema or by inference."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starnorm.sources.dialect import DIALECT, LINE_BREAKS, unescaped
from starnorm.staging import staged

# Fixed value: timestamp pattern of the exported tables, with or without a fraction.
STAR_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX"
LOCAL_STAR_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]"
_CORRUPT = "_corrupt_record"


def _bound(
    spark: SparkSession, path: str, schema: T.StructType, options: Mapping[str, object]
) -> T.StructType:
    """``schema`` in the order of the file's header; other columns of the file as text."""
    header = spark.read.options(**options).csv(path).columns
    missing = [name for name in schema.fieldNames() if name not in header]
    if missing:
        raise ValueError(f"{path}: no column named {', '.join(missing)}")
    known = set(schema.fieldNames())
    return T.StructType([schema[n] if n in known else T.StructField(n, T.StringType()) for n in header])


def _read(spark: SparkSession, path: str, schema: T.StructType, options: Mapping[str, object]):
    bound = _bound(spark, path, schema, options)
    # Spark compares the header of every further file with this order.
    reader = spark.read.options(**options).option("enforceSchema", False)
    return reader.schema(bound).csv(path).select(*schema.fieldNames())


def read_flat(
    spark: SparkSession, path: str, schema: T.StructType | None = None, **options: str
) -> DataFrame:
    """Read flat records; columns are found by the names in the header.

    With a schema the scan is lazy, text such as a zip code with a leading zero stays
    as it is, further columns are ignored and a missing one raises. Without one Spark
    reads the input once more to infer types. Values that do not parse become null;
    ``mode="FAILFAST"`` raises instead, and :func:`read_checked` tells which they are.
    A text that is the null mark, U+E000 alone, reads as null.
    """
    chosen = {**DIALECT, **options}
    if schema is None:
        return spark.read.options(**chosen).option("inferSchema", True).csv(path)
    return _read(spark, path, schema, chosen)


def count_malformed(
    spark: SparkSession, path: str, schema: T.StructType, **options: str
) -> int:
    """Rows with a value that does not parse as its column's type."""
    chosen = {**DIALECT, **options, "columnNameOfCorruptRecord": _CORRUPT}
    bound = _bound(spark, path, schema, chosen).add(_CORRUPT, T.StringType())
    rows = spark.read.options(**chosen).schema(bound).csv(path)
    # Naming all columns makes Spark parse them all.
    whole = [F.count(c) for c in schema.fieldNames()]
    return rows.agg(F.count_if(F.col(_CORRUPT).isNotNull()).alias("bad"), *whole).first()["bad"]


class CheckedRead(NamedTuple):
    """One read of a file, seen from four sides; see :func:`read_checked`."""

    rows: DataFrame
    good: DataFrame
    rejected: DataFrame
    counts: DataFrame


def read_checked(
    spark: SparkSession, path: str, schema: T.StructType, **options: str
) -> CheckedRead:
    """Read flat records once, and account for every value that does not parse.

    The file is parsed and stored once, by the parser and options of :func:`read_flat`;
    the rest reads the stored copy. ``rows`` are all records, malformed values being
    null; ``good`` those without any. ``rejected`` has the text of each other record and
    the columns, in their order, whose values do not parse; there are none where only
    the number of fields is wrong. ``counts`` has a row (column_name, n_malformed) for
    every column, zeros included, and one with a null name for records that have nothing
    wrong but their number of fields.

    What is wrong with a record is found by parsing its text again, as text: a column
    is malformed if it has a text but no value. Only malformed records are parsed twice.
    """
    chosen = {**DIALECT, **options, "columnNameOfCorruptRecord": _CORRUPT}
    chosen.pop("mode", None)
    bound = _bound(spark, path, schema, chosen)
    if _CORRUPT in bound.fieldNames():
        raise ValueError(f"{path}: a column is named {_CORRUPT}")
    # All columns are asked for, so that Spark parses them all.
    whole = spark.read.options(**chosen).schema(bound.add(_CORRUPT, T.StringType())).csv(path)
    stored = staged(whole, "checked")
    names = schema.fieldNames()
    bad = stored.where(F.col(_CORRUPT).isNotNull())

    header = [name for name in bound.fieldNames() if name != _CORRUPT]
    as_text = ", ".join(f"c{i} string" for i in range(len(header)))
    dialect = {k: str(v) for k, v in chosen.items() if k not in ("header", "columnNameOfCorruptRecord")}
    texts = F.from_csv(_CORRUPT, as_text, dialect)
    place = {name: i for i, name in enumerate(header)}
    marked = [
        F.when(F.col(name).isNull() & F.col(f"__texts.c{place[name]}").isNotNull(), F.lit(name))
        for name in names
    ]
    rejected = bad.withColumn("__texts", texts).select(
        F.col(_CORRUPT).alias("record"), F.array_compact(F.array(*marked)).alias("columns")
    )
    rejected = staged(rejected, "rejected")
    found = rejected.select(F.explode_outer("columns").alias("column_name"))
    every = spark.createDataFrame([(name,) for name in [*names, None]], "column_name string")
    counts = (
        found.select("column_name", F.lit(1).alias("n"))
        .unionByName(every.select("column_name", F.lit(0).alias("n")))
        .groupBy("column_name")
        .agg(F.sum("n").alias("n_malformed"))
    )
    return CheckedRead(
        stored.select(*names),
        stored.where(F.col(_CORRUPT).isNull()).select(*names),
        rejected,
        counts,
    )


def read_star_csv(
    spark: SparkSession,
    folder: str,
    schemas: Mapping[str, T.StructType],
    *,
    timestamp_format: str = STAR_TIMESTAMP,
    line_breaks: str = "quoted",
) -> dict[str, DataFrame]:
    """Typed scans of ``<folder>/<table>.csv``, one file or a folder of parts each.

    ``line_breaks`` says how the writer put them down: ``quoted`` ones are part of the
    text, at the price that a file is read by one task; ``escaped`` ones leave every
    line a record, and files of any size are split.
    """
    if line_breaks not in LINE_BREAKS:
        raise ValueError(f"line_breaks must be one of {', '.join(LINE_BREAKS)}")
    options = {
        **DIALECT,
        "encoding": "UTF-8",
        "multiLine": line_breaks == "quoted",
        "timestampFormat": timestamp_format,
        "timestampNTZFormat": LOCAL_STAR_TIMESTAMP,
    }

    def scan(name: str, schema: T.StructType) -> DataFrame:
        rows = _read(spark, f"{folder}/{name}.csv", schema, options)
        if line_breaks == "quoted":
            return rows
        texts = [f.name for f in schema if isinstance(f.dataType, T.StringType)]
        return rows.withColumns({c: unescaped(F.col(c)) for c in texts})

    return {name: scan(name, schema) for name, schema in schemas.items()}


def from_rows(spark: SparkSession, rows: Iterable[Mapping], schema: T.StructType) -> DataFrame:
    """In-memory records under an explicit schema; missing fields are null."""
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows, as a frame."""
    return df.limit(rows)
