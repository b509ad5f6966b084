"""The same queries as SQL over the same tables."""

from __future__ import annotations

from starqueries.visits import VISIT_COLUMNS, WIDE

FLAT = """
flat AS (
  SELECT *,
    CASE WHEN l_returnflag <> 'N' THEN o_orderpriority END AS second_priority,
    CASE WHEN l_returnflag <> 'N' AND NOT (l_returnflag = 'A' AND l_linestatus = 'O')
         THEN o_orderstatus END AS second_status,
    CASE WHEN l_discount >= 0.05 THEN p_partkey END AS promo_key,
    CASE WHEN l_discount >= 0.05 THEN p_name END AS promo_name,
    CASE WHEN l_discount >= 0.05 THEN p_size END AS promo_size
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
)"""


def _numbered(source: str, keys: list[str], id_name: str, where: str = "true") -> str:
    """A natural dimension: distinct keys, numbered from 0 in key order, nulls first."""
    names = ", ".join(keys)
    order = ", ".join(f"{k} NULLS FIRST" for k in keys)
    return (
        f"SELECT row_number() OVER (ORDER BY {order}) - 1 AS {id_name}, {names} "
        f"FROM (SELECT DISTINCT {names} FROM {source} WHERE {where})"
    )


def _deduped(
    source: str, key: list[str], rest: list[str], where: str = "true", last: str = ""
) -> str:
    """One row per key: the first in the order of all other columns, nulls first."""
    names = ", ".join([*key, *rest])
    order = ", ".join(f"{c} NULLS FIRST" for c in rest)
    if last:
        order = ", ".join(f"{c} DESC NULLS LAST" for c in [last, *[r for r in rest if r != last]])
    return (
        f"SELECT {names} FROM (SELECT {names}, row_number() OVER "
        f"(PARTITION BY {', '.join(key)} ORDER BY {order}) AS rn FROM {source} WHERE {where}) "
        "WHERE rn = 1"
    )


ORDER_REST = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINE_REST = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]
LINES = ["l_orderkey", "l_linenumber", *LINE_REST]
CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
SECOND = ["second_priority", "second_status"]
SECOND_KNOWN = "second_priority IS NOT NULL OR second_status IS NOT NULL"
STATUS = (
    "CASE WHEN max(o_orderdate) <= TIMESTAMP '2001-07-20 00:00:00' "
    "THEN 'Inactive' ELSE 'Active' END AS customer_status"
)

STATUS_DIM = f"""
SELECT w.*, s.customer_status
FROM ({_deduped("flat", CUSTOMER[:1], CUSTOMER[1:])}) w
JOIN (SELECT c_custkey AS k, {STATUS} FROM flat GROUP BY c_custkey) s ON w.c_custkey = s.k"""

# The star of order lines, one CTE per table.
STAR = f"""{FLAT},
dim_customer AS ({STATUS_DIM}),
dim_order AS ({_deduped("flat", ["o_orderkey"], ORDER_REST)}),
dim_product AS ({_numbered("flat", ["p_brand", "p_type", "p_size"], "product_id")}),
dim_place AS ({_numbered("flat", ["n_name", "r_name"], "place_id")}),
dim_priority AS ({_numbered("flat", ["o_orderpriority", "o_orderstatus"], "priority_id")}),
dim_second AS ({_numbered("flat", SECOND, "second_priority_id", SECOND_KNOWN)}),
dim_return AS ({_numbered("flat", ["l_returnflag", "l_linestatus"], "return_id")}),
dim_promo AS ({_deduped("flat", ["promo_key"], ["promo_name", "promo_size"],
    "promo_key IS NOT NULL OR promo_name IS NOT NULL OR promo_size IS NOT NULL")}),
attached AS (
  SELECT * FROM flat
  LEFT JOIN dim_product USING (p_brand, p_type, p_size)
  LEFT JOIN dim_place USING (n_name, r_name)
  LEFT JOIN dim_priority USING (o_orderpriority, o_orderstatus)
  LEFT JOIN dim_second USING (second_priority, second_status)
  LEFT JOIN dim_return USING (l_returnflag, l_linestatus)
),
fact AS ({_deduped("attached", ["l_orderkey", "l_linenumber"], [
    "c_custkey", "product_id", "place_id", "priority_id", "second_priority_id",
    "return_id", "promo_key", "l_shipdate", "l_quantity"])})"""


def _counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {source}"
        for name, source in tables.items()
    )


def _fk(facts: str, fk: str, dim: str, key: str, name: str, nullable: bool) -> str:
    """One report row; rows without a partner, nulls among them unless nullable."""
    known = f" AND {fk} IS NOT NULL" if nullable else ""
    return f"""
SELECT '{name}' AS dim_name, '{fk}' AS fk_col, null_count, mismatch_count,
       mismatch_count = 0 AS passed
FROM (SELECT count(*) FILTER ({fk} IS NULL) AS null_count,
             count(*) FILTER (NOT known{known}) AS mismatch_count
      FROM (SELECT {fk}, EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = f.{fk}) AS known
            FROM {facts} f))"""


def _suite(edges: list[tuple[str, str, str, str, str, str, bool]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, * FROM ({_fk(facts, fk, dim, key, name, nullable)})"
        for table, facts, fk, name, dim, key, nullable in edges
    )


GRADED = """
facts AS (SELECT d.doc_id, l.doc_id AS label_id FROM documents d
          LEFT JOIN labels l ON d.doc_id = l.doc_id),
good AS (SELECT * FROM labels WHERE quality = 1)"""

PROFILED = [
    *CUSTOMER,
    "o_orderdate",
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderpriority",
    "p_brand",
    "p_type",
    "p_size",
    "n_name",
    "r_name",
    *SECOND,
    "l_returnflag",
    "l_linestatus",
    "promo_key",
    "promo_name",
    "promo_size",
    "l_orderkey",
    "l_linenumber",
    "l_shipdate",
    "l_quantity",
]

PAYMENT = """
SELECT o_orderstatus, count(l_partkey) AS n_visits
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus"""


def _attached(condition: str) -> str:
    return f"""
WITH {FLAT},
product AS ({_numbered("flat", ["p_brand", "p_type", "p_size"], "product_id")}),
second AS ({_numbered("flat", SECOND, "second_priority_id")})
SELECT l_orderkey, l_linenumber, product_id, second_priority_id
FROM flat f
LEFT JOIN product USING (p_brand, p_type, p_size)
LEFT JOIN second s ON {condition}"""


ORACLE: dict[str, str] = {
    "scan_csv": "SELECT * FROM orders",
    "scan_csv_reordered": "SELECT * FROM orders",
    "scan_csv_malformed": " UNION ALL ".join(
        f"SELECT {name} AS column_name, count(*) FILTER ({where}) AS n_malformed FROM orders"
        for name, where in {
            **{f"'{c}'": "false" for c in ["o_orderkey", *ORDER_REST]},
            "'o_totalprice'": "o_orderkey % 97 = 0",
            "'o_orderdate'": "o_orderkey % 89 = 0",
            "NULL": "false",
        }.items()
    ),
    "scan_csv_rejected": """
SELECT concat_ws(',', CASE WHEN o_orderkey % 97 = 0 THEN 'o_totalprice' END,
                 CASE WHEN o_orderkey % 89 = 0 THEN 'o_orderdate' END) AS malformed,
       count(*) AS n_rows
FROM orders GROUP BY 1""",
    "scan_csv_good": "SELECT * FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0",
    "csv_text_roundtrip": "SELECT doc_id, text FROM documents",
    "csv_text_roundtrip_escaped": "SELECT doc_id, text FROM documents",
    "scan_csv_inferred": "SELECT * FROM customer",
    "scan_star_csv": """
SELECT o_orderkey, o_orderdate, o_totalprice, c_name, n_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "sink_csv_roundtrip": "SELECT * FROM customer",
    "sink_csv_parts_roundtrip": "SELECT * FROM lineitem",
    "sink_parquet_roundtrip": "SELECT * FROM customer",
    "sink_both_roundtrip": """
SELECT *, 'csv' AS copy FROM customer UNION ALL SELECT *, 'parquet' AS copy FROM customer""",
    "project_dim": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "filter_eq": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
    "filter_fk_not_null": f"""
WITH {FLAT} SELECT l_orderkey, l_linenumber, promo_key FROM flat WHERE promo_key IS NOT NULL""",
    "fk_null_count": f"""
WITH {FLAT}
SELECT count(*) FILTER (promo_key IS NULL) AS promo_key_nulls,
       count(*) FILTER (second_priority IS NULL) AS second_priority_nulls,
       count(*) FILTER (second_status IS NULL) AS second_status_nulls
FROM flat""",
    "dropna_all": f"""
WITH {FLAT} SELECT second_priority, second_status FROM flat WHERE {SECOND_KNOWN}""",
    "last_activity": """
SELECT o_custkey, max(o_orderdate) AS last_activity FROM orders GROUP BY o_custkey""",
    "last_activity_joinback": """
SELECT o_orderkey, o_custkey, o_orderdate, last_activity
FROM orders
LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_activity FROM orders GROUP BY o_custkey)
USING (o_custkey)""",
    "patient_status": f"SELECT o_custkey, {STATUS} FROM orders GROUP BY o_custkey",
    "dim_patient_status": f"WITH {FLAT} {STATUS_DIM}",
    "distinct_natural_key": "SELECT DISTINCT p_brand, p_type, p_size FROM part",
    "dense_key": f"WITH {FLAT} " + _numbered("flat", ["promo_name", "second_priority"], "key_id"),
    "dim_natural_3col": _numbered("part", ["p_brand", "p_type", "p_size"], "product_id"),
    "dim_natural_2col": f"""
WITH places AS (
  SELECT n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey)
{_numbered("places", ["n_name", "r_name"], "place_id")}""",
    "dim_natural_nullable": f"WITH {FLAT} "
    + _numbered("flat", SECOND, "second_priority_id", SECOND_KNOWN),
    "dedupe_by_key": _deduped("lineitem", ["l_orderkey", "l_linenumber"], LINE_REST),
    "dedupe_keep_latest": _deduped(
        "orders",
        ["o_custkey"],
        ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
        last="o_orderdate",
    ),
    "dim_keyed": f"WITH {FLAT} " + _deduped("flat", ["o_orderkey"], ORDER_REST),
    "dim_keyed_nullable": f"WITH {FLAT} "
    + _deduped(
        "flat",
        ["promo_key"],
        ["promo_name", "second_priority"],
        "promo_key IS NOT NULL OR promo_name IS NOT NULL OR second_priority IS NOT NULL",
    ),
    "dim_keyed_strict": f"WITH {FLAT} "
    + _deduped(
        "flat", ["promo_key"], ["promo_name", "second_priority"], "promo_key IS NOT NULL"
    ),
    "fact_attach_keys": _attached(
        "f.second_priority = s.second_priority AND f.second_status = s.second_status"
    ),
    "fact_attach_keys_nullsafe": _attached(
        "f.second_priority IS NOT DISTINCT FROM s.second_priority "
        "AND f.second_status IS NOT DISTINCT FROM s.second_status"
    ),
    "fact_attach_keys_shuffled": f"""
WITH {FLAT},
dim AS ({_numbered("flat", [*SECOND, "p_type"], "key_id")})
SELECT l_orderkey, l_linenumber, key_id
FROM flat LEFT JOIN dim USING (second_priority, second_status, p_type)""",
    "fact_build": f"WITH {STAR} SELECT * FROM fact",
    "normalize_rowcounts": f"WITH {STAR} "
    + _counts(
        {
            "DimCustomer": "dim_customer",
            "DimOrder": "dim_order",
            "DimProduct": "dim_product",
            "DimPlace": "dim_place",
            "DimPriority": "dim_priority",
            "DimSecondPriority": "dim_second",
            "DimReturn": "dim_return",
            "DimPromo": "dim_promo",
            "FactLine": "fact",
        }
    ),
    "normalize_fk_suite": f"WITH {STAR} "
    + _suite(
        [
            ("FactLine", "fact", "l_orderkey", "DimOrder", "dim_order", "o_orderkey", False),
            ("FactLine", "fact", "c_custkey", "DimCustomer", "dim_customer", "c_custkey", False),
            ("FactLine", "fact", "product_id", "DimProduct", "dim_product", "product_id", False),
            ("FactLine", "fact", "place_id", "DimPlace", "dim_place", "place_id", False),
            ("FactLine", "fact", "priority_id", "DimPriority", "dim_priority", "priority_id",
             False),
            ("FactLine", "fact", "second_priority_id", "DimSecondPriority", "dim_second",
             "second_priority_id", True),
            ("FactLine", "fact", "return_id", "DimReturn", "dim_return", "return_id", False),
            ("FactLine", "fact", "promo_key", "DimPromo", "dim_promo", "promo_key", True),
            ("DimOrder", "dim_order", "o_custkey", "DimCustomer", "dim_customer", "c_custkey",
             False),
        ]
    ),
    "fk_orphans": """
SELECT * FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c_acctbal > 0)""",
    "fk_check_clean": _fk("lineitem", "l_orderkey", "orders", "o_orderkey", "orders", False),
    "fk_check_broken": f"WITH {GRADED} "
    + _fk("facts", "label_id", "good", "doc_id", "labels", False),
    "fk_check_nullable": f"WITH {GRADED} "
    + _fk("facts", "label_id", "good", "doc_id", "labels", True),
    "fk_suite": _suite(
        [
            ("lineitem", "lineitem", "l_orderkey", "orders", "orders", "o_orderkey", False),
            ("lineitem", "lineitem", "l_partkey", "part", "part", "p_partkey", False),
            ("lineitem", "lineitem", "l_suppkey", "supplier", "supplier", "s_suppkey", False),
            ("orders", "orders", "o_custkey", "customer", "customer", "c_custkey", False),
            ("customer", "customer", "c_nationkey", "nation", "nation", "n_nationkey", False),
            ("supplier", "supplier", "s_nationkey", "nation", "nation", "n_nationkey", False),
            ("nation", "nation", "n_regionkey", "region", "region", "r_regionkey", False),
            ("events", "events", "user_id", "customer", "customer", "c_custkey", False),
        ]
    ),
    "star_wide": f"""
WITH {FLAT}
SELECT l_orderkey, l_linenumber, l_quantity, o_orderstatus, c_mktsegment, p_brand, s_name
FROM flat""",
    "snowflake_chain": f"""
WITH {FLAT} SELECT l_orderkey, l_linenumber, c_name, n_name, r_name FROM flat""",
    "row_counts": _counts(
        {
            t: t
            for t in (
                "region",
                "nation",
                "customer",
                "supplier",
                "part",
                "orders",
                "lineitem",
                "events",
            )
        }
    ),
    "column_profile": f"WITH {FLAT} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, "
        f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_distinct, "
        f"count(*) FILTER ({c} IS NULL) AS n_null FROM flat"
        for c in PROFILED
    ),
    "approximate_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(DISTINCT {c}) "
        f"+ max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_distinct, "
        f"count(*) FILTER ({c} IS NULL) AS n_null, true AS within FROM lineitem"
        for c in LINES
    ),
    "mart_users_rolled_up": """
SELECT event_type, count(user_id) AS n_events, count(DISTINCT user_id) AS n_users, true AS within
FROM events GROUP BY event_type""",
    "mart_gender": """
SELECT c_mktsegment, count(o_custkey) AS n_visits, count(DISTINCT o_custkey) AS n_patients
FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
    "mart_payment_status": PAYMENT,
    "mart_payment_share": f"""
SELECT o_orderstatus, n_visits, n_visits / sum(n_visits) OVER () AS share FROM ({PAYMENT})""",
    "mart_visit_type": """
SELECT event_type, count(user_id) AS n_visits FROM events GROUP BY event_type""",
    "mart_weekday_hour": """
SELECT dayofweek(ts) + 1 AS weekday_no, dayname(ts) AS weekday, hour(ts) AS hour,
       count(event_id) AS n_visits
FROM events GROUP BY ALL""",
    "mart_year_clinic": """
SELECT year(o_orderdate) AS year, c_mktsegment, count(o_orderkey) AS n_visits,
       count(DISTINCT o_custkey) AS n_patients
FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
    "mart_year_status_parts": """
SELECT year(l_shipdate) AS year, o_orderstatus, count(l_linenumber) AS n_lines,
       count(DISTINCT l_partkey) AS n_parts
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
    "lines_per_product": f"""
WITH {FLAT},
product AS ({_numbered("part", ["p_brand", "p_type", "p_size"], "product_id")})
SELECT product_id, p_brand, p_type, p_size, count(l_orderkey) AS n_lines
FROM flat LEFT JOIN product USING (p_brand, p_type, p_size) GROUP BY ALL""",
}


# The clinic-visit star

PATIENT = [c for c in VISIT_COLUMNS if c.startswith("patient_")]
INSURANCE = [c for c in VISIT_COLUMNS if c.startswith("insurance_")]
BILLING = [c for c in VISIT_COLUMNS if c.startswith("billing_")]
PRESCRIPTION = [c for c in VISIT_COLUMNS if c.startswith("prescription_")]
LAB = [c for c in VISIT_COLUMNS if c.startswith("lab_")]
FACT = [
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
]
SECONDARY = ["secondary_diagnosis_code", "secondary_diagnosis_desc"]


def _some(columns: list[str]) -> str:
    return " OR ".join(f"{c} IS NOT NULL" for c in columns)


VISIT_DIMS = {
    "dim_patient": f"""
SELECT w.*, coalesce(s.patient_status, 'Active') AS patient_status
FROM ({_deduped("visits", PATIENT[:1], PATIENT[1:])}) w
LEFT JOIN (SELECT patient_id AS k,
                  CASE WHEN max(visit_datetime) <= TIMESTAMP '2021-12-31 00:00:00'
                       THEN 'Inactive' ELSE 'Active' END AS patient_status
           FROM visits GROUP BY patient_id) s ON w.patient_id = s.k""",
    "dim_insurance": _deduped("visits", INSURANCE[:1], ["patient_id", *INSURANCE[1:]]),
    "dim_billing": _deduped("visits", BILLING[:1], ["insurance_id", *BILLING[1:]]),
    "dim_provider": _numbered(
        "visits", ["doctor_name", "doctor_title", "doctor_department"], "provider_id"
    ),
    "dim_location": _numbered("visits", ["clinic_name", "room_number"], "location_id"),
    "dim_primary_diagnosis": _numbered(
        "visits", ["primary_diagnosis_code", "primary_diagnosis_desc"], "primary_diagnosis_id"
    ),
    "dim_secondary_diagnosis": _numbered(
        "visits", SECONDARY, "secondary_diagnosis_id", _some(SECONDARY)
    ),
    "dim_treatment": _numbered("visits", ["treatment_code", "treatment_desc"], "treatment_id"),
    "dim_prescription": _deduped(
        "visits", PRESCRIPTION[:1], PRESCRIPTION[1:], _some(PRESCRIPTION)
    ),
    "dim_lab_order": _deduped("visits", LAB[:1], LAB[1:], _some(LAB)),
}
VISITS = (
    f"{FLAT},\nvisits AS (SELECT "
    + ", ".join(f"{how} AS {name}" for name, how in VISIT_COLUMNS.items())
    + " FROM flat)"
)
VISIT_STAR = (
    VISITS
    + "".join(f",\n{name} AS ({sql})" for name, sql in VISIT_DIMS.items())
    + f""",
attached AS (
  SELECT * FROM visits
  LEFT JOIN dim_provider USING (doctor_name, doctor_title, doctor_department)
  LEFT JOIN dim_location USING (clinic_name, room_number)
  LEFT JOIN dim_primary_diagnosis USING (primary_diagnosis_code, primary_diagnosis_desc)
  LEFT JOIN dim_secondary_diagnosis USING (secondary_diagnosis_code, secondary_diagnosis_desc)
  LEFT JOIN dim_treatment USING (treatment_code, treatment_desc)
),
fact_visit AS ({_deduped("attached", ["visit_id"], FACT)})"""
)

TABLE_OF = {
    "DimPatient": "dim_patient",
    "DimInsurance": "dim_insurance",
    "DimBilling": "dim_billing",
    "DimProvider": "dim_provider",
    "DimLocation": "dim_location",
    "DimPrimaryDiagnosis": "dim_primary_diagnosis",
    "DimSecondaryDiagnosis": "dim_secondary_diagnosis",
    "DimTreatment": "dim_treatment",
    "DimPrescription": "dim_prescription",
    "DimLabOrder": "dim_lab_order",
    "FactVisit": "fact_visit",
}
KEY_OF = {
    "DimPatient": "patient_id",
    "DimInsurance": "insurance_id",
    "DimBilling": "billing_id",
    "DimProvider": "provider_id",
    "DimLocation": "location_id",
    "DimTreatment": "treatment_id",
    "DimPrimaryDiagnosis": "primary_diagnosis_id",
    "DimSecondaryDiagnosis": "secondary_diagnosis_id",
    "DimPrescription": "prescription_id",
    "DimLabOrder": "lab_order_id",
}
OPTIONAL = {"DimSecondaryDiagnosis", "DimPrescription", "DimLabOrder"}
VISIT_SUITE = f"WITH {VISIT_STAR} " + _suite(
    [
        ("FactVisit", "fact_visit", key, dim, TABLE_OF[dim], key, dim in OPTIONAL)
        for dim, key in KEY_OF.items()
    ]
    + [
        ("DimInsurance", "dim_insurance", "patient_id", "DimPatient", "dim_patient",
         "patient_id", False),
        ("DimBilling", "dim_billing", "insurance_id", "DimInsurance", "dim_insurance",
         "insurance_id", False),
    ]
)
COLUMNS_OF = {
    "DimPatient": [*PATIENT, "patient_status"],
    "DimInsurance": ["patient_id", *INSURANCE],
    "DimBilling": ["insurance_id", *BILLING],
    "DimProvider": ["provider_id", "doctor_name", "doctor_title", "doctor_department"],
    "DimLocation": ["location_id", "clinic_name", "room_number"],
    "DimPrimaryDiagnosis": [
        "primary_diagnosis_id", "primary_diagnosis_code", "primary_diagnosis_desc"
    ],
    "DimSecondaryDiagnosis": ["secondary_diagnosis_id", *SECONDARY],
    "DimTreatment": ["treatment_id", "treatment_code", "treatment_desc"],
    "DimPrescription": PRESCRIPTION,
    "DimLabOrder": LAB,
    "FactVisit": ["visit_id", *FACT],
}


def _profiled(column: str, table: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, count(DISTINCT {column}) "
        f"+ coalesce(max(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END), 0) AS n_distinct, "
        f"count(*) FILTER ({column} IS NULL) AS n_null FROM {table}"
    )


VISIT_PROFILE = f"WITH {VISIT_STAR} " + " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, * FROM ({_profiled(c, TABLE_OF[name])})"
    for name, columns in COLUMNS_OF.items()
    for c in columns
)
VISIT_JOINS = """
FROM fact_visit f
LEFT JOIN dim_billing b ON f.billing_id = b.billing_id
LEFT JOIN dim_insurance i ON b.insurance_id = i.insurance_id
LEFT JOIN dim_lab_order l ON f.lab_order_id = l.lab_order_id
LEFT JOIN dim_location lo ON f.location_id = lo.location_id
LEFT JOIN dim_patient p ON f.patient_id = p.patient_id
LEFT JOIN dim_prescription rx ON f.prescription_id = rx.prescription_id
LEFT JOIN dim_primary_diagnosis d1 ON f.primary_diagnosis_id = d1.primary_diagnosis_id
LEFT JOIN dim_provider dr ON f.provider_id = dr.provider_id
LEFT JOIN dim_secondary_diagnosis d2 ON f.secondary_diagnosis_id = d2.secondary_diagnosis_id
LEFT JOIN dim_treatment t ON f.treatment_id = t.treatment_id"""

ORACLE |= {f"visits_{name}": f"WITH {VISITS} {sql}" for name, sql in VISIT_DIMS.items()}
ORACLE |= {
    "visits_fact": f"WITH {VISIT_STAR} SELECT * FROM fact_visit",
    "visits_row_counts": f"WITH {VISIT_STAR} " + _counts(TABLE_OF),
    "visits_fk_suite": VISIT_SUITE,
    "visits_job": VISIT_SUITE,
    "visits_wide": f"WITH {VISIT_STAR} SELECT {', '.join(WIDE)} {VISIT_JOINS}",
    "visits_profile": f"WITH {VISIT_STAR} "
    + " UNION ALL ".join(_profiled(c, "fact_visit") for c in ["visit_id", *FACT]),
    "visits_star_profile": VISIT_PROFILE,
    "visits_job_fact_csv": f"WITH {VISIT_STAR} SELECT * FROM fact_visit",
    "visits_job_inferred_fact": f"WITH {VISIT_STAR} SELECT * FROM fact_visit",
    "visits_job_escaped_csv": f"WITH {VISIT_STAR} SELECT * FROM dim_billing",
    "visits_job_profile_parquet": VISIT_PROFILE,
    "worksheet_patients_by_gender": f"""
WITH {VISIT_STAR}
SELECT patient_gender, count(f.patient_id) AS n_visits,
       count(DISTINCT f.patient_id) AS n_patients
FROM fact_visit f LEFT JOIN dim_patient p ON f.patient_id = p.patient_id
GROUP BY patient_gender""",
    "worksheet_payment_status_distribution": f"""
WITH {VISIT_STAR}
SELECT billing_payment_status, n_visits, n_visits / sum(n_visits) OVER () AS share
FROM (SELECT billing_payment_status, count(patient_id) AS n_visits
      FROM fact_visit f LEFT JOIN dim_billing b ON f.billing_id = b.billing_id
      GROUP BY billing_payment_status)""",
    "worksheet_visit_type_distribution": f"""
WITH {VISIT_STAR}
SELECT visit_type, n_visits, n_visits / sum(n_visits) OVER () AS share
FROM (SELECT visit_type, count(patient_id) AS n_visits FROM fact_visit GROUP BY visit_type)""",
    "worksheet_visits_by_weekday_and_hour": f"""
WITH {VISIT_STAR}
SELECT dayofweek(visit_datetime) + 1 AS weekday_no, dayname(visit_datetime) AS weekday,
       hour(visit_datetime) AS hour, count(visit_id) AS n_visits
FROM fact_visit GROUP BY ALL""",
    "worksheet_yearly_visits_by_clinic": f"""
WITH {VISIT_STAR}
SELECT year(visit_datetime) AS year, clinic_name, count(visit_id) AS n_visits,
       count(DISTINCT patient_id) AS n_patients
FROM fact_visit f LEFT JOIN dim_location l ON f.location_id = l.location_id
GROUP BY ALL""",
}
