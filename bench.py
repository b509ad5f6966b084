"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from starnorm.session import build_session  # noqa: E402
from starqueries.spark import QUERIES  # noqa: E402

RUNS = 3
HEADLINES = (
    "lines_per_product",
    "scan_csv",
    "sink_csv_roundtrip",
    "sink_parquet_roundtrip",
    "dropna_all",
    "last_activity_joinback",
    "dim_patient_status",
    "dense_key",
    "dim_natural_3col",
    "dim_natural_nullable",
    "dedupe_by_key",
    "dim_keyed",
    "fact_attach_keys",
    "fact_attach_keys_shuffled",
    "fact_build",
    "normalize_fk_suite",
    "fk_suite",
    "fk_orphans",
    "star_wide",
    "snowflake_chain",
    "column_profile",
    "approximate_profile",
    "scan_csv_malformed",
    "mart_gender",
    "mart_payment_share",
    "mart_visit_type",
    "mart_weekday_hour",
    "mart_year_clinic",
    "visits_fact",
    "visits_job",
    "visits_fk_suite",
    "worksheet_yearly_visits_by_clinic",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "starnorm-bench",
        spark__master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("lines_per_product")  # start the JVM's compilers before the clock
    times = {
        name: round(statistics.median(run(name) for _ in range(RUNS)), 3) for name in HEADLINES
    }
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
