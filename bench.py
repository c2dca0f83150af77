"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local cores. Each query is
built and run to the end (all rows, no output). One untimed run warms up the JVM first.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from parceltrail.queries import QUERIES  # noqa: E402
from parceltrail.session import build_session  # noqa: E402

HEADLINE = [
    "silver_orders",
    "silver_items",
    "silver_products",
    "gold_fact",
    "gold_dim_date",
    "kpi_sla",
    "kpi_late_by_region",
    "kpi_late_by_category",
    "kpi_late_by_seller",
    "kpi_late_grouping_sets",
    "kpi_avg_delay_category",
    "kpi_seller_ranking",
    "kpi_top_offenders",
    "kpi_late_by_month",
    "kpi_delay_by_volume",
    "initcap_documents",
    "csv_quoted_text",
    "json_records_inline",
    "layers_end_to_end",
]


def run(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, sf_dir, "kpi_late_by_category")
    seconds = {name: round(run(spark, sf_dir, name), 3) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
