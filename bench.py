"""Time the headline queries and print one JSON line.

Every query runs twice into the no-op sink, which computes all rows and
keeps none; the faster run counts, so JVM warm-up does not. Queries that
write tables are timed with their writes.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sportmart.plans.catalogue import QUERIES  # noqa: E402
from sportmart.session import build_session, remove_shared  # noqa: E402

HEADLINE = [
    "stat_pivot_sum", "stat_pivot_fixed_upper", "stat_pivot_wide", "nested_roundtrip", "explode_nested_path",
    "stack_columns", "match_objects_to_rows", "kickoff_local", "clock_minutes_of_play", "academic_years",
    "dim_country", "dim_player", "dim_award", "dim_match", "fct_club_stat", "fct_player_stat", "fct_object_award",
    "fct_match_stat", "union_deduplicated", "upsert_default", "upsert_latest", "upsert_award_bridge",
    "dq_raw_suite", "link_codes_of_pages", "pages_flatten", "table_upsert_partitions",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "sportmart-bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: round(min(seconds(spark, name, sf_dir) for _ in range(2)), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    remove_shared(spark)
    spark.stop()


if __name__ == "__main__":
    main()
