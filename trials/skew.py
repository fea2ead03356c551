"""How evenly the plans work on a skewed copy of the test tables.

    python trials/skew.py SCRATCH_FOLDER [QUERY...]

Makes a copy 20 times as large with a third of all rows under one club, one match, one customer and one user, runs
queries over it with broadcast joins off, and prints per query its time and, of stages over a second, the
worst ratio of the slowest task to the median and of the largest shuffle read to the median, and what was spilled.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import time
from collections import defaultdict
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sportmart.plans.catalogue import QUERIES  # noqa: E402
from sportmart.session import build_session, remove_shared  # noqa: E402

SOURCE, TIMES = "/root/testdata/sf0.1", 20
NAMES = [
    "stat_pivot_sum", "stat_pivot_wide", "dim_player", "dim_manager", "fct_club_stat", "fct_player_stat",
    "fct_object_award", "fct_match_stat", "upsert_default", "upsert_latest", "upsert_player_fact",
    "table_upsert_partitions",
]
#: Per table its key columns: the first is made new in every copy, the others point at row 1 in a third of all rows.
KEYS = {
    "lineitem": (None, ["l_suppkey", "l_orderkey"]), "events": ("event_id", ["user_id"]),
    "orders": ("o_orderkey", ["o_custkey"]), "customer": ("c_custkey", []), "supplier": ("s_suppkey", []),
}


def copy(spark, folder: str) -> None:
    for table, (own, pointing) in KEYS.items():
        df = spark.read.parquet(f"{SOURCE}/{table}.parquet")
        top = df.selectExpr(f"max({own or pointing[1]})").first()[0]
        columns = [
            f"`{c}` + copy * {top + 1} AS `{c}`" if c == own
            else f"IF(pmod(xxhash64(*), 3) = 0, 1, `{c}` + copy * {top + 1}) AS `{c}`" if c in pointing
            else f"`{c}`"
            for c in df.columns
        ]
        many = df.crossJoin(spark.range(TIMES).selectExpr("id AS copy")).repartition(32)
        many.selectExpr(*columns).write.mode("errorifexists").parquet(f"{folder}/{table}.parquet")
    for path in glob.glob(f"{SOURCE}/*.parquet"):
        if not os.path.exists(f"{folder}/{os.path.basename(path)}"):
            os.symlink(path, f"{folder}/{os.path.basename(path)}")


def stages(log: str) -> dict[int, list[tuple[float, float, float]]]:
    """Per stage (seconds, MB read from shuffles, MB spilled) of its tasks."""
    out = defaultdict(list)
    for line in open(log):
        event = json.loads(line)
        if event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
            m = event["Task Metrics"]
            read = m["Shuffle Read Metrics"]
            mb = (read["Remote Bytes Read"] + read["Local Bytes Read"]) / 1e6
            out[event["Stage ID"]].append((m["Executor Run Time"] / 1000, mb, m["Disk Bytes Spilled"] / 1e6))
    return out


def main() -> None:
    folder, names = sys.argv[1], sys.argv[2:] or NAMES
    data = f"{folder}/skewed"
    for made in ("events", "shared"):
        os.makedirs(f"{folder}/{made}", exist_ok=True)
    spark = build_session(
        "skew", master="local[8]", spark__driver__memory="12g", spark__driver__host="127.0.0.1",
        spark__sql__shuffle__partitions="64", spark__sql__autoBroadcastJoinThreshold="-1",
        spark__checkpoint__dir=f"{folder}/shared", spark__local__dir=f"{folder}/local",
        spark__eventLog__enabled="true", spark__eventLog__dir=f"file://{folder}/events",
        spark__eventLog__rolling__enabled="false", spark__eventLog__compress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not os.path.isdir(data):
        copy(spark, data)
    (log,) = [p for p in glob.glob(f"{folder}/events/*") if spark.sparkContext.applicationId in p]
    print("query | s | slowest / median task | largest / median shuffle read | MB spilled")
    for name in names:
        before = set(stages(log))
        start = time.perf_counter()
        QUERIES[name](spark, data).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
        time.sleep(1)
        slow = large = spilled = 0.0
        for stage, tasks in stages(log).items():
            if stage in before or len(tasks) < 2:
                continue
            took, read = [t[0] for t in tasks], [t[1] for t in tasks]
            spilled += sum(t[2] for t in tasks)
            if max(took) > 1:
                slow = max(slow, max(took) / max(median(took), 0.25))
                large = max(large, max(read) / max(median(read), 1))
        print(f"{name} | {seconds:.1f} | {slow:.1f} | {large:.1f} | {spilled:.0f}", flush=True)
        remove_shared(spark)
    spark.stop()


if __name__ == "__main__":
    main()
