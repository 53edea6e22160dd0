"""Runs the operators on enlarged, skewed copies of the test tables and shows how they hold.

    python scale.py [copies ...]

Each copy of ``lineitem`` gets order keys of its own and shares its parts and suppliers. A third of
all rows goes to one supplier and a ninth has no supplier. ``own pairs`` counts by order key, so
that nearly every row is a pair of ids of its own and most have no label.

For each operator the script prints the seconds at each size and, from Spark's event log, the
longest task and the most shuffle data one task read: a hot key that is not split shows there.
"""

from __future__ import annotations

import json
import statistics
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tierwell import (  # noqa: E402
    Dimension,
    absent_rows,
    assign_batches,
    batch_counts,
    first_per_key,
    groups_above_mean,
    new_shared_path,
    number_rows,
    number_table_rows,
    quarterly_counts,
    session,
)

TABLES = "/root/testdata/sf0.1"
SHIPPED = {"ts": "l_shipdate", "department_id": "l_suppkey", "year": 1997}


def enlarged(spark, copies: int):
    rows = spark.read.parquet(f"{TABLES}/lineitem.parquet")
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"]
    spread = rows.repartition(32).select(*columns, "l_shipdate", copy)
    draw = F.pmod(F.xxhash64("l_orderkey", "l_partkey", "copy"), F.lit(9))
    path = new_shared_path(spark, f"lineitem-{copies}")
    spread.select(
        (F.col("l_orderkey") * copies + F.col("copy")).alias("l_orderkey"),
        "l_linenumber",
        "l_partkey",
        F.when(draw < 3, 1).when(draw > 3, F.col("l_suppkey")).alias("l_suppkey"),
        "l_returnflag",
        "l_shipdate",
    ).write.parquet(path)
    return path


def operators(spark, path):
    def fact():
        return spark.read.parquet(path)

    supplier = Dimension(spark.read.parquet(f"{TABLES}/supplier.parquet"), "s_suppkey", "s_name")
    part = Dimension(spark.read.parquet(f"{TABLES}/part.parquet"), "p_partkey", "p_brand")
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    known = fact().filter("l_returnflag = 'A'")
    return {
        "quarterly_counts": lambda: quarterly_counts(
            fact(), supplier, part, job_id="l_partkey", **SHIPPED
        ),
        "quarterly_counts, own pairs": lambda: quarterly_counts(
            fact(), supplier, part, job_id="l_orderkey", **SHIPPED
        ),
        "groups_above_mean": lambda: groups_above_mean(
            fact(), supplier, row_id="l_orderkey", **SHIPPED
        ),
        "first_per_key, hot key": lambda: first_per_key(fact(), ["l_suppkey"], order),
        "absent_rows, hot key, keep": lambda: absent_rows(
            fact().filter("l_returnflag <> 'A'"),
            known.filter("l_suppkey > 1"),
            ["l_suppkey"],
        ),
        "absent_rows, own keys, first": lambda: absent_rows(
            fact(),
            known,
            ["l_orderkey", "l_linenumber"],
            null_keys="reject",
            source_duplicates="first",
            order_by=order,
        ),
        "absent_rows, small source": lambda: absent_rows(
            spark.read.parquet(f"{TABLES}/orders.parquet"),
            fact().select(F.col("l_orderkey").alias("o_orderkey")),
            ["o_orderkey"],
            null_keys="reject",
        ),
        "number_table_rows": lambda: batch_counts(assign_batches(number_table_rows(fact()), 1000)),
        "number_rows, hot value": lambda: batch_counts(
            assign_batches(number_rows(fact().select("l_suppkey"), ["l_suppkey"]), 1000)
        ),
    }


def task_facts(log: str, name: str) -> tuple[float, float]:
    """Longest task and largest shuffle read (MB) of the jobs that ran under ``name``."""
    stages, tasks = {}, defaultdict(list)
    for file in Path(log).rglob("*"):
        if not file.is_file():
            continue
        for line in file.open(errors="replace"):
            if '"SparkListenerStageSubmitted"' in line:
                event = json.loads(line)
                group = event.get("Properties", {}).get("spark.job.description")
                stages[event["Stage Info"]["Stage ID"]] = group
            elif '"SparkListenerTaskEnd"' in line:
                event = json.loads(line)
                info, metrics = event["Task Info"], event.get("Task Metrics") or {}
                read = metrics.get("Shuffle Read Metrics", {})
                size = read.get("Remote Bytes Read", 0) + read.get("Local Bytes Read", 0)
                tasks[event["Stage ID"]].append((info["Finish Time"] - info["Launch Time"], size))
    mine = [t for stage, group in stages.items() if group == name for t in tasks[stage]]
    return max(t[0] for t in mine) / 1000, max(t[1] for t in mine) / 2**20


def main() -> None:
    sizes = [int(a) for a in sys.argv[1:]] or [1, 10, 40]
    log = tempfile.mkdtemp(prefix="run-events-")
    spark = session(
        "scale",
        "local[8]",
        spark_sql_shuffle_partitions="64",
        spark_driver_memory="12g",
        spark_sql_autoBroadcastJoinThreshold="-1",
        spark_ui_showConsoleProgress="false",
        spark_eventLog_enabled="true",
        spark_eventLog_compress="false",
        spark_eventLog_rolling_enabled="false",
        spark_eventLog_dir=f"file://{log}",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for copies in sizes:
        path = enlarged(spark, copies)
        rows = spark.read.parquet(path).count()
        for name, build in operators(spark, path).items():
            times = []
            for _ in range(2):
                spark.sparkContext.setJobDescription(f"{name}/{copies}")
                start = time.perf_counter()
                build().write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - start)
            seconds[(name, copies)] = (rows, statistics.median(times))
    spark.stop()
    print(f"{'operator':32}{'rows':>12}{'seconds':>9}{'longest task':>14}{'max read MB':>13}")
    for (name, copies), (rows, taken) in sorted(seconds.items()):
        longest, read = task_facts(log, f"{name}/{copies}")
        print(f"{name:32}{rows:>12,}{taken:>9.1f}{longest:>14.1f}{read:>13.1f}")


if __name__ == "__main__":
    main()
