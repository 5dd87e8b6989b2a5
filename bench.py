"""Wall-clock of the headline queries; prints one JSON line.

BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_COPIES   repeat the log lines this many times (default 1)
BENCH_ONLY     comma-separated query names (default all below)

The log is parsed once (``ingest``) and queried as a table; ``..._from_raw`` parse inside
the query instead. Every query runs twice and the second time counts.
"""

from __future__ import annotations

import json
import os
import time

import pyspark
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import QUERIES
from loglark.functions.parsing import parse_logs, valid_logs
from loglark.operators import merge, traffic
from loglark.session import configure, new_folder
from loglark.sources.tables import read_parsed, write_parsed
from loglark.sources.text import read_raw

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "1"))
ONLY = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
BATCH = ("batch_no",)

REPORTS = [
    "assign_batches",
    "latest_runs",
    "run_totals",
    "run_history_json",
    "data_quality",
    "cross_engine_timing",
    "run_comparison",
    "batch_size_avg_time",
    "batch_comparison",
    "integrity_scorecard",
    "stream_batches",
    "stream_hourly_errors",
]


def copied_log(spark: SparkSession) -> str:
    """The log lines as text files, repeated, each copy with later event ids."""
    events = fx.table(spark, SF_DIR, "events")
    if COPIES > 1:
        copy = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
        later = F.col("event_id") + F.col("copy") * 15_000_000
        events = events.withColumn("copy", copy).withColumn("event_id", later)
        events = events.repartition(4 * int(CPUS))
    path = new_folder(spark, "lines")
    fx.lines_of(events).select("value").write.text(path)
    return path


def main() -> None:
    spark = (
        configure(SparkSession.builder.master(f"local[{CPUS}]"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    text = copied_log(spark)
    n_lines = read_raw(spark, text).count()

    def lines():
        # Batches of equal size by a hash of the line: the bench needs some batch column,
        # not the numbering, which `assign_batches` measures.
        batch = F.pmod(F.xxhash64("value"), F.lit(max(1, n_lines // 2500))) + 1
        return read_raw(spark, text).withColumn("batch_no", batch.cast("int"))

    table = new_folder(spark, "parsed")

    def parsed():
        return read_parsed(spark, table)

    jobs = {
        "ingest": lambda: write_parsed(parse_logs(lines()), table),
        "daily_traffic": lambda: traffic.daily_traffic(parsed()),
        "top_resources": lambda: traffic.top_resources(parsed()),
        "hourly_errors": lambda: traffic.hourly_errors(parsed()),
        "hourly_errors_join": lambda: traffic.hourly_errors_join(parsed()),
        "daily_traffic_by_batch": lambda: traffic.daily_traffic(parsed(), BATCH),
        "top_resources_by_batch": lambda: traffic.top_resources(parsed(), by=BATCH),
        "hourly_errors_by_batch": lambda: traffic.hourly_errors(parsed(), BATCH),
        "top_resource_hosts": lambda: traffic.top_resource_hosts(parsed()),
        "top_resource_hosts_by_batch": lambda: traffic.top_resource_hosts(parsed(), by=BATCH),
        "error_hosts": lambda: traffic.error_hosts(parsed()),
        "error_hosts_by_batch": lambda: traffic.error_hosts(parsed(), BATCH),
        "merged_hourly_errors": lambda: merge.merge_hours(
            traffic.hourly_errors(parsed(), BATCH), traffic.error_hosts(parsed(), BATCH)
        ),
        "daily_traffic_from_raw": lambda: traffic.daily_traffic(valid_logs(lines())),
        "top_resources_from_raw": lambda: traffic.top_resources(valid_logs(lines())),
        "hourly_errors_from_raw": lambda: traffic.hourly_errors(valid_logs(lines())),
    }
    if COPIES == 1:
        jobs.update({name: lambda q=QUERIES[name]: q(spark, SF_DIR) for name in REPORTS})

    seconds = {}
    for name, job in jobs.items():
        if ONLY and name not in ONLY and name != "ingest":
            continue
        for _ in range(2):
            start = time.monotonic()
            df = job()
            if df is not None:
                df.write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.monotonic() - start, 3)

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR,
                "lines": n_lines,
                "lines_per_second_ingest": round(n_lines / seconds["ingest"]),
                "cpus": int(CPUS),
                "shuffle_partitions": int(CPUS),
                "spark": pyspark.__version__,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
