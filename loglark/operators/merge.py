"""Merging per-batch result rows into one result per run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_daily(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum requests and bytes over batches by date and status."""
    return daily.groupBy(*by, "log_date", "status_code").agg(
        F.sum("request_count").alias("request_count"), F.sum("total_bytes").alias("total_bytes")
    )


def _merge(
    rows: DataFrame, hosts: DataFrame, keys: Sequence[str], sums: Sequence[str], name: str
) -> DataFrame:
    # Hosts are made distinct by (key, host), which spreads a hot key, and counted before
    # they meet the sums. One grouping instead of a join keeps null keys.
    counted = hosts.select(*keys, "host").distinct().groupBy(*keys).agg(F.count("host").alias(name))
    both = rows.select(*keys, *sums, F.lit(0).cast("bigint").alias(name)).unionByName(
        counted, allowMissingColumns=True
    )
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (*sums, name)])


def merge_resources(top: DataFrame, hosts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum per-batch top rows by resource; distinct hosts over all batches, from their host rows.

    The input holds each batch's own top list, so a resource that misses the cut in
    some batch counts only where it made it. The true top list of a whole dataset is
    ``top_resources`` without ``by``.
    """
    return _merge(
        top,
        hosts,
        [*by, "resource_path"],
        ["request_count", "total_bytes"],
        "distinct_host_count",
    )


def merge_hours(hours: DataFrame, hosts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum errors and requests by date and hour; distinct error hosts from the host rows."""
    return _merge(
        hours,
        hosts,
        [*by, "log_date", "log_hour"],
        ["error_request_count", "total_request_count"],
        "distinct_error_hosts",
    )
