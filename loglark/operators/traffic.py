"""The three traffic queries over parsed rows.

Each takes ``by``: extra leading group columns such as ``("batch_no",)``, which
gives the result of every batch in one job.

A summary has one row per key. Hosts are rows of their own, (key, host), in a second
result: a busy resource or hour can hold a third of all rows, so its hosts fit neither
one row nor one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP_K = 20


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition in which null keys meet, as they do in a grouping."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def is_error(status: Column) -> Column:
    """Client and server errors: status 400 to 599."""
    return status.between(400, 599)


def tag_errors(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("is_error", is_error(F.col("status_code")))


def daily_traffic(parsed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Requests and bytes per raw date text and status."""
    return parsed.groupBy(*by, "log_date", "status_code").agg(
        F.count(F.lit(1)).alias("request_count"), F.sum("bytes").alias("total_bytes")
    )


def resource_hosts(parsed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Requests and bytes of each host on each resource."""
    return (
        parsed.withColumnRenamed("resource", "resource_path")
        .groupBy(*by, "resource_path", "host")
        .agg(F.count(F.lit(1)).alias("request_count"), F.sum("bytes").alias("total_bytes"))
    )


def resource_totals(hosts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of ``resource_hosts`` summed per resource; a null host counts as no host."""
    return hosts.groupBy(*by, "resource_path").agg(
        F.sum("request_count").alias("request_count"),
        F.sum("total_bytes").alias("total_bytes"),
        F.count("host").alias("distinct_host_count"),
    )


def _first(totals: DataFrame, k: int, by: Sequence[str]) -> DataFrame:
    # The last key decides nothing. With it the ranking reads the columns that
    # `top_resource_hosts` returns, and both take the same shuffle.
    order = [F.desc("request_count"), F.desc("resource_path"), F.desc("total_bytes")]
    if not by:
        return totals.orderBy(*order).limit(k)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return totals.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def top_resources(parsed: DataFrame, k: int = TOP_K, by: Sequence[str] = ()) -> DataFrame:
    """The k most requested resources (of each ``by`` group), ties by resource descending.

    One row per resource with requests, bytes and distinct hosts, in no order; sort by
    request_count and resource_path descending to show them. One scan: rows are folded by
    host before the shuffle, so requests of a hot resource are spread over its hosts.
    """
    return _first(resource_totals(resource_hosts(parsed, by), by), k, by)


def top_resource_hosts(parsed: DataFrame, k: int = TOP_K, by: Sequence[str] = ()) -> DataFrame:
    """The hosts of the resources in ``top_resources``, each with its requests and bytes.

    The folded rows are shuffled once and read twice, to rank the resources and to keep the
    winners' rows. An inner join on unique keys is used because a semi join would be moved
    below the folding and end that reuse. A hot resource's share of the join is left to
    the skew handling of adaptive execution.
    """
    keys = [*by, "resource_path"]
    hosts = resource_hosts(parsed, by)
    winners = _first(resource_totals(hosts, by), k, by).select(F.struct(*keys).alias("w"))
    same = reduce(lambda a, b: a & b, (hosts[c].eqNullSafe(winners["w"][c]) for c in keys))
    return hosts.join(winners, same).select(*keys, "host", "request_count", "total_bytes")


def _hours(by: Sequence[str]) -> list[str]:
    return [*by, "log_date", "log_hour"]


def _hourly_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    failed, total = F.col("error_request_count"), F.col("total_request_count")
    rate = F.when(total == 0, F.lit(0.0)).otherwise(failed.cast("double") / total)
    return rows.select(
        *keys,
        "error_request_count",
        "total_request_count",
        rate.alias("error_rate"),
        "distinct_error_hosts",
    )


def hourly_errors(parsed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Errors, requests, rate and error hosts of every (date, hour), also error-free ones.

    One scan: error rows fold by host, all other requests of an hour into one row without
    a host, so that an hour is spread over its error hosts.
    """
    keys, error = _hours(by), is_error(F.col("status_code"))
    folded = parsed.groupBy(*keys, F.when(error, F.col("host")).alias("host")).agg(
        F.count_if(error).alias("errors"), F.count(F.lit(1)).alias("n")
    )
    hours = folded.groupBy(*keys).agg(
        F.sum("errors").alias("error_request_count"),
        F.sum("n").alias("total_request_count"),
        F.count("host").alias("distinct_error_hosts"),
    )
    return _hourly_rows(hours, keys)


def error_hosts(parsed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The hosts with errors in each (date, hour) and their errors."""
    errors = parsed.where(is_error(F.col("status_code")))
    return errors.groupBy(*_hours(by), "host").agg(F.count(F.lit(1)).alias("error_request_count"))


def hourly_errors_join(parsed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The rows of ``hourly_errors`` by the classic route: tag, total, then left-join the error hosts.

    Both sides of the join hold one row per hour.
    """
    keys = _hours(by)
    tagged = tag_errors(parsed)
    totals = tagged.groupBy(*keys).agg(
        F.sum(F.col("is_error").cast("int")).alias("error_request_count"),
        F.count(F.lit(1)).alias("total_request_count"),
    )
    failing = tagged.where("is_error").select(*keys, "host").distinct()
    hosts = failing.groupBy(*keys).agg(F.count("host").alias("_hosts"))
    joined = totals.join(hosts, same_keys(totals, hosts, keys), "left").select(
        *[totals[c] for c in totals.columns],
        F.coalesce("_hosts", F.lit(0).cast("bigint")).alias("distinct_error_hosts"),
    )
    return _hourly_rows(joined, keys)
