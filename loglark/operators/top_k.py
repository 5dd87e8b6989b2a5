"""The top resources in rounds, so that only what can reach the list is summed and counted.

`traffic.top_resources` folds by (resource, host) in one scan, which sends a row for each such
pair of every resource. Here resources first meet as totals of a fixed number of hash buckets.
A bucket's total bounds the count of every resource in it; the exact counts of the resources
in the largest buckets give a count that the list's last entry has at least. Buckets below it
hold no entry, and hosts are counted for the winners alone. It takes three scans of the
resource column and one of resource and host, each with a small shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglark.operators.traffic import TOP_K, _first, same_keys
from loglark.session import staged

#: Hash buckets of each group. Their totals are all that the first round shuffles.
BUCKETS = 4096


def _bucketed(parsed: DataFrame, buckets: int) -> DataFrame:
    bucket = F.pmod(F.xxhash64("resource"), F.lit(buckets)).cast("int")
    return parsed.withColumn("_bucket", bucket).withColumnRenamed("resource", "resource_path")


def _of(rows: DataFrame, chosen: DataFrame, keys: Sequence[str], bounded: bool) -> DataFrame:
    """Rows whose keys are among ``chosen``; one side of a fixed size is broadcast."""
    chosen = chosen.select(*keys)
    return rows.join(F.broadcast(chosen) if bounded else chosen, same_keys(rows, chosen, keys), "left_semi")


def _ranked(rows: DataFrame, by: Sequence[str], order: str, k: int) -> DataFrame:
    """The k rows of each group with the largest ``order``."""
    if not by:
        return rows.orderBy(F.desc(order)).limit(k)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(order)))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def reachable_buckets(rows: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    """The buckets (of each ``by`` group) that can hold one of its k most requested resources.

    ``rows`` have ``resource_path`` and ``_bucket``. A written table of (by, _bucket, n).
    """
    keys, bounded = [*by, "_bucket"], not by
    totals = staged(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "bucket-totals")
    largest = _ranked(totals, by, "n", k)
    counts = _of(rows, largest, keys, bounded).groupBy(*by, "resource_path").agg(F.count(F.lit(1)).alias("n"))
    # Fewer than k resources in the k largest buckets: there are no other buckets.
    least = _ranked(counts, by, "n", k).groupBy(*by).agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("found"))
    bound = F.when(F.col("found") >= k, F.col("least")).otherwise(0)
    if not by:
        found = least.first()  # one row
        return staged(totals.where(F.col("n") >= (found.least if found.found >= k else 0)), "reachable")
    kept = totals.join(least, same_keys(totals, least, by)).where(totals["n"] >= bound)
    return staged(kept.select(*[totals[c] for c in (*keys, "n")]), "reachable")


def top_resources_in_rounds(
    parsed: DataFrame, k: int = TOP_K, by: Sequence[str] = (), buckets: int = BUCKETS
) -> DataFrame:
    """The rows of ``traffic.top_resources``, for logs of very many resources and hosts.

    What is shuffled: bucket totals, counts of resources in buckets that can reach the list, and
    (resource, host) pairs of the winners. ``parsed`` is read four times and should be a stored table.
    """
    rows = _bucketed(parsed, buckets)
    reachable = reachable_buckets(rows, k, by)
    totals = (
        _of(rows, reachable, [*by, "_bucket"], not by)
        .groupBy(*by, "resource_path")
        .agg(F.count(F.lit(1)).alias("request_count"), F.sum("bytes").alias("total_bytes"))
    )
    winners = staged(_first(totals, k, by), "winners")
    keys = [*by, "resource_path"]
    pairs = _of(rows, winners, keys, not by).groupBy(*keys, "host").agg(F.lit(1).alias("_one"))
    hosts = pairs.groupBy(*keys).agg(F.count("host").alias("distinct_host_count"))
    return winners.join(hosts, same_keys(winners, hosts, keys)).select(
        *[winners[c] for c in (*keys, "request_count", "total_bytes")], "distinct_host_count"
    )


def ordered_top(top: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A top list with its ``rank`` (from 1, of each ``by`` group), in rank order: as it is exported."""
    order = [F.desc("request_count"), F.desc("resource_path")]
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return top.withColumn("rank", rank).orderBy(*by, "rank")
