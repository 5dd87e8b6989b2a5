"""Exact distinct hosts as bitmaps, so that merging batches reads bitmaps and not host rows.

A host dictionary gives every host a number. The hosts of a key (an hour, a resource) are bits
of a few bitmaps, each for a range of 32,768 numbers; a busy key is spread over its ranges.
Bitmaps of batches are merged by OR, which needs one row per batch, key and range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglark.operators.batching import number_rows
from loglark.operators.traffic import same_keys

RANGE, BITS = "host_range", "host_bits"
#: Hosts of one range. Bits and ranges follow from Spark's bitmap functions, which count from 1.
RANGE_HOSTS = 32_768


def host_dictionary(hosts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(host, host_id) of all hosts in the column ``host`` of ``hosts``, ids from 1 without gaps.

    Hosts of the dictionary ``known`` keep their numbers, and new ones follow: bitmaps that are
    stored stay right. A null host is no host.
    """
    new = hosts.select("host").where(F.col("host").isNotNull()).distinct()
    first = 1
    if known is not None:
        new = new.join(known, "host", "left_anti")
        first += known.agg(F.coalesce(F.max("host_id"), F.lit(0))).first()[0]
    numbered = number_rows(new, "host").select("host", (F.col("row_no") + first).alias("host_id"))
    return numbered if known is None else known.select("host", "host_id").unionByName(numbered)


def host_bitmaps(hosts: DataFrame, dictionary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key and range of numbers the bitmap of the key's hosts.

    ``hosts`` has rows (keys, host), such as ``traffic.error_hosts`` or the parsed rows
    themselves; a host may come several times. The join with the dictionary is left to Spark.
    """
    known = hosts.join(dictionary, "host").select(*keys, "host_id")
    return known.groupBy(*keys, F.bitmap_bucket_number("host_id").alias(RANGE)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("host_id")).alias(BITS)
    )


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of several batches or loads as one per key and range."""
    return bitmaps.groupBy(*keys, RANGE).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count_hosts(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct hosts of each key over all its bitmaps, of one batch or of many."""
    merged = merge_bitmaps(bitmaps, keys).select(*keys, F.bitmap_count(BITS).alias("_n"))
    return merged.groupBy(*keys).agg(F.sum("_n").alias(name))


def hosts_in(bitmaps: DataFrame, dictionary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows (keys, host) that bitmaps stand for."""
    byte = F.expr(f"explode(sequence(0, length({BITS}) - 1))")
    # A byte at a time: its value, then its bits, lowest first.
    bytes_ = bitmaps.select(*keys, RANGE, BITS, byte.alias("_at")).select(
        *keys, RANGE, "_at", F.conv(F.hex(F.substring(F.col(BITS), F.col("_at") + 1, F.lit(1))), 16, 10).cast("int").alias("_byte")
    )
    bits = bytes_.where(F.col("_byte") > 0).select(*keys, RANGE, "_at", "_byte", F.expr("explode(sequence(0, 7))").alias("_bit"))
    ids = bits.where(F.expr("(shiftright(_byte, _bit) & 1) = 1")).select(
        *keys, ((F.col(RANGE) - 1) * RANGE_HOSTS + F.col("_at") * 8 + F.col("_bit") + 1).cast("bigint").alias("host_id")
    )
    return ids.join(dictionary, "host_id").select(*keys, "host")


def _merged(rows: DataFrame, bitmaps: DataFrame, keys: Sequence[str], sums: Sequence[str], name: str) -> DataFrame:
    added = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    counted = count_hosts(bitmaps, keys, name)
    return added.join(counted, same_keys(added, counted, keys), "left").select(
        *[added[c] for c in (*keys, *sums)], F.coalesce(name, F.lit(0).cast("bigint")).alias(name)
    )


def merge_hours_by_bitmaps(hours: DataFrame, bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The rows of ``merge.merge_hours``, from bitmaps of each batch's error hosts by hour."""
    keys = [*by, "log_date", "log_hour"]
    return _merged(hours, bitmaps, keys, ["error_request_count", "total_request_count"], "distinct_error_hosts")


def merge_resources_by_bitmaps(top: DataFrame, bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The rows of ``merge.merge_resources``, from bitmaps of the hosts in each batch's list."""
    return _merged(top, bitmaps, [*by, "resource_path"], ["request_count", "total_bytes"], "distinct_host_count")
