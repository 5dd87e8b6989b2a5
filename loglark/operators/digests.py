"""Digests of stored results, so that runs are compared without merging or sorting their rows.

A digest is a sum over rows, modulo a prime, of a coefficient that follows from the row's key
times a number of the row, in several independent lanes. As sums of the numbers merge, so do
the digests: rows of many small batches and of one large batch give the same, whatever their
order. Keys are dealt over leaves by hash; a tree of two levels is enough, as the root (all leaves
of a run) is read off the leaves, and unequal leaves name the few rows to look at.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglark.operators.merge import merge_daily, merge_hours, merge_resources

PRIME = 2**31 - 1
LANES = 4
LEAVES = 1024


class Part(NamedTuple):
    """A result table as it is digested: ``hosts`` tells rows (key, host), which are counted when merged."""

    query: int
    keys: tuple[str, ...]
    numbers: tuple[str, ...]
    hosts: bool = False


_HOUR = ("log_date", "log_hour")
PARTS = {
    "daily_traffic": Part(1, ("log_date", "status_code"), ("request_count", "total_bytes")),
    "top_resources": Part(2, ("resource_path",), ("request_count", "total_bytes")),
    "top_resource_hosts": Part(2, ("resource_path",), (), True),
    "hourly_errors": Part(3, _HOUR, ("error_request_count", "total_request_count")),
    "error_hosts": Part(3, _HOUR, (), True),
}
#: The numbers of a merged row of each query.
FIELDS = {
    1: ("request_count", "total_bytes"),
    2: ("request_count", "total_bytes", "distinct_host_count"),
    3: ("error_request_count", "total_request_count", "distinct_error_hosts"),
}


def _hash(columns: Sequence[str], seed: object) -> Column:
    # A null leaves a hash as it is, so each column's nulls are hashed beside it.
    marked = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return F.pmod(F.xxhash64(F.lit(str(seed)), *marked), F.lit(PRIME))


def leaf_of(keys: Sequence[str]) -> Column:
    return (_hash(keys, "leaf") % LEAVES).cast("int")


def _lanes(keys: Sequence[str], numbers: Sequence[str]) -> list[Column]:
    """Per lane what a row adds. Without numbers the row itself is counted."""
    out = []
    for lane in range(LANES):
        one = F.lit(0).cast("bigint")
        for number in numbers or (None,):
            times = F.lit(1) if number is None else F.pmod(F.coalesce(number, F.lit(0)).cast("bigint"), F.lit(PRIME))
            one = (one + _hash(keys, f"{lane} {number}") * times) % PRIME
        out.append(one.cast("bigint").alias(f"lane{lane}"))
    return out


def _sums() -> list[Column]:
    return [(F.sum(f"lane{i}") % PRIME).alias(f"lane{i}") for i in range(LANES)]


def leaves(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(run_id, part, leaf, lanes) of result tables, at most LEAVES rows for each run and table.

    A null number counts as 0. Host rows are digested as they are, once per batch.
    """
    out = None
    for name, rows in tables.items():
        part = PARTS[name]
        keys = [*part.keys, "host"] if part.hosts else part.keys
        found = rows.select("run_id", F.lit(name).alias("part"), leaf_of(part.keys).alias("leaf"), *_lanes(keys, part.numbers))
        out = found if out is None else out.unionByName(found)
    return out.groupBy("run_id", "part", "leaf").agg(*_sums())


def add_leaves(digests: DataFrame) -> DataFrame:
    """Digests of several loads, as one for each run."""
    return digests.groupBy("run_id", "part", "leaf").agg(*_sums())


def unequal_leaves(digests: DataFrame, run_id: int, others: Sequence[int]) -> dict[tuple[int, str], list[int]]:
    """By (run, table) the leaves in which one of the runs ``others`` differs from ``run_id``.

    What is collected is bounded by the runs compared, the tables and their leaves.
    """
    lanes = [f"lane{i}" for i in range(LANES)]
    # One row per digest that a leaf has in any run: at most one for each run, table and leaf.
    same = digests.groupBy("part", "leaf", *lanes).agg(F.collect_set("run_id").alias("runs")).collect()
    everyone = set(others) - {run_id}
    out: dict[tuple[int, str], set[int]] = {}
    for row in same:
        # Of a leaf of the target: the runs without it. Of any other: the runs that have it.
        wrong = everyone - set(row.runs) if run_id in row.runs else everyone & set(row.runs)
        for r in wrong:
            out.setdefault((r, row.part), set()).add(row.leaf)
    return {k: sorted(v) for k, v in out.items()}


def _counted(hosts: DataFrame, part: Part) -> DataFrame:
    keys = ["run_id", *part.keys]
    return hosts.select(*keys, "host").distinct().groupBy(*keys).agg(F.count("host").alias("_n"))


def equal_counts(hosts: DataFrame, name: str, run_id: int, wrong: Mapping[int, Sequence[int]]) -> set[int]:
    """The runs among ``wrong`` whose distinct hosts of every key are as many as those of ``run_id``.

    Only rows of the leaves that are known to differ are read.
    """
    part = PARTS[name]
    own = sorted({x for leaves_ in wrong.values() for x in leaves_})
    rows = hosts.where(F.col("run_id").isin(run_id, *wrong) & leaf_of(part.keys).isin(*own))
    counted = _counted(rows, part).where("_n > 0").withColumn("leaf", leaf_of(part.keys))
    sums = counted.select("run_id", "leaf", *_lanes(part.keys, ["_n"])).groupBy("run_id", "leaf").agg(*_sums())
    found: dict[int, dict[int, tuple]] = {}
    for row in sums.collect():
        found.setdefault(row.run_id, {})[row.leaf] = tuple(row[2:])
    target = found.get(run_id, {})
    return {r for r, some in wrong.items() if all(found.get(r, {}).get(x) == target.get(x) for x in some)}


def unequal_runs(
    tables: Mapping[str, DataFrame], run_id: int, others: Sequence[int], digests: DataFrame | None = None
) -> set[int]:
    """The runs among ``others`` whose merged results are not those of ``run_id``.

    Unequal sums settle it. Equal host rows have equal counts; where only host rows differ, as
    they do for other batch sizes, hosts are counted in the leaves that differ.
    """
    wrong = unequal_leaves(leaves(tables) if digests is None else digests, run_id, others)
    out = {r for r, name in wrong if not PARTS[name].hosts}
    for name, part in PARTS.items():
        suspects = {r: some for (r, n), some in wrong.items() if n == name and r not in out}
        if part.hosts and suspects:
            out |= set(suspects) - equal_counts(tables[name], name, run_id, suspects)
    return out


def _merged(tables: Mapping[str, DataFrame], query: int) -> DataFrame:
    by = ["run_id"]
    if query == 1:
        return merge_daily(tables["daily_traffic"], by)
    if query == 2:
        return merge_resources(tables["top_resources"], tables["top_resource_hosts"], by)
    return merge_hours(tables["hourly_errors"], tables["error_hosts"], by)


def result_differences(tables: Mapping[str, DataFrame], run_id: int, others: Sequence[int]) -> DataFrame:
    """The numbers in which merged results of ``others`` differ from those of ``run_id``.

    One row per run, query, key and field with both values, null where a side has no such
    key: run_id, query_number, key, field, target_value, other_value. Digests are compared first;
    only rows of unequal leaves are merged and joined. Not lazy.
    """
    wrong = unequal_leaves(leaves(tables), run_id, others)
    out = None
    for query, fields in FIELDS.items():
        names = [n for n, p in PARTS.items() if p.query == query]
        by_run: dict[int, set[int]] = {}
        for (r, n), some in wrong.items():
            if n in names:
                by_run.setdefault(r, set()).update(some)
        keys = PARTS[names[0]].keys
        some = sorted(set().union(*by_run.values()))
        if not some:
            continue
        near = {n: tables[n].where(F.col("run_id").isin(run_id, *by_run) & leaf_of(keys).isin(*some)) for n in names}
        key = F.concat_ws(" ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
        values = F.explode(F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*[F.col(f).cast("bigint") for f in fields])))
        rows = _merged(near, query).select("run_id", key.alias("key"), values.alias("field", "value"))
        own = rows.where(F.col("run_id") == run_id).select("key", "field", F.col("value").alias("target_value"))
        for other in sorted(by_run):
            theirs = rows.where(F.col("run_id") == other).select("key", "field", F.col("value").alias("other_value"))
            both = own.join(theirs, ["key", "field"], "full").where(~F.col("target_value").eqNullSafe(F.col("other_value")))
            found = both.select(
                F.lit(other).cast("bigint").alias("run_id"), F.lit(query).alias("query_number"), "key", "field", "target_value", "other_value"
            )
            out = found if out is None else out.unionByName(found)
    if out is None:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "run_id bigint, query_number int, key string, field string, target_value bigint, other_value bigint")
    return out
