"""Digests: what they must not see, what they must, and the rows they lead to."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import FIELDS, make_rows
from loglark.operators import digests, merge, traffic
from loglark.plans.run import QUERIES

BATCH = ("batch_no",)


def stored(spark, rows, run_id):
    df = spark.createDataFrame(rows, FIELDS)
    return {
        name: query(df, by=BATCH).withColumn("run_id", F.lit(run_id).cast("bigint"))
        for tables in QUERIES.values()
        for name, query in tables.items()
    }


def together(*runs):
    first, second = runs
    return {name: first[name].unionByName(second[name]) for name in digests.PARTS}


def rebatched(rows, n):
    return [(1 + i % n, *r[1:]) for i, r in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    # Fewer resources than a list has, so that lists do not depend on batches.
    return [(*r[:4], f"/r{i % 9}", *r[5:]) for i, r in enumerate(make_rows(1200, seed=8))]


def test_order_and_batches_do_not_matter(spark, rows):
    other = rebatched(rows, 7)
    random.Random(1).shuffle(other)
    both = together(stored(spark, rows, 1), stored(spark, other, 2))
    assert digests.unequal_runs(both, 1, [2]) == set()
    assert digests.result_differences(both, 1, [2]).count() == 0
    same = together(stored(spark, rows, 1), stored(spark, rows, 2))
    assert digests.unequal_leaves(digests.leaves(same), 1, [1, 2]) == {}


@pytest.mark.parametrize("change", ["a byte", "a status", "a host", "a row more", "an hour"])
def test_any_change_is_seen_and_found(spark, rows, change):
    other = list(rows)
    at = next(i for i, r in enumerate(rows) if 400 <= r[5] <= 599)
    b, host, date, hour, resource, status, size = other[at]
    other[at] = {
        "a byte": (b, host, date, hour, resource, status, size + 1),
        "a status": (b, host, date, hour, resource, 200, size),
        "a host": (b, "someone else", date, hour, resource, status, size),
        "a row more": other[at],
        "an hour": (b, host, date, 23 - hour, resource, status, size),
    }[change]
    if change == "a row more":
        other.append(other[at])
    both = together(stored(spark, rows, 1), stored(spark, rebatched(other, 3), 2))
    merged = {
        run: [
            merge.merge_daily(both["daily_traffic"].where(f"run_id = {run}")).collect(),
            merge.merge_resources(both["top_resources"].where(f"run_id = {run}"), both["top_resource_hosts"].where(f"run_id = {run}")).collect(),
            merge.merge_hours(both["hourly_errors"].where(f"run_id = {run}"), both["error_hosts"].where(f"run_id = {run}")).collect(),
        ]
        for run in (1, 2)
    }
    unlike = [set(map(str, a)) ^ set(map(str, b)) for a, b in zip(merged[1], merged[2])]
    assert any(unlike)
    assert digests.unequal_runs(both, 1, [2]) == {2}
    want = set()
    for query, (a, b) in enumerate(zip(merged[1], merged[2]), 1):
        n = len(digests.PARTS[[k for k, p in digests.PARTS.items() if p.query == query][0]].keys)
        sides = [{(" ".join(map(str, r[:n])), f): r[f] for r in side for f in digests.FIELDS[query]} for side in (a, b)]
        want |= {(2, query, k, f, sides[0].get((k, f)), sides[1].get((k, f))) for k, f in set(sides[0]) | set(sides[1]) if sides[0].get((k, f)) != sides[1].get((k, f))}
    assert {tuple(r) for r in digests.result_differences(both, 1, [2]).collect()} == want and want


def test_equal_counts_of_other_hosts_match(spark, rows):
    """Merged results hold counts of hosts, not their names."""
    other = [(b, host + "x", *r) for b, host, *r in rows]
    both = together(stored(spark, rows, 1), stored(spark, other, 2))
    assert digests.unequal_leaves(digests.leaves(both), 1, [2]) != {}
    assert digests.unequal_runs(both, 1, [2]) == set()


def test_a_run_without_results_and_null_keys(spark, rows):
    own = stored(spark, rows, 1)
    assert digests.unequal_runs(own, 1, [1, 9]) == {9}
    assert digests.unequal_runs(own, 9, [1]) == {1}
    empty = {k: v.limit(0) for k, v in own.items()}
    assert digests.unequal_runs(empty, 1, [2]) == set()
    a = spark.createDataFrame([(1, None, "x"), (2, "x", None)], "run_id long, resource_path string, other string")
    found = a.select("run_id", digests._hash(["resource_path", "other"], 0).alias("h")).collect()
    assert found[0].h != found[1].h


def test_digests_of_loads_add_up(spark, rows):
    whole = digests.leaves(stored(spark, rows, 1))
    first, second = (stored(spark, [r for r in rows if r[0] % 2 == k], 1) for k in (0, 1))
    parts = digests.leaves(first).unionByName(digests.leaves(second))
    assert sorted(digests.add_leaves(parts).collect()) == sorted(whole.collect())
