import pytest

from conftest import FIELDS, make_rows
from loglark.operators import top_k, traffic

KEYS = ("batch_no",)


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("by", [(), KEYS])
@pytest.mark.parametrize("k", [1, 5, 20, 60_000])
@pytest.mark.parametrize("buckets", [1, 8, 4096])
def test_equal_to_one_scan(spark, by, k, buckets):
    df = spark.createDataFrame(make_rows(2500, seed=k), FIELDS)
    assert rows(top_k.top_resources_in_rounds(df, k, by, buckets)) == rows(traffic.top_resources(df, k, by))


def test_ties_nulls_and_empty_input(spark):
    data = [(b, h, "01/Jul/1995", 0, r, 200, 1) for b in (1, None) for r in ("/b", "/a", None, "/c") for h in ("x", None)]
    df = spark.createDataFrame(data, FIELDS)
    for by in ((), KEYS):
        for k in (1, 2, 3, 9):
            assert rows(top_k.top_resources_in_rounds(df, k, by)) == rows(traffic.top_resources(df, k, by))
        assert top_k.top_resources_in_rounds(df.limit(0), by=by).count() == 0


def long_tail(spark):
    """A few busy resources, and 40,000 that come once, each with its own host."""
    return spark.range(100_000).selectExpr(
        "CAST(id % 3 AS INT) AS batch_no", "concat('h', id) AS host",
        "if(id % 5 < 3, concat('/busy', id % 25), concat('/', id)) AS resource", "1L AS bytes",
    )


@pytest.mark.parametrize("by", [(), KEYS])
def test_few_buckets_can_reach_the_list(spark, by):
    bucketed = top_k._bucketed(long_tail(spark), top_k.BUCKETS)
    kept = top_k.reachable_buckets(bucketed, 10, by)
    assert kept.count() <= 15 * (3 if by else 1)


def test_no_pair_of_a_loser_is_shuffled(spark, tmp_path, conf):
    long_tail(spark).write.parquet(str(tmp_path / "log"))
    df = spark.read.parquet(str(tmp_path / "log"))
    found = top_k.top_resources_in_rounds(df, 10)
    assert found.count() == 10
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Below the only exchange that carries hosts, a join has left the winners' rows.
    pairs = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "host" in x]
    assert len(pairs) == 1
    below = plan[plan.index(pairs[0]) :]
    assert "BroadcastHashJoin" in below and "LeftSemi" in below
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("by", [(), KEYS])
def test_ordered_top(spark, by):
    df = spark.createDataFrame(make_rows(2000, seed=4), FIELDS)
    got = top_k.ordered_top(traffic.top_resources(df, 7, by), by).collect()
    keys = [(*[r[b] for b in by], r["rank"]) for r in got]
    assert keys == sorted(keys) and {r["rank"] for r in got} == set(range(1, 8))
    for a, b in zip(got, got[1:]):
        if a["rank"] < b["rank"]:
            assert (a.request_count, a.resource_path) > (b.request_count, b.resource_path)
