from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import FIELDS, make_rows
from loglark.operators import merge, traffic

KEYS = ("batch_no",)


def expected_hours(rows, by_batch):
    groups = defaultdict(lambda: [0, 0, set()])
    for b, host, date, hour, _, status, _ in rows:
        g = groups[(b, date, hour) if by_batch else (date, hour)]
        g[1] += 1
        if 400 <= status <= 599:
            g[0] += 1
            g[2].add(host)
    return {k: (e, t, e / t, len(h), h) for k, (e, t, h) in groups.items()}


def expected_top(rows, k, by_batch):
    groups = defaultdict(lambda: [0, 0, set()])
    for b, host, _, _, resource, _, size in rows:
        g = groups[(b if by_batch else 0, resource)]
        g[0] += 1
        g[1] += size
        g[2].add(host)
    found = {}
    for batch in {g[0] for g in groups}:
        mine = [(n, r, size, hosts) for (b, r), (n, size, hosts) in groups.items() if b == batch]
        for n, r, size, hosts in sorted(mine, key=lambda x: (x[0], x[1]), reverse=True)[:k]:
            found[(batch, r) if by_batch else (r,)] = (n, size, len(hosts), hosts)
    return found


HOUR_VALUES = ["error_request_count", "total_request_count", "error_rate", "distinct_error_hosts"]
TOP_VALUES = ["request_count", "total_bytes", "distinct_host_count"]


def rows_by_key(df, keys, values):
    found = df.collect()
    got = {tuple(r[k] for k in keys): tuple(r[v] for v in values) for r in found}
    assert len(got) == len(found)
    return got


def hosts_by_key(df, keys):
    got, found = defaultdict(set), df.collect()
    for r in found:
        got[tuple(r[k] for k in keys)].add(r.host)
    assert sum(map(len, got.values())) == len(found)
    return got


@pytest.mark.parametrize("by", [(), KEYS])
@pytest.mark.parametrize("query", [traffic.hourly_errors, traffic.hourly_errors_join])
def test_hours(spark, by, query):
    rows, keys = make_rows(3000, seed=1), [*by, "log_date", "log_hour"]
    got = query(spark.createDataFrame(rows, FIELDS), by=by)
    want = expected_hours(rows, bool(by))
    assert rows_by_key(got, keys, HOUR_VALUES) == {k: v[:-1] for k, v in want.items()}


@pytest.mark.parametrize("by", [(), KEYS])
def test_error_hosts(spark, by):
    rows, keys = make_rows(3000, seed=1), [*by, "log_date", "log_hour"]
    got = traffic.error_hosts(spark.createDataFrame(rows, FIELDS), by)
    want = expected_hours(rows, bool(by))
    assert hosts_by_key(got, keys) == {k: v[-1] for k, v in want.items() if v[-1]}
    errors = got.groupBy(*keys).agg(F.sum("error_request_count").alias("n"))
    assert rows_by_key(errors, keys, ["n"]) == {k: v[:1] for k, v in want.items() if v[0]}


@pytest.mark.parametrize("by", [(), KEYS])
@pytest.mark.parametrize("k", [1, 20, 60_000])
def test_top(spark, by, k):
    rows, keys = make_rows(3000, seed=2), [*by, "resource_path"]
    df = spark.createDataFrame(rows, FIELDS)
    want = expected_top(rows, k, bool(by))
    summaries = {key: v[:-1] for key, v in want.items()}
    assert rows_by_key(traffic.top_resources(df, k, by), keys, TOP_VALUES) == summaries
    hosts = traffic.top_resource_hosts(df, k, by)
    assert hosts_by_key(hosts, keys) == {key: v[-1] for key, v in want.items()}
    assert rows_by_key(traffic.resource_totals(hosts, by), keys, TOP_VALUES) == summaries


def test_one_row_per_key_with_a_million_hosts(spark):
    df = spark.range(1_000_000).selectExpr(
        "concat('h', id) AS host", "'01/Jul/1995' AS log_date", "0 AS log_hour",
        "'/a' AS resource", "404 AS status_code", "1L AS bytes",
    )
    assert [tuple(r) for r in traffic.top_resources(df, k=1).collect()] == [("/a", *[1_000_000] * 3)]
    assert traffic.hourly_errors(df).first().distinct_error_hosts == 1_000_000
    assert traffic.top_resource_hosts(df, k=1).count() == traffic.error_hosts(df).count() == 1_000_000


def test_daily(spark):
    rows = make_rows(2000, seed=3)
    want = defaultdict(lambda: [0, 0])
    for _, _, date, _, _, status, size in rows:
        want[(date, status)][0] += 1
        want[(date, status)][1] += size
    got = traffic.daily_traffic(spark.createDataFrame(rows, FIELDS)).collect()
    assert {(r.log_date, r.status_code): [r.request_count, r.total_bytes] for r in got} == want


def test_ties_go_to_the_later_name(spark):
    rows = [(1, "h", "01/Jul/1995", 0, f"/{c}", 200, 1) for c in "bdaceB"]
    got = traffic.top_resources(spark.createDataFrame(rows, FIELDS), k=3).collect()
    assert [r.resource_path for r in got] == ["/e", "/d", "/c"]


def test_null_group_column_is_kept(spark):
    rows = [(None, "h", "01/Jul/1995", 0, "/a", 404, 1), (1, "h", "01/Jul/1995", 0, "/a", 200, 1)]
    df = spark.createDataFrame(rows, FIELDS)
    hours = {r.batch_no: r.distinct_error_hosts for r in traffic.hourly_errors(df, KEYS).collect()}
    assert hours == {None: 1, 1: 0}
    assert [r.batch_no for r in traffic.error_hosts(df, KEYS).collect()] == [None]
    for query in (traffic.top_resources, traffic.top_resource_hosts):
        assert {r.batch_no for r in query(df, by=KEYS).collect()} == {None, 1}
    merged = merge.merge_hours(traffic.hourly_errors(df, KEYS), traffic.error_hosts(df, KEYS), KEYS)
    assert {r.batch_no: r.distinct_error_hosts for r in merged.collect()} == hours


def test_a_null_host_is_no_host(spark):
    rows = [(1, h, "01/Jul/1995", 0, "/a", 404, 1) for h in (None, None, "h")]
    df = spark.createDataFrame(rows, FIELDS)
    assert tuple(traffic.top_resources(df).first())[1:] == (3, 3, 1)
    assert tuple(traffic.hourly_errors(df).first())[2:] == (3, 3, 1.0, 1)


def test_empty_input(spark):
    df = spark.createDataFrame([], FIELDS)
    queries = [traffic.daily_traffic, traffic.top_resources, traffic.top_resource_hosts]
    for query in (*queries, traffic.hourly_errors, traffic.error_hosts):
        assert query(df).count() == 0


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().toString()


def tasks_of(df, key, value):
    """How many tasks the rows of a key come from."""
    rows = df.withColumn("task", F.spark_partition_id()).collect()  # all columns: sizes decide
    return len({r.task for r in rows if r[key] == value})


def test_hot_keys_are_split_over_tasks(spark, conf):
    """No join or grouping may bring all hosts of a hot key to one task, however it is joined."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__shuffle__partitions="16",
    )
    df = spark.range(60_000).selectExpr(
        "1 AS batch_no",
        "concat('host', id) AS host",
        "'01/Jul/1995' AS log_date",
        "CAST(if(id % 3 = 0, 5, id % 500) AS INT) AS log_hour",
        "if(id % 3 = 0, '/hot', concat('/', id % 50)) AS resource",
        "404 AS status_code",
        "1L AS bytes",
    )
    hours = traffic.error_hosts(df)
    top = traffic.top_resource_hosts(df, by=KEYS)
    for got, key, value in ((hours, "log_hour", 5), (top, "resource_path", "/hot")):
        assert got.where(F.col(key) == value).count() >= 20_000
        assert tasks_of(got, key, value) >= 8
        shuffles = [x for x in plan_of(got).splitlines() if "Exchange hashpartitioning" in x]
        assert shuffles


def test_plans_scan_once(spark, tmp_path):
    path = str(tmp_path / "parsed")
    spark.createDataFrame(make_rows(500, seed=4), FIELDS).write.parquet(path)
    df = spark.read.schema(FIELDS).parquet(path)
    for query in (
        traffic.hourly_errors,
        traffic.error_hosts,
        traffic.top_resources,
        traffic.top_resource_hosts,
        lambda parsed: traffic.top_resources(parsed, by=KEYS),
        lambda parsed: traffic.top_resource_hosts(parsed, by=KEYS),
    ):
        final = plan_of(query(df)).split("== Initial Plan ==")[0].split("== Physical Plan ==")[-1]
        scans = [s for s in final.splitlines() if "FileScan parquet" in s]
        reused = [s for s in final.splitlines() if "ReusedExchange" in s]
        assert len(scans) - len(reused) <= 1, final
        assert "CartesianProduct" not in final and "NestedLoop" not in final


@pytest.mark.parametrize("size", [1, 3, 7])
def test_merged_batches_equal_the_whole(spark, size):
    rows = make_rows(1500, seed=size, batches=size)
    df = spark.createDataFrame(rows, FIELDS)
    daily = merge.merge_daily(traffic.daily_traffic(df, KEYS))
    assert sorted(daily.collect()) == sorted(traffic.daily_traffic(df).collect())
    hours = merge.merge_hours(traffic.hourly_errors(df, KEYS), traffic.error_hosts(df, KEYS)).collect()
    got = {(r.log_date, r.log_hour): tuple(r)[2:] for r in hours}
    assert got == {k: (e, t, n) for k, (e, t, _, n, _) in expected_hours(rows, False).items()}


def test_merged_top_lists(spark):
    rows = make_rows(2500, seed=9)
    df = spark.createDataFrame(rows, FIELDS)
    top, hosts = traffic.top_resources(df, 5, KEYS), traffic.top_resource_hosts(df, 5, KEYS)
    got = merge.merge_resources(top, hosts).collect()
    want = defaultdict(lambda: [0, 0, set()])
    for (_, resource), (n, size, _, hosts) in expected_top(rows, 5, True).items():
        want[resource][0] += n
        want[resource][1] += size
        want[resource][2] |= hosts
    assert {r.resource_path: tuple(r)[1:] for r in got} == {
        k: (n, size, len(h)) for k, (n, size, h) in want.items()
    }
