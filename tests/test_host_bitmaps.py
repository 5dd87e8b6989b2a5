import pytest
from pyspark.sql import functions as F

from conftest import FIELDS, make_rows
from loglark.operators import host_bitmaps as hb
from loglark.operators import merge, traffic

BATCH = ("batch_no",)
HOUR = ["log_date", "log_hour"]


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(make_rows(3000, seed=6), FIELDS)


def test_merged_hours(spark, log):
    hosts, hours = traffic.error_hosts(log, BATCH), traffic.hourly_errors(log, BATCH)
    bitmaps = hb.host_bitmaps(hosts, hb.host_dictionary(hosts), [*BATCH, *HOUR])
    assert rows(hb.merge_hours_by_bitmaps(hours, bitmaps)) == rows(merge.merge_hours(hours, hosts))
    assert rows(hb.merge_hours_by_bitmaps(hours, bitmaps, BATCH)) == rows(merge.merge_hours(hours, hosts, BATCH))


def test_merged_top_lists(spark, log):
    top, hosts = traffic.top_resources(log, 5, BATCH), traffic.top_resource_hosts(log, 5, BATCH)
    bitmaps = hb.host_bitmaps(hosts, hb.host_dictionary(log), [*BATCH, "resource_path"])
    assert rows(hb.merge_resources_by_bitmaps(top, bitmaps)) == rows(merge.merge_resources(top, hosts))


def test_hosts_come_back_from_bitmaps(spark, log):
    hosts = traffic.error_hosts(log, BATCH).drop("error_request_count")
    dictionary = hb.host_dictionary(log)
    back = hb.hosts_in(hb.host_bitmaps(hosts, dictionary, [*BATCH, *HOUR]), dictionary, [*BATCH, *HOUR])
    assert rows(back) == rows(hosts)


def test_the_dictionary_grows_without_changing_a_number(spark):
    first = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "host string")
    old = hb.host_dictionary(first)
    both = hb.host_dictionary(spark.createDataFrame([("a",), ("0",), ("z",), (None,)], "host string"), old)
    assert {r.host: r.host_id for r in old.collect()} == {"a": 1, "b": 2}
    assert {r.host: r.host_id for r in both.collect()} == {"a": 1, "b": 2, "0": 3, "z": 4}


def test_a_hot_hour_is_spread_over_ranges_of_hosts(spark, conf):
    conf(spark__sql__shuffle__partitions="16", spark__sql__adaptive__coalescePartitions__enabled="false")
    hosts = spark.range(400_000).selectExpr("concat('h', id) AS host", "'01/Jul/1995' AS log_date", "5 AS log_hour")
    bitmaps = hb.host_bitmaps(hosts, hb.host_dictionary(hosts), HOUR).withColumn("task", F.spark_partition_id())
    found = bitmaps.select(hb.RANGE, "task", F.bitmap_count(hb.BITS).alias("n")).collect()
    assert len(found) == 13 and sum(r.n for r in found) == 400_000 and max(r.n for r in found) == hb.RANGE_HOSTS
    assert len({r.task for r in found}) >= 6
    counted = hb.count_hosts(bitmaps.drop("task").union(bitmaps.drop("task")), HOUR, "n").collect()
    assert [tuple(r) for r in counted] == [("01/Jul/1995", 5, 400_000)]


def test_null_keys_null_hosts_and_empty_input(spark):
    hours = spark.createDataFrame([(None, 1, 2, 3), ("d", 1, 0, 1)], "log_date string, log_hour int, error_request_count long, total_request_count long")
    hosts = spark.createDataFrame([(None, 1, "a"), (None, 1, None), ("d", 1, None)], "log_date string, log_hour int, host string")
    bitmaps = hb.host_bitmaps(hosts, hb.host_dictionary(hosts), HOUR)
    got = {r.log_date: r.distinct_error_hosts for r in hb.merge_hours_by_bitmaps(hours, bitmaps).collect()}
    assert got == {None: 1, "d": 0}
    assert hb.merge_hours_by_bitmaps(hours.limit(0), bitmaps.limit(0)).count() == 0
