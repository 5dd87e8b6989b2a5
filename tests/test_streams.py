import os

import pytest
from pyspark.sql import functions as F

from conftest import line
from loglark.functions.parsing import valid_logs
from loglark.operators import traffic
from loglark.plans.run import read_runs
from loglark.sources import tables
from loglark.sources.text import read_batches
from loglark.streaming import streams
from test_run import check_results


def put(folder, name, texts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(t + "\n" for t in texts))


def hours_lines(first, last):
    return [
        line(host=f"h{i % 7}", time=f"01/Jul/1995:{h:02d}:{i % 60:02d}:00", status=[200, 404][i % 3 == 0], size=i)
        for h in range(first, last)
        for i in range(60)
    ]


def run_stream(spark, build, source, out, checkpoint):
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(str(source))
    query = streams.write_closed(build(lines), str(out), str(checkpoint))
    query.awaitTermination()
    return query


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_hours_and_days_equal_the_batch_query(spark, conf, tmp_path, zone):
    conf(spark__sql__session__timeZone=zone)
    source = tmp_path / "in"
    put(source, "1.txt", hours_lines(0, 8))
    put(source, "2.txt", [*hours_lines(6, 14), "junk", line(time="45/Jul/1995:00:00:00")])
    put(source, "3.txt", [line(time="03/Jul/1995:00:30:00", status=500)])
    batch = valid_logs(spark.read.text(str(source)))

    run_stream(spark, streams.stream_hourly_errors, source, tmp_path / "h", tmp_path / "c1")
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "h")).collect()))
    want = traffic.hourly_errors(batch).where("log_date = '01/Jul/1995'")
    assert got == sorted(map(tuple, want.collect()))
    assert len(got) == 14

    run_stream(spark, streams.stream_error_hosts, source, tmp_path / "e", tmp_path / "c2")
    hosts = spark.read.parquet(str(tmp_path / "e"))
    lists = traffic.error_hosts(batch).where("log_date = '01/Jul/1995'")
    assert sorted(map(tuple, hosts.collect())) == sorted(map(tuple, lists.collect()))

    run_stream(spark, streams.stream_daily_traffic, source, tmp_path / "d", tmp_path / "c3")
    days = spark.read.parquet(str(tmp_path / "d"))
    want = traffic.daily_traffic(batch).where("log_date = '01/Jul/1995'")
    assert sorted(map(tuple, days.collect())) == sorted(map(tuple, want.collect()))

    lines = spark.read.text(str(source))
    assert streams.undated(lines).count() == 1
    closed = spark.read.parquet(str(tmp_path / "h"))
    assert [tuple(r)[:4] for r in streams.open_hours(lines, closed).collect()] == [("03/Jul/1995", 0, 1, 1)]
    rest = streams.open_days(lines, spark.read.parquet(str(tmp_path / "d"))).collect()
    assert [tuple(r) for r in rest] == [("03/Jul/1995", 500, 1, 10)]
    assert streams.late_rows(lines, closed).count() == 0


def test_late_lines_are_left_out_and_counted(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "1.txt", hours_lines(0, 10))
    args = (streams.stream_hourly_errors, source, tmp_path / "h", tmp_path / "c")
    put(source, "2.txt", [line(time="05/Jul/1995:12:00:00", size=1)])
    run_stream(spark, *args)
    put(source, "3.txt", [*[line(time="01/Jul/1995:09:00:00")] * 2, line(time="05/Jul/1995:11:00:00", size=2)])
    put(source, "4.txt", [line(time="09/Jul/1995:12:00:00", size=4)])
    run_stream(spark, *args)
    lines, written = spark.read.text(str(source)), spark.read.parquet(str(tmp_path / "h"))
    assert [tuple(r) for r in streams.late_rows(lines, written).collect()] == [("01/Jul/1995", 9, 2)]
    got = {(r.log_date, r.log_hour): r.total_request_count for r in written.collect()}
    assert got[("05/Jul/1995", 11)] == 1
    assert sum(n for (d, _), n in got.items() if d == "01/Jul/1995") == 600
    whole = written.unionByName(streams.open_hours(lines, written))
    assert whole.agg(F.sum("total_request_count")).first()[0] + 2 == lines.count()


@pytest.mark.parametrize("files", [1, 3])
def test_stream_of_batches_equals_the_run(spark, tmp_path, files):
    source, root = tmp_path / "in", str(tmp_path / "out")
    checkpoint = str(tmp_path / "c")
    for b in range(1, 5):
        put(source, f"b{b}_61.txt", [*hours_lines(b, b + 1), "junk"])
    args = (spark, str(source), root, "logs_61", "mr", 1, "all", files, checkpoint)
    streams.stream_batches(*args).awaitTermination()
    put(source, "b5_60.txt", hours_lines(9, 10))
    put(source, "temp_b6.txt", ["unfinished"])
    streams.stream_batches(*args).awaitTermination()
    check_results(spark, root, read_batches(spark, str(source)))
    run = read_runs(spark, root).first()
    assert (run.total_record_count, run.total_malformed_record_count) == (304, 4)
    loads = tables.read_metadata(spark, root, "batch_metadata").select("load_id").distinct().count()
    assert loads == {1: 5, 3: 3}[files]


def test_files_older_than_seen_ones_are_read(spark, tmp_path):
    """A file that comes late with an old time is not passed over."""
    folder, root = tmp_path / "in", str(tmp_path / "root")
    folder.mkdir()

    def step():
        streams.stream_batches(
            spark, str(folder), root, "d", "spark", run_id=1, queries="1", checkpoint=str(tmp_path / "check")
        ).awaitTermination()

    (folder / "b1_1.txt").write_text(line() + "\n")
    step()
    late = folder / "b2_1.txt"
    late.write_text(line() + "\n")
    os.utime(late, (1_000_000_000, 1_000_000_000))
    step()
    assert read_runs(spark, root).first().total_record_count == 2


def test_a_trigger_starts_few_jobs(spark, tmp_path):
    """A long stream is as slow as the jobs that each small trigger starts."""
    source, root = tmp_path / "in", str(tmp_path / "out")
    for b in range(1, 4):
        put(source, f"b{b}_61.txt", [*hours_lines(b, b + 1), "junk"])
    jobs = spark.sparkContext._jsc.sc().dagScheduler()
    before = jobs.numTotalJobs()
    query = streams.stream_batches(spark, str(source), root, "logs_61", "mr", 1)
    query.awaitTermination()
    assert len(query.recentProgress) == 3
    assert jobs.numTotalJobs() - before <= 3 * 14
    check_results(spark, root, read_batches(spark, str(source)))
    times = tables.read_metadata(spark, root, "query_metadata", 1).collect()
    assert sorted((r.batch_no, r.query_number) for r in times) == [(b, q) for b in (1, 2, 3) for q in (1, 2, 3)]
    assert all(r.batch_runtime > 0 for r in tables.read_results(spark, root, "batch_metadata", 1).collect())
