import datetime
import json

import pytest
from pyspark.sql import functions as F

from loglark.operators.runs import batch_totals, latest_runs, run_totals, successful_runs
from loglark.plans import reports
from loglark.sources.tables import write_run_history


def at(n):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=n)


# run_id, engine, dataset, avg size, runtime, malformed, records, time
RUNS = [
    (1, "mr", "web_500", 500.0, 10.0, 5, 5000, at(1)),
    (2, "pig", "web_500", 500.0, 20.0, 5, 5000, at(2)),
    (3, "pig", "web_500", 500.0, 30.0, 5, 5000, at(3)),
    (4, "pig", "web_500", 500.0, 0.0, 5, 5000, at(4)),
    (5, "pig", "web_500", 500.0, 5.0, 5000, 5000, at(5)),
    (6, "hive", "web_500", 500.0, 7.0, 0, 800, at(6)),
    (7, "mr", "web_1000", 1000.0, 8.0, 5, 5000, at(7)),
    (8, "mr", "web_1000", 1000.0, 9.0, 5, 5000, at(8)),
    (9, "mr", "web_old_1000", 1000.0, 11.0, 5, 5000, at(9)),
    (10, "mr", "web_x", 1000.0, 12.0, 5, 5000, at(10)),
    (11, "mr", "webx_250", 250.0, 13.0, 5, 5000, at(11)),
    (12, "mr", "web_500", 500.0, 14.0, 5, 5000, at(12)),
    (13, "spark", "web_500", 500.0, 15.0, 5, 5000, at(13)),
    (14, "mongodb", "other_500", 500.0, 16.0, 5, 5000, at(14)),
    (15, "pig", "web_500", 500.0, 40.0, 5, 5000, at(3)),
]
COLUMNS = (
    "run_id long, pipeline_name string, dataset_name string, avg_batch_size double, total_runtime double, "
    "total_malformed_record_count long, total_record_count long, execution_timestamp timestamp"
)
BATCHES = [(r, b, 10 * b, b, float(r * b)) for r in (1, 2, 3, 6, 8) for b in (1, 2)]
TIMES = [(r, b, q, float(100 * r + 10 * b + q)) for r, b, *_ in BATCHES for q in (1, 2, 3)]


@pytest.fixture(scope="module")
def t(spark):
    return (
        spark.createDataFrame(RUNS, COLUMNS),
        spark.createDataFrame(
            BATCHES,
            "run_id long, batch_no int, record_count long, malformed_record_count long, batch_runtime double",
        ),
        spark.createDataFrame(TIMES, "run_id long, batch_no int, query_number int, query_runtime double"),
    )


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_which_runs_count(t):
    runs = t[0]
    assert {r.run_id for r in successful_runs(runs).collect()} == {r[0] for r in RUNS} - {4, 5}
    assert {r.run_id for r in successful_runs(runs, 1000).collect()} == {r[0] for r in RUNS} - {4, 6}


def test_latest_run_ties_go_to_the_higher_id(t):
    latest = latest_runs(successful_runs(t[0])).collect()
    assert {(r.dataset_name, r.pipeline_name): r.run_id for r in latest}[("web_500", "pig")] == 15


def test_history(t, tmp_path):
    history = reports.run_history(t[0])
    assert [r.run_id for r in history.collect()] == [r[0] for r in reversed(RUNS) if r[4] > 0]
    found = reports.run_history_json(t[0])
    objects = [json.loads(r.json) for r in found.collect()]
    assert objects[0] == {"id": 15, "pipeline": "pig", "dataset": "web_500", "timestamp": "2024-01-01 00:03:00.0"}
    write_run_history(found, str(tmp_path / "h"))
    written = [
        json.loads(x) for f in sorted((tmp_path / "h").glob("part-*")) for x in f.read_text().splitlines()
    ]
    assert written == objects


def test_history_time_text(spark):
    times = [datetime.datetime(2024, 1, 1, 0, 0, 10), datetime.datetime(2024, 1, 1, 0, 0, 0, 120500)]
    df = spark.createDataFrame([(i, "mr", "d", 1.0, t) for i, t in enumerate(times)],
        "run_id long, pipeline_name string, dataset_name string, total_runtime double, execution_timestamp timestamp")
    got = [json.loads(r.json)["timestamp"] for r in reports.run_history_json(df).collect()]
    assert got == ["2024-01-01 00:00:00.1205", "2024-01-01 00:00:10.0"]


def test_data_quality(t):
    assert rows(reports.data_quality(t[0], 1)) == [
        ("mr", 1, 4995, 5, True, True),
        ("pig", 15, 4995, 5, False, True),
        ("hive", 6, 800, 0, False, True),
        ("mongodb", None, None, None, False, False),
        ("spark", 13, 4995, 5, False, True),  # not listed, but it has a run
    ]
    assert [r[0] for r in rows(reports.data_quality(t[0], 1, ["pig"]))] == ["pig", "hive", "mr", "spark"]
    assert rows(reports.data_quality(t[0], 99)) == []


def test_engine_comparison(t):
    got = sorted(rows(reports.engine_comparison(t[0], 1)))
    assert got == [("hive", 6, 7.0), ("mr", 1, 10.0), ("pig", 15, 40.0), ("spark", 13, 15.0)]


def test_query_times(t):
    runs, _, times = t
    assert rows(reports.query_totals(times, 1)) == [(1, 232.0), (2, 234.0), (3, 236.0)]
    assert rows(reports.batch_query_times(times, 1))[:2] == [(1, 1, 111.0), (1, 2, 112.0)]
    assert rows(reports.batch_query_times_wide(times, 1)) == [(1, 111.0, 112.0, 113.0), (2, 121.0, 122.0, 123.0)]
    assert rows(reports.cross_engine_timing(runs, times, 1))[::3] == [("hive", 1, 616.0), ("mr", 1, 116.0)]


def test_summaries(t):
    runs, batches, _ = t
    assert rows(reports.run_summary(runs, batches, 1)) == [(1, "mr", "web_500", 2, 500.0, 10.0, 5)]
    assert rows(reports.run_summary(runs, batches, 13))[0][3] == 0
    assert [(r[0], r[3]) for r in rows(reports.run_comparison(runs, batches, 1))] == [(5, 0), (13, 0)]


def test_batch_sizes(t):
    runs, batches, _ = t
    # web_old_1000 comes after web_1000 by name and so speaks for 1000.
    assert rows(reports.batch_size_runtime(runs, 1)) == [(500, 10.0), (1000, 11.0)]
    assert rows(reports.batch_size_avg_time(runs, batches, 1)) == [(500, 1.5), (1000, None)]
    assert rows(reports.batch_size_throughput(runs, 1)) == [(500, 500.0), (1000, 5000 / 11)]
    # The target is shown even unfinished, with no throughput.
    assert rows(reports.batch_size_runtime(runs, 4))[0] == (500, 0.0)
    assert rows(reports.batch_size_throughput(runs, 4))[0] == (500, None)


def test_batches(t):
    runs, batches, _ = t
    assert rows(reports.batch_view(batches, 1)) == [(1, 10, 1.0, 1), (2, 20, 2.0, 2)]
    got = rows(reports.batch_comparison(runs, batches, 1))
    assert {s for s, *_ in got} == {
        "MR (Target Exec: 1)", "PIG (Fastest Exec: 2)", "HIVE (Fastest Exec: 6)"
    }
    assert got == sorted(got) and len(got) == 6


def test_totals(spark):
    stats = spark.createDataFrame(
        [(1, 1, 10, 2, 1.0), (1, 1, 0, 3, 2.0), (1, 2, 5, 0, 4.0), (2, 1, 7, 1, 8.0)],
        "run_id long, batch_no int, record_count long, malformed_record_count long, batch_runtime double",
    )
    batches = batch_totals(stats)
    assert sorted(rows(batches)) == [(1, 1, 10, 3, 3.0), (1, 2, 5, 0, 4.0), (2, 1, 7, 1, 8.0)]
    assert sorted(rows(run_totals(batches))) == [(1, 7.0, 3, 15), (2, 8.0, 1, 7)]


DAILY = "run_id long, batch_no int, log_date date, status_code int, request_count long, total_bytes long"
TOP = (
    "run_id long, batch_no int, resource_path string, request_count long, total_bytes long, "
    "hosts array<string>"
)
HOURS = (
    "run_id long, batch_no int, log_date date, log_hour short, error_request_count long, "
    "total_request_count long, hosts array<string>"
)
DAY = datetime.date(1995, 7, 1)


def result_tables(spark, daily, top, hours):
    """The five result tables; hosts of a summary's row are given with it."""
    tables = [spark.createDataFrame(daily, DAILY)]
    for given in (spark.createDataFrame(top, TOP), spark.createDataFrame(hours, HOURS)):
        tables += [given.drop("hosts"), given.withColumn("host", F.explode("hosts")).drop("hosts")]
    return tables


def scorecard(spark, runs, daily, top, hours, run_id=1):
    df = reports.integrity_scorecard(runs, *result_tables(spark, daily, top, hours), run_id)
    return {r.engine: r.status for r in df.collect()}, reports.all_clear(df).first()[0]


def test_scorecard(spark, t):
    runs = t[0]
    # Run 15 has other batches but the same merged rows; run 6 counts one host more.
    daily = [(1, 1, DAY, 200, 3, 30), (15, 1, DAY, 200, 1, 10), (15, 2, DAY, 200, 2, 20), (6, 1, DAY, 200, 3, 30)]
    top = [
        (1, 1, "/a", 3, 30, ["x", "y"]),
        (15, 1, "/a", 1, 10, ["x"]),
        (15, 2, "/a", 2, 20, ["y", "x"]),
        (6, 1, "/a", 3, 30, ["x", "z", "y"]),
    ]
    hours = [(r, 1, None, 5, 0, 3, []) for r in (1, 15, 6, 13)]
    daily.append((13, 1, DAY, 200, 3, 30))
    top.append((13, 1, "/a", 3, 30, ["x", "y"]))
    daily.sort()
    assert scorecard(spark, runs, daily, top, hours) == (
        {"mr": "BASELINE", "pig": "MATCH", "hive": "MISMATCH", "mongodb": "NO_HISTORY", "spark": "MATCH"}, False)
    same = [row for row in top if row[0] != 6] + [(6, 1, "/a", 3, 30, ["x", "y"])]
    assert scorecard(spark, runs, daily, same, hours)[1] is True
    # A row too few or too many on either side is a mismatch.
    for changed in ([d for d in daily if d[0] != 6], [*daily, (6, 1, DAY, 404, 1, 1)], [*daily, (1, 1, DAY, 404, 1, 1)]):
        assert scorecard(spark, runs, changed, same, hours)[0]["hive"] == "MISMATCH"
    # No results anywhere are equal results.
    assert scorecard(spark, runs, [], [], [])[0]["pig"] == "MATCH"


def test_all_reports(spark, t):
    runs, batches, times = t
    empty = result_tables(spark, [], [], [])
    found = reports.all_reports(runs, batches, times, *empty, run_id=1)
    assert len(found) == 14
    assert all(df.columns for df in found.values())
    assert not any("CartesianProduct" in df._jdf.queryExecution().toString() for df in found.values())


def test_hot_engine_is_combined_before_the_shuffle(spark, t):
    plan = latest_runs(t[0], ["pipeline_name"])._jdf.queryExecution().toString()
    assert "partial_max_by" in plan
