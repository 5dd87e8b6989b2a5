import datetime

import pytest
from pyspark.sql import functions as F

from conftest import line
from loglark.functions.parsing import parse_logs, valid_logs
from loglark.operators import traffic
from loglark.plans import run as runs
from loglark.sources import tables, text


def make_lines(spark, n=600, batches=4):
    rows = []
    for i in range(n):
        value = "junk" if i % 50 == 7 else line(
            host=f"h{i % 17}",
            time=f"{1 + i % 3:02d}/Jul/1995:{i % 5:02d}:00:01",
            resource=f"/r{i % 29}",
            status=[200, 404, 500, 302][i % 4],
            size="-" if i % 10 == 3 else i,
        )
        rows.append((value, 1 + i * batches // n))
    return spark.createDataFrame(rows, "value string, batch_no int")


def stored(spark, root, name, run_id=1):
    rows = tables.read_results(spark, root, name, run_id).drop("run_id", "load_id").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def wanted(df, name):
    typed = tables.to_table(df.withColumns({"run_id": F.lit(0), "load_id": F.lit(0)}), name)
    return sorted((tuple(r) for r in typed.drop("run_id", "load_id").collect()), key=repr)


def check_results(spark, root, lines):
    parsed = valid_logs(lines, keep=("batch_no",))
    for tables_of_query in runs.QUERIES.values():
        for name, query in tables_of_query.items():
            assert stored(spark, root, name) == wanted(query(parsed, by=("batch_no",)), name)


def test_run(spark, tmp_path):
    root, lines = str(tmp_path), make_lines(spark)
    runs.run_batches(lines, root, "logs_150", "MR", run_id=1)
    check_results(spark, root, lines)
    run = runs.read_runs(spark, root).first()
    assert (run.pipeline_name, run.dataset_name, run.avg_batch_size) == ("mr", "logs_150", 150.0)
    assert (run.total_record_count, run.total_malformed_record_count) == (600, 12)
    assert run.total_runtime > 0
    times = tables.read_metadata(spark, root, "query_metadata", 1).collect()
    assert sorted((r.batch_no, r.query_number) for r in times) == [(None, 1), (None, 2), (None, 3)]
    bad = tables.read_malformed(spark, f"{root}/parsed/run=1/load=0")
    assert {r.value for r in bad.collect()} == {"junk"} and bad.count() == 12


def test_repeated_load_changes_nothing(spark, tmp_path):
    root, lines = str(tmp_path), make_lines(spark)
    for _ in range(2):
        runs.run_batches(lines, root, "logs_150", "mr", run_id=1)
    check_results(spark, root, lines)
    assert runs.read_runs(spark, root).first().total_record_count == 600


def test_later_load_supersedes_its_batches_only(spark, tmp_path):
    root, lines = str(tmp_path), make_lines(spark)
    spoiled = lines.withColumn(
        "value", F.when(F.col("batch_no") == 2, F.lit("junk")).otherwise(F.col("value"))
    )
    runs.run_batches(spoiled, root, "logs_150", "mr", run_id=1)
    assert not any(r[0] == 2 for r in stored(spark, root, "daily_traffic"))
    runs.run_batches(lines.where("batch_no = 2"), root, "logs_150", "mr", run_id=1, load_id=1)
    check_results(spark, root, lines)
    assert runs.read_runs(spark, root).first().total_malformed_record_count == 12
    # A batch that loses all its rows in a later load loses its results too.
    runs.run_batches(spoiled.where("batch_no = 2"), root, "logs_150", "mr", run_id=1, load_id=2)
    assert not any(r[0] == 2 for r in stored(spark, root, "daily_traffic"))


def test_batches_one_by_one(spark, tmp_path):
    root, lines = str(tmp_path), make_lines(spark)
    runs.run_batches(lines, root, "logs_150", "mr", run_id=1, separately=[1, 2, 3, 4])
    check_results(spark, root, lines)
    times = tables.read_metadata(spark, root, "query_metadata", 1).collect()
    assert sorted((r.batch_no, r.query_number) for r in times) == [
        (b, q) for b in (1, 2, 3, 4) for q in (1, 2, 3)
    ]
    spent = tables.read_results(spark, root, "batch_metadata", 1).collect()
    assert len(spent) == 4 and all(r.batch_runtime > 0 and r.record_count == 150 for r in spent)


def test_runs_are_kept_apart(spark, tmp_path):
    root, lines = str(tmp_path), make_lines(spark)
    runs.run_batches(lines, root, "logs_150", "mr", run_id=1, queries="1")
    runs.run_batches(lines.where("batch_no < 3"), root, "logs_150", "pig", run_id=2, queries="1")
    assert {r[0] for r in stored(spark, root, "daily_traffic", 2)} == {1, 2}
    plan = tables.read_metadata(spark, root, "daily_traffic", 2)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


def test_query_choice():
    assert runs.select_queries("ALL") == [1, 2, 3]
    assert runs.select_queries("2") == [2]
    for bad in ("4", "0", "x", "", "-1"):
        with pytest.raises(ValueError):
            runs.select_queries(bad)


def test_failed_query_leaves_no_time(spark, tmp_path, monkeypatch):
    def broken(parsed, by=()):
        return traffic.daily_traffic(parsed, by).withColumn("log_date", F.raise_error(F.lit("no")))

    monkeypatch.setitem(runs.QUERIES, 1, {"daily_traffic": broken})
    with pytest.raises(Exception):
        runs.run_batches(make_lines(spark), str(tmp_path), "logs_150", "mr", run_id=1)
    assert not (tmp_path / "query_metadata").exists()
    assert runs.read_runs(spark, str(tmp_path)).first().total_runtime == 0  # opened, not ended


def test_parsed_text_and_exports(spark, tmp_path):
    parsed = parse_logs(make_lines(spark))
    valid = valid_logs(make_lines(spark))
    folder = str(tmp_path / "tsv")
    text.export_query(valid, folder)
    assert sorted(text.read_parsed_tsv(spark, folder).collect()) == sorted(valid.collect())
    (tmp_path / "short.tsv").write_text("a\tb\tc\n" + "\t".join("hdx5678") + "\n")
    assert text.read_parsed_tsv(spark, str(tmp_path / "short.tsv")).count() == 0

    out, keys = str(tmp_path / "hosts"), ("log_date", "log_hour")
    lists = traffic.error_hosts(valid).groupBy(*keys).agg(F.collect_list("host").alias("hosts_list"))
    text.export_query(lists, out)
    got = spark.read.option("sep", "\t").csv(out).toDF(*keys, "hosts_list")
    hosts = text.hosts_of_texts(got.withColumn("log_hour", F.col("log_hour").cast("int")), *keys)
    assert sorted(hosts.collect()) == sorted(traffic.error_hosts(valid).select(*keys, "host").collect())

    path = str(tmp_path / "parsed")
    tables.write_parsed(parsed, path)
    tables.write_parsed(parsed, path)
    assert tables.read_parsed(spark, path).count() == valid.count()
    raw = spark.read.parquet(path).where("is_valid = 'true'").select("value").distinct().collect()
    assert [r[0] for r in raw] == [None]


def test_dates_in_stored_tables(spark):
    df = spark.createDataFrame(
        [("32/Jul/1995", 200, 1, 2), ("01/Xyz/1995", 200, 3, 4)],
        "log_date string, status_code int, request_count long, total_bytes long",
    ).withColumns({c: F.lit(1) for c in ("batch_no", "run_id", "load_id")})
    got = {r.request_count: r.log_date for r in tables.to_table(df, "daily_traffic").collect()}
    assert got == {1: datetime.date(1995, 8, 1), 3: None}


def test_database_writer(spark, monkeypatch):
    """Only the call is checked: a database is not at hand here."""
    from pyspark.sql import DataFrameWriter

    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, *a, **k: calls.append((self._df, a, k)))
    df = spark.createDataFrame([("/a", ["x", "y"])], "resource_path string, hosts_list array<string>")
    tables.write_jdbc(df, "jdbc:postgresql://host/db", "top_resources", {"user": "u"})
    (sent, args, options), = calls
    assert sent.first().hosts_list == "x,y"
    assert args == ("jdbc:postgresql://host/db", "top_resources")
    assert options == {"mode": "append", "properties": {"batchsize": "10000", "user": "u"}}


@pytest.mark.parametrize("column", [None, "batch_no"])
def test_database_reader(spark, monkeypatch, column):
    from pyspark.sql import DataFrameReader

    calls = []

    def jdbc(self, *args, **options):
        calls.append((args, options))
        return spark.createDataFrame([(1, 5), (2, 6)], "run_id int, batch_no int")

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    url = "jdbc:postgresql://host/db"
    rows = tables.read_jdbc(spark, url, "batch_metadata", 2, column=column, bounds=(1, 90), parts=9)
    assert [r.batch_no for r in rows.collect()] == [6]
    split = dict(column="batch_no", lowerBound=1, upperBound=90, numPartitions=9) if column else {}
    assert calls == [((url, "batch_metadata"), {"properties": {}, **split})]


def test_a_load_of_other_batches_is_refused(spark, tmp_path):
    root = str(tmp_path)
    lines = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "value string, batch_no int")
    third = lines.where("batch_no = 3")
    runs.run_batches(lines, root, "d", "spark", run_id=1, separately=[1, 2])
    with pytest.raises(ValueError, match="other batches"):
        runs.run_batches(third, root, "d", "spark", run_id=1, load_id=1)
    runs.run_batches(third, root, "d", "spark", run_id=1, load_id=2)
    assert runs.read_runs(spark, root).first().total_record_count == 3


def test_a_failed_run_is_seen_as_unfinished(spark, tmp_path):
    root = str(tmp_path)
    lines = spark.createDataFrame([(line(), 1)], "value string, batch_no int")
    broken = lines.withColumn("value", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        runs.run_batches(broken, root, "d", "spark", run_id=4)
    run = runs.read_runs(spark, root).first()
    assert (run.run_id, run.total_runtime, run.total_record_count) == (4, 0.0, None)


@pytest.mark.parametrize("most", [0, 16 << 20])
def test_queries_beside_each_other(spark, tmp_path, monkeypatch, most):
    """The results of a load are the same whether its queries are one task each or not."""
    monkeypatch.setattr(runs, "ONE_TASK_BYTES", most)
    root, lines = str(tmp_path), make_lines(spark)
    no_host = F.when(F.col("value") != "junk", F.col("value")).otherwise(None)
    lines = lines.withColumn("value", F.when(F.col("batch_no") == 3, no_host).otherwise(F.col("value")))
    for _ in range(2):
        runs.run_batches(lines, root, "logs_150", "mr", run_id=1, beside=True)
    check_results(spark, root, lines)
    run = runs.read_runs(spark, root).first()
    assert (run.avg_batch_size, run.total_record_count, run.total_malformed_record_count) == (150.0, 600, 12)
    times = tables.read_metadata(spark, root, "query_metadata", 1).collect()
    assert sorted((r.batch_no, r.query_number) for r in times) == [(None, 1), (None, 2), (None, 3)]


def test_a_query_that_fails_beside_others(spark, tmp_path, monkeypatch):
    def broken(parsed, by=()):
        return traffic.daily_traffic(parsed, by).withColumn("log_date", F.raise_error(F.lit("no")))

    monkeypatch.setitem(runs.QUERIES, 1, {"daily_traffic": broken})
    root = str(tmp_path)
    with pytest.raises(Exception, match="no"):
        runs.run_batches(make_lines(spark), root, "logs_150", "mr", run_id=1, beside=True)
    assert tables.read_metadata(spark, root, "top_resources").isEmpty()
    assert runs.read_runs(spark, root).first().total_runtime == 0
