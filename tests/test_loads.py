"""Atomic loads: what readers see while a load is written, fails, is repeated, merged and cleared away."""

import pytest
from pyspark.sql import functions as F

from loglark.operators import traffic
from loglark.plans import run as runs
from loglark.sources import loads, tables
from test_run import check_results, make_lines, stored

NAMES = ("daily_traffic", "top_resources", "top_resource_hosts", "hourly_errors", "error_hosts", "batch_metadata")


def everything(spark, root):
    return {name: stored(spark, root, name) for name in NAMES}


def broken(parsed, by=()):
    return traffic.hourly_errors(parsed, by).withColumn("log_hour", F.raise_error(F.lit("no")))


def test_a_repeat_that_fails_leaves_the_old_load(spark, tmp_path, monkeypatch):
    root, lines = str(tmp_path), make_lines(spark)
    runs.run_batches(lines, root, "logs_150", "mr", run_id=1)
    before, version = everything(spark, root), loads.versions(spark, root)
    with monkeypatch.context() as patch:
        # The tables before this one are written already when it fails.
        patch.setitem(runs.QUERIES, 3, {"error_hosts": traffic.error_hosts, "hourly_errors": broken})
        with pytest.raises(Exception):
            runs.run_batches(lines, root, "logs_150", "mr", run_id=1)
    assert everything(spark, root) == before and loads.versions(spark, root) == version
    assert runs.read_runs(spark, root).first().total_runtime > 0
    assert {e.folder for e in loads.manifest(spark, root)} == {str(p) for p in (tmp_path / "loads").iterdir()} - {
        e.folder for v in version[:-1] for e in loads.manifest(spark, root, v)
    }
    runs.run_batches(lines, root, "logs_150", "mr", run_id=1)
    check_results(spark, root, lines)


def test_a_reader_keeps_its_snapshot(spark, tmp_path):
    root, lines = str(tmp_path), make_lines(spark)
    runs.run_batches(lines, root, "logs_150", "mr", run_id=1, queries="1")
    seen = tables.read_metadata(spark, root, "daily_traffic")
    rows = sorted(map(tuple, seen.collect()))
    runs.run_batches(lines.withColumn("value", F.lit("junk")), root, "logs_150", "mr", run_id=1, queries="1")
    assert sorted(map(tuple, seen.collect())) == rows and rows
    assert tables.read_metadata(spark, root, "daily_traffic").count() == 0


def test_one_of_several_loads_of_a_folder_is_repeated(spark, tmp_path):
    root, lines = str(tmp_path), make_lines(spark)
    runs.run_batches(lines.withColumn("value", F.when(F.col("batch_no") == 2, "junk").otherwise(F.col("value"))),
                     root, "logs_150", "mr", run_id=1, separately=[1, 2, 3, 4])
    runs.run_batches(lines.where("batch_no = 2"), root, "logs_150", "mr", run_id=1, load_id=1, separately=[2])
    check_results(spark, root, lines)
    assert tables.read_metadata(spark, root, "batch_metadata", 1).count() == 4


def test_loads_are_merged(spark, tmp_path):
    root, lines = str(tmp_path), make_lines(spark)
    spoiled = lines.withColumn("value", F.when(F.col("batch_no") == 2, "junk").otherwise(F.col("value")))
    runs.run_batches(spoiled, root, "logs_150", "mr", run_id=1)
    runs.run_batches(lines, root, "logs_150", "pig", run_id=2, queries="1")
    runs.run_batches(lines.where("batch_no = 2"), root, "logs_150", "mr", run_id=1, load_id=3)
    before, own = everything(spark, root), runs.read_runs(spark, root).orderBy("run_id").collect()
    old = tables.read_metadata(spark, root, "daily_traffic", 1)
    assert tables.compact_loads(spark, root, 1) == 2 and tables.compact_loads(spark, root, 1) == 0
    assert everything(spark, root) == before and old.count() > 0
    assert runs.read_runs(spark, root).orderBy("run_id").collect() == own
    merged = [e for e in loads.manifest(spark, root) if e.run_id == 1]
    assert [(e.load_id, e.merged) for e in merged] == [(3, (0,))]
    with pytest.raises(ValueError, match="merged"):
        runs.run_batches(lines, root, "logs_150", "mr", run_id=1, load_id=0)
    runs.run_batches(spoiled.where("batch_no = 2"), root, "logs_150", "mr", run_id=1, load_id=4)
    assert not any(r[0] == 2 for r in stored(spark, root, "daily_traffic"))
    gone = loads.vacuum(spark, root)
    assert len(gone) >= 3 and len(loads.versions(spark, root)) == 1
    assert not any(r[0] == 2 for r in stored(spark, root, "daily_traffic")) and stored(spark, root, "daily_traffic", 2)


def test_versions_of_two_writers(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    a, b = loads.Entry(1, 0, "a"), loads.Entry(2, 0, "b", (7, 8))
    assert loads.manifest(spark, root) == [] and loads.vacuum(spark, root) == []
    assert loads.commit(spark, root, [a]) == 1
    put = loads._put

    def late(spark, root, version, entries):
        # Another writer puts this version in place first, once.
        if version == 2:
            monkeypatch.setattr(loads, "_put", put)
            assert put(spark, root, 2, [a, loads.Entry(3, 0, "c")])
        return put(spark, root, version, entries)

    monkeypatch.setattr(loads, "_put", late)
    assert loads.commit(spark, root, [b]) == 3
    assert loads.manifest(spark, root) == [a, loads.Entry(3, 0, "c"), b]
    assert loads.manifest(spark, root, 1) == [a]


def test_a_look_at_the_manifest_is_as_many_calls_for_any_number_of_versions(spark, tmp_path, monkeypatch):
    from py4j.clientserver import ClientServerConnection as Connection

    sent, send = [], Connection.send_command
    # Objects that Python gives up are told to Java at any time; those calls are not counted.
    monkeypatch.setattr(
        Connection, "send_command", lambda self, c, *a: (c.startswith("m\n") or sent.append(c), send(self, c, *a))[1]
    )

    def calls(root):
        del sent[:]
        loads.versions(spark, root)
        return len(sent)

    few, many = str(tmp_path / "few,v7.json"), str(tmp_path / "many")
    for root, n in ((few, 2), (many, 30)):
        for version in range(1, n + 1):
            assert loads._put(spark, root, version, [])
        assert loads.versions(spark, root) == list(range(1, n + 1))
    assert calls(many) == calls(few) > 0
