from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loglark.functions.names import batch_identity, dataset_base, split_hosts, target_batch_size
from loglark.operators import batching
from loglark.plans.run import split_dataset
from loglark.session import shared_folder
from loglark.sources.text import count_check, read_batches, read_raw, write_batches


def test_lines_are_numbered_in_file_order(spark, conf, tmp_path):
    conf(spark__sql__files__maxPartitionBytes="700", spark__sql__files__openCostInBytes="0")
    want = []
    for name in ("a.txt", "b.txt", "c.txt"):
        texts = [f"{name} line {i} " + "x" * (i % 37) for i in range(150)]
        (tmp_path / name).write_text("\n".join(texts) + "\n")
        want += texts
    lines = read_raw(spark, str(tmp_path), places=True)
    assert lines.rdd.getNumPartitions() > 10
    numbered = batching.number_lines(lines)
    got = {r.row_no: r.value for r in numbered.collect()}
    assert [got[i] for i in range(len(got))] == want
    batched = batching.assign_batches(numbered, 100)
    sizes = {r.batch_no: r["count"] for r in batched.groupBy("batch_no").count().collect()}
    assert sizes == {1: 100, 2: 100, 3: 100, 4: 100, 5: 50}
    stats = batching.dataset_stats(batched).first()
    assert tuple(stats) == (450, 5, 90.0)


def test_rows_are_numbered_in_key_order(spark):
    df = spark.range(5000).select((F.xxhash64("id") % 1000).alias("k"), "id")
    rows = batching.number_rows(df, F.desc("k"), "id").collect()
    order = sorted(((-r.k, r.id) for r in rows))
    assert [(-r.k, r.id) for r in sorted(rows, key=lambda r: r.row_no)] == order
    assert sorted(r.row_no for r in rows) == list(range(5000))


@pytest.mark.parametrize("limit", ["-1", "10MB"])
def test_rows_of_many_tasks_are_numbered_without_a_broadcast(spark, conf, monkeypatch, limit):
    conf(spark__sql__autoBroadcastJoinThreshold=limit)
    monkeypatch.setattr(batching, "TASK_BITS", 1)
    rows = batching.number_rows(spark.range(3000), F.desc("id"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (limit != "-1")
    assert {(r.id, r.row_no) for r in rows.collect()} == {(i, 2999 - i) for i in range(3000)}


def test_offsets_of_many_files_need_no_window_over_all(spark, conf):
    conf(spark__sql__shuffle__partitions="6", spark__sql__adaptive__coalescePartitions__enabled="false")
    groups = spark.range(2000).selectExpr("concat('file', lpad(id, 5, '0')) AS _g", "id % 7 AS _all")
    starts = batching._starts(groups.repartition(5))
    want, at = {}, 0
    for i in range(2000):
        want[f"file{i:05}"] = at
        at += i % 7
    assert {r["_g"]: r["_start"] for r in starts.collect()} == want
    plan = starts._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan
    assert batching._starts(groups.limit(0)).count() == 0


@pytest.mark.parametrize("one_file", [True, False])
def test_split_leaves_only_the_batches(spark, tmp_path, one_file):
    shared = Path(shared_folder(spark))
    before = set(shared.iterdir())
    (tmp_path / "web.log").write_text("".join(f"line {i}\n" for i in range(250)))
    folder = split_dataset(spark, str(tmp_path / "web.log"), str(tmp_path), 100, one_file=one_file)
    assert set(shared.iterdir()) == before
    lines = read_batches(spark, folder)
    assert sorted((r.batch_no, r["count"]) for r in lines.groupBy("batch_no").count().collect()) == [
        (1, 100), (2, 100), (3, 50)
    ]
    assert count_check(lines).isEmpty()
    short = count_check(lines.where("value <> 'line 7'"))
    assert [tuple(r) for r in short.collect()] == [(1, 100, 99)]


def test_batch_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        batching.assign_batches(spark.range(1), 0)


def test_empty_dataset(spark):
    assert tuple(batching.dataset_stats(spark.createDataFrame([], "batch_no int")).first()) == (0, 0, 0.0)


@pytest.mark.parametrize("one_file", [True, False])
def test_batches_round_trip(spark, tmp_path, one_file):
    df = spark.range(2500).selectExpr("id AS row_no", "concat('line ', id) AS value")
    folder = str(tmp_path / "data_300")
    write_batches(batching.assign_batches(df, 300), folder, one_file=one_file)
    back = read_batches(spark, folder)
    got = {(r.value, r.batch_no, r.declared_count) for r in back.collect()}
    assert got == {
        (f"line {i}", i // 300 + 1, 100 if i >= 2400 else 300) for i in range(2500)
    }
    for number, count in ((1, 300), (9, 100)):
        files = sorted((tmp_path / "data_300" / f"batch=b{number}_{count}").glob("*.txt"))
        assert not one_file or len(files) == 1
        texts = [t for f in files for t in f.read_text().splitlines()]
        start = (number - 1) * 300
        assert texts == [f"line {i}" for i in range(start, start + count)]


def test_plain_batch_files(spark, tmp_path):
    for name in ("b1_2.txt", "b10_1.txt", "temp_b3.txt", "notes.md", "odd.txt"):
        (tmp_path / name).write_text(f"{name}\n")
    got = {tuple(r) for r in read_batches(spark, str(tmp_path)).collect()}
    assert got == {("b1_2.txt", 1, 2), ("b10_1.txt", 10, 1), ("odd.txt", 0, 0)}


def java_identity(name):
    """The rule, step by step on positions."""

    def integer(text):
        return int(text) if text and text.lstrip("+-").isdigit() and text.isascii() else None

    b, u, d = name.find("b"), name.rfind("_"), name.rfind(".")
    number = integer(name[b + 1 : u]) if u >= b + 1 and u >= 0 else None
    if number is None:
        return 0, 0
    count = integer(name[u + 1 : d]) if d >= u + 1 else None
    return number, count or 0


def test_batch_identity(spark):
    cases = [
        "b1_500.txt", "b12_7.txt", "1_5.txt", "b1.txt", "bx_5.txt", "b5_x.txt", "b_5.txt", "b5_.txt",
        "web_b3_9.txt", "b3_9", "b3_9.old.txt", "b3.1_9.txt", "b99999999999_1.txt", "", "_", "b", "b-3_4.txt",
        "12_b.txt", "b1_2_3.txt",
    ]
    df = spark.createDataFrame([(c,) for c in cases], "n string")
    got = {r.n: (r.batch_no, r.declared_count) for r in df.select("n", batch_identity(F.col("n")).alias("b")).select("n", "b.*").collect()}
    want = {c: java_identity(c) for c in cases}
    want["b99999999999_1.txt"] = (0, 0)
    assert got == want


def test_dataset_names(spark):
    cases = {
        "logs_500": ("logs", 500),
        "a_b_10": ("a_b", 10),
        "plain": ("plain", None),
        "77": ("77", 77),
        "logs_": ("logs", None),
        "logs_5x": ("logs", None),
        "_9": ("", 9),
    }
    df = spark.createDataFrame([(c,) for c in cases], "n string")
    got = df.select("n", dataset_base(F.col("n")), target_batch_size(F.col("n"))).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == cases


def test_split_hosts(spark):
    cases = {"b, a,,null, b ,\tc": ["a", "b", "c"], "": [], " ": [], "null": [], None: []}
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = {r[0]: r[1] for r in df.select("t", split_hosts(F.col("t"))).collect()}
    assert got == cases
