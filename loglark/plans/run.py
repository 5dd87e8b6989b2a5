"""One run over a batched dataset: parse once, query per batch, keep results and timings."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglark.functions.parsing import count_quality, parse_logs
from loglark.operators.batching import assign_batches, dataset_stats, number_lines
from loglark.operators.runs import run_totals
from loglark.operators.traffic import (
    daily_traffic,
    error_hosts,
    hourly_errors,
    resource_totals,
    top_resource_hosts,
    top_resources,
)
from loglark.session import folder_bytes, side_by_side, staging
from loglark.sources.loads import load_aside, manifest
from loglark.sources.tables import (
    read_aside,
    read_metadata,
    read_parsed,
    read_quality,
    read_results,
    refuse_other_batches,
    table_exists,
    write_aside,
    write_parsed,
)
from loglark.sources.text import read_raw, write_batches

# The result tables of each query, in the order they are written.
QUERIES: dict[int, dict[str, Callable[..., DataFrame]]] = {
    1: {"daily_traffic": daily_traffic},
    2: {"top_resource_hosts": top_resource_hosts, "top_resources": top_resources},
    3: {"error_hosts": error_hosts, "hourly_errors": hourly_errors},
}
BY = ("batch_no",)

#: Parsed bytes up to which a query of a small load is one task: shuffles would take longer than its rows.
ONE_TASK_BYTES = 16 << 20


RUN_COLUMNS = (
    "run_id",
    "pipeline_name",
    "dataset_name",
    "avg_batch_size",
    "total_runtime",
    "total_malformed_record_count",
    "total_record_count",
    "execution_timestamp",
)
EMPTY_TOTALS = {
    "avg_batch_size": "double",
    "total_malformed_record_count": "bigint",
    "total_record_count": "bigint",
}


def select_queries(choice: str) -> list[int]:
    """``all`` or the number of one query."""
    if choice.lower() == "all":
        return list(QUERIES)
    if choice.isdecimal() and int(choice) in QUERIES:
        return [int(choice)]
    raise ValueError(f"queries must be 'all' or one of {list(QUERIES)}, not {choice!r}")


def split_dataset(
    spark: SparkSession, path: str, parent: str, n: int, one_file: bool = True
) -> str:
    """Cut a log file into batches of n lines in ``<parent>/<file name>_<n>``; gives that folder.

    ``one_file=False`` writes a batch as several files, for batches too large for one task.
    """
    name = path.rstrip("/").rsplit("/", 1)[-1]
    stem = name.rsplit(".", 1)[0] if "." in name else name
    folder = f"{parent.rstrip('/')}/{stem}_{n}"
    with staging(spark):
        lines = number_lines(read_raw(spark, path, places=True))
        write_batches(assign_batches(lines, n), folder, one_file=one_file)
    return folder


def run_batches(
    lines: DataFrame,
    root: str,
    dataset: str,
    engine: str,
    run_id: int,
    load_id: int = 0,
    queries: str = "all",
    separately: Sequence[int] = (),
    beside: bool = False,
) -> None:
    """Parse ``value, batch_no`` rows once, query them per batch, write results and metadata.

    All batches are computed together, grouped by ``batch_no``. The time of a query is
    then one number for the load, stored without a batch number, and batches have no
    runtime of their own. The batches listed in ``separately`` are instead queried one
    after the other, each as a load of its own from ``load_id`` on; that takes longer
    but times every query on every batch. A failing query raises and stores no time.

    ``beside`` is for many small loads, whose time is that of starting jobs: the queries of a load
    of at most ``ONE_TASK_BYTES`` run side by side, each in one task. The time of a query is then
    that which it took beside the others.

    Repeating a load replaces it wholly, whatever queries it had, at the end and in one step: until
    then, and if it fails, readers see the old one. A load id that holds other batches is
    refused. A new load begins with the run's row, with runtime 0 until the load ends, so a
    run that fails is seen as unfinished.
    """
    chosen = select_queries(queries)
    start = time.monotonic()
    began = {
        "pipeline_name": F.lit(engine.lower()),
        "dataset_name": F.lit(dataset),
        "avg_batch_size": F.lit(None),
        "total_runtime": F.lit(0.0),
        "total_malformed_record_count": F.lit(None),
        "total_record_count": F.lit(None),
        "execution_timestamp": F.current_timestamp(),
    }
    spark = lines.sparkSession
    ids = [load_id + i for i in range(max(1, len(separately)))]
    held = {e.load_id for e in manifest(spark, root) if e.run_id == run_id} & set(ids)
    for i in sorted(held):
        mine = spark.createDataFrame([(separately[i - load_id],)], "batch_no int") if separately else lines
        refuse_other_batches(spark, root, run_id, i, mine)
    parsed_path = f"{root}/parsed/run={run_id}/load={load_id}"

    def begin():
        with load_aside(spark, root, run_id, ids) as folder:
            write_aside(_one_row(spark).withColumns(began), folder, "run_metadata", run_id, load_id)

    def parse():
        write_parsed(parse_logs(lines.select("value", "batch_no")), parsed_path)

    with load_aside(spark, root, run_id, ids) as folder:
        side_by_side(spark, *([] if held else [begin]), parse)
        parsed, seen = read_parsed(spark, parsed_path), read_quality(spark, parsed_path)
        one_task = beside and not separately and folder_bytes(spark, parsed_path) <= ONE_TASK_BYTES
        run = side_by_side if one_task else _in_turn
        if one_task:
            parsed, seen = parsed.coalesce(1), seen.coalesce(1)
        if separately:
            for i, batch in zip(ids, separately, strict=True):
                mine = F.col("batch_no") == batch
                run(spark, *_load(parsed.where(mine), seen.where(mine), folder, run_id, i, chosen, batch)[1])
            size = dataset_stats(seen.where(F.col("batch_no").isin(*separately))).first().avg_batch_size
            notes = []
        else:
            size, notes = _load(parsed, seen, folder, run_id, load_id, chosen, one_task=one_task)

        def end():
            spent = {"avg_batch_size": F.lit(size), "total_runtime": F.lit(time.monotonic() - start)}
            write_aside(_one_row(spark).withColumns({**began, **spent}), folder, "run_metadata", run_id, load_id)

        run(spark, *notes, end)


def _one_row(spark: SparkSession) -> DataFrame:
    # Constants beside it are folded into its values. Beside a range they would stand in generated
    # code, which is then compiled anew for every load.
    return spark.sql("SELECT * FROM VALUES (0) AS one(id)")


def _in_turn(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    return [job() for job in jobs]


def _load(
    parsed: DataFrame,
    seen: DataFrame,
    folder: str,
    run_id: int,
    load_id: int,
    chosen: Sequence[int],
    batch: int | None = None,
    one_task: bool = False,
) -> tuple[float | None, list[Callable[[], None]]]:
    """Write the results of a load.

    Gives its mean batch size, unless it is told which ``batch`` it is, and the jobs that write its
    batches and times, which are left to do.
    """
    spark, run = parsed.sparkSession, side_by_side if one_task else _in_turn

    def sizes():  # a load of one batch times that batch
        stats = dataset_stats(seen).first()
        return stats.avg_batch_size, seen.first().batch_no if stats.total_batches == 1 else None

    queries = [partial(_query, parsed, folder, run_id, load_id, q, one_task) for q in chosen]
    if batch is None:
        (size, batch), *spent = run(spark, sizes, *queries)
    else:
        size, spent = None, run(spark, *queries)

    def write_batch_rows():
        batches = count_quality(seen).select(
            "batch_no",
            F.col("total_records").alias("record_count"),
            F.col("malformed_records").alias("malformed_record_count"),
            F.lit(sum(spent) / 1000 if batch is not None else None).alias("batch_runtime"),
        )
        write_aside(batches, folder, "batch_metadata", run_id, load_id)

    def write_times():
        rows = [F.struct(F.lit(batch), F.lit(q), F.lit(ms)) for q, ms in zip(chosen, spent, strict=True)]
        times = _one_row(spark).select(F.inline(F.array(*rows)))
        write_aside(times.toDF("batch_no", "query_number", "query_runtime"), folder, "query_metadata", run_id, load_id)

    return size, [write_batch_rows, write_times]


def _query(parsed: DataFrame, folder: str, run_id: int, load_id: int, number: int, one_task: bool) -> float:
    """Write the tables of a query; the milliseconds that took."""
    start = time.monotonic()

    def write(name, query):
        if query is top_resources and not one_task:  # its rows sum the host rows just written
            hosts = read_aside(parsed.sparkSession, folder, "top_resource_hosts", load_id)
            results = resource_totals(hosts, BY)
        else:
            results = query(parsed, by=BY)
        write_aside(results, folder, name, run_id, load_id)

    run = side_by_side if one_task else _in_turn
    run(parsed.sparkSession, *[partial(write, name, query) for name, query in QUERIES[number].items()])
    return (time.monotonic() - start) * 1000


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """One row per run over all its loads, also of a run that has stored no batch yet.

    Runtimes add up; record counts come from the batches, each counted by its newest load.
    """
    loads = (
        read_metadata(spark, root, "run_metadata")
        .groupBy("run_id")
        .agg(
            F.max_by("pipeline_name", "load_id").alias("pipeline_name"),
            F.max_by("dataset_name", "load_id").alias("dataset_name"),
            F.sum("total_runtime").alias("total_runtime"),
            F.max("execution_timestamp").alias("execution_timestamp"),
        )
    )
    if not table_exists(spark, root, "batch_metadata"):
        none = {c: F.lit(None).cast(t) for c, t in EMPTY_TOTALS.items()}
        return loads.withColumns(none).select(*RUN_COLUMNS)
    batches = read_results(spark, root, "batch_metadata")
    sizes = batches.groupBy("run_id").agg(F.avg("record_count").alias("avg_batch_size"))
    totals = run_totals(batches).drop("total_runtime").join(sizes, "run_id")
    return loads.join(totals, "run_id", "left").select(*RUN_COLUMNS)


def read_run_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables below ``root`` as the arguments of ``reports.all_reports``."""
    return {
        "runs": read_runs(spark, root),
        "batches": read_results(spark, root, "batch_metadata"),
        "timings": read_metadata(spark, root, "query_metadata"),
        "daily": read_results(spark, root, "daily_traffic"),
        "top": read_results(spark, root, "top_resources"),
        "top_hosts": read_results(spark, root, "top_resource_hosts"),
        "hours": read_results(spark, root, "hourly_errors"),
        "hour_hosts": read_results(spark, root, "error_hosts"),
    }
