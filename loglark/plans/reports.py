"""Reports over run bookkeeping: each is a table, ready for a chart.

``runs``, ``batches`` and ``timings`` are the run, batch and query metadata tables;
``run_id`` names the target run. The target is one row (``run_id`` is the key), so it
is broadcast; everything else is joined as its size allows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from loglark.functions.names import dataset_base, target_batch_size
from loglark.operators import digests
from loglark.operators.runs import ENGINES, finished_runs, latest_runs, successful_runs

# How large a run must be to compare with, the scorecard's verdicts, and the
# names of the two kinds of series in the batch comparison.
COMPARISON_MIN_RECORDS = 1000
BASELINE, MATCH, MISMATCH, NO_HISTORY = "BASELINE", "MATCH", "MISMATCH", "NO_HISTORY"
TARGET_SERIES, FASTEST_SERIES = "Target Exec", "Fastest Exec"


def _target(runs: DataFrame, run_id: int) -> DataFrame:
    return runs.where(F.col("run_id") == run_id)


def _on_dataset(runs: DataFrame, target: DataFrame) -> DataFrame:
    """Runs of the target's dataset by other engines."""
    key = target.select(
        F.col("dataset_name").alias("_dataset"), F.lower("pipeline_name").alias("_engine")
    )
    matches = (F.col("dataset_name") == F.col("_dataset")) & (
        F.col("pipeline_name") != F.col("_engine")
    )
    return runs.join(F.broadcast(key), matches, "left_semi")


def _competitors(runs: DataFrame, run_id: int) -> DataFrame:
    """The latest successful run of every other engine on the target's dataset."""
    others = _on_dataset(successful_runs(runs), _target(runs, run_id))
    return latest_runs(others, ["pipeline_name"])


def run_history(runs: DataFrame) -> DataFrame:
    """Finished runs, newest id first."""
    return (
        finished_runs(runs)
        .select(
            "run_id",
            F.col("pipeline_name").alias("pipeline"),
            F.col("dataset_name").alias("dataset"),
            F.col("execution_timestamp").alias("timestamp"),
        )
        .orderBy(F.desc("run_id"))
    )


def run_history_json(runs: DataFrame) -> DataFrame:
    """The history as one JSON object per run, newest first."""
    micros = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    text = F.regexp_replace(micros, r"0{1,5}$", "")
    return run_history(runs).select(
        "run_id",
        F.to_json(
            F.struct(F.col("run_id").alias("id"), "pipeline", "dataset", text.alias("timestamp"))
        ).alias("json"),
    )


def _engine_rows(runs: DataFrame, run_id: int, engines: Sequence[str]) -> DataFrame:
    """One row per engine: the target for its own engine, else the latest successful run.

    The listed engines come first, with or without a run, then by name all others that
    have one; so the target always has its row. No rows when there is no such run.
    """
    target = _target(runs, run_id)
    listed = target.select(F.posexplode(F.array(*map(F.lit, engines))).alias("pos", "engine"))
    chosen = target.withColumns(
        {"engine": F.lower("pipeline_name"), "is_baseline": F.lit(True)}
    ).unionByName(
        _competitors(runs, run_id).withColumns(
            {"engine": F.col("pipeline_name"), "is_baseline": F.lit(False)}
        )
    )
    others = chosen.where(~F.col("engine").isin(*engines)).withColumn("pos", F.lit(len(engines)))
    return (
        listed.join(chosen, "engine", "left")
        .unionByName(others)
        .withColumn("is_baseline", F.coalesce("is_baseline", F.lit(False)))
    )


def data_quality(runs: DataFrame, run_id: int, engines: Sequence[str] = ENGINES) -> DataFrame:
    """Valid and malformed lines of the target and of each other engine's latest successful run."""
    return (
        _engine_rows(runs, run_id, engines)
        .orderBy("pos", "engine")
        .select(
            "engine",
            "run_id",
            (F.col("total_record_count") - F.col("total_malformed_record_count")).alias("valid"),
            F.col("total_malformed_record_count").alias("malformed"),
            "is_baseline",
            F.col("run_id").isNotNull().alias("has_history"),
        )
    )


def engine_comparison(runs: DataFrame, run_id: int) -> DataFrame:
    """Total runtime of the target and of the latest successful run of every other engine."""
    columns = [F.col("pipeline_name").alias("pipeline"), "run_id", "total_runtime"]
    return _target(runs, run_id).select(*columns).unionByName(
        _competitors(runs, run_id).select(*columns)
    )


def query_totals(timings: DataFrame, run_id: int) -> DataFrame:
    """Time per query of a run, summed over its batches."""
    return (
        _target(timings, run_id)
        .groupBy("query_number")
        .agg(F.sum("query_runtime").alias("total_time"))
        .orderBy("query_number")
    )


def batch_query_times(timings: DataFrame, run_id: int) -> DataFrame:
    """Time of each query on each batch of a run."""
    return (
        _target(timings, run_id)
        .select("batch_no", "query_number", "query_runtime")
        .orderBy("batch_no", "query_number")
    )


def batch_query_times_wide(timings: DataFrame, run_id: int) -> DataFrame:
    """The same with one column per query."""
    return (
        _target(timings, run_id)
        .groupBy("batch_no")
        .pivot("query_number", [1, 2, 3])
        .agg(F.sum("query_runtime"))
        .select("batch_no", *[F.col(str(q)).alias(f"q{q}") for q in (1, 2, 3)])
        .orderBy("batch_no")
    )


def cross_engine_timing(runs: DataFrame, timings: DataFrame, run_id: int) -> DataFrame:
    """Mean time per query of the target and of the latest successful run of every other engine."""
    chosen = (
        _target(runs, run_id)
        .select("run_id", "pipeline_name")
        .unionByName(_competitors(runs, run_id).select("run_id", "pipeline_name"))
    )
    return (
        timings.join(F.broadcast(chosen), "run_id")  # one row per engine
        .groupBy(F.col("pipeline_name").alias("pipeline"), "query_number")
        .agg(F.avg("query_runtime").alias("avg_time"))
        .orderBy("pipeline", "query_number")
    )


def _summaries(chosen: DataFrame, batches: DataFrame) -> DataFrame:
    counts = (
        batches.join(F.broadcast(chosen.select("run_id")), "run_id", "left_semi")
        .groupBy("run_id")
        .agg(F.count(F.lit(1)).alias("total_batches"))
    )
    return chosen.join(counts, "run_id", "left").select(
        "run_id",
        F.col("pipeline_name").alias("pipeline"),
        F.col("dataset_name").alias("dataset"),
        F.coalesce("total_batches", F.lit(0).cast("bigint")).alias("total_batches"),
        "avg_batch_size",
        "total_runtime",
        F.col("total_malformed_record_count").alias("total_malformed"),
    )


def run_summary(runs: DataFrame, batches: DataFrame, run_id: int) -> DataFrame:
    """One row about the target run."""
    return _summaries(_target(runs, run_id), _target(batches, run_id))


def run_comparison(
    runs: DataFrame,
    batches: DataFrame,
    run_id: int,
    min_records: int = COMPARISON_MIN_RECORDS,
) -> DataFrame:
    """The same about the latest large run of every other engine, fastest first."""
    others = _on_dataset(successful_runs(runs, min_records), _target(runs, run_id))
    latest = latest_runs(others, ["pipeline_name"])
    return _summaries(latest, batches).orderBy("total_runtime", "run_id")


def _family(runs: DataFrame, run_id: int, min_records: int) -> DataFrame:
    """One run per dataset of the target's family by its engine: the target, else the latest.

    The datasets of a family share their base name and differ in batch size.
    """
    target = _target(runs, run_id)
    key = target.select(
        F.lower("pipeline_name").alias("_engine"),
        F.concat(dataset_base(F.col("dataset_name")), F.lit("_")).alias("_prefix"),
    )
    related = (F.col("pipeline_name") == F.col("_engine")) & F.col("dataset_name").startswith(
        F.col("_prefix")
    )
    others = (
        successful_runs(runs, min_records)
        .where(F.col("run_id") != run_id)
        .join(F.broadcast(key), related, "left_semi")
    )
    both = target.withColumn("is_target", F.lit(True)).unionByName(
        others.withColumn("is_target", F.lit(False))
    )
    newest = F.struct("is_target", "execution_timestamp", "run_id")
    picked = F.struct("run_id", "total_runtime", "total_record_count")
    return (
        both.groupBy("dataset_name")
        .agg(F.max_by(picked, newest).alias("r"))
        .select("dataset_name", "r.*")
    )


def _by_batch_size(family: DataFrame, value: Column, name: str) -> DataFrame:
    # Two datasets of a family may end in the same number; the last by name counts.
    return (
        family.withColumn("target_batch_size", target_batch_size(F.col("dataset_name")))
        .where(F.col("target_batch_size").isNotNull())
        .groupBy("target_batch_size")
        .agg(F.max_by(value, "dataset_name").alias(name))
        .orderBy("target_batch_size")
    )


def batch_size_runtime(
    runs: DataFrame, run_id: int, min_records: int = COMPARISON_MIN_RECORDS
) -> DataFrame:
    """Total runtime by batch size over the target's dataset family."""
    family = _family(runs, run_id, min_records)
    return _by_batch_size(family, F.col("total_runtime"), "total_runtime")


def batch_size_avg_time(
    runs: DataFrame, batches: DataFrame, run_id: int, min_records: int = COMPARISON_MIN_RECORDS
) -> DataFrame:
    """Mean batch runtime by batch size; null for a run whose batches were not timed."""
    family = _family(runs, run_id, min_records)
    means = (
        batches.where("batch_runtime IS NOT NULL")
        .join(F.broadcast(family.select("run_id")), "run_id", "left_semi")  # one run per dataset
        .groupBy("run_id")
        .agg(F.avg("batch_runtime").alias("_mean"))
    )
    return _by_batch_size(family.join(means, "run_id", "left"), F.col("_mean"), "avg_batch_time")


def batch_size_throughput(
    runs: DataFrame, run_id: int, min_records: int = COMPARISON_MIN_RECORDS
) -> DataFrame:
    """Records per second by batch size; null without a runtime."""
    family = _family(runs, run_id, min_records)
    rate = F.try_divide(F.col("total_record_count").cast("double"), F.col("total_runtime"))
    return _by_batch_size(family, rate, "records_per_second")


def batch_view(batches: DataFrame, run_id: int) -> DataFrame:
    """The batches of a run in order."""
    return (
        _target(batches, run_id)
        .select(
            "batch_no",
            "record_count",
            "batch_runtime",
            F.col("malformed_record_count").alias("malformed"),
        )
        .orderBy("batch_no")
    )


def batch_comparison(runs: DataFrame, batches: DataFrame, run_id: int) -> DataFrame:
    """Batch runtimes of the target and of the fastest run of every other engine on its dataset.

    Batches that were not timed are left out, and a run with none that was is not compared.
    """
    batches = batches.where("batch_runtime IS NOT NULL")
    target = _target(runs, run_id)
    others = _on_dataset(runs, target).select("run_id", "pipeline_name")
    totals = batches.join(others, "run_id").groupBy("pipeline_name", "run_id").agg(
        F.sum("batch_runtime").alias("total")
    )
    fastest = totals.groupBy("pipeline_name").agg(
        F.min_by("run_id", F.struct("total", "run_id")).alias("run_id")
    )

    def series(rows: DataFrame, kind: str) -> DataFrame:
        label = F.concat(
            F.upper("pipeline_name"), F.lit(f" ({kind}: "), F.col("run_id"), F.lit(")")
        )
        return rows.select("run_id", label.alias("series"))

    chosen = series(target, TARGET_SERIES).unionByName(series(fastest, FASTEST_SERIES))
    return (
        batches.join(F.broadcast(chosen), "run_id")  # one run per engine
        .select("series", "batch_no", "batch_runtime")
        .orderBy("series", "batch_no")
    )


def integrity_scorecard(
    runs: DataFrame,
    daily: DataFrame,
    top: DataFrame,
    top_hosts: DataFrame,
    hours: DataFrame,
    hour_hosts: DataFrame,
    run_id: int,
    engines: Sequence[str] = ENGINES,
) -> DataFrame:
    """Whether each engine's latest successful run gave the target's merged results.

    Results of the compared runs (at most one per engine) are compared by digests, which need no
    merging; hosts are counted only where host rows differ. The engines are read first, so
    this is not lazy. See ``digests.result_differences`` for what differs.
    """
    rows = _engine_rows(runs, run_id, engines).orderBy("pos", "engine").collect()  # one per engine
    compared = [r.run_id for r in rows if r.run_id is not None]
    tables = _compared(daily, top, top_hosts, hours, hour_hosts, compared)
    unequal = digests.unequal_runs(tables, run_id, compared) if len(compared) > 1 else set()

    def status(row: Row) -> str:
        if row.is_baseline:
            return BASELINE
        if row.run_id is None:
            return NO_HISTORY
        return MISMATCH if row.run_id in unequal else MATCH

    found = [(r.engine, r.run_id, status(r)) for r in rows]
    return runs.sparkSession.createDataFrame(found, "engine string, run_id bigint, status string").coalesce(1)


def _compared(
    daily: DataFrame, top: DataFrame, top_hosts: DataFrame, hours: DataFrame, hour_hosts: DataFrame, run_ids: Sequence[int]
) -> dict[str, DataFrame]:
    """The result tables with the rows of some runs."""
    tables = dict(zip(digests.PARTS, (daily, top, top_hosts, hours, hour_hosts), strict=True))
    return {name: rows.where(F.col("run_id").isin(*run_ids)) for name, rows in tables.items()}


def result_differences(
    runs: DataFrame,
    daily: DataFrame,
    top: DataFrame,
    top_hosts: DataFrame,
    hours: DataFrame,
    hour_hosts: DataFrame,
    run_id: int,
    engines: Sequence[str] = ENGINES,
) -> DataFrame:
    """What makes a run of the scorecard a mismatch: every number that differs, with both values."""
    compared = [r.run_id for r in _engine_rows(runs, run_id, engines).where(F.col("run_id").isNotNull()).collect()]
    return digests.result_differences(_compared(daily, top, top_hosts, hours, hour_hosts, compared), run_id, compared)


def all_clear(scorecard: DataFrame) -> DataFrame:
    """One row: true when no engine disagrees."""
    return scorecard.agg((F.count_if(F.col("status") == MISMATCH) == 0).alias("all_clear"))


def all_reports(
    runs: DataFrame,
    batches: DataFrame,
    timings: DataFrame,
    daily: DataFrame,
    top: DataFrame,
    top_hosts: DataFrame,
    hours: DataFrame,
    hour_hosts: DataFrame,
    run_id: int,
    engines: Sequence[str] = ENGINES,
) -> dict[str, DataFrame]:
    """Every report about one run; ``engines`` are listed whether they have a run or not."""
    return {
        "run_history": run_history(runs),
        "run_summary": run_summary(runs, batches, run_id),
        "run_comparison": run_comparison(runs, batches, run_id),
        "batch_size_throughput": batch_size_throughput(runs, run_id),
        "batch_view": batch_view(batches, run_id),
        "batch_comparison": batch_comparison(runs, batches, run_id),
        "data_quality": data_quality(runs, run_id, engines),
        "engine_comparison": engine_comparison(runs, run_id),
        "query_totals": query_totals(timings, run_id),
        "batch_query_times": batch_query_times(timings, run_id),
        "cross_engine_timing": cross_engine_timing(runs, timings, run_id),
        "batch_size_runtime": batch_size_runtime(runs, run_id),
        "batch_size_avg_time": batch_size_avg_time(runs, batches, run_id),
        "integrity_scorecard": integrity_scorecard(
            runs, daily, top, top_hosts, hours, hour_hosts, run_id, engines
        ),
    }
