"""Run bookkeeping: which runs count, which is the latest, and their totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The engine labels reports are made for, in report order.
ENGINES = ("mr", "pig", "hive", "mongodb")


def finished_runs(runs: DataFrame) -> DataFrame:
    """Runs with a runtime."""
    return runs.where(F.col("total_runtime") > 0)


def successful_runs(runs: DataFrame, min_records: int | None = None) -> DataFrame:
    """Finished runs that parsed something; or, with ``min_records``, finished runs larger than that."""
    done = finished_runs(runs)
    if min_records is not None:
        return done.where(F.col("total_record_count") > min_records)
    return done.where(F.col("total_malformed_record_count") < F.col("total_record_count"))


def latest_runs(runs: DataFrame, keys: Sequence[str] = ("dataset_name", "pipeline_name")) -> DataFrame:
    """The newest run of each key; of runs at the same time the highest id.

    ``max_by`` combines on the map side, so a key with most of the runs stays cheap.
    """
    rest = [c for c in runs.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct("execution_timestamp", "run_id"))
    picked = runs.groupBy(*keys).agg(newest.alias("r"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"r.{c}") for c in runs.columns])


def batch_totals(stats: DataFrame) -> DataFrame:
    """Stat events folded per batch: runtimes add up, counts keep their greatest value."""
    return stats.groupBy("run_id", "batch_no").agg(
        F.max("record_count").alias("record_count"),
        F.max("malformed_record_count").alias("malformed_record_count"),
        F.sum("batch_runtime").alias("batch_runtime"),
    )


def run_totals(batches: DataFrame) -> DataFrame:
    """Batch rows folded per run: everything adds up."""
    return batches.groupBy("run_id").agg(
        F.sum("batch_runtime").alias("total_runtime"),
        F.sum("malformed_record_count").alias("total_malformed_record_count"),
        F.sum("record_count").alias("total_record_count"),
    )
