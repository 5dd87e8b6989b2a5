"""The batch jobs and the traffic queries on streams of log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loglark.functions.parsing import clock_date, clock_hour, event_time, valid_logs
from loglark.operators.traffic import daily_traffic, hourly_errors, is_error
from loglark.plans.run import run_batches
from loglark.session import new_folder
from loglark.sources.text import batch_columns


# The file source passes over files this much older than the newest it has seen.
ANY_AGE = "36500d"


def stream_batches(
    spark: SparkSession,
    folder: str,
    root: str,
    dataset: str,
    engine: str,
    run_id: int,
    queries: str = "all",
    files_per_trigger: int = 1,
    checkpoint: str | None = None,
    first_load: int = 0,
) -> StreamingQuery:
    """Process every batch file of a folder once, new ones included, then stop.

    Each batch is one file, so it is never split over triggers. The trigger number gives
    the load id: a trigger repeated after a failure replaces its own rows. A new checkpoint
    counts triggers from 0 again; for the same run give it a ``first_load`` above the old
    loads. Many small batches go faster with more files per trigger. The queries of a small
    trigger run side by side (``beside`` of ``run_batches``).
    """
    reader = (
        spark.readStream.option("pathGlobFilter", "*.txt")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("maxFileAge", ANY_AGE)
    )

    def load(lines: DataFrame, epoch: int) -> None:
        run_batches(lines, root, dataset, engine, run_id, first_load + epoch, queries, beside=True)

    return (
        batch_columns(reader.text(folder))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint or new_folder(spark, "stream-batches"))
        .trigger(availableNow=True)
        .start()
    )


def _timed(lines: DataFrame, delay: str, col: str) -> DataFrame:
    # Lines whose date or clock is not a real time belong to no window. Batch queries
    # keep them under their date text; here `undated` tells which they are.
    timed = lines.withColumn("event_time", event_time(F.col(col)))
    return valid_logs(timed, col, keep=("event_time",)).withWatermark("event_time", delay)


def undated(lines: DataFrame, col: str = "value") -> DataFrame:
    """Valid lines without a real event time, which the windowed queries cannot place."""
    timed = lines.withColumn("event_time", event_time(F.col(col)))
    return valid_logs(timed, col, keep=("event_time",)).where("event_time IS NULL").drop("event_time")


def _hour_hosts(lines: DataFrame, delay: str, col: str) -> DataFrame:
    # State is kept per (hour, error host): a busy hour is spread over all state
    # partitions, and error-free requests fold into one row of host null.
    error = is_error(F.col("status_code"))
    return (
        _timed(lines, delay, col)
        .groupBy(F.window("event_time", "1 hour"), F.when(error, F.col("host")).alias("host"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(error).alias("errors"))
    )


def stream_hourly_errors(lines: DataFrame, delay: str = "1 hour", col: str = "value") -> DataFrame:
    """Errors, requests, rate and distinct error hosts of each hour, once it has closed."""
    hours = (
        _hour_hosts(lines, delay, col)
        .groupBy(F.window(F.window_time("window"), "1 hour").alias("hour"))
        .agg(
            F.sum("errors").alias("error_request_count"),
            F.sum("n").alias("total_request_count"),
            F.count("host").alias("distinct_error_hosts"),
        )
    )
    rate = F.col("error_request_count").cast("double") / F.col("total_request_count")
    return hours.select(
        clock_date(F.col("hour.start")).alias("log_date"),
        clock_hour(F.col("hour.start")).alias("log_hour"),
        "error_request_count",
        "total_request_count",
        rate.alias("error_rate"),
        "distinct_error_hosts",
    )


def stream_error_hosts(lines: DataFrame, delay: str = "1 hour", col: str = "value") -> DataFrame:
    """The error hosts of each closed hour, one row per host with its errors."""
    # Filtering on the count, not the host, keeps the filter above the watermark, so
    # that error-free lines move time forward here as well.
    return (
        _hour_hosts(lines, delay, col)
        .where("errors > 0")
        .select(
            clock_date(F.col("window.start")).alias("log_date"),
            clock_hour(F.col("window.start")).alias("log_hour"),
            "host",
            F.col("errors").alias("error_request_count"),
        )
    )


def stream_daily_traffic(lines: DataFrame, delay: str = "1 hour", col: str = "value") -> DataFrame:
    """Requests and bytes of each day and status, once the day has closed."""
    return (
        _timed(lines, delay, col)
        .groupBy(F.window("event_time", "1 day"), "status_code")
        .agg(F.count(F.lit(1)).alias("request_count"), F.sum("bytes").alias("total_bytes"))
        .select(
            clock_date(F.col("window.start")).alias("log_date"),
            "status_code",
            "request_count",
            "total_bytes",
        )
    )


def write_closed(stream: DataFrame, folder: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append closed windows to Parquet, processing what is there and then stopping."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", folder)
        .option("checkpointLocation", checkpoint or new_folder(stream.sparkSession, "stream"))
        .trigger(availableNow=True)
        .start()
    )


def _dated(lines: DataFrame, col: str) -> DataFrame:
    timed = lines.withColumn("event_time", event_time(F.col(col)))
    return valid_logs(timed, col, keep=("event_time",)).where("event_time IS NOT NULL")


def _missing(rows: DataFrame, written: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(written.select(*keys).distinct(), keys, "left_anti")


def open_hours(lines: DataFrame, written: DataFrame, col: str = "value") -> DataFrame:
    """Rows of ``stream_hourly_errors`` for the hours that the stream has not written.

    A finite input ends before its last windows close. ``lines`` are all its lines, as a
    batch; appended to what is ``written``, the rows found complete it.
    """
    return _missing(hourly_errors(_dated(lines, col)), written, ["log_date", "log_hour"])


def open_days(lines: DataFrame, written: DataFrame, col: str = "value") -> DataFrame:
    """The same for ``stream_daily_traffic``."""
    return _missing(daily_traffic(_dated(lines, col)), written, ["log_date"])


def late_rows(lines: DataFrame, written: DataFrame, col: str = "value") -> DataFrame:
    """How many lines of each written hour came too late for it; hours without any are left out.

    ``lines`` are all lines the stream has read, as a batch, and ``written`` is what
    ``stream_hourly_errors`` made of them. The difference is exact over all triggers and
    restarts, which the counters of the query's progress are not.
    """
    keys = ["log_date", "log_hour"]
    come = _dated(lines, col).groupBy(*keys).agg(F.count(F.lit(1)).alias("come"))
    late = F.col("come") - F.col("total_request_count")
    return (
        come.join(written.select(*keys, "total_request_count"), keys)
        .select(*keys, late.alias("late_lines"))
        .where("late_lines > 0")
    )
