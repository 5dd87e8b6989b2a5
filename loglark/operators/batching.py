"""Numbering rows and cutting them into batches without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from loglark.session import staged

#: Sorted rows are counted up over groups of 2 ** TASK_BITS tasks, then over the tasks of a group.
TASK_BITS = 10


def _task():
    """The task that gave a row its ``_row`` id, which counts up within the task."""
    return F.shiftright("_row", 33)


def _offset_rows(rows: DataFrame, group: Column, inside: Column) -> DataFrame:
    """Add ``row_no`` (from 0) to stored rows with a ``_row`` id.

    ``group`` and ``inside`` tell runs of consecutive rows apart and sort them. Lengths are
    added up by a tree: over sorted ranges of groups, inside each range, then over the runs of
    each group. No window sees all groups, and no task all runs.
    """
    length = F.col("_last") - F.col("_first") + 1
    runs = rows.groupBy(group.alias("_g"), inside.alias("_o"), _task().alias("_t")).agg(
        F.min("_row").alias("_first"), F.max("_row").alias("_last")
    )
    runs = staged(runs.withColumn("_n", length), "runs")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    starts = _starts(runs.groupBy("_g").agg(F.sum("_n").alias("_all")))
    earlier = _sum_of("_n", before.partitionBy("_g").orderBy("_o"))
    offsets = runs.join(starts, "_g").select(
        "_t", "_first", "_last", (F.col("_start") + earlier).alias("_offset")
    )
    at = (_task() == F.col("_t")) & F.col("_row").between(F.col("_first"), F.col("_last"))
    return (
        rows.join(staged(offsets, "offsets"), at)
        .withColumn("row_no", F.col("_offset") + F.col("_row") - F.col("_first"))
        .drop("_row", "_t", "_first", "_last", "_offset")
    )


def _starts(groups: DataFrame) -> DataFrame:
    """(_g, _start): the sum of ``_all`` over the groups that sort before.

    The groups are sorted once over tasks and written; the sums of the tasks, a row each, are
    added up in the driver.
    """
    placed = staged(groups.orderBy("_g").withColumn("_row", F.monotonically_increasing_id()), "groups")
    placed = placed.withColumn("_range", _task())
    sums = placed.groupBy("_range").agg(F.sum("_all").alias("_all")).orderBy("_range").collect()
    at, bases = 0, []
    for row in sums:
        bases.append((row["_range"], at))
        at += row["_all"]
    bases = groups.sparkSession.createDataFrame(bases, "_range bigint, _base bigint")
    inside = Window.partitionBy("_range").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(bases, "_range").select("_g", (F.col("_base") + _sum_of("_all", inside)).alias("_start"))


def _sum_of(name: str, window: WindowSpec) -> Column:
    return F.coalesce(F.sum(name).over(window), F.lit(0))


def number_rows(df: DataFrame, *order: str | Column) -> DataFrame:
    """Add ``row_no`` from 0 in the given order, which should be unique for each row.

    The rows are range-partitioned and sorted once and written to the shared folder;
    both passes over them then see the same ids.
    """
    placed = df.sort(*order).withColumn("_row", F.monotonically_increasing_id())
    tasks = F.shiftright(_task(), TASK_BITS)
    return _offset_rows(staged(placed, "numbered"), tasks, _task())


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``row_no`` in file order to lines from ``sources.text.read_raw(..., places=True)``.

    No sort is needed: lines of one split are already in order, and splits are ordered
    by file and start.
    """
    placed = lines.withColumn("_row", F.monotonically_increasing_id())
    numbered = _offset_rows(staged(placed, "lines"), F.col("file_path"), F.col("block_start"))
    return numbered.drop("file_path", "block_start")


def assign_batches(numbered: DataFrame, n: int) -> DataFrame:
    """Consecutive rows in groups of n: ``batch_no`` from 1, a short last batch allowed."""
    if n < 1:
        raise ValueError("batch size must be at least 1")
    return numbered.withColumn("batch_no", F.expr(f"CAST(row_no DIV {int(n)} + 1 AS INT)"))


def dataset_stats(batched: DataFrame) -> DataFrame:
    """Records, non-empty batches and the mean batch size, counted from the data."""
    sizes = batched.groupBy("batch_no").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.count(F.lit(1)).alias("total_batches"),
        F.coalesce(F.avg("n"), F.lit(0.0)).alias("avg_batch_size"),
    )
