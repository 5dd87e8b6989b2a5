"""Reading and writing log text: raw files, batch folders, parsed rows as TSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loglark.functions.names import batch_identity, join_hosts, split_hosts
from loglark.schemas import PARSED


def read_raw(spark: SparkSession, path: str, places: bool = False) -> DataFrame:
    """A text file or folder as ``value`` rows.

    With ``places`` each row also tells its file and the start of its split, which
    ``operators.batching.number_lines`` needs.
    """
    lines = spark.read.text(path)
    if not places:
        return lines
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def batch_columns(lines: DataFrame) -> DataFrame:
    """Batch number and declared count of text rows, from the name their file was given.

    A batch is a file ``b<id>_<count>.txt``, or a folder ``batch=b<id>_<count>`` as
    ``write_batches`` makes them. Unfinished files (``temp_...``) are left out.
    """
    folder = F.regexp_extract("_metadata.file_path", r"/batch=([^/]+)/[^/]*\z", 1)
    name = F.when(folder != "", F.concat(folder, F.lit(".txt"))).otherwise(
        F.col("_metadata.file_name")
    )
    return (
        lines.where(~F.col("_metadata.file_name").startswith("temp_"))
        .select("value", batch_identity(name).alias("b"))
        .select("value", "b.batch_no", "b.declared_count")
    )


def read_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The finished ``*.txt`` batch files of a folder as ``value, batch_no, declared_count``."""
    reader = spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true")
    return batch_columns(reader.text(folder))


def count_check(lines: DataFrame) -> DataFrame:
    """Batches of ``read_batches`` whose lines are not as many as their name declares.

    A file without lines gives no row here, as it gives none there.
    """
    counted = lines.groupBy("batch_no", "declared_count").agg(F.count(F.lit(1)).alias("lines"))
    return counted.where(F.col("lines") != F.col("declared_count"))


def write_batches(
    batched: DataFrame, folder: str, col: str = "value", one_file: bool = True
) -> None:
    """Write numbered, batched lines as one folder ``batch=b<id>_<count>`` per batch.

    Each batch is one file with its lines in order, after one shuffle by batch. For
    batches too large for one task, ``one_file=False`` range-partitions by batch and
    line: a batch is then shared by several tasks and its files follow each other by name.
    """
    if one_file:
        size = F.count(F.lit(1)).over(Window.partitionBy("batch_no"))
        sized = batched.withColumn("_n", size)
    else:
        sizes = batched.groupBy("batch_no").agg(F.count(F.lit(1)).alias("_n"))
        sized = batched.join(sizes, "batch_no")
    name = F.concat(F.lit("b"), "batch_no", F.lit("_"), "_n")
    named = sized.select(
        # Not nullable, so that the writer keeps the sort order of this column.
        F.coalesce(name, F.lit("")).alias("batch"),
        "row_no",
        F.col(col).alias("value"),
    )
    if one_file:
        placed = named.sortWithinPartitions("batch", "row_no")
    else:
        placed = named.sort("batch", "row_no")
    placed.select("value", "batch").write.mode("overwrite").partitionBy("batch").text(folder)


def read_parsed_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Parsed rows from tab-separated text; rows with fewer than eight fields are left out."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).select(parts.alias("p")).where(F.size("p") >= len(PARSED))
    return rows.select(
        *[F.get("p", F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(PARSED)]
    )


def export_query(df: DataFrame, folder: str) -> None:
    """A result as tab-separated text, host lists comma-joined, the folder's content replaced.

    Values stand as they are, without quotes or escapes; a null or an empty list is empty.
    """
    rows = texts_of_lists(df)
    fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in rows.columns]
    rows.select(F.concat_ws("\t", *fields).alias("value")).write.mode("overwrite").text(folder)


def texts_of_lists(df: DataFrame) -> DataFrame:
    """The same rows with ``hosts_list`` as text, for sinks without arrays."""
    if "hosts_list" not in df.columns:
        return df
    return df.withColumn("hosts_list", join_hosts(F.col("hosts_list")))


def lists_of_texts(df: DataFrame) -> DataFrame:
    """The inverse, for tables that store ``hosts_list`` as text."""
    return df.withColumn("hosts_list", split_hosts(F.col("hosts_list")))


def hosts_of_texts(rows: DataFrame, *keys: str) -> DataFrame:
    """Stored host texts as rows (keys, host), as the merges take them."""
    return rows.select(*keys, F.explode(split_hosts(F.col("hosts_list"))).alias("host"))
