"""Parsed rows, results and bookkeeping as Parquet tables, and the JDBC option.

Every load of batches has a ``load_id``. Tables are partitioned by run and load. Whole loads
are written aside and take effect together (``sources.loads``); a single table is written by
``write_results``, which replaces just its own partition. A batch that is loaded again under a
higher id supersedes its older rows when results are read. Batches themselves are no
partitions: a large dataset has millions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglark.functions.parsing import to_log_date
from loglark.schemas import PARSED, TABLES
from loglark.sources import loads
from loglark.sources.text import texts_of_lists


def write_parsed(parsed: DataFrame, path: str) -> None:
    """Rows of ``parse_logs`` as Parquet, replacing what was there.

    Valid and malformed rows go to two partitions in one pass; only the malformed
    keep their raw line.
    """
    raw = F.when(~F.col("is_valid"), F.col("value")).alias("value")
    kept = [raw if c == "value" else F.col(c) for c in parsed.columns]
    parsed.select(*kept).write.mode("overwrite").partitionBy("is_valid").parquet(path)


def _read_written(spark: SparkSession, path: str, keep: str) -> DataFrame:
    schema = T.StructType.fromDDL(f"{keep}, value string, is_valid boolean")
    return spark.read.schema(T.StructType([*schema, *PARSED])).parquet(path)


def read_parsed(spark: SparkSession, path: str, keep: str = "batch_no int") -> DataFrame:
    """The valid rows written by ``write_parsed``: the eight fields after the columns ``keep`` declares."""
    rows = _read_written(spark, path, keep).where("is_valid")
    return rows.select(*T.StructType.fromDDL(keep).fieldNames(), *PARSED.fieldNames())


def read_malformed(spark: SparkSession, path: str, keep: str = "batch_no int") -> DataFrame:
    """The malformed lines written by ``write_parsed``."""
    rows = _read_written(spark, path, keep).where("NOT is_valid")
    return rows.select(*T.StructType.fromDDL(keep).fieldNames(), "value")


def read_quality(spark: SparkSession, path: str) -> DataFrame:
    """Batch numbers and verdicts of everything written by ``write_parsed``."""
    return _read_written(spark, path, "batch_no int").select("batch_no", "is_valid")


def to_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the column types of result table ``name``; raw date text becomes a date."""
    return _typed(df, TABLES[name])


def _typed(df: DataFrame, fields: Iterable[T.StructField]) -> DataFrame:
    dates = dict(df.dtypes).get("log_date") == "string"
    cols = {f.name: to_log_date(F.col(f.name)) if dates and f.name == "log_date" else F.col(f.name) for f in fields}
    return df.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in fields])


def partition(folder: str, name: str, run_id: int, load_id: int) -> str:
    """Where the rows of a load are in the folder of ``loads.load_aside``."""
    return f"{folder}/table={name}/run_id={run_id}/load_id={load_id}"


def write_results(df: DataFrame, root: str, name: str, run_id: int, load_id: int) -> None:
    """Write one load of a run to a result or bookkeeping table of its own, not under a manifest."""
    tagged = df.withColumns({"run_id": F.lit(run_id), "load_id": F.lit(load_id)})
    (
        to_table(tagged, name)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id", "load_id")
        .parquet(f"{root}/{name}")
    )


def write_aside(df: DataFrame, folder: str, name: str, run_id: int, load_id: int) -> None:
    """Write a table of a load to the folder of ``loads.load_aside``.

    The rows go right into the one partition they can be in: nothing has to be sorted by
    partition or moved at the end.
    """
    rows = _typed(df, [f for f in TABLES[name] if f.name not in ("run_id", "load_id")])
    rows.write.mode("overwrite").parquet(partition(folder, name, run_id, load_id))


def read_aside(spark: SparkSession, folder: str, name: str, load_id: int) -> DataFrame:
    """A table of a load that is not committed yet."""
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/table={name}").where(F.col("load_id") == load_id)


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    known = loads.manifest(spark, root)
    if not known:
        return loads.exists(spark, f"{root}/{name}")
    return any(loads.exists(spark, f"{folder}/table={name}") for folder in {e.folder for e in known})


def refuse_other_batches(
    spark: SparkSession, root: str, run_id: int, load_id: int, batches: DataFrame
) -> None:
    """Raise if the load holds batches that are not among ``batches``: they would be lost."""
    if not any((e.run_id, e.load_id) == (run_id, load_id) for e in loads.manifest(spark, root)):
        return
    held = read_metadata(spark, root, "batch_metadata", run_id).where(F.col("load_id") == load_id)
    if not held.join(batches.select("batch_no").distinct(), "batch_no", "left_anti").isEmpty():
        raise ValueError(f"load {load_id} of run {run_id} holds other batches; take a new load id")


def read_metadata(
    spark: SparkSession, root: str, name: str, run_id: int | None = None
) -> DataFrame:
    """A table as written, of one run (partitions of other runs are not read) or of all.

    A table that no query has written yet is empty. Where ``root`` has a manifest, the rows are
    those of its newest version as it is now: loads that are committed later are not among them.
    """
    known = loads.manifest(spark, root)
    if known:
        # A folder can hold loads that were replaced since, so each load is named by its partition.
        wanted = [e for e in known if run_id is None or e.run_id == run_id]
        paths = loads.existing(spark, root, [partition(e.folder, name, e.run_id, e.load_id) for e in wanted])
        if not paths:
            return spark.createDataFrame([], TABLES[name])
        rows = spark.read.schema(TABLES[name]).option("basePath", f"{root}/loads").parquet(*paths)
        rows = rows.select(*TABLES[name].fieldNames())
    elif loads.exists(spark, f"{root}/{name}"):
        rows = spark.read.schema(TABLES[name]).parquet(f"{root}/{name}")
    else:
        return spark.createDataFrame([], TABLES[name])
    return rows if run_id is None else rows.where(F.col("run_id") == run_id)


def newest_batches(batches: DataFrame) -> DataFrame:
    """For each batch the load that wrote it last."""
    return batches.groupBy("run_id", "batch_no").agg(F.max("load_id").alias("load_id"))


def read_results(
    spark: SparkSession, root: str, name: str, run_id: int | None = None
) -> DataFrame:
    """Per-batch rows of a table, without rows of a load that was superseded."""
    keys = ["run_id", "batch_no", "load_id"]
    newest = newest_batches(read_metadata(spark, root, "batch_metadata", run_id))
    rows = read_metadata(spark, root, name, run_id).join(newest, keys, "left_semi")
    return rows.select(*TABLES[name].fieldNames())


#: Tables with a row or more for each batch, whose superseded rows a compaction leaves out.
PER_BATCH = tuple(name for name in TABLES if name not in ("run_metadata", "query_metadata"))


def compact_loads(spark: SparkSession, root: str, run_id: int) -> int:
    """Rewrite all loads of a run as one, without the rows of superseded loads; how many loads it took in.

    The one load has the highest number, so that later loads supersede it as before. Readers see
    the old loads until it is committed. A load that was taken in cannot be repeated.
    """
    known = [e for e in loads.manifest(spark, root) if e.run_id == run_id]
    if len(known) < 2:
        return 0
    last, folder = max(e.load_id for e in known), loads.new_load_folder(root)
    for name in TABLES:
        if name in PER_BATCH:
            rows = read_results(spark, root, name, run_id)
        else:
            rows = read_metadata(spark, root, name, run_id)
        if name == "run_metadata":
            firsts = ("pipeline_name", "dataset_name")
            rows = rows.groupBy("run_id").agg(
                *[F.max_by(c, "load_id").alias(c) for c in firsts],
                F.sum("total_runtime").alias("total_runtime"),
                F.max("execution_timestamp").alias("execution_timestamp"),
                *[F.lit(None).alias(c) for c in ("avg_batch_size", "total_malformed_record_count", "total_record_count")],
            )
        write_aside(rows, folder, name, run_id, last)
    merged = sorted({i for e in known for i in (e.load_id, *e.merged)} - {last})
    loads.commit(spark, root, [loads.Entry(run_id, last, folder, tuple(merged))], [(run_id, e.load_id) for e in known])
    return len(known)


def write_run_history(history: DataFrame, folder: str) -> None:
    """The JSON objects of ``reports.run_history_json`` as text, one run per line, in order."""
    history.select("json").write.mode("overwrite").text(folder)


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None
) -> None:
    """Append a result to a database table in bulk, host lists as text.

    Each task commits once, at its end. A task that is run again after its commit would
    add its rows twice: give the table a unique key over run, load and the result's keys.
    """
    options = {"batchsize": "10000", **(properties or {})}
    texts_of_lists(df).write.jdbc(url, table, mode="append", properties=options)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    run_id: int,
    properties: dict[str, str] | None = None,
    column: str | None = None,
    bounds: tuple[int, int] = (1, 1),
    parts: int = 1,
) -> DataFrame:
    """The rows of one run from a database table; the filter runs in the database.

    With a whole-numbered ``column`` (such as ``batch_no``) ``parts`` tasks read at once,
    each a range of it; ``bounds`` only place the ranges, rows beyond them or with a null
    are read as well. Without one a single connection reads all.
    Host lists are text there; ``sources.text.lists_of_texts`` turns them into arrays.
    """
    split = {}
    if column is not None:
        split = dict(column=column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts)
    return spark.read.jdbc(url, table, properties=properties or {}, **split).where(F.col("run_id") == run_id)
