"""Views of the given tables in the shapes the package works on.

Every view is an expression that Spark and DuckDB evaluate alike; ``checks.oracles``
holds the DuckDB side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglark.functions.parsing import count_quality, parse_logs
from loglark.plans.run import QUERIES as RUN_QUERIES
from loglark.session import new_folder
from loglark.sources.tables import read_metadata, read_parsed, write_parsed, write_results

BATCH_LINES = 2500


RESULTS = {name: query for tables in RUN_QUERIES.values() for name, query in tables.items()}

LINE = """
case
  when event_id % 150 = 7 then concat('u', user_id, '.example.net - - [garbage')
  when event_id % 150 = 57 then concat('u', user_id, '.example.net - - [',
    date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'), ' -0400] "GET /', event_type, '/',
    event_id % 40, '.html" 200 10')
  when event_id % 150 = 107 then concat('u', user_id, '.example.net - - [',
    date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'), ' -0400] "GET /', event_type, '/',
    event_id % 40, '.html HTTP/1.0" 200 2147483648')
  else concat('u', user_id, '.example.net - - [',
    date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'), ' -0400] "GET /', event_type, '/',
    event_id % 40, '.html HTTP/1.0" ',
    case event_type
      when 'error' then case when event_id % 2 = 0 then '404' else '500' end
      when 'signup' then '302' when 'view' then '304' else '200' end, ' ',
    case when event_id % 10 = 3 then '-' else cast(event_id % 1000 * 37 as string) end)
end
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines_of(events: DataFrame) -> DataFrame:
    return events.select("event_id", F.expr(LINE).alias("value"))


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(table(spark, sf_dir, "events"))


def batch_no(size: int = BATCH_LINES):
    return F.expr(f"CAST(event_id DIV {size} + 1 AS INT)").alias("batch_no")


def batched_log(spark: SparkSession, sf_dir: str, size: int = BATCH_LINES) -> DataFrame:
    return raw_log(spark, sf_dir).select("event_id", "value", batch_no(size))


def all_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_logs(batched_log(spark, sf_dir))


_INGESTED: dict[tuple[str, str], str] = {}


def ingest(spark: SparkSession, sf_dir: str) -> str:
    """Parse the whole log once per application; the queries on parsed rows share the table."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INGESTED:
        path = new_folder(spark, "parsed")
        write_parsed(all_parsed(spark, sf_dir), path)
        _INGESTED[key] = path
    return _INGESTED[key]


def parsed(spark: SparkSession, sf_dir: str, size: int = BATCH_LINES) -> DataFrame:
    rows = read_parsed(spark, ingest(spark, sf_dir), keep="event_id bigint, batch_no int")
    return rows if size == BATCH_LINES else rows.withColumn("batch_no", batch_no(size))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey + 1 as bigint) as run_id",
        "case o_custkey % 4 when 0 then 'mr' when 1 then 'pig' when 2 then 'hive'"
        " else 'mongodb' end as pipeline_name",
        "concat('logs', cast(o_orderkey % 3 as string), '_', case o_orderkey % 4"
        " when 0 then '500' when 1 then '1000' when 2 then '5000' else '10000' end) as dataset_name",
        "cast(case o_orderkey % 4 when 0 then 500 when 1 then 1000 when 2 then 5000"
        " else 10000 end as double) as avg_batch_size",
        "case when o_orderstatus = 'P' then cast(0 as double)"
        " else cast(floor(o_totalprice) as double) end as total_runtime",
        "cast(case when o_orderkey % 13 = 0 then case when o_orderkey % 11 = 0 then 500"
        " else 20000 + o_orderkey end else o_custkey % 100 end as bigint)"
        " as total_malformed_record_count",
        "cast(case when o_orderkey % 11 = 0 then 500 else 20000 + o_orderkey end as bigint)"
        " as total_record_count",
        "o_orderdate + make_dt_interval(0, 0, 0, o_orderkey / 1000.0) as execution_timestamp",
    )


def batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stat events, several per batch."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey + 1 as bigint) as run_id",
        "l_linenumber as batch_no",
        "cast(l_quantity as bigint) as record_count",
        "l_suppkey % 10 as malformed_record_count",
        "cast(floor(l_extendedprice) as double) as batch_runtime",
    )


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        batch_stats(spark, sf_dir)
        .groupBy("run_id", "batch_no")
        .agg(
            F.sum("record_count").alias("record_count"),
            F.count(F.lit(1)).alias("malformed_record_count"),
            F.sum("batch_runtime").alias("batch_runtime"),
        )
    )


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        batches(spark, sf_dir)
        .withColumn("query_number", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
        .selectExpr(
            "run_id",
            "batch_no",
            "query_number",
            "cast(record_count * query_number * 7 + batch_no as double) as query_runtime",
        )
    )


_STORED: dict[tuple[str, str], str] = {}


def stored_results(spark: SparkSession, sf_dir: str) -> str:
    """Results of three runs over the log, stored once per application.

    Run 1 is the baseline, run 2 has larger batches, run 3 is like run 1.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        root = new_folder(spark, "compared")
        for run_id, size in ((1, BATCH_LINES), (2, 2 * BATCH_LINES), (3, BATCH_LINES)):
            rows = parsed(spark, sf_dir, size)
            for name, query in RESULTS.items():
                write_results(query(rows, by=("batch_no",)), root, name, run_id, load_id=0)
        _STORED[key] = root
    return _STORED[key]


def compared_runs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The run table of those runs, and their stored results."""
    seen = count_quality(all_parsed(spark, sf_dir), by=())
    runs = seen.withColumn("run_id", F.explode(F.expr("array(1L, 2L, 3L)"))).selectExpr(
        "run_id",
        "element_at(array('mr', 'pig', 'hive'), cast(run_id as int)) as pipeline_name",
        "'web_log' as dataset_name",
        "cast(run_id as double) as total_runtime",
        "total_records as total_record_count",
        "malformed_records as total_malformed_record_count",
        "make_timestamp(2024, 1, 1, 0, 0, run_id) as execution_timestamp",
    )
    root = stored_results(spark, sf_dir)
    return {"runs": runs, **{name: read_metadata(spark, root, name) for name in RESULTS}}
