"""The named queries: one for each operator that has a result to compare."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from loglark.functions import names, parsing
from loglark.functions.names import join_hosts
from loglark.operators import batching, digests, host_bitmaps, merge, runs as run_ops, top_k, traffic
from loglark.plans import reports
from loglark.plans.run import read_runs, run_batches
from loglark.session import new_folder
from loglark.sources import tables
from loglark.sources.loads import vacuum
from loglark.sources.text import (
    count_check,
    export_query,
    hosts_of_texts,
    read_batches,
    read_parsed_tsv,
    read_raw,
    texts_of_lists,
    write_batches,
)
from loglark.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TARGET = 2
BATCH = ("batch_no",)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- parsing -----------------------------------------------------------------


@query
def parse_logs(spark, sf):
    return fx.all_parsed(spark, sf).drop("value")


@query
def parse_log_function(spark, sf):
    parsing.register_sql_functions(spark)
    rows = fx.raw_log(spark, sf).selectExpr("event_id", "parse_log(value) AS parsed")
    return rows.where("parsed IS NOT NULL").select("event_id", "parsed.*")


@query
def malformed_lines(spark, sf):
    return parsing.malformed_logs(fx.batched_log(spark, sf))


@query
def clean_bytes(spark, sf):
    raw = F.expr("""
        case when o_orderkey % 10 = 3 then '-'
             when o_orderkey % 17 = 5 then '2147483648'
             when o_orderkey % 17 = 6 then '2147483647'
             when o_orderkey % 19 = 7 then ''
             when o_orderkey % 23 = 1 then concat(o_orderkey, 'a')
             else cast(o_orderkey * 37 as string) end""")
    orders = fx.table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    return orders.withColumn("bytes", parsing.clean_bytes(F.col("raw")))


@query
def batch_quality(spark, sf):
    return parsing.count_quality(fx.all_parsed(spark, sf))


@query
def log_dates(spark, sf):
    text = F.expr("""
        concat(lpad(cast(o_orderkey % 40 as string), 2, '0'), '/',
               element_at(array('Jan', 'feb', 'MAR', 'Apr', 'May', 'JUN', 'Jul', 'aug', 'Sep',
                                'Oct', 'Nov', 'Dec', 'Xyz'), cast(o_custkey % 13 + 1 as int)),
               '/', cast(1995 + o_orderkey % 30 as string))""")
    orders = fx.table(spark, sf, "orders").select("o_orderkey", text.alias("log_date"))
    return orders.withColumn("as_date", parsing.to_log_date(F.col("log_date")))


@query
def parse_summary(spark, sf):
    totals, _ = parsing.parse_summary(fx.raw_log(spark, sf))
    return totals


# --- batches -----------------------------------------------------------------


@query
def batch_identity(spark, sf):
    name = F.expr("""
        case o_orderkey % 8
          when 1 then concat('b', o_custkey, '.txt')
          when 2 then concat('b', o_custkey, '_x', o_orderkey, '.txt')
          when 3 then concat('x', o_custkey, '_', o_orderkey, '.txt')
          when 4 then concat(o_custkey, '_', o_orderkey, '.txt')
          when 5 then concat('web_b', o_custkey, '_', o_orderkey, '.old.txt')
          when 6 then concat('b', o_custkey, '_', o_orderkey)
          else concat('b', o_custkey, '_', o_orderkey, '.txt') end""")
    orders = fx.table(spark, sf, "orders").select("o_orderkey", name.alias("file_name"))
    found = names.batch_identity(F.col("file_name")).alias("b")
    return orders.select("o_orderkey", "file_name", found).select("o_orderkey", "file_name", "b.*")


@query
def assign_batches(spark, sf):
    events = fx.table(spark, sf, "events").select("event_id", "ts")
    numbered = batching.number_rows(events, F.desc("ts"), "event_id")
    return batching.assign_batches(numbered, 700).select("event_id", "row_no", "batch_no")


@query
def dataset_stats(spark, sf):
    return batching.dataset_stats(fx.batched_log(spark, sf, 3000))


@query
def dataset_family(spark, sf):
    name = F.expr("""
        case o_orderkey % 6
          when 1 then concat('logs', o_custkey)
          when 2 then concat('logs_x', o_custkey)
          when 3 then concat('a_b', o_custkey, '_', o_orderkey)
          when 4 then cast(o_custkey as string)
          when 5 then concat('logs_', o_custkey, '_')
          else concat('logs', o_custkey, '_', o_orderkey) end""")
    orders = fx.table(spark, sf, "orders").select("o_orderkey", name.alias("dataset_name"))
    return orders.select(
        "*",
        names.dataset_base(F.col("dataset_name")).alias("dataset_base"),
        names.target_batch_size(F.col("dataset_name")).alias("target_batch_size"),
    )


# --- traffic -----------------------------------------------------------------


@query
def tag_errors(spark, sf):
    return traffic.tag_errors(fx.parsed(spark, sf)).select("event_id", "status_code", "is_error")


@query
def daily_traffic(spark, sf):
    return traffic.daily_traffic(fx.parsed(spark, sf))


@query
def top_resources(spark, sf):
    return traffic.top_resources(fx.parsed(spark, sf))


@query
def hourly_errors(spark, sf):
    return traffic.hourly_errors(fx.parsed(spark, sf))


@query
def hourly_errors_join(spark, sf):
    return traffic.hourly_errors_join(fx.parsed(spark, sf))


@query
def daily_traffic_by_batch(spark, sf):
    return traffic.daily_traffic(fx.parsed(spark, sf), BATCH)


@query
def top_resources_by_batch(spark, sf):
    return traffic.top_resources(fx.parsed(spark, sf), by=BATCH)


@query
def hourly_errors_by_batch(spark, sf):
    return traffic.hourly_errors(fx.parsed(spark, sf), BATCH)


@query
def top_resource_hosts(spark, sf):
    return traffic.top_resource_hosts(fx.parsed(spark, sf))


@query
def error_hosts(spark, sf):
    return traffic.error_hosts(fx.parsed(spark, sf))


@query
def top_resource_hosts_by_batch(spark, sf):
    return traffic.top_resource_hosts(fx.parsed(spark, sf), by=BATCH)


@query
def error_hosts_by_batch(spark, sf):
    return traffic.error_hosts(fx.parsed(spark, sf), BATCH)


# --- merging -----------------------------------------------------------------


@query
def merged_daily_traffic(spark, sf):
    return merge.merge_daily(traffic.daily_traffic(fx.parsed(spark, sf), BATCH))


@query
def merged_top_resources(spark, sf):
    rows = fx.parsed(spark, sf)
    return merge.merge_resources(
        traffic.top_resources(rows, by=BATCH), traffic.top_resource_hosts(rows, by=BATCH)
    )


@query
def merged_hourly_errors(spark, sf):
    rows = fx.parsed(spark, sf)
    return merge.merge_hours(traffic.hourly_errors(rows, BATCH), traffic.error_hosts(rows, BATCH))


@query
def split_hosts(spark, sf):
    text = F.expr("""
        case when event_id % 11 = 0 then ''
             when event_id % 11 = 1 then 'null'
             else concat('u', user_id, ', u', user_id % 7, ' ,null,,u', event_id % 5, ',u', user_id)
        end""")
    events = fx.table(spark, sf, "events").select("event_id", text.alias("hosts_text"))
    hosts = names.split_hosts(F.col("hosts_text"))
    return events.select(
        "event_id", join_hosts(hosts).alias("hosts_list"), F.size(hosts).alias("host_count")
    )


@query
def global_top_resources(spark, sf):
    """The true top list, beside the merged per-batch lists."""
    return traffic.top_resources(fx.parsed(spark, sf), k=50)


@query
def top_resources_in_rounds(spark, sf):
    return top_k.top_resources_in_rounds(fx.parsed(spark, sf))


@query
def top_resources_in_rounds_by_batch(spark, sf):
    return top_k.top_resources_in_rounds(fx.parsed(spark, sf), by=BATCH)


@query
def global_top_resources_in_rounds(spark, sf):
    return top_k.top_resources_in_rounds(fx.parsed(spark, sf), k=50)


@query
def top_resources_ordered(spark, sf):
    """The top list of every batch with its ranks, as it is exported."""
    return top_k.ordered_top(traffic.top_resources(fx.parsed(spark, sf), by=BATCH), BATCH)


@query
def merged_top_resources_by_bitmaps(spark, sf):
    rows = fx.parsed(spark, sf)
    top, hosts = traffic.top_resources(rows, by=BATCH), traffic.top_resource_hosts(rows, by=BATCH)
    dictionary = host_bitmaps.host_dictionary(rows)
    bitmaps = host_bitmaps.host_bitmaps(hosts, dictionary, [*BATCH, "resource_path"])
    return host_bitmaps.merge_resources_by_bitmaps(top, bitmaps)


@query
def merged_hourly_errors_by_bitmaps(spark, sf):
    rows = fx.parsed(spark, sf)
    hosts = traffic.error_hosts(rows, BATCH)
    bitmaps = host_bitmaps.host_bitmaps(hosts, host_bitmaps.host_dictionary(hosts), [*BATCH, "log_date", "log_hour"])
    return host_bitmaps.merge_hours_by_bitmaps(traffic.hourly_errors(rows, BATCH), bitmaps)


# --- runs and reports ----------------------------------------------------------


@query
def successful_runs(spark, sf):
    runs = fx.runs(spark, sf)
    some = run_ops.successful_runs(runs).withColumn("variant", F.lit("parsed something"))
    large = run_ops.successful_runs(runs, 1000).withColumn("variant", F.lit("over 1000 records"))
    return some.unionByName(large).select("variant", "run_id")


@query
def latest_runs(spark, sf):
    latest = run_ops.latest_runs(run_ops.successful_runs(fx.runs(spark, sf)))
    return latest.select("dataset_name", "pipeline_name", "run_id", "total_runtime")


@query
def batch_totals(spark, sf):
    return run_ops.batch_totals(fx.batch_stats(spark, sf))


@query
def run_totals(spark, sf):
    return run_ops.run_totals(run_ops.batch_totals(fx.batch_stats(spark, sf)))


@query
def run_history(spark, sf):
    return reports.run_history(fx.runs(spark, sf))


@query
def run_history_json(spark, sf):
    return reports.run_history_json(fx.runs(spark, sf))


@query
def data_quality(spark, sf):
    return reports.data_quality(fx.runs(spark, sf), TARGET)


@query
def engine_comparison(spark, sf):
    return reports.engine_comparison(fx.runs(spark, sf), TARGET)


@query
def query_totals(spark, sf):
    return reports.query_totals(fx.timings(spark, sf), TARGET)


@query
def batch_query_times(spark, sf):
    return reports.batch_query_times(fx.timings(spark, sf), TARGET)


@query
def batch_query_times_wide(spark, sf):
    return reports.batch_query_times_wide(fx.timings(spark, sf), TARGET)


@query
def cross_engine_timing(spark, sf):
    return reports.cross_engine_timing(fx.runs(spark, sf), fx.timings(spark, sf), TARGET)


@query
def run_summary(spark, sf):
    return reports.run_summary(fx.runs(spark, sf), fx.batches(spark, sf), TARGET)


@query
def run_comparison(spark, sf):
    return reports.run_comparison(fx.runs(spark, sf), fx.batches(spark, sf), TARGET)


@query
def batch_size_runtime(spark, sf):
    return reports.batch_size_runtime(fx.runs(spark, sf), TARGET)


@query
def batch_size_avg_time(spark, sf):
    return reports.batch_size_avg_time(fx.runs(spark, sf), fx.batches(spark, sf), TARGET)


@query
def batch_size_throughput(spark, sf):
    return reports.batch_size_throughput(fx.runs(spark, sf), TARGET)


@query
def batch_view(spark, sf):
    return reports.batch_view(fx.batches(spark, sf), TARGET)


@query
def batch_comparison(spark, sf):
    return reports.batch_comparison(fx.runs(spark, sf), fx.batches(spark, sf), TARGET)


@query
def integrity_scorecard(spark, sf):
    found = fx.compared_runs(spark, sf)
    return reports.integrity_scorecard(
        found["runs"],
        found["daily_traffic"],
        found["top_resources"],
        found["top_resource_hosts"],
        found["hourly_errors"],
        found["error_hosts"],
        run_id=1,
    )


@query
def result_differences(spark, sf):
    """Every number in which the compared runs differ from the baseline."""
    found = fx.compared_runs(spark, sf)
    return reports.result_differences(found["runs"], *[found[name] for name in digests.PARTS], run_id=1)


@query
def scorecard_all_clear(spark, sf):
    return reports.all_clear(QUERIES["integrity_scorecard"](spark, sf))


@query
def data_quality_unlisted(spark, sf):
    """The report where one engine is under a name that is not listed."""
    engine = F.col("pipeline_name")
    renamed = F.when(engine == "pig", "spark").otherwise(engine)
    runs = fx.runs(spark, sf).withColumn("pipeline_name", renamed)
    return reports.data_quality(runs, TARGET).where("has_history")


# The names the plan gives them.
QUERIES["pipeline_comparison"] = engine_comparison
QUERIES["cross_pipeline_timing"] = cross_engine_timing


# --- files, whole runs and streams ------------------------------------------------


def _batch_files(spark, sf):
    files = new_folder(spark, "batches")
    batched = fx.batched_log(spark, sf).withColumnRenamed("event_id", "row_no")
    write_batches(batched, files)
    return files


@query
def batch_files(spark, sf):
    """The log written as batch files and read back."""
    return read_batches(spark, _batch_files(spark, sf))


@query
def declared_counts(spark, sf):
    """Batch files of which two in three have lost the lines that end in 7."""
    lines = read_batches(spark, _batch_files(spark, sf))
    lost = (F.col("batch_no") % 3 != 0) & F.col("value").endswith("7")
    return count_check(lines.where(~lost))


@query
def line_batches(spark, sf):
    """The log written as text files, numbered in file order and cut into batches."""
    files = new_folder(spark, "lines")
    fx.raw_log(spark, sf).select("value").write.text(files)
    numbered = batching.number_lines(read_raw(spark, files, places=True))
    batched = batching.assign_batches(numbered, 700)
    return batched.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("row_no").alias("first_row"),
        F.max("row_no").alias("last_row"),
    )


@query
def parsed_tsv(spark, sf):
    """Parsed rows exported as tab-separated text and read back."""
    folder = new_folder(spark, "tsv")
    export_query(fx.parsed(spark, sf).drop("event_id", "batch_no"), folder)
    return read_parsed_tsv(spark, folder)


@query
def tsv_special_characters(spark, sf):
    """Quotes, backslashes and commas come back from text as they went."""
    rows = fx.table(spark, sf, "events").selectExpr(
        "concat('h\"', user_id) as host",
        "'01/Jul/1995' as log_date",
        "cast(event_id % 24 as int) as log_hour",
        "'GET' as method",
        "concat('/a\"', event_id % 7, char(92), event_id % 3, ',', char(39)) as resource",
        "'HTTP/1.0' as protocol",
        "200 as status_code",
        "event_id as bytes",
    )
    folder = new_folder(spark, "tsv")
    export_query(rows, folder)
    return read_parsed_tsv(spark, folder)


@query
def reloaded_results(spark, sf):
    """A load of valid lines, repeated with only malformed ones: nothing of the first is left."""
    root, lines = new_folder(spark, "results"), fx.batched_log(spark, sf)
    run_batches(lines, root, "web_2500", "spark", run_id=1)
    broken = lines.withColumn("value", F.concat(F.lit("junk "), "value"))
    run_batches(broken, root, "web_2500", "spark", run_id=1, queries="1")
    rows = sum(tables.read_results(spark, root, name, 1).count() for name in fx.RESULTS)
    return tables.read_results(spark, root, "batch_metadata", 1).agg(
        F.lit(rows).cast("long").alias("stored_rows"),
        F.sum("malformed_record_count").alias("malformed"),
        F.sum("record_count").alias("records"),
    )


@query
def stored_malformed(spark, sf):
    """The malformed lines kept beside the parsed table."""
    return tables.read_malformed(spark, fx.ingest(spark, sf), keep="event_id bigint, batch_no int")


@query
def hosts_from_text(spark, sf):
    """Hourly errors with host lists stored as text, merged over batches."""
    rows, keys = fx.parsed(spark, sf), ("batch_no", "log_date", "log_hour")
    lists = traffic.error_hosts(rows, BATCH).groupBy(*keys).agg(F.collect_list("host").alias("hosts_list"))
    hosts = hosts_of_texts(texts_of_lists(lists), *keys)
    return merge.merge_hours(traffic.hourly_errors(rows, BATCH), hosts)


@query
def run_metadata(spark, sf):
    """What a run over the batch files leaves in the run table, but for its times."""
    root = new_folder(spark, "results")
    lines = read_batches(spark, _batch_files(spark, sf))
    run_batches(lines, root, "web_2500", "Spark", run_id=7, queries="1")
    return read_runs(spark, root).drop("total_runtime", "execution_timestamp")


# Key, second key and numbers of each result table, under common names.
STORED = {
    "daily_traffic": ("log_date", "status_code", "request_count", "total_bytes"),
    "top_resources": ("resource_path", "distinct_host_count", "request_count", "total_bytes"),
    "top_resource_hosts": ("concat_ws(' ', resource_path, host)", "null", "request_count", "total_bytes"),
    "hourly_errors": (
        "concat_ws(' ', log_date, log_hour)",
        "distinct_error_hosts",
        "error_request_count",
        "total_request_count",
    ),
    "error_hosts": ("concat_ws(' ', log_date, host)", "log_hour", "error_request_count", "null"),
}


def _stored_rows(spark, root):
    """The rows of run 1 in every result table."""
    tables_of_run = [
        tables.read_results(spark, root, name, 1).selectExpr(
            f"'{name}' as result",
            "batch_no",
            f"cast({key} as string) as key",
            f"cast({second} as bigint) as second",
            f"cast({first_number} as bigint) as first_number",
            f"cast({second_number} as bigint) as second_number",
        )
        for name, (key, second, first_number, second_number) in STORED.items()
    ]
    return reduce(DataFrame.unionByName, tables_of_run)


@query
def run_results(spark, sf):
    """Write the log as batch files, read them back, run all queries, read all stored rows."""
    files, root = _batch_files(spark, sf), new_folder(spark, "results")
    run_batches(read_batches(spark, files), root, "web_2500", "spark", run_id=1)
    return _stored_rows(spark, root)


@query
def compacted_results(spark, sf):
    """A run whose batches come in two loads, one of them again after it was spoiled, merged into one load."""
    files, root = _batch_files(spark, sf), new_folder(spark, "results")
    lines = read_batches(spark, files)
    spoiled = lines.withColumn("value", F.when(F.col("batch_no") % 2 == 0, "junk").otherwise(F.col("value")))
    run_batches(spoiled, root, "web_2500", "spark", run_id=1)
    run_batches(lines.where("batch_no % 2 = 0"), root, "web_2500", "spark", run_id=1, load_id=1)
    tables.compact_loads(spark, root, 1)
    vacuum(spark, root)
    return _stored_rows(spark, root)


@query
def stream_batches(spark, sf):
    """The same batch files as a stream; the run's totals and all stored rows."""
    files, root = _batch_files(spark, sf), new_folder(spark, "results")
    streams.stream_batches(
        spark, files, root, "web_2500", "spark", run_id=1, files_per_trigger=50
    ).awaitTermination()
    totals = read_runs(spark, root).select("run_id", "total_record_count")
    stored = _stored_rows(spark, root).withColumn("run_id", F.lit(1).cast("long"))
    return stored.join(totals, "run_id").drop("run_id")


def _event_stream(spark, sf):
    schema = fx.table(spark, sf, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return fx.lines_of(reader.parquet(sf))


def _closed(spark, stream):
    folder = new_folder(spark, "closed")
    streams.write_closed(stream, folder).awaitTermination()
    return spark.read.schema(stream.schema).parquet(folder)


@query
def stream_hourly_errors(spark, sf):
    return _closed(spark, streams.stream_hourly_errors(_event_stream(spark, sf), "1 hour"))


@query
def stream_error_hosts(spark, sf):
    return _closed(spark, streams.stream_error_hosts(_event_stream(spark, sf), "1 hour"))


@query
def stream_daily_traffic(spark, sf):
    return _closed(spark, streams.stream_daily_traffic(_event_stream(spark, sf), "1 hour"))


@query
def stream_hours_finished(spark, sf):
    """The hours a finite stream has closed, and those it left open."""
    closed = _closed(spark, streams.stream_hourly_errors(_event_stream(spark, sf), "1 hour"))
    return closed.unionByName(streams.open_hours(fx.raw_log(spark, sf), closed))


@query
def stream_days_finished(spark, sf):
    """The days a finite stream has closed, and those it left open."""
    closed = _closed(spark, streams.stream_daily_traffic(_event_stream(spark, sf), "1 hour"))
    return closed.unionByName(streams.open_days(fx.raw_log(spark, sf), closed))


@query
def late_rows(spark, sf):
    """Every seventh line comes after all others; those of hours closed by then are late."""
    log = fx.raw_log(spark, sf)
    folder, out, checkpoint = (new_folder(spark, name) for name in ("lines", "closed", "stream"))
    lines = lambda: streams.stream_hourly_errors(spark.readStream.schema("value string").text(folder))
    for part in ("event_id % 7 <> 3", "event_id % 7 = 3"):
        log.where(part).select("value").write.mode("append").text(folder)
        streams.write_closed(lines(), out, checkpoint).awaitTermination()
    written = spark.read.schema(lines().schema).parquet(out)
    return streams.late_rows(spark.read.text(folder), written)
