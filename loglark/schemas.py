"""Declared schemas of parsed rows, result tables and run bookkeeping tables."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, INT, LONG, SHORT = T.StringType(), T.IntegerType(), T.LongType(), T.ShortType()
DOUBLE, DATE, TIME = T.DoubleType(), T.DateType(), T.TimestampType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


PARSED = _schema(
    host=TEXT,
    log_date=TEXT,
    log_hour=INT,
    method=TEXT,
    resource=TEXT,
    protocol=TEXT,
    status_code=INT,
    bytes=LONG,
)

# Result tables. `load_id` tells repeated loads of a batch apart (see sources.tables);
# the hosts of a summary's row are rows of a table of their own.
DAILY_TRAFFIC = _schema(
    batch_no=INT,
    log_date=DATE,
    status_code=INT,
    request_count=LONG,
    total_bytes=LONG,
    run_id=LONG,
    load_id=LONG,
)
TOP_RESOURCES = _schema(
    batch_no=INT,
    resource_path=TEXT,
    request_count=LONG,
    total_bytes=LONG,
    distinct_host_count=LONG,
    run_id=LONG,
    load_id=LONG,
)
TOP_RESOURCE_HOSTS = _schema(
    batch_no=INT,
    resource_path=TEXT,
    host=TEXT,
    request_count=LONG,
    total_bytes=LONG,
    run_id=LONG,
    load_id=LONG,
)
HOURLY_ERRORS = _schema(
    batch_no=INT,
    log_date=DATE,
    log_hour=SHORT,
    error_request_count=LONG,
    total_request_count=LONG,
    error_rate=DOUBLE,
    distinct_error_hosts=LONG,
    run_id=LONG,
    load_id=LONG,
)
ERROR_HOSTS = _schema(
    batch_no=INT,
    log_date=DATE,
    log_hour=SHORT,
    host=TEXT,
    error_request_count=LONG,
    run_id=LONG,
    load_id=LONG,
)

RUN_METADATA = _schema(
    pipeline_name=TEXT,
    dataset_name=TEXT,
    avg_batch_size=DOUBLE,
    total_runtime=DOUBLE,
    total_malformed_record_count=LONG,
    total_record_count=LONG,
    execution_timestamp=TIME,
    run_id=LONG,
    load_id=LONG,
)
BATCH_METADATA = _schema(
    batch_no=INT,
    record_count=LONG,
    malformed_record_count=LONG,
    batch_runtime=DOUBLE,
    run_id=LONG,
    load_id=LONG,
)
QUERY_METADATA = _schema(
    batch_no=INT, query_number=INT, query_runtime=DOUBLE, run_id=LONG, load_id=LONG
)

TABLES = {
    "daily_traffic": DAILY_TRAFFIC,
    "top_resources": TOP_RESOURCES,
    "top_resource_hosts": TOP_RESOURCE_HOSTS,
    "hourly_errors": HOURLY_ERRORS,
    "error_hosts": ERROR_HOSTS,
    "run_metadata": RUN_METADATA,
    "batch_metadata": BATCH_METADATA,
    "query_metadata": QUERY_METADATA,
}
