"""Access-log analytics as Spark DataFrame operations."""

from loglark.functions.parsing import malformed_logs, parse_logs, valid_logs
from loglark.operators.traffic import (
    daily_traffic,
    hourly_errors,
    hourly_errors_join,
    top_resources,
)

__all__ = [
    "daily_traffic",
    "hourly_errors",
    "hourly_errors_join",
    "malformed_logs",
    "parse_logs",
    "top_resources",
    "valid_logs",
]
