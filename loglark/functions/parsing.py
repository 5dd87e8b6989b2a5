"""Parsing raw access-log lines with native columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loglark.schemas import PARSED

# The log line pattern, and what its eight groups mean.
# It ends in \z because Java's $ would also accept a trailing \r or \u0085.
LOG_PATTERN = (
    r"^(\S+)\s+\S+\s+\S+\s+"
    r"\[(\d{2}/\w{3}/\d{4}):(\d{2}):\d{2}:\d{2}\s+[+-]\d{4}\]\s+"
    r'"([A-Z]+)\s+(\S+)\s+(HTTP/[\d.]+)"\s+(\d{3})\s+(\d+|-)\z'
)
FIELDS = ("host", "log_date", "log_hour", "method", "resource", "protocol", "status_code", "bytes")

# Time of day, read only where an event time is asked for.
_CLOCK_PATTERN = r"\[(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2})\s"

_REWRITTEN, _PARTS, _BYTES, _OK = "_ll_rewritten", "_ll_parts", "_ll_bytes", "_ll_ok"


def clean_bytes(raw: Column) -> Column:
    """``-`` is 0, a 32-bit integer is itself, anything else is null."""
    return (
        F.when(raw == "-", F.lit(0))
        .when(raw.rlike(r"^[+-]?[0-9]+\z"), raw.try_cast("int"))
        .cast("bigint")
    )


def to_log_date(text: Column) -> Column:
    """``dd/MMM/yyyy`` to a date; a day outside the month rolls over, a bad text is null."""
    first = F.try_to_date(F.concat(F.lit("01/"), F.substring(text, 4, 8)), "dd/MMM/yyyy")
    shaped = F.when(text.rlike(r"^\d{2}/\w{3}/\d{4}\z"), text)
    return F.date_add(first, F.substring(shaped, 1, 2).try_cast("int") - 1)


def _prepare(df: DataFrame, col: str) -> DataFrame:
    # One regex evaluation per line: a full match is rewritten to its eight groups
    # joined by tabs (no group can hold whitespace); any other line stays as it is.
    # The steps are kept in separate projections so that none is computed twice.
    groups = "\t".join(f"${i}" for i in range(1, len(FIELDS) + 1))
    last = F.get(_PARTS, F.lit(len(FIELDS) - 1))
    return (
        df.withColumn(_REWRITTEN, F.regexp_replace(F.col(col), LOG_PATTERN, groups))
        .withColumn(_PARTS, F.split(_REWRITTEN, "\t"))
        .withColumn(_BYTES, F.when(last == "-", F.lit(0)).otherwise(last.try_cast("int")))
        .withColumn(
            _OK,
            F.coalesce(F.col(_REWRITTEN) != F.col(col), F.lit(False))
            & F.col(_BYTES).isNotNull(),
        )
    )


def _field(i: int) -> Column:
    name = FIELDS[i]
    if name == "bytes":
        return F.col(_BYTES).cast("bigint").alias(name)
    text = F.get(_PARTS, F.lit(i))
    if name in ("log_hour", "status_code"):
        text = text.try_cast("int")
    return text.alias(name)


def parse_logs(df: DataFrame, col: str = "value") -> DataFrame:
    """Every input row with the eight fields (null when malformed) and ``is_valid``."""
    fields = [F.when(F.col(_OK), _field(i)).alias(f) for i, f in enumerate(FIELDS)]
    return _prepare(df, col).select(*df.columns, *fields, F.col(_OK).alias("is_valid"))


def valid_logs(df: DataFrame, col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Only the valid rows: the columns in ``keep`` and the eight fields.

    Dropping the rows inside the generator, not by a filter, keeps the optimizer
    from evaluating the pattern a second time below the projection.
    """
    fields = F.struct(*[_field(i) for i in range(len(FIELDS))])
    return _prepare(df, col).select(*keep, F.inline(F.when(F.col(_OK), F.array(fields))))


def malformed_logs(df: DataFrame, col: str = "value") -> DataFrame:
    """The input rows that are not valid log lines, unchanged, for audit."""
    return parse_logs(df, col).where(~F.col("is_valid")).select(*df.columns)


def event_time(line: Column) -> Column:
    """Local time of a line, null when its date or clock is not a real one.

    The zone offset is left out of account, as it is in ``log_date`` and ``log_hour``:
    the timestamp is the instant at which a clock in UTC shows the local time.
    Hours and days are thus the same in any session time zone.
    """
    clock = F.regexp_extract(line, _CLOCK_PATTERN, 1)
    return F.try_to_timestamp(F.concat(clock, F.lit(" +0000")), F.lit("dd/MMM/yyyy:HH:mm:ss Z"))


def clock_date(instant: Column) -> Column:
    """The date text of an ``event_time``."""
    return F.date_format(F.date_from_unix_date(_floor_div(instant, 86400)), "dd/MMM/yyyy")


def clock_hour(instant: Column) -> Column:
    """The hour of an ``event_time``."""
    return F.pmod(_floor_div(instant, 3600), F.lit(24))


def _floor_div(instant: Column, seconds: int) -> Column:
    return F.floor(F.unix_seconds(instant) / seconds).cast("int")


def _counts() -> list[Column]:
    ok = F.col("is_valid")
    return [
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(ok).alias("valid_records"),
        F.count_if(~ok).alias("malformed_records"),
    ]


def count_quality(parsed: DataFrame, by: tuple[str, ...] = ("batch_no",)) -> DataFrame:
    """Total, valid and malformed lines per batch (or over everything with ``by=()``)."""
    return parsed.groupBy(*by).agg(*_counts())


def observe_quality(parsed: DataFrame, name: str = "quality") -> tuple[DataFrame, Observation]:
    """The same totals, measured while ``parsed`` is being written."""
    seen = Observation(name)
    return parsed.observe(seen, *_counts()), seen


def parse_summary(lines: DataFrame, col: str = "value", sample: int = 20):
    """Totals over all lines, and a few parsed rows to look at."""
    totals = count_quality(parse_logs(lines, col), by=())
    shown = valid_logs(lines, col).select("log_date", "log_hour", "status_code", "bytes")
    return totals, shown.limit(sample)


def register_sql_functions(spark: SparkSession) -> None:
    """``parse_log(line)`` for SQL users: a struct of the eight fields, or null."""
    groups = "\\t".join(f"${i}" for i in range(1, len(FIELDS) + 1))
    types, values = [], []
    for i, (name, kind) in enumerate((f.name, f.dataType.simpleString()) for f in PARSED):
        text = f"get(p, {i})"
        if name == "bytes":
            text = f"CAST(IF({text} = '-', 0, try_cast({text} AS INT)) AS BIGINT)"
        elif kind == "int":
            text = f"try_cast({text} AS INT)"
        types.append(f"{name}: {kind}")
        values.append(f"'{name}', {text}")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION parse_log(line STRING)
        RETURNS STRUCT<{', '.join(types)}>
        RETURN get(transform(
          filter(
            array(split(nullif(regexp_replace(line, r'{LOG_PATTERN}', '{groups}'), line), '\\t')),
            p -> get(p, 7) = '-' OR try_cast(get(p, 7) AS INT) IS NOT NULL),
          p -> named_struct({', '.join(values)})), 0)""")
