"""DuckDB SQL with the result each named query must give."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

TARGET = 2

# Fixed value: the log line pattern, with its eight groups.
PATTERN = (
    r"^(\S+)\s+\S+\s+\S+\s+"
    r"\[(\d{2}/\w{3}/\d{4}):(\d{2}):\d{2}:\d{2}\s+[+-]\d{4}\]\s+"
    r'"([A-Z]+)\s+(\S+)\s+(HTTP/[\d.]+)"\s+(\d{3})\s+(\d+|-)\z'
)

RAW_LOG = """
raw_log as (
  select event_id, ts, case
    when event_id % 150 = 7 then concat('u', user_id, '.example.net - - [garbage')
    when event_id % 150 = 57 then concat('u', user_id, '.example.net - - [',
      strftime(ts, '%d/%b/%Y:%H:%M:%S'), ' -0400] "GET /', event_type, '/',
      event_id % 40, '.html" 200 10')
    when event_id % 150 = 107 then concat('u', user_id, '.example.net - - [',
      strftime(ts, '%d/%b/%Y:%H:%M:%S'), ' -0400] "GET /', event_type, '/',
      event_id % 40, '.html HTTP/1.0" 200 2147483648')
    else concat('u', user_id, '.example.net - - [',
      strftime(ts, '%d/%b/%Y:%H:%M:%S'), ' -0400] "GET /', event_type, '/',
      event_id % 40, '.html HTTP/1.0" ',
      case event_type
        when 'error' then case when event_id % 2 = 0 then '404' else '500' end
        when 'signup' then '302' when 'view' then '304' else '200' end, ' ',
      case when event_id % 10 = 3 then '-' else cast(event_id % 1000 * 37 as varchar) end)
  end as value from events)"""


def _group(i: int) -> str:
    return f"regexp_extract(value, '{PATTERN}', {i})"


ALL_PARSED = f"""{RAW_LOG},
verdicts as (
  select *, cast(event_id // 2500 + 1 as integer) as batch_no,
    regexp_matches(value, '{PATTERN}')
      and ({_group(8)} = '-' or try_cast({_group(8)} as integer) is not null) as is_valid
  from raw_log),
all_parsed as (
  select event_id, ts, value, batch_no,
    case when is_valid then {_group(1)} end as host,
    case when is_valid then {_group(2)} end as log_date,
    case when is_valid then cast({_group(3)} as integer) end as log_hour,
    case when is_valid then {_group(4)} end as method,
    case when is_valid then {_group(5)} end as resource,
    case when is_valid then {_group(6)} end as protocol,
    case when is_valid then cast({_group(7)} as integer) end as status_code,
    case when is_valid then
      case when {_group(8)} = '-' then 0 else cast({_group(8)} as bigint) end end as bytes,
    is_valid
  from verdicts)"""

PARSED = f"{ALL_PARSED}, parsed as (select * from all_parsed where is_valid)"


def _daily(by: str = "", source: str = "parsed") -> str:
    return f"""select {by} log_date, status_code, count(*) as request_count,
      cast(sum(bytes) as bigint) as total_bytes
    from {source} group by all"""


def _top(by: str = "", source: str = "parsed") -> str:
    over = f"partition by {by.rstrip(', ')}" if by else ""
    return f"""select * exclude (rank_no) from (
      select *, row_number() over ({over} order by request_count desc, resource_path desc) as rank_no
      from (
        select {by} resource as resource_path, count(*) as request_count,
          cast(sum(bytes) as bigint) as total_bytes, count(distinct host) as distinct_host_count
        from {source} group by {by} resource))
    where rank_no <= 20"""


def _top_hosts(by: str = "") -> str:
    return f"""select {by} resource_path, host, count(*) as request_count,
      cast(sum(bytes) as bigint) as total_bytes
    from (select *, resource as resource_path from parsed)
    join (select {by} resource_path from ({_top(by)})) using ({by} resource_path)
    group by all"""


def _error_hosts(by: str = "") -> str:
    return f"""select {by} log_date, log_hour, host, count(*) as error_request_count
    from parsed where status_code between 400 and 599 group by all"""


def _hours(by: str = "", source: str = "parsed") -> str:
    error = "status_code between 400 and 599"
    return f"""select {by} log_date, log_hour,
      count(*) filter (where {error}) as error_request_count,
      count(*) as total_request_count,
      cast(count(*) filter (where {error}) as double) / count(*) as error_rate,
      count(distinct host) filter (where {error}) as distinct_error_hosts
    from {source} group by {by} log_date, log_hour"""


RUNS = """
runs as (
  select cast(o_orderkey + 1 as bigint) as run_id,
    case o_custkey % 4 when 0 then 'mr' when 1 then 'pig' when 2 then 'hive'
      else 'mongodb' end as pipeline_name,
    concat('logs', cast(o_orderkey % 3 as varchar), '_', case o_orderkey % 4
      when 0 then '500' when 1 then '1000' when 2 then '5000' else '10000' end) as dataset_name,
    cast(case o_orderkey % 4 when 0 then 500 when 1 then 1000 when 2 then 5000
      else 10000 end as double) as avg_batch_size,
    case when o_orderstatus = 'P' then cast(0 as double)
      else cast(floor(o_totalprice) as double) end as total_runtime,
    cast(case when o_orderkey % 13 = 0 then case when o_orderkey % 11 = 0 then 500
      else 20000 + o_orderkey end else o_custkey % 100 end as bigint)
      as total_malformed_record_count,
    cast(case when o_orderkey % 11 = 0 then 500 else 20000 + o_orderkey end as bigint)
      as total_record_count,
    o_orderdate + to_milliseconds(o_orderkey) as execution_timestamp
  from orders)"""

BATCHES = """
batches as (
  select cast(l_orderkey + 1 as bigint) as run_id, l_linenumber as batch_no,
    cast(sum(cast(l_quantity as bigint)) as bigint) as record_count,
    cast(count(*) as bigint) as malformed_record_count,
    cast(sum(floor(l_extendedprice)) as double) as batch_runtime
  from lineitem group by l_orderkey, l_linenumber)"""

TIMINGS = f"""{BATCHES},
timings as (
  select run_id, batch_no, q as query_number,
    cast(record_count * q * 7 + batch_no as double) as query_runtime
  from batches, (values (1), (2), (3)) t(q))"""

TARGET_RUN = f"target as (select * from runs where run_id = {TARGET})"
SUCCESS = "total_runtime > 0 and total_malformed_record_count < total_record_count"

# The latest successful run of every other engine on the target's dataset.
COMPETITORS = f"""{TARGET_RUN},
competitors as (
  select * from runs
  where {SUCCESS} and dataset_name = (select dataset_name from target)
    and pipeline_name <> (select pipeline_name from target)
  qualify row_number() over (partition by pipeline_name
    order by execution_timestamp desc, run_id desc) = 1)"""

FAMILY = f"""{TARGET_RUN},
base as (select regexp_replace(dataset_name, '_[^_]*$', '') || '_' as prefix, pipeline_name from target),
family as (
  select r.*, cast(regexp_extract(r.dataset_name, '_([0-9]+)$', 1) as integer) as target_batch_size
  from runs r, base b
  where r.run_id = {TARGET} or (starts_with(r.dataset_name, b.prefix)
    and r.pipeline_name = b.pipeline_name and total_runtime > 0 and total_record_count > 1000)
  qualify row_number() over (partition by r.dataset_name
    order by r.run_id = {TARGET} desc, execution_timestamp desc, r.run_id desc) = 1)"""

STATS = """
stats as (
  select cast(l_orderkey + 1 as bigint) as run_id, l_linenumber as batch_no,
    max(cast(l_quantity as bigint)) as record_count, max(l_suppkey % 10) as malformed_record_count,
    sum(cast(floor(l_extendedprice) as double)) as batch_runtime
  from lineitem group by all)"""


def oracle(name: str, body: str, *ctes: str) -> None:
    ORACLES[name] = (f"with {', '.join(ctes)} " if ctes else "") + body


PARSED_COLUMNS = "host, log_date, log_hour, method, resource, protocol, status_code, bytes"

oracle("parse_logs", f"select event_id, batch_no, {PARSED_COLUMNS}, is_valid from all_parsed", ALL_PARSED)
oracle("parse_log_function", f"select event_id, {PARSED_COLUMNS} from parsed", PARSED)
oracle(
    "malformed_lines",
    "select event_id, value, batch_no from all_parsed where not is_valid",
    ALL_PARSED,
)
oracle(
    "clean_bytes",
    """select o_orderkey, raw, case when raw = '-' then 0
        when regexp_matches(raw, '^[0-9]+$') then cast(try_cast(raw as integer) as bigint) end as bytes
      from (select o_orderkey, case when o_orderkey % 10 = 3 then '-'
          when o_orderkey % 17 = 5 then '2147483648' when o_orderkey % 17 = 6 then '2147483647'
          when o_orderkey % 19 = 7 then '' when o_orderkey % 23 = 1 then concat(o_orderkey, 'a')
          else cast(o_orderkey * 37 as varchar) end as raw from orders)""",
)
QUALITY = """count(*) as total_records, count(*) filter (where is_valid) as valid_records,
  count(*) filter (where not is_valid) as malformed_records"""
oracle("batch_quality", f"select batch_no, {QUALITY} from all_parsed group by batch_no", ALL_PARSED)
oracle("parse_summary", f"select {QUALITY} from all_parsed", ALL_PARSED)
oracle(
    "log_dates",
    """select o_orderkey, log_date, cast(try_strptime(
          '01/' || upper(substr(log_date, 4, 1)) || lower(substr(log_date, 5, 2)) || substr(log_date, 7, 5),
          '%d/%b/%Y') as date) + (cast(substr(log_date, 1, 2) as integer) - 1) as as_date
      from (select o_orderkey, concat(lpad(cast(o_orderkey % 40 as varchar), 2, '0'), '/',
          (['Jan', 'feb', 'MAR', 'Apr', 'May', 'JUN', 'Jul', 'aug', 'Sep', 'Oct', 'Nov', 'Dec',
            'Xyz'])[o_custkey % 13 + 1], '/', cast(1995 + o_orderkey % 30 as varchar)) as log_date
        from orders)""",
)

oracle(
    "batch_identity",
    """select o_orderkey, file_name,
        cast(case when k in (1, 2, 6, 7, 0) and k <> 1 then o_custkey
          when k = 4 then o_custkey else 0 end as integer) as batch_no,
        cast(case when k in (0, 4, 7) then o_orderkey else 0 end as integer) as declared_count
      from (select o_orderkey, o_custkey, o_orderkey % 8 as k, case o_orderkey % 8
          when 1 then concat('b', o_custkey, '.txt')
          when 2 then concat('b', o_custkey, '_x', o_orderkey, '.txt')
          when 3 then concat('x', o_custkey, '_', o_orderkey, '.txt')
          when 4 then concat(o_custkey, '_', o_orderkey, '.txt')
          when 5 then concat('web_b', o_custkey, '_', o_orderkey, '.old.txt')
          when 6 then concat('b', o_custkey, '_', o_orderkey)
          else concat('b', o_custkey, '_', o_orderkey, '.txt') end as file_name
        from orders)""",
)
oracle(
    "assign_batches",
    """select event_id, row_no, cast(row_no // 700 + 1 as integer) as batch_no
      from (select event_id, row_number() over (order by ts desc, event_id) - 1 as row_no from events)""",
)
oracle(
    "dataset_stats",
    """select cast(sum(n) as bigint) as total_records, count(*) as total_batches,
        avg(n) as avg_batch_size
      from (select event_id // 3000 as batch_no, count(*) as n from events group by 1)""",
)
oracle(
    "dataset_family",
    r"""select o_orderkey, dataset_name,
        case when contains(dataset_name, '_')
          then array_to_string(parts[:-2], '_') else dataset_name end as dataset_base,
        case when regexp_matches(parts[-1], '^[0-9]+$')
          then cast(parts[-1] as integer) end as target_batch_size
      from (select *, string_split(dataset_name, '_') as parts from (
        select o_orderkey, case o_orderkey % 6
          when 1 then concat('logs', o_custkey) when 2 then concat('logs_x', o_custkey)
          when 3 then concat('a_b', o_custkey, '_', o_orderkey) when 4 then cast(o_custkey as varchar)
          when 5 then concat('logs_', o_custkey, '_')
          else concat('logs', o_custkey, '_', o_orderkey) end as dataset_name from orders))""",
)

oracle(
    "tag_errors",
    "select event_id, status_code, status_code between 400 and 599 as is_error from parsed",
    PARSED,
)
oracle("daily_traffic", _daily(), PARSED)
oracle("top_resources", _top(), PARSED)
oracle("hourly_errors", _hours(), PARSED)
oracle("top_resource_hosts", _top_hosts(), PARSED)
oracle("error_hosts", _error_hosts(), PARSED)
oracle("top_resource_hosts_by_batch", _top_hosts("batch_no, "), PARSED)
oracle("error_hosts_by_batch", _error_hosts("batch_no, "), PARSED)
oracle("hourly_errors_join", _hours(), PARSED)
oracle("daily_traffic_by_batch", _daily("batch_no, "), PARSED)
oracle("top_resources_by_batch", _top("batch_no, "), PARSED)
oracle("hourly_errors_by_batch", _hours("batch_no, "), PARSED)
oracle("merged_daily_traffic", _daily(), PARSED)
oracle(
    "merged_top_resources",
    f"""select t.resource_path, cast(sum(n) as bigint) as request_count,
        cast(sum(b) as bigint) as total_bytes, count(distinct host) as distinct_host_count
      from (select batch_no, resource as resource_path, host, count(*) as n, sum(bytes) as b
            from parsed group by all) t
      join (select batch_no, resource_path from ({_top('batch_no, ')})) w using (batch_no, resource_path)
      group by t.resource_path""",
    PARSED,
)
oracle(
    "merged_hourly_errors",
    f"""select log_date, log_hour, error_request_count, total_request_count, distinct_error_hosts
      from ({_hours()})""",
    PARSED,
)
oracle(
    "split_hosts",
    """select event_id, array_to_string(hosts, ',') as hosts_list,
        cast(len(hosts) as integer) as host_count
      from (select event_id, list_sort(list_distinct(list_filter(
          list_transform(string_split(hosts_text, ','), lambda h: trim(h)),
          lambda h: h <> '' and h <> 'null'))) as hosts
        from (select event_id, case when event_id % 11 = 0 then '' when event_id % 11 = 1 then 'null'
            else concat('u', user_id, ', u', user_id % 7, ' ,null,,u', event_id % 5, ',u', user_id)
            end as hosts_text from events))""",
)
oracle(
    "global_top_resources",
    """select resource as resource_path, count(*) as request_count,
        cast(sum(bytes) as bigint) as total_bytes, count(distinct host) as distinct_host_count
      from parsed group by resource order by request_count desc, resource desc limit 50""",
    PARSED,
)
oracle("top_resources_in_rounds", ORACLES["top_resources"])
oracle("top_resources_in_rounds_by_batch", ORACLES["top_resources_by_batch"])
oracle("global_top_resources_in_rounds", ORACLES["global_top_resources"])
oracle("merged_top_resources_by_bitmaps", ORACLES["merged_top_resources"])
oracle("merged_hourly_errors_by_bitmaps", ORACLES["merged_hourly_errors"])
oracle(
    "top_resources_ordered",
    f"""select *, cast(row_number() over (partition by batch_no order by request_count desc, resource_path desc) as integer) as rank
      from ({_top('batch_no, ')})""",
    PARSED,
)

oracle(
    "successful_runs",
    f"""select 'parsed something' as variant, run_id from runs where {SUCCESS}
      union all select 'over 1000 records', run_id from runs
      where total_runtime > 0 and total_record_count > 1000""",
    RUNS,
)
oracle(
    "latest_runs",
    f"""select dataset_name, pipeline_name, run_id, total_runtime from runs where {SUCCESS}
      qualify row_number() over (partition by dataset_name, pipeline_name
        order by execution_timestamp desc, run_id desc) = 1""",
    RUNS,
)
oracle("batch_totals", "select * from stats", STATS)
oracle(
    "run_totals",
    """select run_id, sum(batch_runtime) as total_runtime,
        cast(sum(malformed_record_count) as bigint) as total_malformed_record_count,
        cast(sum(record_count) as bigint) as total_record_count from stats group by run_id""",
    STATS,
)
oracle(
    "run_history",
    """select run_id, pipeline_name as pipeline, dataset_name as dataset,
        execution_timestamp as timestamp
      from runs where total_runtime > 0 order by run_id desc""",
    RUNS,
)
oracle(
    "run_history_json",
    """select run_id, concat('{"id":', run_id, ',"pipeline":"', pipeline_name, '","dataset":"',
        dataset_name, '","timestamp":"',
        regexp_replace(strftime(execution_timestamp, '%Y-%m-%d %H:%M:%S.%f'), '0{1,5}$', ''),
        '"}') as json
      from runs where total_runtime > 0 order by run_id desc""",
    RUNS,
)
ENGINES = "(values (0, 'mr'), (1, 'pig'), (2, 'hive'), (3, 'mongodb')) e(pos, engine)"
oracle(
    "data_quality",
    f"""select engine, run_id, total_record_count - total_malformed_record_count as valid,
        total_malformed_record_count as malformed,
        coalesce(run_id = {TARGET}, false) as is_baseline, run_id is not null as has_history
      from {ENGINES} left join (select * from target union all select * from competitors) r
        on r.pipeline_name = engine order by pos""",
    RUNS,
    COMPETITORS,
)
oracle(
    "engine_comparison",
    """select pipeline_name as pipeline, run_id, total_runtime
      from (select * from target union all select * from competitors)""",
    RUNS,
    COMPETITORS,
)
oracle(
    "query_totals",
    f"""select query_number, sum(query_runtime) as total_time from timings
      where run_id = {TARGET} group by query_number order by query_number""",
    TIMINGS,
)
oracle(
    "batch_query_times",
    f"""select batch_no, query_number, query_runtime from timings where run_id = {TARGET}
      order by batch_no, query_number""",
    TIMINGS,
)
oracle(
    "batch_query_times_wide",
    f"""select batch_no, sum(query_runtime) filter (where query_number = 1) as q1,
        sum(query_runtime) filter (where query_number = 2) as q2,
        sum(query_runtime) filter (where query_number = 3) as q3
      from timings where run_id = {TARGET} group by batch_no order by batch_no""",
    TIMINGS,
)
oracle(
    "cross_engine_timing",
    f"""select pipeline_name as pipeline, query_number, avg(query_runtime) as avg_time
      from timings join runs using (run_id)
      where run_id = {TARGET} or run_id in (select run_id from competitors)
      group by all order by all""",
    RUNS,
    COMPETITORS,
    TIMINGS,
)
SUMMARY = """run_id, pipeline_name as pipeline, dataset_name as dataset,
  (select count(*) from batches b where b.run_id = r.run_id) as total_batches,
  avg_batch_size, total_runtime, total_malformed_record_count as total_malformed"""
oracle("run_summary", f"select {SUMMARY} from target r", RUNS, TARGET_RUN, BATCHES)
oracle(
    "run_comparison",
    f"""select {SUMMARY} from (
        select * from runs
        where total_runtime > 0 and total_record_count > 1000
          and dataset_name = (select dataset_name from target)
          and pipeline_name <> (select pipeline_name from target)
        qualify row_number() over (partition by pipeline_name
          order by execution_timestamp desc, run_id desc) = 1) r order by total_runtime""",
    RUNS,
    TARGET_RUN,
    BATCHES,
)
oracle("batch_size_runtime", "select target_batch_size, total_runtime from family order by 1", RUNS, FAMILY)
oracle(
    "batch_size_avg_time",
    """select target_batch_size, (select avg(batch_runtime) from batches b
        where b.run_id = f.run_id) as avg_batch_time from family f order by 1""",
    RUNS,
    FAMILY,
    BATCHES,
)
oracle(
    "batch_size_throughput",
    """select target_batch_size, case when total_runtime <> 0
        then cast(total_record_count as double) / total_runtime end as records_per_second
      from family order by 1""",
    RUNS,
    FAMILY,
)
oracle(
    "batch_view",
    f"""select batch_no, record_count, batch_runtime, malformed_record_count as malformed
      from batches where run_id = {TARGET} order by batch_no""",
    BATCHES,
)
oracle(
    "batch_comparison",
    f"""select concat(upper(pipeline_name), ' (', case when run_id = {TARGET} then 'Target'
          else 'Fastest' end, ' Exec: ', run_id, ')') as series, batch_no, batch_runtime
      from batches join (
        select run_id, pipeline_name from target
        union all (select run_id, pipeline_name from (
          select run_id, pipeline_name, sum(batch_runtime) as total
          from runs join batches using (run_id)
          where dataset_name = (select dataset_name from target)
            and pipeline_name <> (select pipeline_name from target)
          group by all)
        qualify row_number() over (partition by pipeline_name order by total, run_id) = 1))
        using (run_id)
      order by series, batch_no""",
    RUNS,
    TARGET_RUN,
    BATCHES,
)


def _merged(size: int) -> str:
    """Merged top resources of a run with batches of the given size, as one text per row."""
    return f"""select concat_ws('|', t.resource_path, sum(n), sum(b), count(distinct host)) as row_text
      from (select event_id // {size} as b_no, resource as resource_path, host, count(*) as n,
              sum(bytes) as b from parsed group by all) t
      join (select b_no, resource_path from (
              select event_id // {size} as b_no, resource as resource_path, row_number() over (
                partition by event_id // {size} order by count(*) desc, resource desc) as rank_no
              from parsed group by b_no, resource) where rank_no <= 20) w using (b_no, resource_path)
      group by t.resource_path"""


# Daily and hourly results do not depend on the batch size, so only the merged top lists
# can tell the runs apart.
oracle(
    "integrity_scorecard",
    """select engine, cast(run_id as bigint) as run_id, case pos when 0 then 'BASELINE'
        when 1 then case when exists (select row_text from small except select row_text from large)
          or exists (select row_text from large except select row_text from small)
          then 'MISMATCH' else 'MATCH' end
        when 2 then 'MATCH' else 'NO_HISTORY' end as status
      from (values (0, 'mr', 1), (1, 'pig', 2), (2, 'hive', 3), (3, 'mongodb', null)) e(pos, engine, run_id)
      order by pos""",
    PARSED,
    f"small as ({_merged(2500)})",
    f"large as ({_merged(5000)})",
)

oracle(
    "result_differences",
    """select cast(2 as bigint) as run_id, 2 as query_number, key, field, s.value as target_value, l.value as other_value
      from (unpivot (select split_part(row_text, '|', 1) as key, split_part(row_text, '|', 2)::bigint as request_count,
          split_part(row_text, '|', 3)::bigint as total_bytes, split_part(row_text, '|', 4)::bigint as distinct_host_count from small)
        on request_count, total_bytes, distinct_host_count into name field value value) s
      full join (unpivot (select split_part(row_text, '|', 1) as key, split_part(row_text, '|', 2)::bigint as request_count,
          split_part(row_text, '|', 3)::bigint as total_bytes, split_part(row_text, '|', 4)::bigint as distinct_host_count from large)
        on request_count, total_bytes, distinct_host_count into name field value value) l using (key, field)
      where s.value is distinct from l.value""",
    PARSED,
    f"small as ({_merged(2500)})",
    f"large as ({_merged(5000)})",
)
oracle(
    "scorecard_all_clear",
    """select not exists (select row_text from small except select row_text from large)
        and not exists (select row_text from large except select row_text from small) as all_clear""",
    PARSED,
    f"small as ({_merged(2500)})",
    f"large as ({_merged(5000)})",
)
oracle(
    "batch_files",
    """select value, batch_no,
        cast(count(*) over (partition by batch_no) as integer) as declared_count from all_parsed""",
    ALL_PARSED,
)
oracle(
    "declared_counts",
    """select batch_no, cast(count(*) as integer) as declared_count,
        count(*) filter (where batch_no % 3 = 0 or not ends_with(value, '7')) as lines
      from all_parsed group by batch_no
      having declared_count <> lines and lines > 0""",
    ALL_PARSED,
)
oracle(
    "line_batches",
    """select cast(row_no // 700 + 1 as integer) as batch_no, count(*) as lines,
        min(row_no) as first_row, max(row_no) as last_row
      from (select row_number() over () - 1 as row_no from events) group by 1""",
)
oracle("parsed_tsv", f"select {PARSED_COLUMNS} from parsed", PARSED)
oracle("stored_malformed", ORACLES["malformed_lines"])
oracle("hosts_from_text", ORACLES["merged_hourly_errors"])
oracle(
    "run_metadata",
    """select cast(7 as bigint) as run_id, 'spark' as pipeline_name, 'web_2500' as dataset_name,
        cast(count(*) as double) / count(distinct batch_no) as avg_batch_size,
        count(*) filter (where not is_valid) as total_malformed_record_count,
        count(*) as total_record_count
      from all_parsed""",
    ALL_PARSED,
)

DAY = "strftime(strptime(log_date, '%d/%b/%Y'), '%Y-%m-%d')"
STORED = f"""
  select 'daily_traffic' as result, batch_no, {DAY} as key, cast(status_code as bigint) as second,
    request_count as first_number, total_bytes as second_number from ({_daily('batch_no, ')})
  union all select 'top_resources', batch_no, resource_path, distinct_host_count, request_count,
    total_bytes from ({_top('batch_no, ')})
  union all select 'top_resource_hosts', batch_no, concat(resource_path, ' ', host), null,
    request_count, total_bytes from ({_top_hosts('batch_no, ')})
  union all select 'hourly_errors', batch_no, concat({DAY}, ' ', log_hour), distinct_error_hosts,
    error_request_count, total_request_count from ({_hours('batch_no, ')})
  union all select 'error_hosts', batch_no, concat({DAY}, ' ', host), log_hour,
    error_request_count, null from ({_error_hosts('batch_no, ')})"""
oracle("run_results", STORED, PARSED)
oracle("compacted_results", STORED, PARSED)
oracle(
    "stream_batches",
    f"select *, (select count(*) from raw_log) as total_record_count from ({STORED})",
    PARSED,
)

# Windows are closed once the newest valid line is an hour past their end.
CLOSED = "where date_trunc('{unit}', ts) + interval 1 {unit} <= (select max(date_trunc('second', ts)) - interval 1 hour from parsed)"
oracle(
    "stream_hourly_errors",
    _hours("", f"(select * from parsed {CLOSED.format(unit='hour')})"),
    PARSED,
)
oracle(
    "stream_error_hosts",
    f"""select log_date, log_hour, host, count(*) as error_request_count
      from (select * from parsed {CLOSED.format(unit='hour')})
      where status_code between 400 and 599 group by all""",
    PARSED,
)
oracle(
    "stream_daily_traffic",
    _daily("", f"(select * from parsed {CLOSED.format(unit='day')})"),
    PARSED,
)

oracle(
    "data_quality_unlisted",
    f"""select case when pipeline_name = 'pig' then 'spark' else pipeline_name end as engine, run_id,
        total_record_count - total_malformed_record_count as valid,
        total_malformed_record_count as malformed, run_id = {TARGET} as is_baseline, true as has_history
      from (select * from target union all select * from competitors)""",
    RUNS,
    COMPETITORS,
)
oracle(
    "reloaded_results",
    "select cast(0 as bigint) as stored_rows, count(*) as malformed, count(*) as records from events",
)
oracle(
    "tsv_special_characters",
    """select concat('h"', user_id) as host, '01/Jul/1995' as log_date, cast(event_id % 24 as integer) as log_hour,
        'GET' as method, concat('/a"', event_id % 7, chr(92), event_id % 3, ',', chr(39)) as resource,
        'HTTP/1.0' as protocol, 200 as status_code, event_id as bytes from events""",
)
# The names the plan gives them.
ORACLES["pipeline_comparison"] = ORACLES["engine_comparison"]
ORACLES["cross_pipeline_timing"] = ORACLES["cross_engine_timing"]
# With its open windows a finite stream gives what the batch queries give.
ORACLES["stream_hours_finished"] = ORACLES["hourly_errors"]
ORACLES["stream_days_finished"] = ORACLES["daily_traffic"]
oracle(
    "late_rows",
    """select log_date, log_hour, count(*) filter (where event_id % 7 = 3) as late_lines
      from parsed
      where date_trunc('hour', ts) + interval 1 hour <= (
        select max(date_trunc('second', ts)) - interval 1 hour from parsed where event_id % 7 <> 3)
      group by all
      having late_lines > 0 and count(*) filter (where event_id % 7 <> 3) > 0""",
    PARSED,
)
