"""DuckDB SQL for the registered queries, for comparison only; the library does not use it.

Where the library takes another way than plain SQL (aggregates instead of windows, cheap tests
before casts), the SQL here takes the plain one.
"""

from __future__ import annotations

from billweave.operators.staging import DEFAULT_SOURCE_RELATION
from billweave.schema import (
    INSTANCE_COUNTS,
    INSTANCE_DIMENSIONS,
    OVERVIEW_DIMENSIONS,
    OVERVIEW_MEASURES,
    PRODUCT_COUNTS,
    PRODUCT_DIMENSIONS,
    REPORT_COLUMNS,
    REPORT_KINDS,
    ROLLUP_TOTALS,
    STAGING_SOURCES,
)
from billweave.sources.star_schema import FILLED_COLUMNS

# Rows of a batch at most, in the query of bounded batches.
BOUNDED_ROWS = 25_000
RESTAMPED_AT = "2026-05-28 00:00:00.000"

_TYPES = {"text": "varchar", "time": "timestamp", "int": "bigint", "number": "float"}
_AGGREGATES = {
    "total": "sum(coalesce({0}, 0))",
    "mean": "avg({0})",
    "largest": "max({0})",
    "smallest": "min({0})",
    "rows": "count({0})",
}


def _listed(items) -> str:
    return ",\n  ".join(items)


RAW = f"""
lines as (
  select *, substr(cast(l_shipdate as varchar), 1, 7) as m, if(year(l_shipdate) < 1998, ' (old)', '') as era,
    ['Compute', 'Storage', 'Network'][1 + l_partkey % 3] as service
  from lineitem join nation on l_suppkey % 25 = n_nationkey
),
raw as (select
  {_listed(f"{FILLED_COLUMNS[c]} as {c}" for c in REPORT_COLUMNS)}
  from lines
)"""


def _typed(source: str = "raw", **replaced: str) -> str:
    columns = [
        f"try_cast(nullif({replaced.get(c, c)}, '') as {_TYPES[REPORT_KINDS[c]]}) as {c}"
        for c in REPORT_COLUMNS
    ]
    return f"""
typed as (select '{DEFAULT_SOURCE_RELATION}' as source_relation,
  {_listed(columns)}
  from {source}
)"""


_COMPUTED = {
    "source_relation": "source_relation",
    "report": "trim(split_part(_file, '/', 1) || '/' || split_part(_file, '/', 2), '/')",
    "product_name": "coalesce(product_product_name, json_extract_string(product, '$.product_name'))",
    "is_latest_file_version": "_modified = max(_modified) over "
    "(partition by bill_billing_period_start_date)",
}
FLAGGED = f"""
flagged as (select
  {_listed(f"{_COMPUTED.get(c) or f'coalesce({", ".join([*s, "null"])})'} as {c}" for c, s in STAGING_SOURCES.items())}
  from typed
)"""


def _staging(start: str = "1970-01-01", **replaced: str) -> str:
    return f"""with {RAW}, {_typed(**replaced)}, {FLAGGED},
staging as (
  select * from flagged
  where is_latest_file_version and billing_period_start_date::date >= date '{start}'
)"""


def _names(account: str, seen: str) -> str:
    return f"""select {account}_id, {account}_name, source_relation
from (
  select {account}_id, {account}_name, source_relation, max({seen}) as last_seen
  from staging where {account}_name is not null group by all
)
qualify row_number() over (
  partition by {account}_id, source_relation order by last_seen desc, {account}_name) = 1"""


def _key(dimensions) -> str:
    parts = [f"coalesce({c}::varchar, '_dbt_utils_surrogate_key_null_')" for c in dimensions]
    return f"md5(concat_ws('-', {', '.join(parts)})) as unique_key"


_PICKED = {
    "usage_account_name": "coalesce(s.usage_account_name, u.usage_account_name)",
    "bill_payer_account_name": "coalesce(s.bill_payer_account_name, p.bill_payer_account_name)",
    "usage_start_date": "s.usage_start_date::date",
    "usage_end_date": "s.usage_end_date::date",
}
OVERVIEW = f"""{_staging()},
usage_names as ({_names("usage_account", "usage_start_date")}),
payer_names as ({_names("bill_payer_account", "billing_period_start_date")}),
grouped as (select
  {_listed(f"{_PICKED.get(c, 's.' + c)} as {c}" for c in OVERVIEW_DIMENSIONS)},
  {_listed(f"cast({_AGGREGATES[kind].format('*' if source == '*' else 's.' + source)} as decimal(28,6)) as {name}" for name, kind, source in OVERVIEW_MEASURES)}
  from staging s
  left join usage_names u
    on s.usage_account_id = u.usage_account_id and s.source_relation = u.source_relation
  left join payer_names p
    on s.bill_payer_account_id = p.bill_payer_account_id and s.source_relation = p.source_relation
  group by all
),
overview as (select *, {_key(OVERVIEW_DIMENSIONS)} from grouped)"""


def _rollup(dimensions, counts) -> str:
    totals = [f"sum(coalesce(o.{old}, 0)) as {new}" for new, old in ROLLUP_TOTALS.items()]
    distinct = [f"count(distinct o.{old}) as {new}" for new, old in counts.items()]
    keys = ["o.usage_start_date as usage_date" if c == "usage_date" else f"o.{c}" for c in dimensions]
    return f"""{OVERVIEW}, rolled as (
  select {_listed([*keys, *distinct, *totals])} from overview o group by all
)
select *, {_key(dimensions)} from rolled"""


def _landed(column: str) -> str:
    """A report column as ingest stores it: texts as they are, fractions of whole numbers cut off."""
    cast = {
        "text": "{0}",
        "time": "try_cast({0} as timestamp)",
        "int": "try_cast(trunc(try_cast({0} as double)) as bigint)",
        "number": "try_cast({0} as double)",
    }
    return f"{cast[REPORT_KINDS[column]].format(column)} as {column}"


def _cast_failures() -> str:
    judged = [c for c in REPORT_COLUMNS if REPORT_KINDS[c] != "text"]
    counts = [
        f"select '{c}' as column_name, count(*) as failed_rows from raw "
        f"where {c} <> '' and try_cast({c} as {_TYPES[REPORT_KINDS[c]]}) is null"
        for c in judged
    ]
    return f"with {RAW} select * from (" + " union all ".join(counts) + ") where failed_rows > 0"


def all_queries() -> dict[str, str]:
    product = _rollup(PRODUCT_DIMENSIONS, PRODUCT_COUNTS)
    return {
        "raw_report": f"with {RAW} select * from raw",
        "typed_staging": f"with {RAW}, {_typed()} select * from typed",
        "staging_report": f"{_staging()} select * from staging",
        "latest_file_version": f"""with {RAW}, {_typed()}, {FLAGGED}
select _file, _line, _modified, billing_period_start_date, is_latest_file_version from flagged""",
        "start_date_filter": f"{_staging('1998-01-01')} select * from staging",
        "usage_account_names": f"{_staging()} {_names('usage_account', 'usage_start_date')}",
        "billing_account_names": f"{_staging()} {_names('bill_payer_account', 'billing_period_start_date')}",
        "daily_overview": f"{OVERVIEW} select * from overview",
        "daily_product_report": product,
        "daily_instance_report": _rollup(INSTANCE_DIMENSIONS, INSTANCE_COUNTS),
        "key_unique_failures": f"""{OVERVIEW}
select unique_key, count(*) as n_records from overview
where unique_key is not null group by all having count(*) > 1""",
        "key_null_failures": f"{OVERVIEW} select unique_key from overview where unique_key is null",
        "duplicates_of_a_dimension": f"""{OVERVIEW}
select line_item_description, count(*) as n_records from overview
where line_item_description is not null group by all having count(*) > 1""",
        "nulls_of_a_dimension": f"""{OVERVIEW}
select unique_key, instance_type from overview where instance_type is null""",
        "cast_failures": _cast_failures(),
        "row_counts": f"""{OVERVIEW}
select 'raw' as table_name, count(*) as n_rows from raw
union all select 'staging', count(*) from staging
union all select 'overview', count(*) from overview""",
        "restamped_report": f"""{_staging(_modified=repr(RESTAMPED_AT))} select * from staging""",
        "ctas_sample": f"with {RAW} select _file, _line from raw order by _file, _line limit 10",
        "append_readback": f"with {RAW} select {_listed(map(_landed, REPORT_COLUMNS))} from raw",
        "event_envelopes": """select event_type as _file, event_id as _line,
  ts - interval 2 hour as _modified,
  make_timestamp((1700000000000 + event_id) * 1000) as _fivetran_synced,
  value as line_item_unblended_cost, cast(null as double) as line_item_usage_amount,
  props as product
from events""",
        "stream_ingest_marts": product,
        "written_overview": f"{OVERVIEW} select * from overview",
        "written_product_report": product,
        "written_instance_report": _rollup(INSTANCE_DIMENSIONS, INSTANCE_COUNTS),
        "table_checks": f"""select 'daily_overview' as table_name, count(*) as n_rows from ({OVERVIEW} select * from overview)
union all select 'daily_product_report', count(*) from ({product})
union all select 'daily_instance_report', count(*) from ({_rollup(INSTANCE_DIMENSIONS, INSTANCE_COUNTS)})""",
        "parquet_folder": f"with {RAW} select * from raw",
        "csv_folder": f"with {RAW} select {_listed(f"nullif({c}, '') as {c}" for c in REPORT_COLUMNS)} from raw",
        "csv_catalog": f"with {RAW} select {_listed(f"nullif({c}, '') as {c}" for c in REPORT_COLUMNS)} from raw",
        "landed_report": f"{_staging()} select * from staging",
        "compacted_ingest": f"with {RAW} select {_listed(map(_landed, REPORT_COLUMNS))} from raw",
        "merged_states_overview": f"{OVERVIEW} select * from overview",
        "appended_parquet": "select count(*) as n_rows from lineitem",
        "row_bounded_ingest": f"""with total as (select count(*) as n from lineitem)
select 'batch-' || i as ingest_batch, least({BOUNDED_ROWS}, n - i * {BOUNDED_ROWS}) as n_rows
from total, unnest(range(0, (n + {BOUNDED_ROWS} - 1) // {BOUNDED_ROWS})) as t(i)""",
        "catalog_table": f"{_staging()} select * from staging",
        "table_lifecycle": f"""with {RAW}
select 'appended' as step, count(*) as n_rows from raw
union all select 'after truncate', 0
union all select 'refunds', count(*) from raw where bill_bill_type = 'Refund'
union all select 'tables after drop', 0
union all select 'probe', 1""",
    }
