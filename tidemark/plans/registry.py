"""Named queries over the given tables, each with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.star import Star


@dataclass(frozen=True)
class Entry:
    name: str
    operators: tuple[str, ...]
    build: Callable[[Star], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Star(spark, sf_dir))


ENTRIES: dict[str, Entry] = {}


def query(operators: str, sql: str | None):
    """Register a function of the tables under its own name."""

    def register(fn: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
        if fn.__name__ in ENTRIES:
            raise ValueError(f"query {fn.__name__} is registered twice")
        ENTRIES[fn.__name__] = Entry(fn.__name__, tuple(operators.split()), fn, sql)
        return fn

    return register


def id_sql(*parts: str) -> str:
    """SQL of an id derived from text expressions: each after its length, null as '-'."""
    return "sha256(" + " || ".join(f"coalesce(length({p}) || ':' || {p}, '-')" for p in parts) + ")"


# Shared SQL: the tables in the shapes of the data model.
MONTHLY = """monthly as (
  select c_mktsegment as indicator_id, r_name as geo_code,
         cast(date_trunc('month', o_orderdate) as date) as period_start,
         cast(substr(o_orderpriority, 1, 1) as integer) as digit,
         cast(sum(cast(o_totalprice as decimal(28,8))) as decimal(28,8)) as value
  from orders join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
  group by 1, 2, 3, 4)"""

OBSERVATIONS = (
    MONTHLY
    + """, observations as (
  select indicator_id, geo_code, strftime(period_start, '%Y-%m') as period, period_start,
         last_day(period_start) as period_end,
         cast(last_day(period_start) + digit as date) as vintage_date, value, 'usd' as unit,
         case when indicator_id = 'BUILDING' then 'sa' else 'nsa' end as seasonal_adjustment,
         cast(timestamp '2002-01-01' + digit * interval '1 day' as timestamp) as retrieved_at,
         timestamp '2002-02-01' as processed_at, digit
  from monthly), latest as (
  select * from (select *, row_number() over (
      partition by indicator_id, geo_code, period order by vintage_date desc) as rn from observations)
  where rn = 1)"""
)

KPI_SELECT = """select indicator_id, geo_code, period, period_start, value,
  round((value - lag(value, 1) over w) / nullif(lag(value, 1) over w, 0) * 100, 4) as mom_pct_change,
  round((value - lag(value, 12) over w) / nullif(lag(value, 12) over w, 0) * 100, 4) as yoy_pct_change
from latest window w as (partition by indicator_id, geo_code order by period_start)"""

RUNS = """runs as (
  select cast(event_id as varchar) as run_id, 'user_' || user_id as dataset_id, ts as started_at,
         ts + to_microseconds(cast(cast(value as decimal(20,2)) * 1000000 as bigint)) as finished_at,
         case when event_type = 'error' then 'failed' when event_type = 'signup' then 'partial'
              else 'success' end as status,
         cast(json_extract_string(props, '$.k') as integer) as retry_count,
         case when event_type = 'error' then props end as error
  from events)"""

DATASETS = """datasets as (
  select 'user_' || c_custkey as dataset_id from customer
  where c_custkey <= (select max(user_id) from events))"""

ENVELOPES = """envelopes as (
  select user_id || '-' || strftime(ts, '%Y%m%d') as event_id,
    case event_type when 'signup' then 'ingestion.requested' when 'view' then 'raw_data.received'
      when 'click' then 'raw_data.validated' when 'error' then 'raw_data.quarantined'
      when 'purchase' then 'gold_data.published' end as event_type,
    ts as occurred_at, 'events' as producer,
    case when k < 5 then '2.0.0' else '1.0.0' end as schema_version,
    'user_' || user_id as dataset_id, cast(event_id as varchar) as correlation_id,
    'k/' || k as payload_reference, props,
    concat_ws(', ', case when k > 50 then 'FR-QUAL-001' end,
              case when value > 100 then 'FR-QUAL-005' end) as rules
  from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events)),
entries as (
  select event_id, event_type, producer, dataset_id, correlation_id, payload_reference,
    case when rules = '' then 'raw_data.quarantined'
         else 'data-quality rule(s) failed: ' || rules end as failure_reason,
    occurred_at as quarantined_at
  from envelopes where event_type = 'raw_data.quarantined'),
stored as (
  select * from (select *, row_number() over (
      partition by event_id order by quarantined_at, cast(event_type as varchar), producer, dataset_id,
      correlation_id) as rn from entries) where rn = 1)"""

BARS = """bars as (
  select event_type as instrument_id, date_trunc('day', ts) as observed_at,
    arg_min(cast(value as decimal(20,8)), (ts, event_id)) as open,
    max(cast(value as decimal(20,8))) as high, min(cast(value as decimal(20,8))) as low,
    arg_max(cast(value as decimal(20,8)), (ts, event_id)) as close,
    cast(count(*) as decimal(28,8)) as volume
  from events group by 1, 2)"""

RECORDS = """records as (
  select event_id, event_type || '_' || strftime(ts, '%Y-%m-%d') as batch_id, event_type as source_id,
    'u' || user_id as series_id, date_trunc('hour', ts) as observed_at,
    case when event_type = 'click' and k >= 98 then null
         else cast(cast(value as decimal(20,2)) - 0.10 as decimal(20,2)) end as value,
    event_type = 'view' and k = 0 as lacks_start, event_type = 'click' and k >= 98 as bad_value,
    event_type = 'signup' and k = 1 as has_note, strftime(ts, '%Y-%m-%d') as day
  from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events))"""
