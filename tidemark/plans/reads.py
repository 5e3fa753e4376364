"""Queries over the read side: point in time, bars, trade, catalog, lineage, revisions."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import keys
from tidemark.operators import gold, serve, silver
from tidemark.plans.registry import BARS, DATASETS, KPI_SELECT, OBSERVATIONS, RUNS, query
from tidemark.session import scratch_path
from tidemark.sources import star as S, tables
from tidemark.sources.star import Star

AS_OF = [date(1997, 3, 3), date(1999, 12, 31)]


@query(
    "QRY-01",
    f"""with {OBSERVATIONS} select indicator_id, geo_code, period, vintage_date, value from (
  select *, row_number() over (partition by indicator_id, geo_code, period order by vintage_date desc) as rk
  from observations where vintage_date <= date '1997-03-03') where rk = 1""",
)
def as_of(star: Star) -> DataFrame:
    return serve.as_of(S.observations(star), AS_OF[0]).select(
        "indicator_id", "geo_code", "period", "vintage_date", "value"
    )


@query(
    "QRY-01",
    f"""with {OBSERVATIONS}, days as (select unnest([date '1997-03-03', date '1999-12-31']) as as_of)
select as_of, indicator_id, geo_code, period, vintage_date, value from (
  select *, row_number() over (
    partition by as_of, indicator_id, geo_code, period order by vintage_date desc) as rk
  from observations join days on vintage_date <= as_of) where rk = 1""",
)
def as_of_dates(star: Star) -> DataFrame:
    return serve.as_of_many(S.observations(star), AS_OF).select(
        "as_of", "indicator_id", "geo_code", "period", "vintage_date", "value"
    )


@query(
    "QRY-01 GLD-04",
    f"""with {OBSERVATIONS.replace("from observations)", "from observations where vintage_date <= date '1997-03-03')")}
{KPI_SELECT}""",
)
def kpi_as_of(star: Star) -> DataFrame:
    """The indicators as they would have been shown on a past day."""
    return gold.kpi(gold.latest_vintage(S.observations(star), AS_OF[0]))


@query(
    "QRY-02",
    f"""with {OBSERVATIONS} select indicator_id, geo_code, period, vintage_date, value from (
  select *, row_number() over (partition by indicator_id, geo_code
    order by period_start desc, vintage_date desc) as rk from observations) where rk = 1""",
)
def latest_only(star: Star) -> DataFrame:
    return serve.latest_period(S.observations(star)).select(
        "indicator_id", "geo_code", "period", "vintage_date", "value"
    )


@query(
    "QRY-03",
    f"""with {OBSERVATIONS} select indicator_id, geo_code, period, vintage_date, value from observations
where geo_code = 'ASIA' and period >= '1996-01' and period <= '1997-06'""",
)
def period_range(star: Star) -> DataFrame:
    return serve.in_periods(S.observations(star), "1996-01", "1997-06", geo_code="ASIA").select(
        "indicator_id", "geo_code", "period", "vintage_date", "value"
    )


@query(
    "QRY-04 DQ-20",
    f"""with {OBSERVATIONS} select indicator_id, geo_code, unit, seasonal_adjustment, period,
  cast(value as varchar) as value, vintage_date,
  case when value < 500000 then 'flagged' else 'ok' end as data_quality_status from latest""",
)
def indicator_response(star: Star) -> DataFrame:
    observations = S.observations(star)
    low = observations.where("value < 500000").select(
        "indicator_id", "geo_code", "period", "vintage_date", F.lit("flagged").alias("data_quality_status")
    )
    return serve.indicator_response(observations, low)


@query(
    "QRY-05",
    f"""with {OBSERVATIONS}, l as (select * from latest where indicator_id = 'BUILDING'),
r as (select * from latest where indicator_id = 'MACHINERY')
select coalesce(l.geo_code, r.geo_code) as geo_code, coalesce(l.period_end, r.period_end) as period_end,
  l.value as left_value, r.value as right_value
from l full outer join r on l.geo_code = r.geo_code and l.period_end = r.period_end""",
)
def alignment(star: Star) -> DataFrame:
    return serve.align(S.observations(star), "BUILDING", "MACHINERY")


@query("QRY-06", f"with {BARS} select instrument_id, observed_at, open, high, low, close, volume from bars")
def ohlcv_bars(star: Star) -> DataFrame:
    return S.bars(star).select("instrument_id", "observed_at", "open", "high", "low", "close", "volume")


@query(
    "QRY-06",
    f"""with {BARS} select instrument_id, observed_at, open, high, low, close, volume from bars
where instrument_id = 'purchase' and observed_at >= timestamp '2024-01-05' order by observed_at limit 10""",
)
def ohlcv_page(star: Star) -> DataFrame:
    """A page of ten daily bars of one instrument."""
    start = datetime(2024, 1, 5, tzinfo=timezone.utc)
    page = serve.bars(S.bars(star), S.instruments(star), "crypto", "PURCHASE", "1d", start, limit=10)
    return page.select("instrument_id", "observed_at", "open", "high", "low", "close", "volume")


@query(
    "QRY-06",
    f"""with {BARS} select instrument_id, observed_at, close from (select *, row_number() over (
  partition by instrument_id order by observed_at desc) as rk from bars) where rk <= 7""",
)
def ohlcv_newest(star: Star) -> DataFrame:
    return serve.newest_bars(S.bars(star), 7).select("instrument_id", "observed_at", "close")


@query(
    "QRY-07 SNK-03",
    f"""with {BARS} select instrument_id, observed_at, open, high, low, close,
  case when observed_at >= timestamp '2024-01-20' then volume + 1 else volume end as volume from bars""",
)
def ohlcv_upsert(star: Star) -> DataFrame:
    """Bars up to the 25th are stored; bars from the 20th on arrive with corrected volumes."""
    bars = S.bars(star)
    day = F.col("observed_at")
    stored = bars.where(day < F.lit("2024-01-26").cast("timestamp"))
    incoming = bars.where(day >= F.lit("2024-01-20").cast("timestamp")).withColumn(
        "volume", (F.col("volume") + 1).cast("decimal(28,8)")
    )
    return serve.upsert_bars(stored, incoming).select(
        "instrument_id", "observed_at", "open", "high", "low", "close", "volume"
    )


_TRADE = """trade as (
  select cn.n_name as reporter, sn.n_name as partner, p_type as commodity_code,
    strftime(l_shipdate, '%Y-%m') as period,
    cast(sum(cast(l_extendedprice as decimal(28,2))) as decimal(28,2)) as trade_value
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join nation cn on c_nationkey = cn.n_nationkey join supplier on l_suppkey = s_suppkey
  join nation sn on s_nationkey = sn.n_nationkey join part on l_partkey = p_partkey group by 1, 2, 3, 4)"""


@query(
    "QRY-09",
    f"""with {_TRADE} select * from trade
where reporter = 'NATION_3' and commodity_code = 'PROMO' and period >= '1996-01' and period <= '1998-12'""",
)
def trade_observations(star: Star) -> DataFrame:
    found = serve.trade(
        S.trade_rows(star),
        reporter="NATION_3",
        commodity_code="PROMO",
        period_from="1996-01",
        period_to="1998-12",
    )
    return found.drop("trade_flow")


@query(
    "QRY-10",
    f"""with {RUNS}, {DATASETS}, described as (
  select 'user_' || c_custkey as dataset_id, cast(c_nationkey as varchar) as source_id, c_mktsegment as domain,
    c_name as name from customer where 'user_' || c_custkey in (select dataset_id from datasets)),
updated as (select dataset_id, max(finished_at) as finished from runs where status = 'success' group by 1)
select d.dataset_id, domain, d.source_id, case when n_regionkey < 3 then 'official' else 'community_unofficial' end
    as trust_tier, n_name as license_url, finished as last_updated_at,
  case when finished is null then 'unknown' when timestamp '2024-01-31' - finished > interval 24 hour then 'stale' else 'ok' end
    as freshness_status
from described d left join nation on d.source_id = cast(n_nationkey as varchar)
left join updated u on u.dataset_id = d.dataset_id
where domain = 'BUILDING' and contains(lower(d.dataset_id || ' ' || name), 'customer#0000000')""",
)
def catalog(star: Star) -> DataFrame:
    described = star.customer.select(
        F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("dataset_id"),
        F.col("c_nationkey").cast("string").alias("source_id"),
        F.col("c_mktsegment").alias("domain"),
        F.col("c_name").alias("name"),
    ).join(S.user_datasets(star), "dataset_id", "left_semi")
    tier = F.when(F.col("n_regionkey") < 3, "official").otherwise("community_unofficial")
    sources = star.nation.select(
        F.col("n_nationkey").cast("string").alias("source_id"),
        tier.alias("trust_tier"),
        F.col("n_name").alias("license_url"),
    )
    return serve.catalog(
        described, sources, S.runs(star), S.NOW, timedelta(hours=24), "BUILDING", "Customer#0000000"
    )


@query(
    "QRY-11 BRZ-06",
    f"""with {OBSERVATIONS}, used as (
  select l.*, lower('sales_' || indicator_id || '_' || replace(geo_code, ' ', '-') || '_' || digit) as dataset_id
  from latest l)
select indicator_id, geo_code, period, value, vintage_date, dataset_id,
  cast(retrieved_at as date) as landed_on, true as id_matches_key from used""",
)
def lineage(star: Star) -> DataFrame:
    """Indicator values back to the raw object their vintage came from."""
    stored = S.bronze_rows(S.sales_objects(star))
    rows = silver.conform(stored, S.sales_map(star), S.indicators(star), S.RUN_AT, S.SALES_PARSERS).rows
    traced = serve.lineage(gold.latest_vintage(rows), rows, stored)
    part = keys.key_parts("raw_object_key")
    return traced.select(
        "indicator_id",
        "geo_code",
        "period",
        "value",
        "vintage_date",
        part["dataset_id"].alias("dataset_id"),
        part["landed_on"].alias("landed_on"),
        (F.col("bronze_id") == keys.bronze_id("raw_object_key")).alias("id_matches_key"),
    )


@query(
    "QRY-14",
    """select user_id, min(ts) as available_from, min(ts) > timestamp '2024-01-01 06:00:00' as truncated
from events group by user_id""",
)
def history_ceiling(star: Star) -> DataFrame:
    start = datetime(2024, 1, 1, 6, tzinfo=timezone.utc)
    return serve.history_ceiling(star.events, ["user_id"], F.col("ts"), start)


@query(
    "QRY-15",
    """select year(ts) as year, month(ts) as month, day(ts) as day, count(*) as n,
  cast(sum(event_id) as bigint) as id_sum from events group by 1, 2, 3""",
)
def compaction(star: Star) -> DataFrame:
    """Events rewritten into a day layout under the shared folder, then read back from it."""
    target = scratch_path(star.spark, "compacted")
    events = star.events
    tables.compact(star.spark, f"{star.sf_dir}/events.parquet", target, events.schema, "ts")
    merged = star.spark.read.parquet(target)
    return (
        merged.groupBy("year", "month", "day")
        .agg(F.count("*").alias("n"), F.sum("event_id").alias("id_sum"))
        .select(
            *[F.col(c).cast("bigint").alias(c) for c in ("year", "month", "day")], "n", "id_sum"
        )
    )


@query(
    "QRY-16",
    f"""with {OBSERVATIONS} select indicator_id, geo_code, period, vintage_date, value,
  row_number() over w as revision, lag(value) over w as previous_value, value - lag(value) over w as change
from observations window w as (partition by indicator_id, geo_code, period order by vintage_date)""",
)
def revision_diff(star: Star) -> DataFrame:
    return serve.revisions(S.observations(star))


@query(
    "QRY-16",
    """with snapshots as (
  select p_brand as indicator_id, p_partkey as taken_at, p_type as unit, p_size as scale from part),
compared as (select *, lag(unit) over w as p_unit, lag(scale) over w as p_scale, lag(taken_at) over w as p_at
  from snapshots window w as (partition by indicator_id order by taken_at))
select indicator_id, taken_at, concat_ws(',', case when scale <> p_scale then 'scale' end,
  case when unit <> p_unit then 'unit' end) as changed_fields
from compared where p_at is not null and (unit <> p_unit or scale <> p_scale)""",
)
def metadata_diff(star: Star) -> DataFrame:
    """Parts of a brand as successive metadata snapshots of one indicator."""
    snapshots = star.part.select(
        F.col("p_brand").alias("indicator_id"),
        F.col("p_partkey").alias("taken_at"),
        F.col("p_size").alias("scale"),
        F.col("p_type").alias("unit"),
    )
    changes = serve.metadata_changes(snapshots, "indicator_id", "taken_at", ["scale", "unit"])
    return changes.select("indicator_id", "taken_at", F.array_join("changed_fields", ",").alias("changed_fields"))
