"""Queries over the data-quality operators."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.contracts import DataContract
from tidemark.functions import keys
from tidemark.functions import records as R
from tidemark.operators import adjacency, runs, serve
from tidemark.operators.quality import metadata, reconcile, rows, sets, verdict
from tidemark.plans.registry import RECORDS, query
from tidemark.session import scratch_path
from tidemark.sources import star as S, tables
from tidemark.sources.star import Star


def _event_records(star: Star) -> DataFrame:
    return rows.from_json_text(S.event_json(star), "batch_id", "line")


@query(
    "DQ-01 DQ-02",
    f"""with {RECORDS} select batch_id, series_id,
  case when lacks_start then 'realtime_start' else '' end as missing,
  case when has_note then 'note' else '' end as extra,
  case when bad_value then 'value' else '' end as type_errors, count(*) as n
from records where lacks_start or has_note or bad_value group by 1, 2, 3, 4, 5""",
)
def dq_schema(star: Star) -> DataFrame:
    found = rows.schema_violations(_event_records(star), S.EVENT_CONTRACT)
    return (
        found.select(
            "batch_id",
            R.field_text("record", "series_id").alias("series_id"),
            *[F.array_join(c, ",").alias(c) for c in ("missing", "extra", "type_errors")],
        )
        .groupBy("batch_id", "series_id", "missing", "extra", "type_errors")
        .agg(F.count("*").alias("n"))
    )


@query(
    "DQ-02",
    """select o_orderkey, false as string_fits_date, true as day_fits_date, true as compact_fits_date,
  false as short_fits_date, true as week_fits_date, false as text_fits_decimal, true as price_fits_decimal,
  true as grouped_fits_decimal, o_orderdate as instant, false as price_fits_string from orders""",
)
def dq_type_matching(star: Star) -> DataFrame:
    """Order fields in several spellings against the contract types."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    price = F.col("o_totalprice").cast("decimal(20,2)")
    week = F.concat(
        F.extract(F.lit("YEAROFWEEK"), F.col("o_orderdate")).cast("string"),
        F.lit("-W"),
        F.lpad(F.weekofyear("o_orderdate").cast("string"), 2, "0"),
    )
    packed = rows.from_columns(
        star.orders,
        F.col("o_orderkey").cast("string"),
        {
            "status": F.col("o_orderstatus"),
            "day": day,
            "compact": F.date_format("o_orderdate", "yyyyMMdd"),
            "short": F.date_format("o_orderdate", "yyyy-M"),
            "week": week,
            "price": price,
            "grouped": F.concat(F.lit("1_"), price.cast("string")),
            "moment": F.date_format("o_orderdate", "yyyy-MM-dd'T'HHmmss'Z'"),
        },
    )
    fields = R.unpack(packed, ["status", "day", "compact", "short", "week", "price", "grouped", "moment"])

    def fits(field: str, spec: str):
        return R.field(field).matches(spec)

    return fields.select(
        F.col("batch_id").cast("bigint").alias("o_orderkey"),
        fits("status", "date").alias("string_fits_date"),
        fits("day", "date").alias("day_fits_date"),
        fits("compact", "date").alias("compact_fits_date"),
        fits("short", "date").alias("short_fits_date"),
        fits("week", "date").alias("week_fits_date"),
        fits("status", "decimal(20,8)").alias("text_fits_decimal"),
        fits("price", "decimal(20,8)").alias("price_fits_decimal"),
        fits("grouped", "decimal(20,8)").alias("grouped_fits_decimal"),
        R.field("moment").as_instant().alias("instant"),
        fits("price", "string").alias("price_fits_string"),
    )


_DAYS = "select unnest(generate_series(timestamp '2024-01-01', timestamp '2024-01-30', interval 1 day)) as day"


@query(
    "DQ-03",
    f"""with days as ({_DAYS}), users as (select distinct user_id from events),
seen as (select distinct user_id, cast(ts as date) as day from events)
select u.user_id, cast(d.day as date) as day from users u cross join days d
left join seen s on s.user_id = u.user_id and s.day = cast(d.day as date) where s.user_id is null""",
)
def dq_completeness(star: Star) -> DataFrame:
    start, stop = (F.lit(d).cast("date") for d in ("2024-01-01", "2024-01-30"))
    expected = sets.calendar(star.events, ["user_id"], start, stop, "1 day", "day")
    actual = star.events.select("user_id", F.to_date("ts").alias("day"))
    return sets.missing_keys(expected, actual, ["user_id", "day"])


@query(
    "DQ-04 DQ-17",
    """select l_orderkey, l_linenumber, count(*) as n from lineitem
group by l_orderkey, l_linenumber having count(*) > 1""",
)
def dq_uniqueness(star: Star) -> DataFrame:
    return sets.duplicate_keys(star.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "DQ-05",
    """select user_id, max(ts) as latest,
  case when timestamp '2024-01-31' - max(ts) > interval 1 day then 'failed' else 'passed' end as status
from events group by user_id""",
)
def dq_freshness(star: Star) -> DataFrame:
    return sets.freshness(star.events, ["user_id"], F.col("ts"), S.NOW, timedelta(days=1))


@query("DQ-06", "select c_custkey, c_acctbal from customer where c_acctbal <= 0")
def dq_value_positive(star: Star) -> DataFrame:
    balances = star.customer.select("c_custkey", "c_acctbal")
    return balances.where(rows.value_violation(F.col("c_acctbal")))


@query(
    "DQ-07",
    """with bars as (
  select user_id, cast(ts as date) as day,
    arg_min(value, (ts, event_id)) as open, arg_max(value, (ts, event_id)) as close,
    max(value) filter (event_type <> 'error') as high, min(value) filter (event_type <> 'error') as low
  from events group by 1, 2)
select user_id, day, open, high, low, close from bars
where open is not null and high is not null and low is not null and close is not null
  and not (low <= open and open <= high and low <= close and close <= high)""",
)
def dq_ohlc(star: Star) -> DataFrame:
    """Daily bars whose range comes from a feed without error events: bars that open or close on
    one can fall outside their own range."""
    place = F.struct("ts", "event_id")
    sound = F.when(F.col("event_type") != "error", F.col("value"))
    bars = star.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.min_by("value", place).alias("open"),
        F.max(sound).alias("high"),
        F.min(sound).alias("low"),
        F.max_by("value", place).alias("close"),
    )
    return bars.where(rows.ohlc_violation(*[F.col(c) for c in rows.OHLC]))


@query(
    "DQ-08",
    """select l_orderkey, l_linenumber, l_suppkey from lineitem
where l_suppkey is null or l_suppkey not in (select s_suppkey from supplier where s_acctbal > 0)""",
)
def dq_referential(star: Star) -> DataFrame:
    lines = star.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    return sets.dangling(lines, "l_suppkey", star.supplier.where("s_acctbal > 0"), "s_suppkey")


@query(
    "DQ-08",
    """select l_returnflag, cast(count(*) as bigint) as dangling_rows from lineitem
where l_suppkey is null or l_suppkey not in (select s_suppkey from supplier where s_acctbal > 0)
group by l_returnflag""",
)
def dq_referential_counts(star: Star) -> DataFrame:
    known = star.supplier.where("s_acctbal > 0")
    return sets.dangling_counts(star.lineitem, ["l_returnflag"], "l_suppkey", known, "s_suppkey")


_FINGERPRINT = """cast(('0x' || substr(md5(
  coalesce(length(event_id::varchar) || ':' || event_id, '-') || coalesce(length(props) || ':' || props, '-')
), 1, 15)) as bigint)"""


@query(
    "DQ-09",
    f"""with local as (
  select event_type, count(*) as local_count, cast(sum({_FINGERPRINT}) as varchar) as local_checksum
  from events group by 1), source as (
  select event_type, case when event_type <> 'view' then count(*) end as source_count,
    case when event_type not in ('view', 'click') then cast(sum({_FINGERPRINT}) as varchar) end as source_checksum
  from events where event_type <> 'purchase' or value < 400 group by 1)
select l.event_type, local_count, source_count, local_checksum, source_checksum,
  case when source_count is null and source_checksum is null then 'skipped'
    when coalesce(local_count <> source_count, false) or coalesce(local_checksum <> source_checksum, false)
    then 'failed' else 'passed' end as status
from local l left join source s on l.event_type = s.event_type""",
)
def dq_reconciliation(star: Star) -> DataFrame:
    """The source lacks purchases of 400 and more, reports no view figures and no click checksum."""
    checksum = keys.batch_checksum("event_id", "props").cast("string")
    kind = F.col("event_type")
    local = star.events.groupBy("event_type").agg(
        F.count("*").alias("local_count"), checksum.alias("local_checksum")
    )
    counted = star.events.where((kind != "purchase") | (F.col("value") < 400)).groupBy("event_type").agg(
        F.count("*").alias("n"), checksum.alias("c")
    )
    source = counted.select(
        "event_type",
        F.when(kind != "view", F.col("n")).alias("source_count"),
        F.when(~kind.isin("view", "click"), F.col("c")).alias("source_checksum"),
    )
    return sets.reconcile(local, source, ["event_type"])


@query(
    "DQ-10",
    """select user_id, event_id, from_at, ts as to_at, from_value, value as to_value,
  round(abs((value - from_value) / from_value) * 100, 6) as pct_change from (
  select *, lag(value) over w as from_value, lag(ts) over w as from_at from events
  window w as (partition by user_id order by ts, event_id))
where from_value <> 0 and abs((value - from_value) / from_value) * 100 > 1000""",
)
def dq_outliers(star: Star) -> DataFrame:
    moves = adjacency.extreme_moves(star.events, ["user_id"], F.col("ts"), F.col("value"), ["event_id"])
    return moves.withColumn("pct_change", F.round("pct_change", 6))


@query(
    "DQ-11",
    """with contracts as (
  select p_partkey, case when p_size <= 5 then ' ' else p_type end as units,
    case when p_brand in ('Brand#1', 'Brand#2') then null else 'nsa' end as seasonal_adjustment,
    p_type = 'PROMO' as has_index_base, case when p_size > 10 then p_brand else '' end as index_base from part)
select p_partkey, concat_ws(',', case when trim(units) = '' then 'units' end,
    case when seasonal_adjustment is null then 'seasonal_adjustment' end,
    case when has_index_base and index_base = '' then 'index_base' end) as missing_metadata,
  case when trim(units) = '' or seasonal_adjustment is null or (has_index_base and index_base = '')
    then 'failed' else 'passed' end as status
from contracts""",
)
def dq_semantic_metadata(star: Star) -> DataFrame:
    """Parts as contracts: small ones have blank units, two brands no adjustment, some no index base."""
    contracts = star.part.select(
        "p_partkey",
        F.when(F.col("p_size") <= 5, " ").otherwise(F.col("p_type")).alias("units"),
        F.when(~F.col("p_brand").isin("Brand#1", "Brand#2"), "nsa").alias("seasonal_adjustment"),
        (F.col("p_type") == "PROMO").alias("has_index_base"),
        F.when(F.col("p_size") > 10, F.col("p_brand")).otherwise("").alias("index_base"),
    )
    return metadata.semantic_metadata(contracts).select(
        "p_partkey", F.array_join("missing_metadata", ",").alias("missing_metadata"), "status"
    )


@query(
    "DQ-11",
    """select c_mktsegment, count(*) as orders from orders join customer on o_custkey = c_custkey
where c_mktsegment in (select c_mktsegment from customer group by 1 having min(c_acctbal) > -900)
group by 1""",
)
def dq_publish_gate(star: Star) -> DataFrame:
    """Rows of segments whose metadata is complete; the lowest balance decides which are."""
    lowest = star.customer.groupBy("c_mktsegment").agg(F.min("c_acctbal").alias("lowest"))
    contracts = lowest.select(
        "c_mktsegment",
        F.when(F.col("lowest") > -900, "usd").alias("units"),
        F.lit("nsa").alias("seasonal_adjustment"),
        F.lit(False).alias("has_index_base"),
        F.lit(None).cast("string").alias("index_base"),
    )
    placed = star.orders.join(star.customer, F.col("o_custkey") == F.col("c_custkey"))
    gated = metadata.publishable(placed, contracts, "c_mktsegment")
    return gated.groupBy("c_mktsegment").agg(F.count("*").alias("orders"))


def _results(star: Star) -> DataFrame:
    """All nine rules over daily event batches, with every kind of context given."""
    events = star.events
    batches = events.select(S.event_batch().alias("batch_id")).distinct()
    hours = F.explode(F.sequence(F.lit(9), F.lit(16)))
    calendar = (
        events.select(S.event_batch().alias("batch_id"), F.date_format("ts", "yyyy-MM-dd").alias("day"))
        .distinct()
        .withColumn("hour", hours)
        .select(
            "batch_id",
            F.format_string("%sT%02d:00:00Z", "day", "hour").alias("expected_key"),
        )
    )
    kind = F.col("event_type")
    kept = F.count_if((kind != "purchase") | (F.col("value") < 300))
    control = (
        events.groupBy(S.event_batch().alias("batch_id"), "event_type")
        .agg(kept.alias("kept"))
        .select(
            "batch_id",
            F.when(kind.isin("purchase", "click"), F.col("kept")).alias("source_count"),
            F.lit(None).cast("string").alias("source_checksum"),
            F.lit(None).cast("string").alias("local_checksum"),
        )
    )
    sources = events.where(kind != "error").select(F.col("event_type").alias("source_id")).distinct()
    return verdict.evaluate(
        batches,
        _event_records(star),
        S.EVENT_CONTRACT,
        expected=calendar,
        now=S.NOW,
        max_lag=timedelta(days=10),
        known_keys={"source_id": sources},
        source_control=control,
        threshold_pct=100.0,
        stage=lambda shaped: tables.staged(shaped, scratch_path(star.spark, "records")),
    )


@query(
    "DQ-11",
    """select c_nationkey, min(c_acctbal) > -900 as published, count(o_orderkey) as orders
from customer left join orders on o_custkey = c_custkey group by 1""",
)
def dq_publish_outcomes(star: Star) -> DataFrame:
    """Orders per nation on both sides of the gate; the lowest balance decides whether a unit is known."""
    contracts = star.customer.groupBy("c_nationkey").agg(
        F.when(F.min("c_acctbal") > -900, "usd").alias("units"),
        F.lit("nsa").alias("seasonal_adjustment"),
        F.lit(False).alias("has_index_base"),
        F.lit(None).cast("string").alias("index_base"),
    )
    placed = star.customer.join(star.orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    gated = metadata.publishable(placed, contracts, "c_nationkey").select("c_nationkey").distinct()
    counts = placed.groupBy("c_nationkey").agg(F.count("o_orderkey").alias("orders"))
    return counts.join(gated.withColumn("published", F.lit(True)), "c_nationkey", "left").select(
        "c_nationkey", F.coalesce("published", F.lit(False)).alias("published"), "orders"
    )


def _delivering_side(star: Star, whole: bool) -> DataFrame:
    """Records as their source has them: views with k = 50 read one more there. Unless ``whole``, it also lacks
    signups with k = 60."""
    other = Star(star.spark, star.sf_dir)
    kind, k = F.col("event_type"), S.prop_k()
    there = star.events if whole else star.events.where((kind != "signup") | (k != 60))
    there = there.withColumn("value", F.when((kind == "view") & (k == 50), F.col("value") + 1).otherwise(F.col("value")))
    other.events = there
    return _event_records(other)


@query(
    "DQ-09",
    f"""with {RECORDS} select batch_id, case when max(case when e.event_type = 'view'
    and json_extract_string(props, '$.k') = '50' then 1 else 0 end) = 1 then 'failed' else 'passed' end as status
from records join events e on e.event_id = records.event_id group by 1""",
)
def dq_checksum_verdict(star: Star) -> DataFrame:
    """Counts agree everywhere, so the checksum alone decides; it is computed in the scan of the records."""
    control = reconcile.checksums(_delivering_side(star, whole=True), S.EVENT_CONTRACT)
    batches = star.events.select(S.event_batch().alias("batch_id"))
    results = verdict.evaluate(batches, _event_records(star), S.EVENT_CONTRACT, source_control=control)
    return results.where(F.col("rule_id") == verdict.RECONCILIATION).select("batch_id", "status")


@query(
    "DQ-09 QRY-13",
    f"""with {RECORDS}, keyed as (
  select batch_id, series_id, strftime(observed_at, '%Y-%m-%dT%H:%M:%SZ') as observed_at, count(*) as n_here,
    count(*) filter (not (e.event_type = 'signup' and json_extract_string(props, '$.k') = '60')) as n_there,
    max(case when e.event_type = 'view' and json_extract_string(props, '$.k') = '50' then 1 else 0 end) as changed
  from records join events e on e.event_id = records.event_id group by 1, 2, 3)
select batch_id, series_id, observed_at, case when n_there = 0 then 'missing there' else 'differs' end as problem,
  n_here, nullif(n_there, 0) as n_there
from keyed where n_there <> n_here or changed = 1""",
)
def dq_mismatch_keys(star: Star) -> DataFrame:
    """The keys on which two deliveries differ, found from sums per batch and per bucket of keys."""
    return reconcile.locate(
        _event_records(star),
        _delivering_side(star, whole=False),
        S.EVENT_CONTRACT,
        lambda x: tables.staged(x, scratch_path(star.spark, "sums")),
    )


_RESULTS = f"""{RECORDS}, per_key as (
  select batch_id, series_id, observed_at, count(*) as n from records group by 1, 2, 3),
dups as (select batch_id, count(*) as n from per_key where n > 1 group by 1),
hours as (select b.batch_id, b.day::timestamp + h * interval 1 hour as at
  from (select distinct batch_id, day from records) b cross join (select unnest(range(9, 17)) as h)),
gaps as (select h.batch_id, count(*) as n from hours h
  where not exists (select 1 from records r where r.batch_id = h.batch_id and r.observed_at = h.at) group by 1),
moves as (select batch_id, count(*) as n from (
    select batch_id, value, lag(value) over (partition by batch_id, series_id order by observed_at, value) as p
    from records where value is not null)
  where p <> 0 and abs((cast(value as double) - cast(p as double)) / cast(p as double)) * 100 > 100 group by 1),
control as (select event_type || '_' || strftime(ts, '%Y-%m-%d') as batch_id,
    count(*) filter (event_type <> 'purchase' or value < 300) as n from events
  where event_type in ('purchase', 'click') group by 1),
base as (select batch_id, min(source_id) as source_id, count(*) as records,
    count(*) filter (lacks_start or bad_value or has_note) as schema_rows,
    count(*) filter (value <= 0) as range_rows, max(observed_at) as latest from records group by 1),
wide as (select b.*, coalesce(d.n, 0) as dup_keys, coalesce(g.n, 0) as missing, coalesce(m.n, 0) as moves,
    c.n as source_count
  from base b left join dups d on d.batch_id = b.batch_id left join gaps g on g.batch_id = b.batch_id
  left join moves m on m.batch_id = b.batch_id left join control c on c.batch_id = b.batch_id),
results as (
  select batch_id, 'FR-QUAL-001' as rule_id, case when schema_rows > 0 then 'failed' else 'passed' end as status,
    cast(schema_rows as bigint) as failed_rows from wide
  union all select batch_id, 'FR-QUAL-002', case when missing > 0 then 'failed' else 'passed' end, missing from wide
  union all select batch_id, 'FR-QUAL-003', case when dup_keys > 0 then 'failed' else 'passed' end, dup_keys from wide
  union all select batch_id, 'FR-QUAL-004',
    case when timestamp '2024-01-31' - latest > interval 10 day then 'failed' else 'passed' end,
    case when timestamp '2024-01-31' - latest > interval 10 day then 1 else 0 end from wide
  union all select batch_id, 'FR-QUAL-005', case when range_rows > 0 then 'failed' else 'passed' end, range_rows from wide
  union all select batch_id, 'FR-QUAL-006', case when source_id = 'error' then 'failed' else 'passed' end,
    case when source_id = 'error' then records else 0 end from wide
  union all select batch_id, 'FR-QUAL-007', case when source_count is null then 'skipped'
      when source_count <> records then 'failed' else 'passed' end,
    case when source_count <> records then 1 else 0 end from wide
  union all select batch_id, 'FR-QUAL-008', case when records < 2 then 'skipped'
      when moves > 0 then 'flagged' else 'passed' end, case when records < 2 then 0 else moves end from wide
  union all select batch_id, 'FR-QUAL-009', 'passed', 0 from wide)"""


@query(
    "DQ-01 DQ-03 DQ-04 DQ-05 DQ-06 DQ-08 DQ-09 DQ-10 DQ-11 DQ-12",
    f"with {_RESULTS} select batch_id, rule_id, status, failed_rows from results",
)
def dq_rule_results(star: Star) -> DataFrame:
    return _results(star).drop("message")


_VERDICTS = """verdicts as (
  select batch_id, string_agg(rule_id, ',' order by rule_id) filter (status = 'failed') as failed_rules,
    string_agg(rule_id, ',' order by rule_id) filter (status = 'flagged') as flagged_rules
  from results group by batch_id)"""


@query(
    "DQ-12",
    f"""with {_RESULTS}, {_VERDICTS} select batch_id, coalesce(failed_rules, '') as failed_rules,
  coalesce(flagged_rules, '') as flagged_rules,
  case when failed_rules is null then 'validated' else 'quarantined' end as outcome from verdicts""",
)
def dq_verdict(star: Star) -> DataFrame:
    joined = [F.array_join(c, ",").alias(c) for c in ("failed_rules", "flagged_rules")]
    return verdict.verdicts(_results(star)).select("batch_id", *joined, "outcome")


@query(
    "DQ-13",
    f"""with {_RESULTS} select batch_id, count(*) filter (status = 'passed') as passed,
  count(*) filter (status = 'failed') as failed, count(*) filter (status = 'flagged') as flagged,
  count(*) filter (status = 'skipped') as skipped, bool_or(status = 'failed') as has_failures,
  bool_or(status = 'flagged') as has_flags from results group by batch_id""",
)
def dq_report(star: Star) -> DataFrame:
    return verdict.report(_results(star))


@query(
    "DQ-12 STR-03",
    f"""with {_RESULTS}, {_VERDICTS} select r.batch_id, r.series_id,
  case when failed_rules is null then 'validated' else 'quarantined' end as outcome, count(*) as n
from records r join verdicts v on r.batch_id = v.batch_id group by 1, 2, 3""",
)
def dq_routing(star: Star) -> DataFrame:
    """Records of batches that passed and of batches that did not."""
    good, bad = verdict.route(_event_records(star), verdict.verdicts(_results(star)))

    def counted(records: DataFrame, outcome: str) -> DataFrame:
        series = R.field_text("record", "series_id").alias("series_id")
        return (
            records.groupBy("batch_id", series)
            .agg(F.count("*").alias("n"))
            .withColumn("outcome", F.lit(outcome))
        )

    return counted(good, "validated").unionByName(counted(bad, "quarantined"))


@query(
    "DQ-19",
    f"""with {_RESULTS} select rule_id as test_id, 'events' as table_name, 'run-1' as run_id,
  case when bool_or(status = 'failed') then 'fail' when bool_or(status = 'flagged') then 'warn' else 'pass' end
    as status, cast(sum(failed_rows) as bigint) as failed_rows, timestamp '2024-01-31' as evaluated_at
from results where status <> 'skipped' group by rule_id""",
)
def dq_results_stored(star: Star) -> DataFrame:
    """Outcomes of two evaluations appended to the result log; the latest per test stands."""
    path = scratch_path(star.spark, "quality")
    found = tables.staged(verdict.quality_results(_results(star), "events", "run-1", S.NOW), scratch_path(star.spark, "found"))
    earlier = found.withColumns({"run_id": F.lit("run-0"), "status": F.lit("fail"), "evaluated_at": F.col("evaluated_at") - F.expr("interval 1 day")})
    for label, rows_ in (("run-1", found), ("run-0", earlier)):
        tables.append_slice(rows_, path, label)
    stored = tables.read_table(star.spark, path, schemas.QUALITY_RESULT).select(*schemas.QUALITY_RESULT.fieldNames())
    return tables.latest_by_key(stored, schemas.QUALITY_RESULT_KEY, ("evaluated_at",))


@query(
    "DQ-20",
    """with lagged as (
  select *, lag(value) over (partition by user_id order by ts, event_id) as p from events)
select event_id, case when value < 1 then 'quarantined'
  when p <> 0 and abs((value - p) / p) * 100 > 1000 then 'flagged' else 'ok' end as data_quality_status
from lagged""",
)
def dq_row_status(star: Star) -> DataFrame:
    moves = adjacency.extreme_moves(star.events, ["user_id"], F.col("ts"), F.col("value"), ["event_id"])
    flagged = moves.select("event_id", F.lit(True).alias("extreme"))
    joined = star.events.select("event_id", "value").join(flagged, "event_id", "left")
    status = rows.quality_status([F.col("value") < 1], [F.col("extreme")])
    return joined.select("event_id", status.alias("data_quality_status"))


_BAR_CONTRACT = DataContract.from_mapping(
    {
        "dataset": "line_bars",
        "owner": "lineitem",
        "source": "lineitem",
        "version": "1.0.0",
        "primary_key": ["source_id", "instrument_id", "interval", "observed_at"],
        "schema": {"volume": "decimal(28,8)"},
        "quality_rules": ["nonnegative_volume"],
    }
)


@query(
    "DQ-21",
    """select l_partkey, count(*) as violations from lineitem where l_quantity - l_discount * 100 < 0
group by 1""",
)
def dq_volume(star: Star) -> DataFrame:
    """Quantity net of discount points as a volume, which must not be negative."""
    net = F.col("l_quantity") - F.col("l_discount") * 100
    packed = rows.from_columns(star.lineitem, F.col("l_partkey").cast("string"), {"volume": net})
    flagged = R.unpack(packed, ["volume"]).withColumns(rows.range_flags(_BAR_CONTRACT))
    return (
        R.keep(flagged, F.col("volume_bad"))
        .groupBy(F.col("batch_id").cast("bigint").alias("l_partkey"))
        .agg(F.count("*").alias("violations"))
    )


@query(
    "DQ-22",
    """with datasets as (select cast(s_suppkey as varchar) as dataset_id, s_nationkey as source_id from supplier),
contracts as (select cast(s_suppkey as varchar) as dataset_id,
    case when s_acctbal > 5000 then s_name else ' ' end as owner from supplier where s_acctbal > 0),
sources as (select n_nationkey as source_id, case when n_regionkey <> 2 then n_name end as license_url,
    case when n_regionkey <> 3 then 'official' end as trust_tier from nation where n_regionkey < 4)
select * from (select d.dataset_id, d.source_id, concat_ws(',', case when c.dataset_id is null then 'contract' end,
    case when trim(coalesce(c.owner, '')) = '' then 'owner' end, case when s.source_id is null then 'source' end,
    case when s.license_url is null then 'license' end, case when s.trust_tier is null then 'trust_tier' end) as gaps
  from datasets d left join contracts c on c.dataset_id = d.dataset_id
  left join sources s on s.source_id = d.source_id) where gaps <> ''""",
)
def dq_onboarding(star: Star) -> DataFrame:
    """Suppliers as datasets and nations as sources, each with some metadata missing."""
    key = F.col("s_suppkey").cast("string").alias("dataset_id")
    datasets = star.supplier.select(key, F.col("s_nationkey").alias("source_id"))
    contracts = star.supplier.where("s_acctbal > 0").select(
        key, F.when(F.col("s_acctbal") > 5000, F.col("s_name")).otherwise(" ").alias("owner")
    )
    sources = star.nation.where("n_regionkey < 4").select(
        F.col("n_nationkey").alias("source_id"),
        F.when(F.col("n_regionkey") != 2, F.col("n_name")).alias("license_url"),
        F.when(F.col("n_regionkey") != 3, "official").alias("trust_tier"),
    )
    gaps = metadata.onboarding_gaps(datasets, contracts, sources)
    return gaps.withColumn("gaps", F.array_join("gaps", ","))


@query(
    "QRY-13 DQ-09",
    """with sampled as (select dataset_id from (select distinct 'user_' || user_id as dataset_id from events)
  where cast(('0x' || substr(md5(dataset_id), 1, 8)) as bigint) % 100 < 30)
select 'user_' || user_id as dataset_id, count(*) as local_count,
  count(*) filter (value < 300) as source_count,
  case when count(*) <> count(*) filter (value < 300) then 'failed' else 'passed' end as status
from events where 'user_' || user_id in (select dataset_id from sampled) group by 1""",
)
def sampled_reconciliation(star: Star) -> DataFrame:
    """Counts of a reproducible sample of datasets against a source that drops values from 300 up."""
    events = star.events.select(S.user_dataset().alias("dataset_id"), "value")
    sample = runs.sampled_datasets(events.select("dataset_id").distinct(), 30)
    chosen = events.join(sample, "dataset_id", "left_semi")
    text = F.lit(None).cast("string")
    local = chosen.groupBy("dataset_id").agg(F.count("*").alias("local_count")).withColumn("local_checksum", text)
    source = chosen.groupBy("dataset_id").agg(F.count_if(F.col("value") < 300).alias("source_count"))
    compared = sets.reconcile(local, source.withColumn("source_checksum", text), ["dataset_id"])
    return compared.select("dataset_id", "local_count", "source_count", "status")


@query(
    "DQ-03 QRY-08",
    f"""with days as ({_DAYS}), bars as (
  select user_id, cast(ts as date) as day, count(*) as ticks, max(value) as high from events group by 1, 2)
select u.user_id, cast(d.day as date) as day, ticks, high, b.user_id is null as is_gap
from (select distinct user_id from events) u cross join days d
left join bars b on b.user_id = u.user_id and b.day = cast(d.day as date)""",
)
def gap_marker(star: Star) -> DataFrame:
    start, stop = (F.lit(d).cast("date") for d in ("2024-01-01", "2024-01-30"))
    expected = sets.calendar(star.events, ["user_id"], start, stop, "1 day", "day")
    bars = star.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("ticks"), F.max("value").alias("high")
    )
    return serve.with_gaps(expected, bars, ["user_id", "day"])
