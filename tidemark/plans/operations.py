"""Queries over runs, quality results, alerts, events and the dead-letter table."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import keys
from tidemark.operators import alerts, dlq, events, runs
from tidemark.plans.registry import DATASETS, ENVELOPES, RUNS, id_sql, query
from tidemark.plans import pipeline
from tidemark.session import scratch_path
from tidemark.sources import export, star as S, tables
from tidemark.sources.star import Star


def _recorded(star: Star) -> pipeline.Layout:
    """All runs recorded in a place of their own, in two parts; alerts follow from each."""
    layout = pipeline.Layout(scratch_path(star.spark, "runs"))
    early = F.col("started_at") < F.lit("2024-01-16").cast("timestamp")
    everything = S.runs(star)
    for part in (everything.where(early), everything.where(~early)):
        pipeline.record_runs(star.spark, layout, part)
    return layout


@query(
    "SNK-02 OPS-02",
    f"""with {RUNS} select dataset_id, count(*) as runs, count(*) filter (status = 'failed') as failed,
  max(case when status = 'failed' then run_id end) as greatest_failed from runs group by 1""",
)
def run_log(star: Star) -> DataFrame:
    """What the stored run table holds per dataset after two recordings."""
    failed = F.col("status") == "failed"
    return pipeline.read_runs(star.spark, _recorded(star)).groupBy("dataset_id").agg(
        F.count("*").alias("runs"),
        F.count_if(failed).alias("failed"),
        F.max(F.when(failed, F.col("run_id"))).alias("greatest_failed"),
    )


@query("OPS-01 SNK-02", f"with {RUNS} select * from runs where run_id = '17'")
def run_lookup(star: Star) -> DataFrame:
    """Runs are recorded first, failed ones too, and looked up in the stored table."""
    found = runs.by_id(pipeline.read_runs(star.spark, _recorded(star)), "17")
    return found.select("run_id", "dataset_id", "started_at", "finished_at", "status", "retry_count", "error")


@query(
    "OPS-02 OPS-03",
    f"""with {RUNS} select run_id, started_at, finished_at, status,
  cast(epoch_us(finished_at) - epoch_us(started_at) as double) / 1000000 as duration_seconds
from runs where dataset_id = 'user_5'""",
)
def run_history(star: Star) -> DataFrame:
    history = runs.history(S.runs(star), "user_5")
    return history.select("run_id", "started_at", "finished_at", "status", "duration_seconds")


@query(
    "OPS-03",
    f"""with {RUNS} select dataset_id, count(*) as runs,
  cast(sum(epoch_us(finished_at) - epoch_us(started_at)) as bigint) as total_micros from runs group by 1""",
)
def run_durations(star: Star) -> DataFrame:
    timed = runs.with_duration(S.runs(star))
    micros = F.round(F.col("duration_seconds") * 1_000_000).cast("bigint")
    return timed.groupBy("dataset_id").agg(
        F.count("*").alias("runs"), F.sum(micros).alias("total_micros")
    )


_TESTS = """tests as (
  select event_type as test_id, 'user_' || user_id as table_name, cast(event_id as varchar) as run_id,
    case when value > 200 then 'fail' when value > 100 then 'warn' else 'pass' end as status,
    cast(json_extract_string(props, '$.k') as integer) as failed_rows, ts as evaluated_at from events),
current_tests as (select test_id, table_name, run_id, status, failed_rows, evaluated_at from (
  select *, row_number() over (partition by test_id, table_name order by evaluated_at desc, run_id desc) as rn
  from tests) where rn = 1)"""


def _tests(star: Star) -> DataFrame:
    """Events as quality results: one test per event type on one table per user."""
    value = F.col("value")
    return star.events.select(
        F.col("event_type").alias("test_id"),
        S.user_dataset().alias("table_name"),
        F.col("event_id").cast("string").alias("run_id"),
        F.when(value > 200, "fail").when(value > 100, "warn").otherwise("pass").alias("status"),
        S.prop_k().alias("failed_rows"),
        F.col("ts").alias("evaluated_at"),
    )


def _current_tests(star: Star) -> DataFrame:
    tests = _tests(star)
    early = F.col("evaluated_at") < F.lit("2024-01-15").cast("timestamp")
    return runs.record_quality(tests.where(early), tests.where(~early))


@query("SNK-03 DQ-19", f"with {_TESTS} select * from current_tests")
def quality_upsert(star: Star) -> DataFrame:
    """Results of the second half of the month replace those of the first."""
    return _current_tests(star)


@query("OPS-04", f"with {_TESTS} select * from current_tests where table_name = 'user_7'")
def quality_for_table(star: Star) -> DataFrame:
    return runs.quality_for_table(_current_tests(star), "user_7")


@query(
    "OPS-04",
    f"with {_TESTS} select * from current_tests where table_name = 'user_7' and test_id = 'error'",
)
def quality_lookup(star: Star) -> DataFrame:
    return runs.quality_result(_current_tests(star), "error", "user_7")


_STREAKS = f"""{RUNS}, ranked as (
  select *, sum(case when status <> 'failed' then 1 else 0 end) over (
    partition by dataset_id order by started_at desc, run_id desc
    rows between unbounded preceding and current row) as others from runs),
streaks as (select dataset_id, count(*) as consecutive_failures,
    arg_max(run_id, (started_at, run_id)) as latest_run_id, arg_max(error, (started_at, run_id)) as latest_error
  from ranked where others = 0 group by dataset_id)"""


@query(
    "OPS-05",
    f"""with {_STREAKS} select dataset_id, consecutive_failures, latest_run_id, latest_error
from streaks where consecutive_failures >= 2""",
)
def alert_consecutive(star: Star) -> DataFrame:
    return alerts.consecutive_failures(S.runs(star))


_STATE = f"""{RUNS}, {DATASETS}, newest as (
  select * from (select *, row_number() over (partition by dataset_id order by started_at desc, run_id desc) as rn
  from runs) where rn = 1),
state as (select d.dataset_id, n.run_id as latest_run_id, n.status as latest_status,
    case when n.status = 'success' then cast(epoch_us(timestamp '2024-01-31') - epoch_us(finished_at) as double)
      / 1000000 end as lag_seconds,
    case when n.run_id is null then 'no run' when n.status <> 'success' then 'latest run not successful'
      when timestamp '2024-01-31' - finished_at > interval 12 hour then 'too old' end as breach
  from datasets d left join newest n on n.dataset_id = d.dataset_id)"""


@query("OPS-06", f"with {_STATE} select * from state where breach is not null")
def alert_freshness(star: Star) -> DataFrame:
    found = alerts.freshness_breaches(S.runs(star), S.user_datasets(star), S.NOW, timedelta(hours=12))
    return found.select("dataset_id", "latest_run_id", "latest_status", "lag_seconds", "breach")


@query(
    "OPS-07",
    f"""with {_TESTS} select table_name, string_agg(test_id, ',' order by test_id) as failing_test_ids
from current_tests where status = 'fail' group by table_name""",
)
def alert_quality(star: Star) -> DataFrame:
    found = alerts.quality_failures(_current_tests(star))
    return found.withColumn("failing_test_ids", F.array_join("failing_test_ids", ","))


@query(
    "OPS-08",
    f"""with {_STREAKS}, {_TESTS} select 'consecutive_failures' as alert_type, dataset_id,
  {id_sql("'consecutive_failures'", 'dataset_id', 'latest_run_id')} as alert_id,
  dataset_id || ' failed ' || consecutive_failures || ' times in a row' as message
from streaks where consecutive_failures >= 2
union all
select 'data_quality_blocking_failure', table_name,
  {id_sql("'data_quality_blocking_failure'", 'table_name', "string_agg(test_id, ',' order by test_id)")},
  count(*) || ' tests failing on ' || table_name
from current_tests where status = 'fail' group by table_name""",
)
def alert_log(star: Star) -> DataFrame:
    """Quality results and runs are stored, run by run recorded alerts are inserted first-wins, twice."""
    layout = pipeline.Layout(scratch_path(star.spark, "alerts"))
    label = "results"
    tables.append_slice(_current_tests(star).select(*schemas.QUALITY_RESULT.fieldNames()), layout.path("data_quality_result"), label)
    recorded = S.runs(star)
    for part in (recorded, recorded.limit(0)):
        pipeline.record_runs(star.spark, layout, part)
    found = pipeline.read_alerts(star.spark, layout)
    return found.select("alert_type", "dataset_id", "alert_id", "message")


@query(
    "OPS-09",
    f"""with {_STATE}, ranked as (
  select *, sum(case when status <> 'failed' then 1 else 0 end) over (
    partition by dataset_id order by started_at desc, run_id desc
    rows between unbounded preceding and current row) as others from runs),
streaks as (select dataset_id, count(*) as n from ranked where others = 0 group by 1 having count(*) >= 2)
select s.dataset_id, 'consecutive_failures' as check_name, k.n is null as passed,
  case when k.n is not null then k.n || ' failures in a row' end as description
from state s left join streaks k on k.dataset_id = s.dataset_id
union all select dataset_id, 'freshness_breach', breach is null, breach from state""",
)
def run_checks(star: Star) -> DataFrame:
    return alerts.run_checks(S.runs(star), S.user_datasets(star), S.NOW, timedelta(hours=12))


@query(
    "OPS-10",
    """select c_custkey, sha256('GET https://example.org/series/observations?series_id=' || c_name
    || case when c_acctbal > 0 then '&realtime_start=' || c_mktsegment else '' end
    || '&realtime_end=2024-01-31') as request_hash from customer""",
)
def request_hashes(star: Star) -> DataFrame:
    start = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))
    hashed = keys.request_hash(F.lit("https://example.org"), F.col("c_name"), start, F.lit("2024-01-31"))
    return star.customer.select("c_custkey", hashed.alias("request_hash"))


@query(
    "EVT-01",
    f"""with {ENVELOPES} select event_id, event_type, occurred_at, producer, schema_version, dataset_id,
  correlation_id, payload_reference, case when event_type = 'raw_data.quarantined' then null else props end as props,
  cast(null as varchar) as problem from envelopes""",
)
def event_envelopes(star: Star) -> DataFrame:
    """Envelopes to JSON text and back."""
    parsed = events.parse(events.serialise(S.envelopes(star)))
    k = F.get_json_object("metadata", "$.k")
    quarantined = F.col("event_type") == "raw_data.quarantined"
    props = F.when(~quarantined, F.concat(F.lit('{"k": '), k, F.lit("}"))).alias("props")
    return parsed.select(*[c for c in events.COLUMNS if c != "metadata"], props, "problem")


@query(
    "EVT-01",
    """select cast(event_id as varchar) as correlation_id, sha256('{"event_type":"' || event_type
  || '","occurred_at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z","dataset_id":"user_' || user_id
  || '","correlation_id":"' || event_id || '"}') as event_id,
  '1.0.0' as schema_version, '{}' as metadata, 'unknown event type' as problem from events""",
)
def event_defaults(star: Star) -> DataFrame:
    """Envelopes with fields left out get defaults; a type outside the catalogue is a problem."""
    line = F.to_json(
        F.struct(
            "event_type",
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("occurred_at"),
            S.user_dataset().alias("dataset_id"),
            F.col("event_id").cast("string").alias("correlation_id"),
        )
    )
    parsed = events.parse(star.events.select(line.alias("envelope")))
    return parsed.select("correlation_id", "event_id", "schema_version", "metadata", "problem")


@query(
    "EVT-02",
    f"""with {ENVELOPES} select event_id, occurred_at, dataset_id, correlation_id from envelopes
where event_type = 'raw_data.validated'""",
)
def event_history(star: Star) -> DataFrame:
    chosen = events.history(S.envelopes(star), "raw_data.validated")
    return chosen.select("event_id", "occurred_at", "dataset_id", "correlation_id")


@query(
    "EVT-03 DLQ-01",
    f"""with {ENVELOPES} select correlation_id, 'counter' as consumer, 'handled' as outcome,
  cast(null as varchar) as failure_reason from envelopes where event_type = 'gold_data.published'
union all
select cast(event_id as varchar), 'publisher', case when value > 150 then 'failed' else 'handled' end,
  case when value > 150 then 'ValueError: value too large' end from events where event_type = 'purchase'
union all
select correlation_id, 'broken', 'failed', 'RuntimeError: not configured' from envelopes
where event_type = 'gold_data.published'""",
)
def event_fan_out(star: Star) -> DataFrame:
    """Three consumers of one event type, one of which raises; the failures of one do not reach the others."""
    values = star.events.select(F.col("event_id").cast("string").alias("correlation_id"), "value")

    def publish(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        valued = batch.join(values, "correlation_id")
        large = F.col("value") > 150
        failed = dlq.from_failures(valued.where(large), F.lit("ValueError"), F.lit("value too large"))
        return valued.where(~large), failed

    def count(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        return batch, batch.where(F.lit(False)).withColumn("failure_reason", F.lit(None).cast("string"))

    def broken(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        raise RuntimeError("not configured")

    handlers = {"publisher": publish, "counter": count, "broken": broken}
    out = events.fan_out(S.envelopes(star), {name: ("gold_data.published", h) for name, h in handlers.items()})
    rows = None
    for name, (handled, failed) in out.items():
        part = handled.select(
            "correlation_id",
            F.lit(name).alias("consumer"),
            F.lit("handled").alias("outcome"),
            F.lit(None).cast("string").alias("failure_reason"),
        ).unionByName(
            failed.select(
                "correlation_id",
                F.lit(name).alias("consumer"),
                F.lit("failed").alias("outcome"),
                "failure_reason",
            )
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query(
    "EVT-04",
    f"""with {ENVELOPES} select event_type, schema_version, schema_version = '1.0.0' as understood, count(*) as n
from envelopes group by 1, 2, 3""",
)
def event_version_guard(star: Star) -> DataFrame:
    understood, diverted = events.version_guard(S.envelopes(star), [schemas.EVENT_SCHEMA_VERSION])
    both = understood.withColumn("understood", F.lit(True)).unionByName(
        diverted.withColumn("understood", F.lit(False))
    )
    return both.groupBy("event_type", "schema_version", "understood").agg(F.count("*").alias("n"))


def _entries(star: Star) -> DataFrame:
    return dlq.from_quarantined(S.envelopes(star))


def _stored(star: Star) -> DataFrame:
    entries = _entries(star)
    return dlq.to_insert(entries, entries.where(F.lit(False)))


def _replays(star: Star) -> DataFrame:
    """Entries of the first half of the month were replayed, some of them twice."""
    early = _entries(star).where(F.col("quarantined_at") < F.lit("2024-01-15").cast("timestamp"))
    return early.select("event_id", F.col("quarantined_at").alias("replayed_at"))


def _current(star: Star) -> DataFrame:
    return dlq.current(_stored(star), _replays(star))


_CURRENT = f"""{ENVELOPES}, replays as (
  select event_id, min(quarantined_at) as replayed_at from entries
  where quarantined_at < timestamp '2024-01-15' group by 1),
dlq as (select s.event_id, s.dataset_id, s.correlation_id, s.payload_reference, s.failure_reason, s.quarantined_at,
    case when r.event_id is null then 'pending' else 'replayed' end as status, r.replayed_at
  from stored s left join replays r on r.event_id = s.event_id)"""


@query(
    "DLQ-01 SNK-04",
    f"""with {ENVELOPES} select event_id, event_type, dataset_id, correlation_id, failure_reason, quarantined_at
from stored where event_id not in (select event_id from entries where quarantined_at < timestamp '2024-01-10')""",
)
def dlq_first_wins(star: Star) -> DataFrame:
    """Entries to insert: the first per event id, none of those stored up to the tenth."""
    entries = _entries(star)
    existing = entries.where(F.col("quarantined_at") < F.lit("2024-01-10").cast("timestamp"))
    return dlq.to_insert(entries, existing).select(
        "event_id", "event_type", "dataset_id", "correlation_id", "failure_reason", "quarantined_at"
    )


@query("DLQ-02", f"with {_CURRENT} select event_id, failure_reason, quarantined_at from dlq where status = 'pending'")
def dlq_pending(star: Star) -> DataFrame:
    return dlq.pending(_current(star)).select("event_id", "failure_reason", "quarantined_at")


@query("DLQ-02", f"with {_CURRENT} select * from dlq where event_id = '8-20240101'")
def dlq_lookup(star: Star) -> DataFrame:
    found = dlq.by_id(_current(star), "8-20240101")
    return found.select(
        "event_id",
        "dataset_id",
        "correlation_id",
        "payload_reference",
        "failure_reason",
        "quarantined_at",
        "status",
        "replayed_at",
    )


@query("DLQ-03 SNK-05", f"with {_CURRENT} select event_id, status, replayed_at from dlq")
def dlq_state(star: Star) -> DataFrame:
    """A second replay of an entry does not move its time."""
    return _current(star).select("event_id", "status", "replayed_at")


@query(
    "DLQ-03",
    f"""with {_CURRENT} select event_id, timestamp '2024-01-31' as replayed_at from dlq
where status = 'pending' and dataset_id in ('user_1', 'user_2', 'user_3')""",
)
def dlq_mark_replayed(star: Star) -> DataFrame:
    """Asked for every event of three datasets; unknown and replayed ids yield nothing."""
    wanted = S.envelopes(star).where(F.col("dataset_id").isin("user_1", "user_2", "user_3"))
    return dlq.mark_replayed(_current(star), wanted, S.NOW)


@query(
    "DLQ-04",
    f"""with {_CURRENT} select {id_sql("'dlq.replay'", 'event_id')} as event_id, 'raw_data.received' as event_type,
  timestamp '2024-01-31' as occurred_at, 'dlq.replay' as producer, '1.0.0' as schema_version, dataset_id,
  correlation_id, payload_reference, '{{"replayed_from_dlq_event_id":"' || event_id || '"}}' as metadata
from dlq where status = 'pending'""",
)
def dlq_replay(star: Star) -> DataFrame:
    published, _ = dlq.replay(_current(star), S.NOW)
    return published


@query(
    "DLQ-05",
    f"""with {_CURRENT} select d.event_id, d.dataset_id, quarantined_at,
  cast(epoch(timestamp '2024-01-31') - floor(epoch(quarantined_at)) as bigint) as age_seconds
from dlq d join customer c on d.dataset_id = 'user_' || c_custkey
where status = 'pending'
  and epoch(timestamp '2024-01-31') - floor(epoch(quarantined_at)) > cast(abs(c_acctbal) * 100 as bigint)""",
)
def dlq_ageing(star: Star) -> DataFrame:
    """Pending entries older than their dataset's limit, which follows the customer's balance."""
    limit = F.abs("c_acctbal") * 100
    slo = star.customer.select(
        F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("dataset_id"),
        F.round(limit).cast("bigint").alias("max_lag_seconds"),
    )
    found = alerts.dlq_ageing(_current(star), slo, S.NOW)
    return found.select("event_id", "dataset_id", "quarantined_at", "age_seconds")


@query(
    "QRY-12",
    f"""with {RUNS}, daily as (select cast(started_at as date) as day, count(*) as runs,
    count(*) filter (status = 'success') as successes from runs group by 1)
select day, cast(sum(runs) over w as bigint) as runs, cast(sum(successes) over w as bigint) as successes,
  round(sum(successes) over w / sum(runs) over w, 6) as success_rate
from daily window w as (order by day range between interval 29 days preceding and current row)""",
)
def run_success_rate(star: Star) -> DataFrame:
    return runs.success_rate(S.runs(star))


@query(
    "QRY-12",
    f"""with {RUNS}, {DATASETS}, newest as (
  select dataset_id, max(finished_at) as finished_at from runs where status = 'success' group by 1)
select count(*) as datasets, count(*) filter (
    floor(epoch(timestamp '2024-01-31')) - floor(epoch(finished_at)) <= 86400) as fresh,
  round(count(*) filter (floor(epoch(timestamp '2024-01-31')) - floor(epoch(finished_at)) <= 86400)
    / count(*), 6) as adherence
from datasets d left join newest n on n.dataset_id = d.dataset_id""",
)
def freshness_adherence(star: Star) -> DataFrame:
    datasets = S.user_datasets(star).withColumn("max_lag_seconds", F.lit(86400))
    return runs.freshness_adherence(S.runs(star), datasets, S.NOW)


@query(
    "QRY-12",
    f"""with {_TESTS} select count(*) as tests, count(*) filter (status <> 'fail') as not_failed,
  round(count(*) filter (status <> 'fail') / count(*), 6) as pass_rate from current_tests""",
)
def quality_pass_rate(star: Star) -> DataFrame:
    return runs.pass_rate(_current_tests(star))


@query(
    "SNK-06",
    """select doc_id, 'src' || substr(source, 4) as source_id, p_brand as publisher,
  case when p_size > 25 then 'Licensed from ' || p_brand else 'Source: ' || p_brand end as attribution
from documents left join part on source = 'src' || p_partkey""",
)
def export_attribution(star: Star) -> DataFrame:
    """Documents with their source's attribution, written as CSV and read back; parts play the sources."""
    brand = F.col("p_brand")
    sources = star.part.select(
        F.concat(F.lit("src"), F.col("p_partkey").cast("string")).alias("source_id"),
        brand.alias("publisher"),
        F.lit(None).cast("string").alias("license_url"),
        F.when(F.col("p_size") > 25, F.concat(F.lit("Licensed from "), brand)).alias("attribution_text"),
    )
    documents = star.documents.select("doc_id", F.col("source").alias("source_id"))
    path = scratch_path(star.spark, "export")
    export.export_csv(documents, sources, path)
    schema = "source_id string, doc_id long, publisher string, license_url string, attribution string"
    written = star.spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return written.select("doc_id", "source_id", "publisher", "attribution")
