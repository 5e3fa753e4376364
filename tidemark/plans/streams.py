"""Streaming operators over the given tables, run until what is available has been processed.

Each run works in a fresh place under the shared folder, so runs do not see each other's state.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping
from datetime import timedelta

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.plans.checks import _RESULTS, _VERDICTS
from tidemark.plans.layers import _OBJECTS
from tidemark.plans.operations import _STREAKS
from tidemark.plans.pipeline import Layout
from tidemark.plans import pipeline
from tidemark.plans.registry import ENVELOPES, id_sql, query
from tidemark.session import scratch_path
from tidemark.sources import landing, star as S, tables
from tidemark.sources.star import Star
from tidemark.streaming import alerts, consumers, ingest, streaks, validate


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # handlers of single events run in tasks


class _Streamed(Star):
    """The same tables as streams, so that adapters apply to them unchanged."""

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        schema = getattr(Star(self.spark, self.sf_dir), name).schema
        # A glob of one name: the table may be one file or a directory of part files.
        return self.spark.readStream.schema(schema).parquet(f"{self.sf_dir}/{name}[.]parquet")


def _finish(query_) -> None:
    query_.awaitTermination()


@query(
    "STR-01 SRC-02 BRZ-02",
    f"""with {_OBJECTS} select sha256(raw_object_key) as bronze_id, raw_object_key, min(raw_sha256) as raw_sha256,
  min(retrieved_at) as retrieved_at from objects group by raw_object_key""",
)
def stream_ingest(star: Star) -> DataFrame:
    """Documents land once in a landing table and are streamed from it into Bronze."""
    layout = Layout(scratch_path(star.spark, "ingest"))
    objects = S.document_objects(star).drop("doc_id")
    landing.land_table(objects, objects.where(F.lit(False)), layout.path("landed"))
    schema = star.spark.read.parquet(layout.path("landed")).schema
    stream = ingest.object_table(star.spark, layout.path("landed"), schema)
    _finish(
        ingest.to_bronze(
            stream, layout.path("bronze"), layout.path("rejected"), S.CODE_VERSION, layout.path("checkpoint"), "ingest"
        )
    )
    stored = tables.read_table(star.spark, layout.path("bronze"), schemas.BRONZE)
    return stored.select("bronze_id", "raw_object_key", "raw_sha256", "retrieved_at")


@query("STR-02", "select distinct user_id, event_type from events")
def stream_deduplicate(star: Star) -> DataFrame:
    """One row per user and event type out of a stream; the delay spans the month."""
    layout = Layout(scratch_path(star.spark, "dedupe"))
    stream = _Streamed(star.spark, star.sf_dir).events.select("user_id", "event_type", "ts")
    kept = ingest.deduplicate(stream, ["user_id", "event_type"], "ts", "40 days")
    _finish(alerts.append_windows(kept, layout.path("kept"), layout.path("checkpoint"), "dedupe"))
    return star.spark.read.schema(kept.schema).parquet(layout.path("kept")).select("user_id", "event_type")


@query(
    "STR-03 DLQ-01",
    f"""with {_RESULTS}, judged as (
  select * from results where rule_id in ('FR-QUAL-001', 'FR-QUAL-003', 'FR-QUAL-004', 'FR-QUAL-005', 'FR-QUAL-009')),
{_VERDICTS.replace("from results", "from judged")}
select batch_id, case when failed_rules is null then 'raw_data.validated' else 'raw_data.quarantined' end
    as event_type, case when failed_rules is not null
      then 'data-quality rule(s) failed: ' || replace(failed_rules, ',', ', ') end as failure_reason
from verdicts""",
)
def stream_validate(star: Star) -> DataFrame:
    """Daily event batches judged as a stream: outcome events and dead-letter reasons."""
    layout = Layout(scratch_path(star.spark, "validate"))
    lines = S.event_json(_Streamed(star.spark, star.sf_dir)).select("batch_id", "line")
    _finish(
        validate.validate_and_route(
            lines,
            S.EVENT_CONTRACT,
            layout,
            layout.path("checkpoint"),
            "validate",
            now=S.NOW,
            max_lag=timedelta(days=10),
        )
    )
    dead = validate.read_quarantined(star.spark, layout).select("event_id", "failure_reason")
    return validate.read_outcomes(star.spark, layout).join(dead, "event_id", "left").select(
        F.col("correlation_id").alias("batch_id"), "event_type", "failure_reason"
    )


def _reference_number(batch: DataFrame) -> DataFrame:
    return batch.select("event_id", "dataset_id", F.substring("payload_reference", 3, 9).cast("long").alias("n"))


def _strict_number(event: Mapping) -> Iterator[Mapping]:
    """Raises on an event: ids ending in 777 are taken for forged ones. The number as ``_reference_number`` has it."""
    if (event["event_id"] or "").endswith("777"):
        raise ValueError("forged id")
    reference = event["payload_reference"]
    number = None if reference is None else int(reference[2:11])
    yield {"event_id": event["event_id"], "dataset_id": event["dataset_id"], "n": number}


@query(
    "EVT-03 EVT-02 DLQ-01",
    f"""with {ENVELOPES}, received as (
  select correlation_id as event_id, dataset_id, cast(substr(payload_reference, 3) as bigint) as n
  from envelopes where event_type = 'raw_data.received')
select 'plain' as consumer, event_id, dataset_id, n, cast(null as varchar) as reason from received
union all select 'strict', event_id, dataset_id, n, null from received where event_id not like '%777'
union all select 'dead letter', event_id, dataset_id, null, 'strict' from received where event_id like '%777'""",
)
def consumer_queries(star: Star) -> DataFrame:
    """Two consumers of one event type over a log that grows between their runs; one of them raises on some
    events as they are computed."""
    layout = Layout(scratch_path(star.spark, "consumers"))
    log = S.envelopes(star).withColumn("event_id", F.col("correlation_id"))
    early = F.col("occurred_at") < F.lit("2024-01-16").cast("timestamp")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("event_id", "dataset_id")] + [T.StructField("n", T.LongType())])
    made = {
        "plain": consumers.Consumer("raw_data.received", _reference_number, schema),
        "strict": consumers.Consumer("raw_data.received", _strict_number, schema, per_event=True),
    }
    for label, part in (("early", log.where(early)), ("late", log.where(~early))):
        pipeline.append_events(part, layout, label)
        consumers.run_all(star.spark, layout, made)
    handled = [
        consumers.read_consumed(star.spark, layout, name, c).withColumns({"consumer": F.lit(name), "reason": F.lit(None).cast("string")})
        for name, c in made.items()
    ]
    letters = pipeline.read_dlq(star.spark, layout).select(
        "event_id", "dataset_id", F.lit(None).cast("long").alias("n"), F.lit("dead letter").alias("consumer"),
        F.substring_index("failure_reason", ":", 1).alias("reason"),
    )
    return handled[0].unionByName(handled[1]).unionByName(letters)


@query(
    "STR-04 OPS-05 OPS-08",
    f"""with {_STREAKS} select dataset_id,
  {id_sql("'consecutive_failures'", 'dataset_id', 'latest_run_id')} as alert_id,
  dataset_id || ' failed ' || consecutive_failures || ' times in a row' as message
from streaks where consecutive_failures >= 2""",
)
def stream_failure_streaks(star: Star) -> DataFrame:
    """Streaks kept as state per dataset; what stands is read from the state store."""
    layout = Layout(scratch_path(star.spark, "streaks"))
    stream = S.runs(_Streamed(star.spark, star.sf_dir))
    _finish(streaks.failure_streaks(stream, layout.path("alerts"), layout.path("checkpoint"), "streaks"))
    found = streaks.standing_alerts(star.spark, layout.path("checkpoint"), layout.path("alerts"))
    return found.select("dataset_id", "alert_id", "message")


@query(
    "STR-05 EVT-02",
    """select date_trunc('hour', ts) as window_start, date_trunc('hour', ts) + interval 1 hour as window_end,
  event_type, count(*) as events from events group by 1, 2, 3""",
)
def stream_event_counts(star: Star) -> DataFrame:
    layout = Layout(scratch_path(star.spark, "counts"))
    stream = _Streamed(star.spark, star.sf_dir).events
    # The delay spans the month, as files may arrive in any order.
    counts = alerts.event_counts(stream, "ts", ["event_type"], "1 hour", "40 days")
    _finish(alerts.keep_windows(counts, layout.path("windows"), layout.path("checkpoint"), "counts"))
    return alerts.read_windows(star.spark, layout.path("windows"), counts.schema)
