"""Dead-letter table: first failure per event wins, replay is a log of state changes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import keys
from tidemark.operators import events as E
from tidemark.sources import tables

COLUMNS = [f.name for f in schemas.DLQ.fields]
# Producer and event type of a replay, wording of a quarantine reason.
REPLAY_PRODUCER = "dlq.replay"
RECEIVED = "raw_data.received"
QUARANTINED = "raw_data.quarantined"
REASON_PREFIX = "data-quality rule(s) failed: "


def _entries(events: DataFrame, reason: Column) -> DataFrame:
    return events.select(
        "event_id",
        "event_type",
        "producer",
        "dataset_id",
        "correlation_id",
        "payload_reference",
        "metadata",
        reason.alias("failure_reason"),
        F.col("occurred_at").alias("quarantined_at"),
        F.lit("pending").alias("status"),
        F.lit(None).cast("timestamp").alias("replayed_at"),
    )


def from_quarantined(events: DataFrame) -> DataFrame:
    """Entries of quarantine events; the reason lists the failed rules their metadata names."""
    rules = F.from_json("metadata", "struct<failed_rules: array<string>>").failed_rules
    named = F.coalesce(F.size(rules), F.lit(0)) > 0
    reason = F.when(named, F.concat(F.lit(REASON_PREFIX), F.array_join(rules, ", "))).otherwise(QUARANTINED)
    return _entries(events.where(F.col("event_type") == QUARANTINED), reason)


def from_failures(failed: DataFrame, error_type: Column, error: Column) -> DataFrame:
    """Entries of events a consumer could not handle."""
    return _entries(failed, F.concat(error_type, F.lit(": "), error))


def to_insert(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Entries to append: one per event id, none that is stored already."""
    return tables.insert_absent(incoming, existing, ("event_id",), ("quarantined_at",)).select(*COLUMNS)


def current(entries: DataFrame, replays: DataFrame) -> DataFrame:
    """The table as readers see it: the earliest replay of an entry fixes its state."""
    first = replays.groupBy("event_id").agg(F.min("replayed_at").alias("_at"))
    return (
        entries.drop("status", "replayed_at")
        .join(first, "event_id", "left")
        .select(
            *[c for c in COLUMNS if c not in ("status", "replayed_at")],
            F.when(F.col("_at").isNull(), "pending").otherwise("replayed").alias("status"),
            F.col("_at").alias("replayed_at"),
        )
    )


def by_id(dlq: DataFrame, event_id: str) -> DataFrame:
    return dlq.where(F.col("event_id") == event_id)


def pending(dlq: DataFrame) -> DataFrame:
    """Entries still to replay, oldest first."""
    return dlq.where("status = 'pending'").orderBy("quarantined_at", "event_id")


def mark_replayed(dlq: DataFrame, wanted: DataFrame, replayed_at: datetime) -> DataFrame:
    """State changes to append for the wanted ids; unknown and replayed ones yield nothing."""
    open_entries = dlq.where("status = 'pending'").select("event_id")
    return (
        open_entries.join(wanted.select("event_id").distinct(), "event_id", "left_semi")
        .withColumn("replayed_at", F.lit(replayed_at).cast("timestamp"))
    )


def replay(
    dlq: DataFrame, replayed_at: datetime, wanted: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(events to publish, state changes to append) for pending entries.

    Once the state changes are stored the same call yields nothing.
    """
    chosen = dlq.where("status = 'pending'")
    if wanted is not None:
        chosen = chosen.join(wanted.select("event_id").distinct(), "event_id", "left_semi")
    published = E.emit(
        chosen,
        RECEIVED,
        REPLAY_PRODUCER,
        replayed_at,
        correlation_id=F.col("correlation_id"),
        payload_reference=F.col("payload_reference"),
        metadata=F.struct(F.col("event_id").alias("replayed_from_dlq_event_id")),
        event_id=keys.derived_id(F.lit(REPLAY_PRODUCER), "event_id"),
    )
    changes = chosen.select("event_id", F.lit(replayed_at).cast("timestamp").alias("replayed_at"))
    return published, changes
