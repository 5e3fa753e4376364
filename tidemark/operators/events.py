"""Event envelopes as rows of an append-only event log."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import keys, periods

COLUMNS = [f.name for f in schemas.EVENT.fields]


def _instant(value: Column | datetime) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def emit(
    about: DataFrame,
    event_type: str,
    producer: str,
    occurred_at: Column | datetime,
    dataset_id: str | Column = "dataset_id",
    correlation_id: Column | None = None,
    payload_reference: Column | None = None,
    metadata: Column | None = None,
    event_id: Column | None = None,
) -> DataFrame:
    """One event per row of ``about``. Unless given, the id is derived from the content, so a
    retried task emits the same event and a first-wins insert keeps one."""
    if event_type not in schemas.EVENT_TYPES:
        raise ValueError(f"unknown event type {event_type!r}")
    text = F.lit(None).cast("string")
    shaped = about.select(
        F.lit(event_type).alias("event_type"),
        _instant(occurred_at).alias("occurred_at"),
        F.lit(producer).alias("producer"),
        F.lit(schemas.EVENT_SCHEMA_VERSION).alias("schema_version"),
        (F.col(dataset_id) if isinstance(dataset_id, str) else dataset_id).alias("dataset_id"),
        (text if correlation_id is None else correlation_id).alias("correlation_id"),
        (text if payload_reference is None else payload_reference).alias("payload_reference"),
        (F.lit("{}") if metadata is None else F.to_json(metadata)).alias("metadata"),
        (text if event_id is None else event_id).alias("event_id"),
    )
    derived = keys.derived_id(
        "event_type", "occurred_at", "dataset_id", "correlation_id", "payload_reference", "metadata"
    )
    return shaped.withColumn("event_id", F.coalesce("event_id", derived)).select(*COLUMNS)


def serialise(events: DataFrame) -> DataFrame:
    """Envelope as JSON text with an ISO timestamp; metadata stays a JSON object inside it."""
    body = F.to_variant_object(
        F.struct(
            "event_id",
            "event_type",
            F.date_format("occurred_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("occurred_at"),
            "producer",
            "schema_version",
            "dataset_id",
            "correlation_id",
            "payload_reference",
            F.try_parse_json(F.coalesce("metadata", F.lit("{}"))).alias("metadata"),
        )
    )
    return events.select("event_id", F.to_json(body).alias("envelope"))


def parse(lines: DataFrame, text: str = "envelope") -> DataFrame:
    """Envelope columns from JSON text with the defaults of absent fields.

    A given event id is kept, an absent one is derived from the text. ``problem`` names what makes
    a line no valid envelope (null when it is one).
    """
    body = F.try_parse_json(text)

    def get(name: str) -> Column:
        return F.try_variant_get(body, f"$.{name}", "string")

    occurred = periods.iso_instant(get("occurred_at"))
    problem = (
        F.when(body.isNull(), "not JSON")
        .when(get("event_type").isNull() | ~get("event_type").isin(*schemas.EVENT_TYPES), "unknown event type")
        .when(get("producer").isNull(), "no producer")
        .when(get("dataset_id").isNull(), "no dataset")
        .when(occurred.isNull(), "unreadable time")
    )
    return lines.select(
        F.coalesce(get("event_id"), F.sha2(text, 256)).alias("event_id"),
        get("event_type").alias("event_type"),
        occurred.alias("occurred_at"),
        get("producer").alias("producer"),
        F.coalesce(get("schema_version"), F.lit(schemas.EVENT_SCHEMA_VERSION)).alias("schema_version"),
        get("dataset_id").alias("dataset_id"),
        get("correlation_id").alias("correlation_id"),
        get("payload_reference").alias("payload_reference"),
        F.coalesce(F.to_json(F.try_variant_get(body, "$.metadata", "variant")), F.lit("{}")).alias("metadata"),
        problem.alias("problem"),
    )


def history(events: DataFrame, event_type: str | None = None) -> DataFrame:
    """Events, all or of one type, oldest first."""
    chosen = events if event_type is None else events.where(F.col("event_type") == event_type)
    return chosen.orderBy("occurred_at", "event_id")


def version_guard(events: DataFrame, known: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(understood, diverted) by schema version; a missing version is not understood."""
    understood = F.coalesce(F.col("schema_version").isin(*known), F.lit(False))
    return events.where(understood), events.where(~understood)


Handler = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


def fan_out(
    events: DataFrame, consumers: Mapping[str, tuple[str, Handler]]
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Give each consumer the events of its type; returns (handled, failed) per consumer.

    A handler splits its events into handled rows and failed rows (event columns plus
    ``failure_reason``). Failed rows go to the dead-letter table; other consumers never see them.
    A handler that raises fails all its events, with the error as the reason, and no other consumer's.
    """
    return {
        name: _isolated(handler, events.where(F.col("event_type") == event_type))
        for name, (event_type, handler) in consumers.items()
    }


def _isolated(handler: Handler, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    try:
        return handler(batch)
    except Exception as error:  # whatever a consumer does wrong is its own failure
        reason = F.lit(f"{type(error).__name__}: {error}")
        return batch.where(F.lit(False)), batch.withColumn("failure_reason", reason)
