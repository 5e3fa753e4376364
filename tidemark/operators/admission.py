"""Admission of raw objects: each is a batch that the quality rules judge before Bronze takes it.

The payload is parsed with the parser Silver uses, shaped by the contract of its source and judged by all
nine rules. Verdicts are narrow rows; the join that lets objects through compares ids only.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.contracts import DataContract
from tidemark.functions import keys
from tidemark.operators import events, silver
from tidemark.operators.quality import rows, verdict

# Fixed value: producer of the outcome events.
PRODUCER = "validation.engine"


@dataclass(frozen=True)
class Gate:
    """Contract and parser per source, and the context that the rules are given (see ``verdict.evaluate``)."""

    contracts: Mapping[str, DataContract]
    parsers: Mapping[str, silver.Parser]
    context: Mapping[str, Any] = field(default_factory=dict)


def judge(objects: DataFrame, gate: Gate, stage: verdict.Stage | None = None) -> DataFrame:
    """Rule results per object, ``batch_id`` being its Bronze id.

    An unreadable payload fails the schema rule with the reason as message. A value written with the
    source's missing marker is no record. Objects of sources without contract or parser have no results.
    """
    batches = objects.withColumn("bronze_id", keys.bronze_id("raw_object_key"))
    parts = []
    for source, contract in sorted(gate.contracts.items()):
        if source not in gate.parsers:
            continue
        mine = batches.where(F.col("source_id") == source)
        parsed = gate.parsers[source](mine)
        if "problem" not in parsed.columns:
            parsed = parsed.withColumn("problem", F.lit(None).cast("string"))
        if stage is not None:
            parsed = stage(parsed)
        broken = parsed.where("problem is not null").groupBy("bronze_id").agg(F.min("problem").alias("problem"))
        written = F.col("value_text").isNull() | (F.col("value_text") != silver.MISSING_MARKER)
        records = rows.from_observations(parsed.where(F.col("problem").isNull() & written), F.col("dataset_id"))
        found = verdict.evaluate(mine.select(F.col("bronze_id").alias("batch_id")), records, contract, **gate.context)
        parts.append(_unreadable(found, broken.withColumnRenamed("bronze_id", "batch_id")))
    if not parts:
        none = batches.select(F.col("bronze_id").alias("batch_id")).where(F.lit(False))
        empty = {"rule_id": "string", "status": "string", "failed_rows": "bigint", "message": "string"}
        return none.select("batch_id", *[F.lit(None).cast(t).alias(n) for n, t in empty.items()])
    return reduce(DataFrame.unionByName, parts)


def _unreadable(results: DataFrame, broken: DataFrame) -> DataFrame:
    hit = F.col("problem").isNotNull() & (F.col("rule_id") == verdict.SCHEMA)
    return results.join(broken, "batch_id", "left").select(
        "batch_id",
        "rule_id",
        F.when(hit, "failed").otherwise(F.col("status")).alias("status"),
        F.when(hit, 1).otherwise(F.col("failed_rows")).cast("bigint").alias("failed_rows"),
        F.when(hit, F.col("problem")).otherwise(F.col("message")).alias("message"),
    )


def verdicts(objects: DataFrame, results: DataFrame, judged_at: datetime, earlier: DataFrame) -> DataFrame:
    """One verdict per object. An object that no contract covers is quarantined without a failed rule.

    ``earlier`` verdicts count the attempts: an object that was quarantined and is judged again has been
    replayed, and another failure of it is another event.
    """
    named = objects.select(keys.bronze_id("raw_object_key").alias("batch_id"), "raw_object_key", "dataset_id")
    before = current(earlier).select(
        "raw_object_key", (F.col("attempt") + (F.col("outcome") == "quarantined").cast("int")).alias("attempt")
    )
    empty = F.array().cast("array<string>")
    found = named.join(verdict.verdicts(results), "batch_id", "left").join(before, "raw_object_key", "left")
    return found.select(
        "batch_id",
        "raw_object_key",
        "dataset_id",
        F.coalesce("failed_rules", empty).alias("failed_rules"),
        F.coalesce("flagged_rules", empty).alias("flagged_rules"),
        F.coalesce("outcome", F.lit("quarantined")).alias("outcome"),
        F.coalesce("attempt", F.lit(0)).alias("attempt"),
        F.lit(judged_at).cast("timestamp").alias("judged_at"),
    )


def admitted(judged: DataFrame) -> DataFrame:
    return judged.where("outcome = 'validated'").select("raw_object_key")


def current(judged: DataFrame) -> DataFrame:
    """The newest verdict of each object."""
    order = F.struct("attempt", "judged_at", "outcome", "dataset_id", "batch_id", "failed_rules", "flagged_rules")
    newest = judged.groupBy("raw_object_key").agg(F.max(order).alias("row"))
    return newest.select("raw_object_key", "row.*").select(*schemas.BATCH_VERDICT.fieldNames())


def refused(judged: DataFrame, replays: DataFrame) -> DataFrame:
    """Keys that stay out: quarantined, and not replayed since. A replayed one is judged again."""
    standing = current(judged).where("outcome = 'quarantined'").withColumn("event_id", outcome_id())
    since = replays.groupBy("event_id").agg(F.max("replayed_at").alias("replayed_at"))
    again = F.coalesce(F.col("replayed_at") >= F.col("judged_at"), F.lit(False))
    return standing.join(since, "event_id", "left").where(~again).select("raw_object_key")


def outcome_id() -> F.Column:
    """Id of a verdict's event: the same verdict on the same object is the same event."""
    rules = [F.array_join(c, ",") for c in ("failed_rules", "flagged_rules")]
    return keys.derived_id(F.lit("outcome"), "raw_object_key", "outcome", "attempt", *rules)


def outcome_events(judged: DataFrame, at: datetime) -> DataFrame:
    """A validated event naming the flagged rules, or a quarantined one naming the failed ones, per object."""
    parts = []
    for outcome, rules in (("validated", "flagged_rules"), ("quarantined", "failed_rules")):
        parts.append(
            events.emit(
                judged.where(F.col("outcome") == outcome),
                f"raw_data.{outcome}",
                PRODUCER,
                at,
                correlation_id=F.col("batch_id"),
                payload_reference=F.col("raw_object_key"),
                metadata=F.struct(rules),
                event_id=outcome_id(),
            )
        )
    return parts[0].unionByName(parts[1])
