"""Streaming validation: every batch is judged whole, however its records arrive."""

from __future__ import annotations

from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.contracts import DataContract
from tidemark.functions import keys
from tidemark.operators import dlq, events
from tidemark.operators.quality import rows, verdict
from tidemark.plans.pipeline import Layout
from tidemark.sources import tables
from tidemark.streaming.ingest import run_batches

# Fixed value: producer of the outcome events.
PRODUCER = "validation.engine"

VERDICT = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("failed_rules", T.ArrayType(T.StringType())),
        T.StructField("flagged_rules", T.ArrayType(T.StringType())),
        T.StructField("outcome", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("batch_number", T.LongType()),
    ]
)


def _outcome_id(dataset_id: str) -> F.Column:
    """Id of the event of a verdict: the same verdict on the same batch is the same event."""
    rules = [F.array_join(c, ",") for c in ("failed_rules", "flagged_rules")]
    return keys.derived_id("outcome", F.lit(dataset_id), "batch_id", *rules)


def outcome_events(verdicts: DataFrame, dataset_id: str, at: datetime) -> DataFrame:
    """A validated or quarantined event per batch, naming its flagged or failed rules."""
    about = verdicts.withColumn("dataset_id", F.lit(dataset_id))
    parts = []
    for outcome, rules in (("validated", "flagged_rules"), ("quarantined", "failed_rules")):
        parts.append(
            events.emit(
                about.where(F.col("outcome") == outcome),
                f"raw_data.{outcome}",
                PRODUCER,
                at,
                correlation_id=F.col("batch_id"),
                metadata=F.struct(rules),
                event_id=_outcome_id(dataset_id),
            )
        )
    return parts[0].unionByName(parts[1])


#: Records are stored by this many buckets of their batch id; a trigger reads the buckets it touches.
BUCKETS, BUCKET = 256, "bucket"


def bucket_of(batch_id: F.Column) -> F.Column:
    return F.pmod(F.xxhash64(batch_id), F.lit(BUCKETS)).cast("int")


def _sliced(spark: SparkSession, path: str, schema: T.StructType, *partitions: T.StructField) -> DataFrame:
    slice_ = T.StructField(tables.BATCH_COLUMN, T.StringType())
    return tables.read_table(spark, path, T.StructType([*schema.fields, *partitions, slice_]))


def touched_batches(spark: SparkSession, path: str, schema: T.StructType, own: F.Column) -> DataFrame:
    """All stored records of the batches that a slice has records of.

    Their buckets, at most ``BUCKETS`` numbers, become a filter on the partition column, so the directories
    of other buckets are not read; inside those read, a semi join keeps the batches.
    """
    received = _sliced(spark, path, schema, T.StructField(BUCKET, T.IntegerType()))
    ids = received.where(own).select("batch_id", BUCKET).distinct()
    buckets = sorted(r[BUCKET] for r in ids.select(BUCKET).distinct().collect())
    return received.where(F.col(BUCKET).isin(buckets)).join(ids.select("batch_id"), "batch_id", "left_semi")


def validate_and_route(
    lines: DataFrame,
    contract: DataContract,
    layout: Layout,
    checkpoint: str,
    name: str,
    **context: Any,
) -> StreamingQuery:
    """Records (``batch_id``, ``line`` JSON text) to a verdict per batch, with an outcome event per
    verdict and a dead-letter entry per quarantine.

    Arriving records are stored first, by bucket of their batch id. Then each batch they touch is judged
    over all its records, those of earlier triggers too, which lie in the same buckets. The newest
    verdict of a batch replaces the older ones (see ``current_verdicts``), so neither the number of
    triggers nor their order matters. Every table is written by slice, so repeating a micro-batch
    changes nothing.
    """
    spark = lines.sparkSession
    slice_column = tables.BATCH_COLUMN

    def write(batch: DataFrame, batch_id: int) -> None:
        own = F.col(slice_column) == tables.slice_name(name, batch_id)
        received_path, verdict_path = layout.path("received"), layout.path("verdicts")
        bucketed = batch.withColumn(BUCKET, bucket_of(F.col("batch_id")))
        tables.write_batch(bucketed, received_path, name, batch_id, (BUCKET,))
        whole = touched_batches(spark, received_path, batch.schema, own).drop(slice_column, BUCKET)
        records = rows.from_json_text(whole, "batch_id", "line")
        results = verdict.evaluate(whole.select("batch_id"), records, contract, **context)
        judged = (
            verdict.verdicts(results)
            .withColumn("event_id", _outcome_id(contract.dataset))
            .withColumn("batch_number", F.lit(batch_id).cast("bigint"))
            .select(*VERDICT.fieldNames())
        )
        tables.write_batch(judged, verdict_path, name, batch_id)
        stored = _sliced(spark, verdict_path, VERDICT).where(own)
        emitted = outcome_events(stored, contract.dataset, datetime.now(timezone.utc))
        tables.write_batch(emitted, layout.path("event_log"), name, batch_id)
        tables.write_batch(dlq.from_quarantined(emitted), layout.path("dlq"), name, batch_id)

    return run_batches(lines, write, checkpoint, name)


def current_verdicts(spark: SparkSession, layout: Layout) -> DataFrame:
    """The newest verdict of each batch."""
    return tables.latest_by_key(
        tables.read_table(spark, layout.path("verdicts"), VERDICT), ("batch_id",), ("batch_number",)
    )


def read_routed(spark: SparkSession, layout: Layout, schema: T.StructType, outcome: str) -> DataFrame:
    """Records whose batch stands as ``validated`` or ``quarantined``."""
    chosen = current_verdicts(spark, layout).where(F.col("outcome") == outcome)
    return tables.read_table(spark, layout.path("received"), schema).join(chosen.select("batch_id"), "batch_id", "left_semi")


def read_outcomes(spark: SparkSession, layout: Layout) -> DataFrame:
    """The events of the verdicts that stand, one per batch."""
    return _standing(spark, layout, tables.read_table(spark, layout.path("event_log"), schemas.EVENT), "occurred_at")


def read_quarantined(spark: SparkSession, layout: Layout) -> DataFrame:
    """The dead-letter entries of the verdicts that stand, one per batch."""
    return _standing(spark, layout, tables.read_table(spark, layout.path("dlq"), schemas.DLQ), "quarantined_at")


def _standing(spark: SparkSession, layout: Layout, log: DataFrame, at: str) -> DataFrame:
    ids = current_verdicts(spark, layout).select("event_id")
    return tables.first_by_key(log.join(ids, "event_id", "left_semi"), ("event_id",), (at,))
