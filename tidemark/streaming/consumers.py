"""Consumers of the event log: a query and a checkpoint each, so none waits for or fails with another.

What a consumer raises while its rows are computed is its own failure: the micro-batch is split by event id and
its parts are tried again, until the events that fail stand alone. They become dead letters with the error as the
reason, all others are handled, and the stream goes on.

Splitting takes some dozens of jobs for each event that fails. A handler of single events (``per_event``) is tried
event by event inside the tasks instead, one pass over the batch however many events fail.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.operators import dlq
from tidemark.plans.pipeline import Layout
from tidemark.session import scratch_path
from tidemark.sources import tables
from tidemark.streaming.ingest import run_batches

#: Bits of the id's hash that split a failing part, parts tried at a time, and how often a part is split: until
#: all bits of the hash are used.
BITS, AT_ONCE, DEEPEST = 4, 4, 16
FAN = 1 << BITS

#: Functions of this module run in tasks and are shipped by value, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Handler = Callable[[DataFrame], DataFrame]
EventHandler = Callable[[Mapping], Iterable[Mapping]]


@dataclass(frozen=True)
class Consumer:
    """Handles the events of one type; ``schema`` is that of the rows it makes of them.

    ``handler`` makes rows of a batch of events, or with ``per_event`` rows of one event, both as mappings.
    """

    event_type: str
    handler: Handler | EventHandler
    schema: T.StructType
    per_event: bool = False


def event_stream(spark: SparkSession, layout: Layout, max_files: int = 1000) -> DataFrame:
    """The event log as a stream, the slices of batch runs and of streaming queries alike."""
    sliced = T.StructType([*schemas.EVENT.fields, T.StructField(tables.BATCH_COLUMN, T.StringType())])
    stream = spark.readStream.schema(sliced).option("maxFilesPerTrigger", max_files)
    return stream.parquet(layout.path("event_log")).drop(tables.BATCH_COLUMN)


def error_text(error: Exception) -> str:
    """Type and message in one line. Of an error in a Python worker, those of what the worker raised."""
    lines = [x.strip() for x in str(error).splitlines() if x.strip()]
    raised = [x for x in lines if re.match(r"[\w.]*(Error|Exception|Interrupt): ", x)]
    if raised and type(error).__name__ == "PythonException":
        return raised[-1]
    return f"{type(error).__name__}: {lines[0] if lines else ''}"


def _share(numbers: tuple[int, ...]) -> Column:
    """Events of one part: the digits of the id's hash, taken to base FAN, from the last on."""
    digest, chosen = F.xxhash64("event_id"), F.lit(True)
    for level, number in enumerate(numbers):
        chosen = chosen & (F.shiftrightunsigned(digest, BITS * level).bitwiseAND(FAN - 1) == number)
    return chosen


def _tried(events: list[Mapping], handler: EventHandler, made: pa.DataType) -> tuple[pa.Array, list[str | None]]:
    """Lists of the rows of each event, and what it raised; rows that do not fit the schema are a failure too."""
    rows: list[list[Mapping]] = []
    reasons: list[str | None] = []
    for event in events:
        try:
            rows.append([dict(x) for x in handler(event)])
            reasons.append(None)
        except Exception as error:  # whatever a consumer does wrong is its own failure
            rows.append([])
            reasons.append(error_text(error))
    try:
        return pa.array(rows, made), reasons
    except Exception:  # some event's rows, found one by one
        for k, one in enumerate(rows):
            try:
                pa.array([one], made)
            except Exception as error:
                rows[k], reasons[k] = [], error_text(error)
        return pa.array(rows, made), reasons


def _handle_each(batch: DataFrame, consumer: Consumer) -> tuple[DataFrame, DataFrame]:
    """As ``handle``, with every event tried for itself in one pass, which is stored before it is read."""
    handler, kind = consumer.handler, T.ArrayType(consumer.schema)
    made = to_arrow_type(kind)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows, reasons = _tried(part.to_pylist(), handler, made)
            yield pa.RecordBatch.from_arrays([*part.columns, rows, pa.array(reasons, pa.string())], [*part.schema.names, "rows", "failure_reason"])

    # Of an event that was handled only its rows are written, one that failed stays whole.
    tried = batch.mapInArrow(each, T.StructType([*batch.schema.fields, T.StructField("rows", kind), T.StructField("failure_reason", T.StringType())]))
    kept = {c: F.when(F.col("failure_reason").isNotNull(), F.col(c)).alias(c) for c in batch.columns}
    place = scratch_path(batch.sparkSession, "consumer")
    stored = tables.staged(tried.select(*kept.values(), "rows", "failure_reason"), place)
    rows = stored.where("failure_reason is null").select(F.inline("rows"))
    return rows, stored.where("failure_reason is not null").drop("rows")


def handle(batch: DataFrame, consumer: Consumer) -> tuple[DataFrame | None, DataFrame | None]:
    """(handled rows, failed events with ``failure_reason``) of a stored batch; None where there are none.

    Rows of a part are written before they count as handled, so errors of planning and of computing both
    show here. Storage that fails for good fails the query, which starts again from its checkpoint: when parts
    failed, one event is stored without the consumer, and if that fails too, it was not the consumer.
    """
    if consumer.per_event:
        return _handle_each(batch, consumer)
    spark = batch.sparkSession
    place = scratch_path(spark, "consumer")

    def attempt(numbers: tuple[int, ...]) -> tuple[tuple[int, ...], str | None]:
        part = batch.where(_share(numbers)) if numbers else batch
        path = f"{place}/" + "-".join(map(str, (len(numbers), *numbers)))
        try:
            rows = consumer.handler(part)
            rows.select(*consumer.schema.fieldNames()).write.mode("overwrite").parquet(path)
        except Exception as error:  # whatever a consumer does wrong is its own failure
            return numbers, error_text(error)
        handled.append(path)
        return numbers, None

    handled: list[str] = []
    failed: list[DataFrame] = []
    todo: list[tuple[int, ...]] = [()]
    with ThreadPoolExecutor(AT_ONCE) as pool:
        while todo:
            results, todo = list(pool.map(attempt, todo)), []
            if any(reason is not None for _, reason in results):
                tables.staged(batch.limit(1), f"{place}/unhandled")
            for numbers, reason in results:
                if reason is None:
                    continue
                part = batch.where(_share(numbers)) if numbers else batch
                alone = len(numbers) >= DEEPEST or part.select("event_id").distinct().limit(2).count() < 2
                if alone:
                    failed.append(part.withColumn("failure_reason", F.lit(reason)))
                else:
                    todo += [(*numbers, n) for n in range(FAN)]
    rows = spark.read.schema(consumer.schema).parquet(*handled) if handled else None
    return rows, reduce(DataFrame.unionByName, failed) if failed else None


def start(spark: SparkSession, layout: Layout, name: str, consumer: Consumer, max_files: int = 1000) -> StreamingQuery:
    """One consumer's query over what the log holds; started again, it goes on from its checkpoint.

    Its rows go to ``consumed/<name>``, one slice per micro-batch, and its failures to the dead-letter table.
    An event that a writer of the log repeats within a micro-batch is handled once.
    """
    known = event_stream(spark, layout, max_files).where(F.col("event_type") == consumer.event_type)

    def write(batch: DataFrame, batch_id: int) -> None:
        once = tables.first_by_key(batch, ("event_id",), ("occurred_at",))
        stored = tables.staged(once, layout.path(f"consumer_input/{name}"))
        rows, failed = handle(stored, consumer)
        if rows is not None:
            tables.write_batch(rows, layout.path(f"consumed/{name}"), name, batch_id)
        if failed is not None:
            entries = dlq.from_failures(failed, F.lit(f"{name}"), F.col("failure_reason"))
            tables.write_batch(entries, layout.path("dlq"), name, batch_id)

    return run_batches(known, write, layout.path(f"checkpoints/consumer-{name}"), f"consumer-{name}")


class ConsumersFailed(RuntimeError):
    """Queries failed as a whole; ``outcome`` has the reason of each consumer, None of those that came to their end."""

    def __init__(self, outcome: Mapping[str, str | None]) -> None:
        super().__init__(outcome)
        self.outcome = dict(outcome)

    def __str__(self) -> str:
        return "; ".join(f"{name}: {reason}" for name, reason in self.outcome.items() if reason is not None)


def run_all(
    spark: SparkSession, layout: Layout, consumers: Mapping[str, Consumer], max_files: int = 1000
) -> dict[str, None]:
    """Start every consumer and wait for all; the names of the consumers, each with None for no failure.

    If a query fails as a whole, the others still come to their end, then ``ConsumersFailed`` is raised: what
    the failed one has consumed lacks events, and is whole only when it was started again and has ended.
    """
    queries: dict[str, StreamingQuery] = {}
    errors: dict[str, Exception] = {}
    for name, consumer in consumers.items():
        try:
            queries[name] = start(spark, layout, name, consumer, max_files)
        except Exception as error:  # one query's start is not another's
            errors[name] = error
    for name, query in queries.items():
        try:
            query.awaitTermination()
        except Exception as error:  # one query's end is not another's
            errors[name] = error
    if errors:
        outcome = {name: error_text(errors[name]) if name in errors else None for name in consumers}
        raise ConsumersFailed(outcome) from next(iter(errors.values()))
    return dict.fromkeys(consumers)


def read_consumed(spark: SparkSession, layout: Layout, name: str, consumer: Consumer) -> DataFrame:
    return tables.read_table(spark, layout.path(f"consumed/{name}"), consumer.schema).select(*consumer.schema.fieldNames())
