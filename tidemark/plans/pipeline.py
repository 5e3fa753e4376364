"""End-to-end plan: raw payloads to Bronze, Silver and Gold, with validation in between."""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import keys
from tidemark.operators import admission, alerts, bronze, dlq, events, gold, runs, silver
from tidemark.operators.quality import verdict
from tidemark.sources import landing, tables


@dataclass(frozen=True)
class Dimensions:
    dataset_map: DataFrame
    indicators: DataFrame


@dataclass(frozen=True)
class Built:
    bronze: DataFrame
    rejected: DataFrame
    silver: DataFrame
    quarantined: DataFrame
    gold: DataFrame


def build(
    objects: DataFrame,
    existing_bronze: DataFrame,
    dimensions: Dimensions,
    run_at: datetime,
    code_version: str,
    parsers: Mapping[str, silver.Parser] = silver.DEFAULT_PARSERS,
    calendar_aware: bool = False,
) -> Built:
    """The whole flow as one lazy plan; nothing is materialised between stages."""
    loaded = bronze.load(objects, existing_bronze, code_version, run_at)
    all_bronze = existing_bronze.unionByName(loaded.rows)
    conformed = silver.conform(
        all_bronze, dimensions.dataset_map, dimensions.indicators, run_at, parsers
    )
    kpis = gold.kpi(gold.latest_vintage(conformed.rows), calendar_aware)
    return Built(loaded.rows, loaded.rejected, conformed.rows, conformed.quarantined, kpis)


@dataclass(frozen=True)
class Layout:
    """Table locations under one root, on storage every executor reaches."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"


def run(
    spark: SparkSession,
    raw_root: str,
    layout: Layout,
    dimensions: Dimensions,
    run_at: datetime,
    code_version: str,
    parsers: Mapping[str, silver.Parser] = silver.DEFAULT_PARSERS,
    dates: list[str] | None = None,
    incremental: bool = False,
    gate: admission.Gate | None = None,
) -> None:
    """Stored form of the flow. Each stage is written before the next reads it, which cuts the
    lineage at a durable table: losing executors repeats a stage's tasks, never the whole flow.

    With a ``gate`` every new object is a batch that the quality rules judge: only admitted ones reach
    Bronze, the others are dead letters and are not read again until they are replayed. Bronze grows by
    the new objects; Silver and Gold are rebuilt from it. A failed run can simply be run again: Bronze
    skips what it holds, the rebuilds replace their slices, and events that the failed run did not get
    to are made up for. Each run leaves a row per dataset in ``ingestion_run``, a failed one too.
    With ``incremental`` only the indicators the new objects feed are rebuilt, each of them whole;
    the others keep their slices. Use it while map and indicator dimension stay as they were, and
    follow a failed incremental run by a full one.
    """
    began = time.monotonic()
    error = None
    try:
        new_datasets = _ingest(spark, raw_root, layout, run_at, code_version, dates, gate)
        _publish(spark, layout, dimensions, run_at, parsers, new_datasets if incremental else None)
    except Exception as failure:
        error = f"{type(failure).__name__}: {str(failure).splitlines()[0] if str(failure) else ''}"
        raise
    finally:
        finished = run_at + timedelta(seconds=time.monotonic() - began)
        attempts = run_rows(spark, layout, dimensions, raw_root, run_at, finished, code_version, error)
        record_runs(spark, layout, attempts)


def _label(run_at: datetime) -> str:
    """The slice that a run appends to."""
    return f"run-{run_at:%Y%m%dT%H%M%S.%f}"


def held_keys(spark: SparkSession, layout: Layout) -> DataFrame:
    """Keys that are not to be read: in Bronze, refused by a verdict, or rejected and not replayed since."""
    stored = tables.read_table(spark, layout.path("bronze_raw_records"), schemas.BRONZE)
    judged = tables.read_table(spark, layout.path("batch_verdicts"), schemas.BATCH_VERDICT)
    replays = tables.read_table(spark, layout.path("dlq_replays"), schemas.DLQ_REPLAY)
    rejected = read_dlq(spark, layout).where("producer = 'bronze' and status = 'pending'")
    return (
        stored.select("raw_object_key")
        .unionByName(admission.refused(judged, replays))
        .unionByName(rejected.select(F.col("payload_reference").alias("raw_object_key")))
    )


def _ingest(
    spark: SparkSession,
    raw_root: str,
    layout: Layout,
    run_at: datetime,
    code_version: str,
    dates: list[str] | None,
    gate: admission.Gate | None,
) -> DataFrame:
    """New objects into Bronze; returns the datasets they belong to.

    Names are settled first; then the bytes of new objects alone are read, once, and stay where they
    are read: verdicts and admission compare ids.
    """
    under_way = layout.path("_ingest_under_way")
    if tables.exists(spark, under_way):
        announce(spark, layout, run_at)  # what an earlier run wrote but did not get to log
    manifest = tables.read_table(spark, layout.path("retrievals"), schemas.RETRIEVAL)
    names = landing.winners(landing.listed(spark, raw_root, dates), held_keys(spark, layout), manifest)
    names = tables.staged(names.withColumn("run_at", F.lit(run_at).cast("timestamp")), layout.path("run_names"))
    bronze_path = layout.path("bronze_raw_records")
    if not names.isEmpty():
        tables.mark(spark, under_way)
        fetched = landing.fetch(names.drop("run_at"))
        checked = tables.staged(bronze.verify_checksum(fetched), layout.path("bronze_checked"))
        good = checked.where("checksum_ok").drop("actual_sha256", "checksum_ok")
        if gate is not None:
            good = _admitted(spark, layout, good, names, gate, run_at)
        rows = bronze.lineage(good, code_version, run_at)
        tables.append(rows, bronze_path, ("source_id", "dataset_id"), rebalance=False)
        announce(spark, layout, run_at)
    stored = tables.read_table(spark, bronze_path, schemas.BRONZE)
    catch_up(spark, layout, stored, run_at)
    tables.unmark(spark, under_way)
    return stored.where(F.col("ingested_at") == F.lit(run_at).cast("timestamp")).select("dataset_id").distinct()


#: Ids of admitted objects that are broadcast; of more, the bytes are read again rather than shuffled.
ADMITTED_IDS = 200_000


def _admitted(
    spark: SparkSession, layout: Layout, good: DataFrame, names: DataFrame, gate: admission.Gate, run_at: datetime
) -> DataFrame:
    """Judge the objects, store verdicts and quality results, and let the validated ones through."""
    label, path = _label(run_at), layout.path("batch_verdicts")
    parsed = iter(range(len(gate.contracts)))
    results = tables.staged(
        admission.judge(good, gate, lambda p: tables.staged(p, layout.path(f"batch_records_{next(parsed)}"))),
        layout.path("batch_results"),
    )
    earlier = tables.read_table(spark, path, schemas.BATCH_VERDICT)
    judged = tables.staged(admission.verdicts(good, results, run_at, earlier), layout.path("batch_judged"))
    tables.append_slice(judged, path, label)
    outcomes = verdict.quality_results(results, "bronze_raw_records", label, run_at)
    tables.append_slice(outcomes, layout.path("data_quality_result"), label)
    let_in = admission.admitted(judged)
    if let_in.count() <= ADMITTED_IDS:
        return good.join(F.broadcast(let_in), "raw_object_key", "left_semi")
    return landing.fetch(names.drop("run_at").join(let_in, "raw_object_key", "left_semi"))


def announce(spark: SparkSession, layout: Layout, at: datetime) -> None:
    """Log the events and dead letters of the run whose names are stored, those that are not logged yet.

    Their ids follow from what they are about, so a run that died is made up for by the next one.
    """
    names_schema = T.StructType([*schemas.OBJECT_NAME.fields, T.StructField("run_at", T.TimestampType())])
    names = tables.read_table(spark, layout.path("run_names"), names_schema)
    first = names.select("run_at").first()
    if first is None:
        return
    that_run = F.lit(first.run_at.replace(tzinfo=timezone.utc)).cast("timestamp")
    wanted = names.select("raw_object_key")
    stored = tables.read_table(spark, layout.path("bronze_raw_records"), schemas.BRONZE)
    judged = tables.read_table(spark, layout.path("batch_verdicts"), schemas.BATCH_VERDICT).where(F.col("judged_at") == that_run)
    judged = judged.join(wanted, "raw_object_key", "left_semi")
    outcomes = admission.outcome_events(judged, at)
    new = (
        received_events(names, at)
        .unionByName(outcomes)
        .unionByName(written_events(stored.where(F.col("ingested_at") == that_run), at))
    )
    append_events(unlogged(spark, new, layout), layout, _label(at))
    checked = tables.read_table(spark, layout.path("bronze_checked"), CHECKED)
    rejected = bronze.checksum_rejects(checked).join(wanted, "raw_object_key", "left_semi")
    letters = rejected_entries(rejected, at).unionByName(dlq.from_quarantined(outcomes))
    append_dead_letters(spark, letters, layout, _label(at))


def catch_up(spark: SparkSession, layout: Layout, stored: DataFrame, at: datetime) -> None:
    """Log Bronze rows that no run announced. Every logged id is a Bronze row's, so equal counts settle it;
    only when they differ are the ids compared."""
    logged = read_events(spark, layout).where("event_type = 'bronze_data.written'").select("event_id").distinct()
    if logged.count() != stored.count():
        append_events(unlogged(spark, written_events(stored, at), layout), layout, _label(at))


CHECKED = T.StructType(
    [
        *schemas.OBJECT_NAME.fields,
        T.StructField("payload", T.BinaryType()),
        T.StructField("actual_sha256", T.StringType()),
        T.StructField("checksum_ok", T.BooleanType()),
    ]
)


def _publish(
    spark: SparkSession,
    layout: Layout,
    dimensions: Dimensions,
    run_at: datetime,
    parsers: Mapping[str, silver.Parser],
    new_datasets: DataFrame | None,
) -> None:
    """Silver and Gold from Bronze: all of it, or the indicators that ``new_datasets`` feed."""
    silver_path, label = layout.path("fact_economic_observation"), _label(run_at)
    all_bronze = tables.read_table(spark, layout.path("bronze_raw_records"), schemas.BRONZE)
    dataset_map, incremental = dimensions.dataset_map, new_datasets is not None
    if incremental:
        dataset_map = fed_by(dataset_map, new_datasets)
    conformed = silver.conform(all_bronze, dataset_map, dimensions.indicators, run_at, parsers)
    tables.replace(conformed.rows, silver_path, "indicator_id", incremental)
    tables.replace(conformed.quarantined, layout.path("silver_quarantine"), "dataset_id", incremental)
    stored = read_observations(spark, layout)
    if incremental:
        stored = stored.join(dataset_map.select("indicator_id").distinct(), "indicator_id", "left_semi")
    append_events(stage_events(stored, "silver_data.transformed", "silver", run_at), layout, label)

    tables.replace(gold.kpi(gold.latest_vintage(stored)), layout.path("fact_economic_kpi"), "indicator_id", incremental)
    kpis = read_kpis(spark, layout)
    if incremental:
        kpis = kpis.join(dataset_map.select("indicator_id").distinct(), "indicator_id", "left_semi")
    append_events(stage_events(kpis, "gold_data.published", "gold", run_at), layout, label)
    append_events(stage_events(kpis, "data_product.ready", "gold", run_at), layout, label)


def run_rows(
    spark: SparkSession,
    layout: Layout,
    dimensions: Dimensions,
    raw_root: str,
    started_at: datetime,
    finished_at: datetime,
    code_version: str,
    error: str | None,
) -> DataFrame:
    """One ingestion-run row per dataset that had new objects; after an error, a failed one.

    An error before the names are known fails every mapped dataset. Without one, a dataset whose objects
    were all refused is quarantined and one with some refused is partial.
    """
    names_schema = T.StructType([*schemas.OBJECT_NAME.fields, T.StructField("run_at", T.TimestampType())])
    that_run = F.lit(started_at).cast("timestamp")
    names = tables.read_table(spark, layout.path("run_names"), names_schema).where(F.col("run_at") == that_run)
    per_dataset = names.groupBy("dataset_id").agg(F.count("*").alias("objects"))
    if error is not None and per_dataset.isEmpty():
        per_dataset = dimensions.dataset_map.select("dataset_id", F.lit(0).alias("objects")).distinct()
    stored = tables.read_table(spark, layout.path("bronze_raw_records"), schemas.BRONZE)
    loaded = stored.where(F.col("ingested_at") == that_run).groupBy("dataset_id").agg(F.count("*").alias("loaded"))
    status = (
        F.when(F.lit(error is not None), "failed")
        .when(F.coalesce("loaded", F.lit(0)) == 0, "quarantined")
        .when(F.col("loaded") < F.col("objects"), "partial")
        .otherwise("success")
    )
    return per_dataset.join(loaded, "dataset_id", "left").select(
        runs.run_id("dataset_id", that_run).alias("run_id"),
        "dataset_id",
        F.lit(code_version).alias("connector_version"),
        that_run.alias("started_at"),
        F.lit(finished_at).cast("timestamp").alias("finished_at"),
        status.alias("status"),
        keys.request_hash(F.lit(raw_root), "dataset_id").alias("request_hash"),
        F.lit(0).alias("retry_count"),
        F.lit(raw_root).alias("raw_storage_path"),
        F.lit(error).cast("string").alias("error"),
    )


def record_runs(spark: SparkSession, layout: Layout, attempts: DataFrame) -> None:
    """Append run rows, then the alerts that the whole history now gives, each once."""
    tables.append(attempts.select(*schemas.INGESTION_RUN.fieldNames()), layout.path("ingestion_run"))
    found = alerts.consecutive_failure_alerts(read_runs(spark, layout))
    results = tables.read_table(spark, layout.path("data_quality_result"), schemas.QUALITY_RESULT)
    newest = tables.latest_by_key(results, schemas.QUALITY_RESULT_KEY, ("evaluated_at",))
    insert_alerts(spark, layout, found.unionByName(alerts.quality_alerts(newest)))


def insert_alerts(spark: SparkSession, layout: Layout, found: DataFrame) -> None:
    """First wins: an alert about the same condition is stored once, however often it is found."""
    stored = tables.read_table(spark, layout.path("alerts"), schemas.ALERT)
    fresh = tables.insert_absent(found, stored, ("alert_id",), ("message",))
    tables.append(fresh.select(*schemas.ALERT.fieldNames()), layout.path("alerts"))


def read_runs(spark: SparkSession, layout: Layout) -> DataFrame:
    return tables.read_table(spark, layout.path("ingestion_run"), schemas.INGESTION_RUN)


def read_alerts(spark: SparkSession, layout: Layout) -> DataFrame:
    return tables.read_table(spark, layout.path("alerts"), schemas.ALERT)


def fed_by(dataset_map: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Map rows of every indicator that at least one new object feeds, with all its datasets."""
    touched = dataset_map.join(new_rows.select("dataset_id").distinct(), "dataset_id", "left_semi")
    return dataset_map.join(touched.select("indicator_id").distinct(), "indicator_id", "left_semi")


def read_observations(spark: SparkSession, layout: Layout) -> DataFrame:
    return tables.read_replaced(spark, layout.path("fact_economic_observation"), schemas.STORED_OBSERVATION)


def read_kpis(spark: SparkSession, layout: Layout) -> DataFrame:
    return tables.read_replaced(spark, layout.path("fact_economic_kpi"), schemas.KPI)


def stage_events(table: DataFrame, event_type: str, producer: str, run_at: datetime) -> DataFrame:
    """One event per indicator a stage produced, with its row count."""
    per_indicator = table.groupBy("indicator_id").agg(F.count("*").alias("rows"))
    return events.emit(
        per_indicator, event_type, producer, run_at, dataset_id="indicator_id", metadata=F.struct("rows")
    )


def append_events(new: DataFrame, layout: Layout, label: str) -> None:
    """The log is written in slices by batch runs and streaming queries alike, so readers see all of it."""
    tables.append_slice(new.select(*events.COLUMNS), layout.path("event_log"), label)


def read_events(spark: SparkSession, layout: Layout) -> DataFrame:
    return tables.read_table(spark, layout.path("event_log"), schemas.EVENT)


def received_events(names: DataFrame, at: datetime) -> DataFrame:
    """One event per new object."""
    return events.emit(
        names,
        "raw_data.received",
        "landing",
        at,
        payload_reference=F.col("raw_object_key"),
        metadata=F.struct("length"),
        event_id=keys.derived_id(F.lit("landed"), "raw_object_key"),
    )


def written_events(rows: DataFrame, run_at: datetime) -> DataFrame:
    """One event per Bronze row; its id follows from the row, not from the run."""
    return events.emit(
        rows,
        "bronze_data.written",
        "bronze",
        run_at,
        payload_reference=F.col("raw_object_key"),
        metadata=F.struct("bronze_id"),
        event_id=keys.derived_id(F.lit("bronze_data.written"), "bronze_id"),
    )


def unlogged(spark: SparkSession, new: DataFrame, layout: Layout) -> DataFrame:
    """Events that the log does not hold yet, so a run that died before logging is made up for."""
    log = read_events(spark, layout)
    return new.join(log.select("event_id"), "event_id", "left_anti").select(*events.COLUMNS)


def rejected_entries(rejected: DataFrame, run_at: datetime) -> DataFrame:
    """Dead-letter entries of objects that failed the checksum gate, one per object and reason."""
    failed = events.emit(
        rejected,
        "raw_data.received",
        "bronze",
        run_at,
        payload_reference=F.col("raw_object_key"),
        metadata=F.struct("reason"),
        event_id=keys.derived_id(F.lit("raw_data.received"), "raw_object_key", "reason"),
    )
    reason = F.from_json("metadata", "struct<reason: string>").reason
    return dlq.from_failures(failed, F.lit("IntegrityError"), reason)


def append_dead_letters(spark: SparkSession, entries: DataFrame, layout: Layout, label: str) -> None:
    path = layout.path("dlq")
    existing = tables.read_table(spark, path, schemas.DLQ)
    tables.append_slice(dlq.to_insert(entries, existing), path, label)


def read_dlq(spark: SparkSession, layout: Layout) -> DataFrame:
    entries = tables.read_table(spark, layout.path("dlq"), schemas.DLQ).select(*dlq.COLUMNS)
    entries = tables.first_by_key(entries, ("event_id",), ("quarantined_at",))
    replays = tables.read_table(spark, layout.path("dlq_replays"), schemas.DLQ_REPLAY)
    return dlq.current(entries, replays)


def replay_pending(spark: SparkSession, layout: Layout, at: datetime) -> None:
    """Publish every pending entry again. The events are appended before the state change, and
    their ids follow from the entry, so a crash in between repeats events but never loses one."""
    published, changes = dlq.replay(read_dlq(spark, layout), at)
    label = f"replay-{at:%Y%m%dT%H%M%S.%f}"
    append_events(published, layout, label)
    tables.append_slice(changes, layout.path("dlq_replays"), label)


def differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows in only one of two builds; a repeated build of the same input gives none."""
    columns = before.columns
    return (
        before.exceptAll(after.select(*columns))
        .withColumn("only_in", F.lit("before"))
        .unionByName(after.select(*columns).exceptAll(before).withColumn("only_in", F.lit("after")))
    )
