"""Streaming operators over several micro-batches, and with micro-batches tried again."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.test_operations import run_rows
from tests.test_quality import BASE, CONTRACT
from tests.conftest import SF
from tidemark.plans import catalogue
from tidemark import schemas
from tidemark.operators import alerts as batch_alerts
from tidemark.plans.pipeline import Layout
from tidemark.sources import landing, tables
from tidemark.streaming import alerts, ingest, validate

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def payloads(spark, *bodies):
    rows = [("fred", "d", T0, bytearray(b)) for b in bodies]
    schema = "source_id string, dataset_id string, retrieved_at timestamp, payload binary"
    return landing.address(spark.createDataFrame(rows, schema))


def test_files_reach_bronze_once(spark, tmp_path):
    root, bronze, rejected = (str(tmp_path / n) for n in ("in", "bronze", "rejected"))

    def go(checkpoint):
        stream = ingest.object_files(spark, root, max_files=1)
        ingest.to_bronze(stream, bronze, rejected, "1", str(tmp_path / checkpoint), checkpoint).awaitTermination()
        return tables.read_table(spark, bronze, schemas.BRONZE)

    landing.land_files(payloads(spark, b"1", b"2", b"3"), (tmp_path / "in").as_uri())
    assert go("c1").count() == 3
    landing.land_files(payloads(spark, b"3", b"4"), (tmp_path / "in").as_uri())
    forged = tmp_path / "in" / "raw/fred/d/date=2024-01-01" / ("0" * 64 + ".json")
    forged.write_bytes(b"x")
    assert go("c1").count() == 4
    # another checkpoint reads everything again and adds nothing
    stored = go("c2")
    assert stored.count() == 4 and stored.select("bronze_id").distinct().count() == 4
    reasons = spark.read.parquet(rejected)
    assert reasons.where("reason like 'Checksum mismatch%'").count() == 2


def test_repeated_batch_replaces_its_slice(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        tables.write_batch(spark.range(3), path, "q", 0)
    tables.write_batch(spark.range(2), path, "q", 1)
    schema = spark.range(1).schema
    assert tables.read_table(spark, path, schema).count() == 5
    assert tables.other_batches(spark, path, schema, "q", 1).count() == 3


@pytest.mark.parametrize("snapshot_every", [2, 100])
def test_streaks_across_batches(spark, tmp_path, snapshot_every):
    histories = {"two": "FF", "healed": "FFSF", "long": "SFFF", "apart": "FSFS", "late": "SSSF"}
    runs = run_rows(spark, **histories)
    source, layout = str(tmp_path / "runs"), Layout(str(tmp_path / "out"))

    def go():
        stream = spark.readStream.schema(schemas.INGESTION_RUN).parquet(source)
        alerts.failure_streaks(
            stream,
            layout.path("state"),
            layout.path("alerts"),
            layout.path("checkpoint"),
            "streaks",
            snapshot_every=snapshot_every,
        ).awaitTermination()

    for n in range(1, 5):
        runs.where(F.col("run_id") == f"run-{n}").write.mode("append").parquet(source)
        go()
    found = {
        (json.loads(r.details)["latest_run_id"], r.dataset_id, json.loads(r.details)["consecutive_failures"])
        for r in alerts.read_alerts(spark, layout.path("alerts")).collect()
    }
    assert found == {("run-2", "two", 2), ("run-2", "healed", 2), ("run-3", "long", 2), ("run-4", "long", 3)}
    streaks = {r.dataset_id: r.consecutive_failures for r in alerts.read_streaks(spark, layout.path("state")).collect()}
    want = {r.dataset_id: r.consecutive_failures for r in batch_alerts.failure_streaks(runs).collect()}
    assert streaks == want


def test_streaks_in_any_order_and_delivered_twice(spark, tmp_path):
    runs = run_rows(spark, two="FF", healed="FFSF", long="SFFF", apart="FSFS", late="SSSF")
    source, layout = str(tmp_path / "runs"), Layout(str(tmp_path / "out"))
    for n in (3, 1, 4, 3, 2, 1):
        runs.where(F.col("run_id") == f"run-{n}").write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.INGESTION_RUN).parquet(source)
        alerts.failure_streaks(
            stream, layout.path("state"), layout.path("alerts"), layout.path("c"), "s", snapshot_every=2
        ).awaitTermination()
    want = sorted(map(tuple, batch_alerts.failure_streaks(runs).collect()))
    assert sorted(map(tuple, alerts.read_streaks(spark, layout.path("state")).collect())) == want
    standing = alerts.standing_alerts(spark, layout.path("state"), layout.path("alerts")).collect()
    assert sorted(r.message for r in standing) == ["long failed 3 times in a row", "two failed 2 times in a row"]


def test_batches_split_over_triggers_are_judged_whole(spark, tmp_path):
    """A key repeated in another trigger, and one file or several per trigger, give the same verdicts."""
    schema = "batch_id string, line string"
    parts = [("twice", BASE), ("once", BASE), ("twice", BASE), ("twice", {**BASE, "series_id": "other"})]
    found = []
    for label, max_files in (("one", 1), ("all", 100)):
        source, layout = str(tmp_path / label), Layout(str(tmp_path / f"{label}-out"))
        for batch, record in parts:
            spark.createDataFrame([(batch, json.dumps(record))], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
        validate.validate_and_route(stream, CONTRACT, layout, layout.path("c"), "v").awaitTermination()
        found.append(sorted((r.correlation_id, r.event_type) for r in validate.read_outcomes(spark, layout).collect()))
        assert [r.correlation_id for r in validate.read_quarantined(spark, layout).collect()] == ["twice"]
        assert validate.read_routed(spark, layout, stream.schema, "quarantined").count() == 3
    assert found[0] == found[1] == [("once", "raw_data.validated"), ("twice", "raw_data.quarantined")]


def test_validate_and_route(spark, tmp_path):
    source, layout = str(tmp_path / "lines"), Layout(str(tmp_path / "out"))
    schema = "batch_id string, line string"
    for batch, record in (("good", BASE), ("bad", {**BASE, "value": "-1"}), ("odd", {"x": 1})):
        spark.createDataFrame([(batch, json.dumps(record))], schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        validate.validate_and_route(stream, CONTRACT, layout, layout.path("c"), "v").awaitTermination()
    ok = validate.read_routed(spark, layout, stream.schema, "validated")
    bad = validate.read_routed(spark, layout, stream.schema, "quarantined")
    assert [r.batch_id for r in ok.collect()] == ["good"]
    assert sorted(r.batch_id for r in bad.collect()) == ["bad", "odd"]
    dead = tables.read_table(spark, layout.path("dlq"), schemas.DLQ)
    reasons = {r.correlation_id: r.failure_reason for r in dead.collect()}
    assert reasons == {
        "bad": "data-quality rule(s) failed: FR-QUAL-005",
        "odd": "data-quality rule(s) failed: FR-QUAL-001",
    }
    log = tables.read_table(spark, layout.path("event_log"), schemas.EVENT)
    assert {r.event_type for r in log.collect()} == {"raw_data.validated", "raw_data.quarantined"}


def test_windows_and_dedupe(spark, tmp_path):
    source = str(tmp_path / "events")
    schema = "id long, kind string, ts timestamp"

    def add(*rows):
        full = [(i, k, T0 + timedelta(minutes=m)) for i, k, m in rows]
        spark.createDataFrame(full, schema).coalesce(1).write.mode("append").parquet(source)

    def go(name):
        stream = spark.readStream.schema(schema).parquet(source)
        if name == "counts":
            out = alerts.event_counts(stream, "ts", ["kind"], "1 hour", "10 minutes")
        else:
            out = ingest.deduplicate(stream, ["id"], "ts", "1 day")
        alerts.append_windows(out, str(tmp_path / name), str(tmp_path / f"{name}-c"), name).awaitTermination()
        return spark.read.schema(out.schema).parquet(str(tmp_path / name))

    add((1, "a", 5), (1, "a", 6), (2, "b", 50))
    assert go("dedupe").count() == 2 and go("counts").count() == 0
    add((2, "b", 51), (3, "a", 90))
    assert go("dedupe").count() == 3
    counts = {(r.window_start.hour, r.kind): r.events for r in go("counts").collect()}
    assert counts == {(0, "a"): 2, (0, "b"): 2}


def test_streamed_tables_of_many_files_read_whole(spark, tmp_path):
    """A table given as one file or as a directory of part files gives the same rows."""
    source = spark.read.parquet(f"{SF}/events.parquet")
    source.repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("stream_event_counts", "stream_deduplicate"):
        one, many = (catalogue.ENTRIES[name](spark, d) for d in (SF, str(tmp_path)))
        assert one.count() > 0
        assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    counted = catalogue.ENTRIES["stream_event_counts"](spark, str(tmp_path)).agg(F.sum("events")).first()[0]
    assert counted == source.count()
