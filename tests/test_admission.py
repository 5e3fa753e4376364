"""The gate between landing and Bronze, keys-first ingest, the retrieval manifest, pointer tables and run records."""

import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.test_layers import INITIAL, REVISION, at, objects, payload
from tidemark import schemas
from tidemark.contracts import DataContract
from tidemark.operators import admission, alerts, silver
from tidemark.plans import pipeline
from tidemark.sources import landing, seeds, tables

CONTRACT = DataContract.from_mapping(
    {
        "dataset": "fred",
        "owner": "o",
        "source": "fred",
        "version": "1",
        "primary_key": ["series_id", "observed_at", "realtime_start"],
        "schema": {
            "observed_at": "timestamp_utc",
            "value": "decimal(28,8)",
            "source_id": "string",
            "series_id": "string",
            "realtime_start": "date",
            "realtime_end": "date",
        },
        "quality_rules": ["value_positive"],
        "metadata": {"units": "index", "seasonal_adjustment": "sa"},
    }
)
GATE = admission.Gate({"fred": CONTRACT}, silver.DEFAULT_PARSERS)
NEGATIVE = payload(("2024-02-01", "-4", "2024-03-01"))
BROKEN = b'{"observations": ['


@pytest.fixture
def dims(spark):
    _, indicators, dataset_map = seeds.starter_frames(spark)
    return pipeline.Dimensions(dataset_map, indicators)


def day(n):
    return datetime(2030, 1, n, tzinfo=timezone.utc)


@pytest.fixture
def place(spark, dims, tmp_path):
    class Place:
        root, layout = str(tmp_path / "in"), pipeline.Layout(str(tmp_path / "tables"))

        def land(self, *items):
            landing.land_files(objects(spark, *items), (tmp_path / "in").as_uri())

        def run(self, n, **kw):
            pipeline.run(spark, self.root, self.layout, dims, day(n), "1", **{"gate": GATE, **kw})

        def events(self):
            rows = pipeline.read_events(spark, self.layout).groupBy("event_type").count().collect()
            return {r.event_type.partition(".")[2] if "raw" in r.event_type else r.event_type: r["count"] for r in rows}

        def pending(self):
            return {r.payload_reference: r.failure_reason for r in pipeline.read_dlq(spark, self.layout).where("status = 'pending'").collect()}

    return Place()


def test_only_admitted_batches_reach_bronze(spark, place):
    place.land((INITIAL, "2024-02-01T09:00"), (NEGATIVE, "2024-03-01T09:00"), (BROKEN, "2024-03-02T09:00"))
    place.run(1)
    bronze = tables.read_table(spark, place.layout.path("bronze_raw_records"), schemas.BRONZE)
    assert [bytes(r.payload) for r in bronze.collect()] == [INITIAL]
    assert pipeline.read_observations(spark, place.layout).count() == 3
    stages = {"received": 3, "validated": 1, "quarantined": 2, "bronze_data.written": 1}
    stages |= dict.fromkeys(("silver_data.transformed", "gold_data.published", "data_product.ready"), 1)
    assert place.events() == stages
    assert sorted(place.pending().values()) == ["data-quality rule(s) failed: FR-QUAL-001", "data-quality rule(s) failed: FR-QUAL-005"]
    results = tables.read_table(spark, place.layout.path("data_quality_result"), schemas.QUALITY_RESULT)
    assert {r.test_id: (r.status, r.failed_rows) for r in results.collect()}["FR-QUAL-005"] == ("fail", 1)
    runs = pipeline.read_runs(spark, place.layout).collect()
    assert [(r.dataset_id, r.status) for r in runs] == [("fred_cpiaucsl", "partial")]
    # nothing is read, judged or logged again
    place.run(2)
    assert place.events() == {k: n * (2 if k.startswith(("silver", "gold", "data_product")) else 1) for k, n in stages.items()}
    assert len(place.pending()) == 2 and pipeline.read_runs(spark, place.layout).count() == 1


def test_a_replayed_batch_is_judged_again_and_each_failure_is_an_entry(spark, place):
    place.land((NEGATIVE, "2024-03-01T09:00"))
    place.run(1)
    [key] = place.pending()
    pipeline.replay_pending(spark, place.layout, day(2))
    assert not place.pending()
    place.run(3)
    assert list(place.pending()) == [key] and place.events()["quarantined"] == 2
    pipeline.replay_pending(spark, place.layout, day(4))
    lenient = admission.Gate({"fred": DataContract.from_mapping({**_raw(CONTRACT), "quality_rules": []})}, silver.DEFAULT_PARSERS)
    place.run(5, gate=lenient)
    assert not place.pending() and place.events()["bronze_data.written"] == 1


def _raw(contract):
    return {
        "dataset": contract.dataset, "owner": contract.owner, "source": contract.source, "version": contract.version,
        "primary_key": list(contract.primary_key), "schema": dict(contract.schema), "metadata": dict(contract.metadata),
    }


def test_a_source_without_contract_is_held_back(spark, place):
    place.land((INITIAL, "2024-02-01T09:00"))
    place.run(1, gate=admission.Gate({}, {}))
    assert list(place.pending().values()) == ["raw_data.quarantined"]
    assert pipeline.read_observations(spark, place.layout).count() == 0


def test_empty_landing_zone_and_missing_marker(spark, place):
    place.land((payload(("2024-01-01", ".", "2024-02-01"), ("2024-02-01", "3", "2024-03-01")), "2024-03-01T09:00"))
    place.run(1)
    assert not place.pending() and pipeline.read_observations(spark, place.layout).count() == 1
    place.run(2)
    assert pipeline.read_observations(spark, place.layout).count() == 1


def test_a_run_that_dies_after_bronze_is_made_up_for(spark, place, monkeypatch):
    place.land((INITIAL, "2024-02-01T09:00"), (NEGATIVE, "2024-03-01T09:00"))
    real = tables.append

    def dies(df, path, *a, **kw):
        real(df, path, *a, **kw)
        if path.endswith("bronze_raw_records"):
            raise RuntimeError("killed")

    monkeypatch.setattr(tables, "append", dies)
    with pytest.raises(RuntimeError):
        place.run(1)
    monkeypatch.setattr(tables, "append", real)
    assert {(r.status, r.error) for r in pipeline.read_runs(spark, place.layout).collect()} == {("failed", "RuntimeError: killed")}
    place.run(2)
    events = place.events()
    assert (events["received"], events["validated"], events["quarantined"], events["bronze_data.written"]) == (2, 1, 1, 1)
    assert len(place.pending()) == 1 and pipeline.read_observations(spark, place.layout).count() == 3


def test_failed_runs_raise_one_alert(spark, place, monkeypatch):
    place.land((INITIAL, "2024-02-01T09:00"))
    monkeypatch.setattr(landing, "listed", lambda *a, **k: 1 / 0)
    for n in (1, 2, 3):
        with pytest.raises(ZeroDivisionError):
            place.run(n)
    stored = pipeline.read_alerts(spark, place.layout).where(F.col("alert_type") == alerts.CONSECUTIVE_FAILURES).collect()
    assert len(stored) == 2 and {json.loads(r.details)["consecutive_failures"] for r in stored} == {2, 3}
    pipeline.record_runs(spark, place.layout, pipeline.read_runs(spark, place.layout).limit(0))
    assert pipeline.read_alerts(spark, place.layout).count() == 2


# --- keys first -----------------------------------------------------------------------------------


def test_no_payload_is_shuffled_and_old_files_stay_shut(spark, place, tmp_path, monkeypatch):
    place.land((INITIAL, "2024-02-01T09:00"), (REVISION, "2024-03-01T09:00"))
    names = landing.winners(landing.listed(spark, place.root), spark.createDataFrame([], "raw_object_key string"))
    plan = landing.fetch(names)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan
    for line in plan.splitlines():
        assert not ("Exchange" in line or "Sort" in line) or "payload" not in line
    place.run(1)
    # files that Bronze holds can be gone: the next run lists names and opens new files only
    for folder, _, files in os.walk(place.root):
        for name in files:
            with open(os.path.join(folder, name), "wb") as f:
                f.write(b"changed under an old name")
    third = payload(("2024-04-01", "9", "2024-05-01"))
    place.land((third, "2024-05-01T09:00"))
    place.run(2)
    stored = tables.read_table(spark, place.layout.path("bronze_raw_records"), schemas.BRONZE)
    assert {bytes(r.payload) for r in stored.collect()} == {INITIAL, REVISION, third}
    checked = spark.read.parquet(place.layout.path("bronze_checked"))
    assert checked.count() == 1 and not place.pending()


def test_a_file_that_vanishes_is_rejected(spark, place):
    place.land((INITIAL, "2024-02-01T09:00"))
    names = landing.listed(spark, place.root).withColumn("path", F.concat("path", F.lit("x")))
    assert [r.payload for r in landing.fetch(names).collect()] == [None]


def test_fetch_splits_large_batches(spark, place, monkeypatch):
    monkeypatch.setattr(landing, "BATCH_BYTES", 100)
    place.land(*((payload((f"2024-{m:02d}-01", "1", "2024-12-01")), f"2024-{m:02d}-02T00:00") for m in range(1, 10)))
    got = landing.fetch(landing.listed(spark, place.root)).select("raw_sha256", F.sha2("payload", 256).alias("is")).collect()
    assert len(got) == 9 and all(r.raw_sha256 == r["is"] for r in got)


def test_copying_the_landing_zone_changes_no_silver_row(spark, dims, tmp_path):
    import shutil

    root = tmp_path / "in"
    layout = pipeline.Layout(str(tmp_path / "a"))
    rows = objects(spark, (INITIAL, "2024-02-01T09:00"), (REVISION, "2024-03-01T09:00"))
    landing.land(rows, root.as_uri(), layout.path("retrievals"), "first")
    landing.land(rows.withColumn("retrieved_at", F.lit(day(9))), root.as_uri(), layout.path("retrievals"), "again")
    pipeline.run(spark, str(root), layout, dims, day(1), "1")
    shutil.copytree(root, tmp_path / "copy", copy_function=shutil.copyfile)
    other = pipeline.Layout(str(tmp_path / "b"))
    shutil.copytree(layout.path("retrievals"), other.path("retrievals"))
    pipeline.run(spark, str(tmp_path / "copy"), other, dims, day(1), "1")
    first, second = (sorted(pipeline.read_observations(spark, x).collect()) for x in (layout, other))
    assert first == second and {str(r.retrieved_at)[:10] for r in first} == {"2024-02-01", "2024-03-01"}


# --- pointer tables -------------------------------------------------------------------------------

ROWS = "k string, v int"


def test_a_replacement_that_dies_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    schema = spark.createDataFrame([], ROWS).schema
    assert tables.read_replaced(spark, path, schema).count() == 0
    tables.replace(spark.createDataFrame([("a", 1), ("b", 2)], ROWS), path, "k")
    monkeypatch.setattr(tables, "_point", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        tables.replace(spark.createDataFrame([("a", 9)], ROWS), path, "k")
    monkeypatch.undo()
    assert sorted(map(tuple, tables.read_replaced(spark, path, schema).select("k", "v").collect())) == [("a", 1), ("b", 2)]
    tables.replace(spark.createDataFrame([("c", 3)], ROWS), path, "k")
    assert [tuple(r) for r in tables.read_replaced(spark, path, schema).select("k", "v").collect()] == [("c", 3)]
    assert len(list((tmp_path / "t").glob("version=*"))) == 2  # this one and the one before


def test_slices_are_replaced_one_by_one(spark, tmp_path):
    path, schema = str(tmp_path / "t"), spark.createDataFrame([], ROWS).schema

    def rows():
        return sorted(map(tuple, tables.read_replaced(spark, path, schema).select("k", "v").collect()))

    tables.replace(spark.createDataFrame([("a", 1), ("b", 2)], ROWS), path, "k")
    for n in (5, 6):
        tables.replace(spark.createDataFrame([("b", n), ("d e", n)], ROWS), path, "k", slices_only=True)
        assert rows() == [("a", 1), ("b", n), ("d e", n)]
    tables.replace(spark.createDataFrame([], ROWS), path, "k", slices_only=True)
    assert len(rows()) == 3
    tables.replace(spark.createDataFrame([], ROWS), path, "k")
    assert rows() == []
    plan = tables.read_replaced(spark, path, schema).where("k = 'a'")
    assert plan.count() == 0
