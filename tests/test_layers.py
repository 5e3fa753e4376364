"""Raw objects to Gold on small payloads with hand-checked values."""

import json
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import bronze, gold, serve, silver
from tidemark.operators.quality import assertions
from tidemark.plans import pipeline
from tidemark.sources import export, landing, seeds, tables

RUN_AT = datetime(2024, 4, 1, tzinfo=timezone.utc)


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def payload(*observations):
    keys = ("date", "value", "realtime_start")
    return json.dumps({"observations": [dict(zip(keys, o, strict=True)) for o in observations]}).encode()


INITIAL = payload(
    ("2023-11-01", "307.671", "2024-02-01"),
    ("2023-12-01", "306.746", "2024-02-01"),
    ("2024-01-01", "308.417", "2024-02-01"),
)
REVISION = payload(("2023-11-01", "307.900", "2024-03-01"))


def objects(spark, *items):
    rows = [("fred", "fred_cpiaucsl", at(when), bytearray(body)) for body, when in items]
    schema = "source_id string, dataset_id string, retrieved_at timestamp, payload binary"
    return landing.address(spark.createDataFrame(rows, schema))


@pytest.fixture
def dims(spark):
    _, indicators, dataset_map = seeds.starter_frames(spark)
    return pipeline.Dimensions(dataset_map, indicators)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], schemas.BRONZE)


def build(spark, dims, empty, *items, **kw):
    return pipeline.build(objects(spark, *items), empty, dims, RUN_AT, "1.0.0", **kw)


def test_initial_then_revision(spark, dims, empty):
    first = (INITIAL, "2024-02-01T09:00")
    assert build(spark, dims, empty, first).silver.count() == 3
    both = build(spark, dims, empty, first, first, (REVISION, "2024-03-01T09:00"))
    rows = both.silver.orderBy("period", "vintage_date").collect()
    assert [(r.period, r.vintage_date) for r in rows] == [
        ("2023-11", date(2024, 2, 1)),
        ("2023-11", date(2024, 3, 1)),
        ("2023-12", date(2024, 2, 1)),
        ("2024-01", date(2024, 2, 1)),
    ]
    kpis = {r.period: r for r in both.gold.collect()}
    assert kpis["2023-11"].value == Decimal("307.90000000")
    assert kpis["2023-11"].mom_pct_change is None
    assert kpis["2023-12"].mom_pct_change == round((306.746 - 307.9) / 307.9 * 100, 4)
    assert serve.as_of(both.silver, date(2024, 2, 15)).where("period = '2023-11'").first().value == Decimal(
        "307.67100000"
    )


def test_silver_columns_and_times(spark, dims, empty):
    row = build(spark, dims, empty, (INITIAL, "2024-02-01T09:00")).silver.where("period = '2024-01'").first()
    assert (row.period_start, row.period_end) == (date(2024, 1, 1), date(2024, 1, 31))
    assert row.published_at is None
    assert row.retrieved_at == datetime(2024, 2, 1, 9) and row.processed_at == datetime(2024, 4, 1)
    assert (row.unit, row.seasonal_adjustment) == ("index_1982_84_100", "sa")


def test_values_that_are_not_numbers(spark, dims, empty):
    body = payload(
        ("2024-01-01", ".", "2024-02-01"),
        ("2024-02-01", None, "2024-02-01"),
        ("2024-03-01", "n/a", "2024-02-01"),
        ("2024-04-01", "123456789012345678901", "2024-02-01"),
        ("2024-05-01", " 12 ", "2024-02-01"),
        ("2024-06-01", "1e3", "2024-02-01"),
        ("2024-07-01", "1", "soon"),
        ("later", "1", "2024-02-01"),
        ("2024-08-01", "1", None),
    )
    built = build(spark, dims, empty, (body, "2024-02-01T09:00"))
    values = {r.period: r.value for r in built.silver.collect()}
    assert values == {"2024-05": Decimal("12.00000000"), "2024-06": Decimal("1000.00000000")}
    held = {(r.date_text, r.vintage_text): r.reason for r in built.quarantined.collect()}
    assert held == {
        ("2024-07-01", "soon"): "unreadable vintage date",
        ("later", "2024-02-01"): "unreadable observation date",
        ("2024-08-01", None): "unreadable vintage date",
    }


@pytest.mark.parametrize(
    ("body", "reason"),
    [
        (b"{}", "payload has no array observations"),
        (b"not json", "payload is not JSON"),
        (b"[]", "payload has no array observations"),
        (b'{"observations": null}', "payload has no array observations"),
        (b"", "payload is not JSON"),
        (b'{"observations": []}', None),
    ],
)
def test_payload_without_observations(spark, dims, empty, body, reason):
    built = build(spark, dims, empty, (body, "2024-02-01T09:00"))
    assert built.silver.count() == 0
    assert [r.reason for r in built.quarantined.collect()] == ([reason] if reason else [])


def test_sources_without_parser_are_held_back(spark, dims, empty):
    held = build(spark, dims, empty, (INITIAL, "2024-02-01T09:00"), parsers={"other": silver.OBSERVATIONS_PARSER})
    assert held.silver.count() == 0
    assert [r.reason for r in held.quarantined.collect()] == ["no parser for source fred"]


def test_events_lost_in_a_crash_are_made_up_for(spark, dims, tmp_path):
    landing.land_files(objects(spark, (INITIAL, "2024-02-01T09:00")), (tmp_path / "in").as_uri())
    layout = pipeline.Layout(str(tmp_path / "tables"))
    fresh = bronze.load(
        landing.read_landed(spark, str(tmp_path / "in")), spark.createDataFrame([], schemas.BRONZE), "1", RUN_AT
    )
    tables.append(fresh.rows, layout.path("bronze_raw_records"), ("source_id", "dataset_id"))  # died before logging
    for day in (1, 2):
        pipeline.run(spark, str(tmp_path / "in"), layout, dims, datetime(2030, 1, day, tzinfo=timezone.utc), "1")
    log = tables.read_table(spark, layout.path("event_log"), schemas.EVENT)
    assert log.where("event_type = 'bronze_data.written'").count() == 1


def test_numbers_and_text_read_alike(spark, dims, empty):
    body = b'{"observations": [{"date": "2024-01-01", "value": 1.50, "realtime_start": "2024-02-01"}]}'
    assert build(spark, dims, empty, (body, "2024-02-01T09:00")).silver.first().value == Decimal("1.50000000")


def test_newest_retrieval_wins_and_repeats_fan_out(spark, dims, empty):
    old = payload(("2024-01-01", "1", "2024-02-01"))
    new = payload(("2024-01-01", "2", "2024-02-01"))
    built = build(spark, dims, empty, (new, "2024-02-03T00:00"), (old, "2024-02-02T00:00"))
    assert [r.value for r in built.silver.collect()] == [Decimal("2.00000000")]
    twice = pipeline.Dimensions(
        dims.dataset_map.unionByName(dims.dataset_map.withColumn("geo_code", F.lit("XX"))), dims.indicators
    )
    assert build(spark, twice, empty, (new, "2024-02-03T00:00")).silver.count() == 2


def test_unmapped_and_unknown_are_dropped(spark, dims, empty):
    none = pipeline.Dimensions(dims.dataset_map.where("false"), dims.indicators)
    assert build(spark, none, empty, (INITIAL, "2024-02-01T09:00")).silver.count() == 0
    unknown = pipeline.Dimensions(dims.dataset_map, dims.indicators.where("false"))
    assert build(spark, unknown, empty, (INITIAL, "2024-02-01T09:00")).silver.count() == 0


def test_bronze_is_idempotent_and_checksummed(spark, empty):
    batch = objects(spark, (INITIAL, "2024-02-01T09:00"), (REVISION, "2024-03-01T09:00"))
    first = bronze.load(batch, empty, "1", RUN_AT)
    assert first.rows.count() == 2 and first.rejected.count() == 0
    assert first.rows.schema.names == schemas.BRONZE.names
    assert bronze.load(batch, first.rows, "2", RUN_AT).rows.count() == 0
    forged = batch.withColumn("raw_sha256", F.lit("0" * 64))
    broken = bronze.load(forged, empty, "1", RUN_AT, manifest=batch)
    assert broken.rows.count() == 0
    assert {r.reason.split(":")[0] for r in broken.rejected.collect()} == {"Checksum mismatch"}
    missing = bronze.load(batch.where("false"), empty, "1", RUN_AT, manifest=batch)
    assert [r.reason for r in missing.rejected.collect()] == ["Raw object missing"] * 2
    key = batch.first().raw_object_key
    assert bronze.by_key(first.rows, key).count() == 1


def test_landed_files_keep_their_bytes(spark, tmp_path):
    body = b'{"observations": [ {"date" : "2024-01-01"} ] }\n'
    batch = objects(spark, (body, "2024-02-01T09:00"))
    for _ in range(2):
        landing.land_files(batch, tmp_path.as_uri())
    read = landing.read_landed(spark, str(tmp_path))
    row = read.first()
    assert read.count() == 1 and bytes(row.payload) == body
    assert (row.source_id, row.dataset_id) == ("fred", "fred_cpiaucsl")
    assert row.raw_object_key == batch.first().raw_object_key
    assert bronze.verify_checksum(read).first().checksum_ok
    assert landing.read_landed(spark, str(tmp_path), dates=["2024-02-01"]).count() == 1
    assert landing.new_objects(batch, landing.landed_keys(spark, str(tmp_path))).count() == 0
    assert landing.object_at(read, row.raw_object_key).count() == 1


def series(spark, rows):
    typed = [("i", "g", date.fromisoformat(d), d[:7], None if v is None else Decimal(v)) for d, v in rows]
    return spark.createDataFrame(
        typed, "indicator_id string, geo_code string, period_start date, period string, value decimal(28,8)"
    )


def test_kpi_row_and_calendar_offsets(spark):
    rows = series(spark, [("2024-01-01", "100"), ("2024-03-01", "110"), ("2024-04-01", "0"), ("2024-05-01", "5")])
    by_row = {r.period: r.mom_pct_change for r in gold.kpi(rows).collect()}
    assert by_row == {"2024-01": None, "2024-03": 10.0, "2024-04": -100.0, "2024-05": None}
    by_month = {r.period: r.mom_pct_change for r in gold.kpi(rows, calendar_aware=True).collect()}
    assert by_month == {"2024-01": None, "2024-03": None, "2024-04": -100.0, "2024-05": None}


def test_yoy_needs_twelve_rows(spark):
    months = [(f"{2022 + m // 12}-{m % 12 + 1:02d}-01", str(300 + m)) for m in range(25)]
    rows = gold.kpi(series(spark, months)).orderBy("period").collect()
    assert rows[11].yoy_pct_change is None
    assert rows[12].yoy_pct_change == 4.0
    assert rows[24].yoy_pct_change == round(12 / 312 * 100, 4)


def test_stored_run_is_repeatable(spark, dims, tmp_path):
    landing.land_files(objects(spark, (INITIAL, "2024-02-01T09:00")), (tmp_path / "in").as_uri())
    layout = pipeline.Layout(str(tmp_path / "tables"))

    def run(when):
        pipeline.run(spark, str(tmp_path / "in"), layout, dims, at(when), "1.0.0")
        rows = pipeline.read_observations(spark, layout)
        return rows.drop("processed_at", "retrieved_at").collect()

    first = run("2030-01-01T00:00")
    assert len(first) == 3 and sorted(run("2030-01-02T00:00")) == sorted(first)
    assert tables.read_table(spark, layout.path("bronze_raw_records"), schemas.BRONZE).count() == 1
    landing.land_files(objects(spark, (REVISION, "2024-03-01T09:00")), (tmp_path / "in").as_uri())
    assert len(run("2030-01-03T00:00")) == 4
    kpis = pipeline.read_kpis(spark, layout)
    assert gold.at_period(kpis, "2023-11").first().value == Decimal("307.90000000")
    log = tables.read_table(spark, layout.path("event_log"), schemas.EVENT)
    assert log.where("event_type = 'bronze_data.written'").count() == 2
    traced = serve.lineage(
        kpis,
        pipeline.read_observations(spark, layout),
        tables.read_table(spark, layout.path("bronze_raw_records"), schemas.BRONZE),
    )
    assert traced.count() == 3


def test_incremental_run_rebuilds_only_what_changed(spark, dims, tmp_path):
    other = dims.dataset_map.withColumns({"dataset_id": F.lit("other"), "indicator_id": F.lit("x")})
    wide = pipeline.Dimensions(
        dims.dataset_map.unionByName(other),
        dims.indicators.unionByName(dims.indicators.withColumn("indicator_id", F.lit("x"))),
    )
    root, layout = (tmp_path / "in").as_uri(), pipeline.Layout(str(tmp_path / "tables"))
    first = objects(spark, (INITIAL, "2024-02-01T09:00"))
    landing.land_files(first, root)
    landing.land_files(landing.address(first.withColumn("dataset_id", F.lit("other"))), root)

    def run(day, incremental):
        when = datetime(2030, 1, day, tzinfo=timezone.utc)
        pipeline.run(spark, str(tmp_path / "in"), layout, wide, when, "1", incremental=incremental)
        rows = pipeline.read_observations(spark, layout).collect()
        return {(r.indicator_id, r.processed_at.day) for r in rows}, len(rows)

    assert run(1, False) == ({("cpi_us", 1), ("x", 1)}, 6)
    landing.land_files(objects(spark, (REVISION, "2024-03-01T09:00")), root)
    assert run(2, True) == ({("cpi_us", 2), ("x", 1)}, 7)
    assert pipeline.read_kpis(spark, layout).count() == 6
    narrow = pipeline.Dimensions(dims.dataset_map, wide.indicators)
    pipeline.run(spark, str(tmp_path / "in"), layout, narrow, RUN_AT, "1")
    assert pipeline.read_observations(spark, layout).where("indicator_id = 'x'").count() == 0
    assert gold.at_period(pipeline.read_kpis(spark, layout), "2023-11").where("value = 307.9").count() == 1


def test_stored_run_dead_letters_and_replay(spark, dims, tmp_path):
    key = "raw/fred/fred_cpiaucsl/date=2024-02-01/" + "0" * 64 + ".json"
    target = tmp_path / "in" / key
    target.parent.mkdir(parents=True)
    target.write_bytes(INITIAL)
    layout = pipeline.Layout(str(tmp_path / "tables"))
    for day in (1, 2):
        pipeline.run(spark, str(tmp_path / "in"), layout, dims, datetime(2030, 1, day, tzinfo=timezone.utc), "1")
    entries = pipeline.read_dlq(spark, layout)
    assert entries.select("payload_reference", "status").collect() == [(key, "pending")]
    assert entries.first().failure_reason.startswith("IntegrityError: Checksum mismatch")
    for _ in range(2):
        pipeline.replay_pending(spark, layout, RUN_AT)
    assert pipeline.read_dlq(spark, layout).where("status = 'pending'").count() == 0
    log = tables.read_table(spark, layout.path("event_log"), schemas.EVENT)
    assert log.where("producer = 'dlq.replay'").count() == entries.count()


def test_seed_files_and_tests(spark, tmp_path):
    (tmp_path / "map.csv").write_text(
        "dataset_id,source_id,indicator_id,geo_code,frequency\nd1,s,i,US,monthly\nd1,s,i,,monthly\n"
    )
    frame = seeds.read_dataset_map(spark, str(tmp_path / "map.csv"))
    source, indicator, _ = seeds.starter_frames(spark)
    failed = {
        r.test_id: r.failed_rows
        for r in assertions.seed_tests(source, indicator, frame).collect()
        if r.failed_rows
    }
    assert failed == {"not_null_dataset_indicator_map_geo_code": 1, "unique_dataset_indicator_map_dataset_id": 1}


def test_model_tests_on_built_tables(spark, dims, empty):
    built = build(spark, dims, empty, (INITIAL, "2024-02-01T09:00"))
    checks = assertions.observation_tests(built.silver).unionByName(assertions.kpi_tests(built.gold))
    assert checks.where("failed_rows > 0").count() == 0
    assert assertions.primary_key_test(built.silver).count() == 0
    assert assertions.time_fields_test(built.silver).count() == 0


def test_csv_export_carries_attribution(spark, tmp_path):
    source, _, _ = seeds.starter_frames(spark)
    rows = spark.createDataFrame([("fred", 1)], "source_id string, v int")
    export.export_csv(rows, source, str(tmp_path / "out"))
    row = spark.read.option("header", True).csv(str(tmp_path / "out")).first()
    assert row.attribution == "Source: Federal Reserve Bank of St. Louis" and row.v == "1"


def test_compaction_merges_files_and_can_repeat(spark, tmp_path):
    rows = spark.range(200).select(
        "id", F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 1000).alias("at")
    )
    rows.repartition(20).write.parquet(str(tmp_path / "small"))
    for _ in range(2):
        tables.compact(spark, str(tmp_path / "small"), str(tmp_path / "merged"), rows.schema, "at")
    assert spark.read.parquet(str(tmp_path / "merged")).count() == 200
    files = list((tmp_path / "merged").glob("year=2024/month=1/day=1/*.parquet"))
    assert len(files) == 1


def test_scans_read_only_what_a_query_needs(spark):
    import __spark_entry__ as entry

    def plan(name):
        return entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()

    history = plan("period_range")
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp,o_orderpriority:string>" in history
    assert "PushedFilters: [IsNotNull(r_name), EqualTo(r_name,ASIA)" in history
    assert "CartesianProduct" not in history and "BroadcastNestedLoopJoin" not in history
