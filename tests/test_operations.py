"""Run history, alerts, events, dead letters and the read side on small literal inputs."""

from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import keys
from tidemark.operators import alerts, dlq, events, runs, serve
from tidemark.sources import tables

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def run_rows(spark, **histories):
    rows = []
    for dataset, statuses in histories.items():
        for n, s in enumerate(statuses, 1):
            status = {"F": "failed", "S": "success", "P": "partial"}[s]
            start = T0 + timedelta(hours=n)
            error = "timeout" if s == "F" else None
            rows.append((f"run-{n}", dataset, "1", start, start + timedelta(minutes=1), status, "h", 0, None, error))
    return spark.createDataFrame(rows, schemas.INGESTION_RUN)


def test_failure_streaks(spark):
    found = alerts.consecutive_failures(run_rows(spark, one="F", two="FF", healed="FFS", apart="FSF", mixed="SPFFF"))
    got = {r.dataset_id: (r.consecutive_failures, r.latest_run_id, r.latest_error) for r in found.collect()}
    assert got == {"two": (2, "run-2", "timeout"), "mixed": (3, "run-5", "timeout")}
    assert alerts.consecutive_failures(run_rows(spark, one="F"), threshold=1).count() == 1


def test_freshness(spark):
    history = run_rows(spark, fresh="S", old="S", failed="SF")
    datasets = spark.createDataFrame([(d,) for d in ("fresh", "old", "failed", "never")], "dataset_id string")
    now = T0 + timedelta(hours=3, minutes=1)

    def breaches(lag):
        return {r.dataset_id: r.breach for r in alerts.freshness_breaches(history, datasets, now, lag).collect()}

    always = {"failed": "latest run not successful", "never": "no run"}
    assert breaches(timedelta(hours=2)) == always
    assert breaches(timedelta(hours=1, minutes=59)) == {**always, "fresh": "too old", "old": "too old"}
    checks = alerts.run_checks(history, datasets, now, timedelta(hours=2))
    assert checks.count() == 8 and checks.where("not passed").count() == 2


def test_quality_upsert_and_alert(spark):
    def rows(*items):
        return spark.createDataFrame(
            [(t, "tbl", r, s, n, T0 + timedelta(hours=h)) for t, r, s, n, h in items], schemas.QUALITY_RESULT
        )

    stored = rows(("a", "r1", "fail", 3, 0), ("b", "r1", "fail", 1, 0), ("c", "r1", "pass", 0, 0))
    state = runs.record_quality(stored, rows(("a", "r2", "pass", 0, 1)))
    assert {(r.test_id, r.run_id, r.status) for r in state.collect()} == {
        ("a", "r2", "pass"),
        ("b", "r1", "fail"),
        ("c", "r1", "pass"),
    }
    # a later arrival replaces a stored row even when it was evaluated earlier
    assert runs.record_quality(stored, rows(("a", "r0", "warn", 0, -1))).where("test_id='a'").first().run_id == "r0"
    assert [r.failing_test_ids for r in alerts.quality_failures(state).collect()] == [["b"]]
    assert alerts.quality_failures(state.where("status = 'pass'")).count() == 0
    once, again = alerts.quality_alerts(state), alerts.quality_alerts(state)
    assert once.collect() == again.collect()


def envelope_rows(spark, *rows):
    full = [
        (i, kind, T0 + timedelta(hours=n), "p", version, "d", None, "ref", meta)
        for n, (i, kind, version, meta) in enumerate(rows)
    ]
    return spark.createDataFrame(full, schemas.EVENT)


QUARANTINED = "raw_data.quarantined"


def test_dead_letters(spark):
    log = envelope_rows(
        spark,
        ("e1", QUARANTINED, "1.0.0", '{"failed_rules":["FR-QUAL-001","FR-QUAL-005"]}'),
        ("e1", QUARANTINED, "1.0.0", '{"failed_rules":["FR-QUAL-003"]}'),
        ("e2", QUARANTINED, "1.0.0", "{}"),
        ("e3", "raw_data.received", "1.0.0", "{}"),
    )
    none = spark.createDataFrame([], schemas.DLQ)
    first = dlq.to_insert(dlq.from_quarantined(log), none)
    reasons = {r.event_id: r.failure_reason for r in first.collect()}
    assert reasons == {
        "e1": "data-quality rule(s) failed: FR-QUAL-001, FR-QUAL-005",
        "e2": "raw_data.quarantined",
    }
    assert dlq.to_insert(dlq.from_quarantined(log), first).count() == 0
    failed = dlq.from_failures(log.where("event_id = 'e3'"), F.lit("ValueError"), F.lit("boom"))
    assert failed.first().failure_reason == "ValueError: boom"

    replays = spark.createDataFrame([], schemas.DLQ_REPLAY)
    state = dlq.current(first, replays)
    assert [r.event_id for r in dlq.pending(state).collect()] == ["e1", "e2"]
    wanted = spark.createDataFrame([("e1",), ("unknown",)], "event_id string")
    at = T0 + timedelta(days=1)
    published, changes = dlq.replay(state, at, wanted)
    row = published.first()
    assert published.count() == 1
    assert (row.event_type, row.producer, row.payload_reference) == ("raw_data.received", "dlq.replay", "ref")
    assert row.metadata == '{"replayed_from_dlq_event_id":"e1"}'
    later = changes.unionByName(changes.withColumn("replayed_at", F.lit(T0 + timedelta(days=9)).cast("timestamp")))
    after = dlq.current(first, later)
    assert dlq.by_id(after, "e1").first().replayed_at == datetime(2024, 1, 2)
    assert dlq.replay(after, at, wanted)[0].count() == 0
    assert dlq.mark_replayed(after, wanted, at).count() == 0
    slo = spark.createDataFrame([("d", 3600)], "dataset_id string, max_lag_seconds long")
    assert alerts.dlq_ageing(state, slo, T0 + timedelta(hours=2)).count() == 1


def test_envelopes(spark):
    log = envelope_rows(spark, ("e1", "raw_data.received", "1.0.0", '{"a":1}'), ("e2", "raw_data.received", "9", "{}"))
    back = events.parse(events.serialise(log))
    assert sorted(back.drop("problem").collect()) == sorted(log.collect())
    known, diverted = events.version_guard(log, ["1.0.0"])
    assert known.count() == 1 and [r.event_id for r in diverted.collect()] == ["e2"]
    lines = spark.createDataFrame([("nope",), ("{}",)], "envelope string")
    assert {r.problem for r in events.parse(lines).collect()} == {"not JSON", "unknown event type"}
    with pytest.raises(ValueError):
        events.emit(spark.range(1), "made.up", "p", T0)
    about = spark.createDataFrame([("d",)], "dataset_id string")
    ids = {events.emit(about, "raw_data.received", "p", T0).first().event_id for _ in range(2)}
    assert len(ids) == 1


def test_request_hash_text(spark):
    import hashlib

    frame = spark.createDataFrame([("S", "2024-01-01", ""), ("S", None, None)], "s string, a string, b string")
    got = [r[0] for r in frame.select(keys.request_hash(F.lit("https://h"), "s", "a", "b")).collect()]
    base = "GET https://h/series/observations?series_id=S"
    want = [base + "&realtime_start=2024-01-01", base]
    assert got == [hashlib.sha256(w.encode()).hexdigest() for w in want]


def test_first_and_last_wins(spark):
    rows = spark.createDataFrame(
        [("k", 1, "a"), ("k", 2, "b"), (None, 1, "c"), (None, 2, "d")], "k string, n int, v string"
    )
    assert {r.v for r in tables.latest_by_key(rows, ["k"], ["n"]).collect()} == {"b", "d"}
    assert {r.v for r in tables.first_by_key(rows, ["k"], ["n"]).collect()} == {"a", "c"}


def observations(spark, rows):
    full = [
        ("i", "g", p, date.fromisoformat(p + "-01"), date.fromisoformat(p + "-28"), date.fromisoformat(v), Decimal(x))
        for p, v, x in rows
    ]
    return spark.createDataFrame(
        full,
        "indicator_id string, geo_code string, period string, period_start date, period_end date,"
        "vintage_date date, value decimal(28,8)",
    )


def test_point_in_time(spark):
    rows = observations(
        spark,
        [("2024-01", "2024-02-01", "1"), ("2024-01", "2024-03-01", "2"), ("2024-02", "2024-03-01", "3")],
    )
    days = [date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 29), date(2024, 3, 1), date(2025, 1, 1)]
    many = {(r.as_of, r.period): r.value for r in serve.as_of_many(rows, days).collect()}
    single = {(d, r.period): r.value for d in days for r in serve.as_of(rows, d).collect()}
    assert many == single and len(single) == 6
    assert serve.latest_period(rows).first().value == Decimal(3)
    diff = {(r.period, r.revision): r.change for r in serve.revisions(rows).collect()}
    assert diff == {("2024-01", 1): None, ("2024-01", 2): Decimal(1), ("2024-02", 1): None}


def test_bar_page_limits(spark):
    empty = spark.createDataFrame([], schemas.MARKET_OHLCV)
    instruments = spark.createDataFrame([], schemas.DIM_INSTRUMENT)
    for bad in ({"limit": 0}, {"limit": -1}, {"interval": "2h"}):
        args = {"interval": "1d", **bad}
        with pytest.raises(ValueError):
            serve.bars(empty, instruments, "crypto", "BTC", **args)
    assert serve.bars(empty, instruments, "crypto", "BTC", "1d").count() == 0


def test_gaps_stay_null(spark):
    expected = spark.createDataFrame([(1,), (2,)], "d int")
    bars = spark.createDataFrame([(1, 5.0)], "d int, close double")
    rows = {r.d: (r.close, r.is_gap) for r in serve.with_gaps(expected, bars, ["d"]).collect()}
    assert rows == {1: (5.0, False), 2: (None, True)}


def test_metadata_changes(spark):
    rows = [("s", 1, "a", None), ("s", 2, "a", "x"), ("s", 3, "a", "x"), ("s", 4, "b", None), ("t", 1, "z", "z")]
    frame = spark.createDataFrame(rows, "k string, at int, unit string, base string")
    got = {
        (r.k, r.at): sorted(r.changed_fields)
        for r in serve.metadata_changes(frame, "k", "at", ["unit", "base"]).collect()
    }
    assert got == {("s", 2): ["base"], ("s", 4): ["base", "unit"]}
