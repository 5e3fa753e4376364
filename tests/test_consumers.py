"""Consumers of the event log: isolation at execution, over several triggers and beside each other."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import events
from tidemark.plans import pipeline, streams
from tidemark.sources import tables
from tidemark.sources.star import Star
from tidemark.streaming import consumers

OUT = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("n", T.LongType())])
NOW = datetime(2024, 1, 1, tzinfo=timezone.utc)


def log(spark, layout, label, ids, kind="raw_data.received"):
    rows = spark.createDataFrame([(i, "d") for i in ids], "id string, dataset_id string")
    made = events.emit(rows, kind, "p", NOW, event_id=F.col("id"), payload_reference=F.col("id"))
    pipeline.append_events(made, layout, label)


def numbers(batch):
    """Fails when a row is computed whose id is no number."""
    return batch.select("event_id", F.col("event_id").cast("long").alias("n"))


def by_python(batch):
    @F.udf("long")
    def parse(text):
        return int(text)

    return batch.select("event_id", parse("event_id").alias("n"))


def never(batch):
    raise ValueError("cannot even plan")


@pytest.fixture
def layout(tmp_path):
    return pipeline.Layout(str(tmp_path / "t"))


def dead(spark, layout):
    return {r.event_id: r.failure_reason for r in pipeline.read_dlq(spark, layout).where("status = 'pending'").collect()}


def test_poison_rows_go_and_the_stream_goes_on(spark, layout):
    consumer = consumers.Consumer("raw_data.received", numbers, OUT)
    good = {str(i) for i in range(40)}
    log(spark, layout, "a", [*good, "poison", "venom"])
    assert consumers.run_all(spark, layout, {"c": consumer}) == {"c": None}
    log(spark, layout, "b", ["100", "toxin", "101"])
    log(spark, layout, "b", ["102"], "raw_data.validated")
    assert consumers.run_all(spark, layout, {"c": consumer}) == {"c": None}
    rows = consumers.read_consumed(spark, layout, "c", consumer).collect()
    assert {r.event_id for r in rows} == good | {"100", "101"} and len(rows) == 42
    letters = dead(spark, layout)
    assert set(letters) == {"poison", "venom", "toxin"}
    assert all("CAST_INVALID_INPUT" in x for x in letters.values())


def test_a_raising_consumer_leaves_the_others_alone(spark, layout):
    log(spark, layout, "a", ["1", "2", "x"])
    made = {
        "never": consumers.Consumer("raw_data.received", never, OUT),
        "python": consumers.Consumer("raw_data.received", by_python, OUT),
        "other": consumers.Consumer("raw_data.validated", numbers, OUT),
    }
    assert set(consumers.run_all(spark, layout, made).values()) == {None}
    assert consumers.read_consumed(spark, layout, "never", made["never"]).count() == 0
    assert {r.n for r in consumers.read_consumed(spark, layout, "python", made["python"]).collect()} == {1, 2}
    entries = tables.read_table(spark, layout.path("dlq"), pipeline.schemas.DLQ).collect()
    reasons = {(r.event_id, r.failure_reason.partition(":")[0]) for r in entries}
    assert reasons == {("1", "never"), ("2", "never"), ("x", "never"), ("x", "python")}
    assert any("invalid literal for int()" in r.failure_reason for r in entries)


def test_batch_and_streaming_writers_share_log_and_dead_letters(spark, layout):
    """Rows of both forms are read whatever comes first, and replay finds the entries of both."""
    log(spark, layout, "run-1", ["x", "5"])
    consumers.run_all(spark, layout, {"c": consumers.Consumer("raw_data.received", numbers, OUT)})
    rejected = spark.createDataFrame([("k", "s", "d", "why")], "raw_object_key string, source_id string, dataset_id string, reason string")
    pipeline.append_dead_letters(spark, pipeline.rejected_entries(rejected, NOW), layout, "run-2")
    assert len(dead(spark, layout)) == 2
    pipeline.replay_pending(spark, layout, NOW)
    assert not dead(spark, layout)
    assert pipeline.read_events(spark, layout).count() == 4


def one_number(event):
    """A row for each digit; what does not fit the schema is the event's own failure."""
    if event["event_id"] == "loose":
        yield {"event_id": "loose", "n": "no number"}
    elif not event["event_id"].isdigit():
        raise KeyError("no digits")
    else:
        yield from ({"event_id": event["event_id"], "n": int(x)} for x in event["event_id"])


def test_events_tried_one_by_one_take_one_pass_however_many_fail(spark, layout):
    consumer = consumers.Consumer("raw_data.received", one_number, OUT, per_event=True)
    good, bad = {str(i) for i in range(100)}, {f"x{i}" for i in range(300)} | {"loose"}
    log(spark, layout, "a", [*good, *bad])
    before = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    assert consumers.run_all(spark, layout, {"c": consumer}) == {"c": None}
    assert spark.sparkContext._jsc.sc().dagScheduler().nextJobId() - before < 20
    rows = consumers.read_consumed(spark, layout, "c", consumer).collect()
    assert sorted((r.event_id, r.n) for r in rows) == sorted((i, int(x)) for i in good for x in i)
    letters = dead(spark, layout)
    assert set(letters) == bad and letters["x7"] == "c: KeyError: 'no digits'"
    assert letters["loose"].startswith("c: Arrow")


def test_parts_of_a_failing_batch_are_of_like_size(spark):
    """Every digit of the hash splits: a good event never stays with a failing one for want of digits."""
    ids = spark.range(1600).select(F.col("id").cast("string").alias("event_id")).cache()
    for above in ((), (3,), (3, 5)):
        sizes = [ids.where(consumers._share((*above, n))).count() for n in range(consumers.FAN)]
        whole = ids.where(consumers._share(above)).count() if above else 1600
        assert sum(sizes) == whole and max(sizes) < max(3, whole / 4)
    assert consumers.BITS * consumers.DEEPEST == 64


def failing(monkeypatch, end):
    """Writing to a table whose path ends so raises; all other tables are as ever."""
    real = tables.write_batch

    def write(df, path, *rest):
        if path.endswith(end):
            raise OSError("store is gone")
        real(df, path, *rest)

    monkeypatch.setattr(tables, "write_batch", write)


def test_a_query_that_fails_as_a_whole_raises_once_all_have_ended(spark, layout, monkeypatch):
    made = {name: consumers.Consumer("raw_data.received", numbers, OUT) for name in ("a", "b", "c")}
    log(spark, layout, "a", ["1", "2"])
    with monkeypatch.context() as patch:
        failing(patch, "consumed/a")
        with pytest.raises(consumers.ConsumersFailed, match="^a: StreamingQueryException") as caught:
            consumers.run_all(spark, layout, made)
    assert {name for name, reason in caught.value.outcome.items() if reason is None} == {"b", "c"}
    assert "store is gone" in str(caught.value.__cause__)
    assert [consumers.read_consumed(spark, layout, name, c).count() for name, c in made.items()] == [0, 2, 2]
    assert consumers.run_all(spark, layout, made) == {"a": None, "b": None, "c": None}
    assert [consumers.read_consumed(spark, layout, name, c).count() for name, c in made.items()] == [2, 2, 2]


def test_a_query_that_cannot_start_keeps_none_from_its_end(spark, layout):
    made = {name: consumers.Consumer("raw_data.received", numbers, OUT) for name in ("a", "b", "c")}
    log(spark, layout, "a", ["1", "2"])
    tables.mark(spark, layout.path("checkpoints/consumer-b"))  # a file where a folder should be
    with pytest.raises(consumers.ConsumersFailed) as caught:
        consumers.run_all(spark, layout, made)
    assert {name for name, reason in caught.value.outcome.items() if reason is not None} == {"b"}
    assert not spark.streams.active
    assert [consumers.read_consumed(spark, layout, name, c).count() for name, c in made.items()] == [2, 0, 2]


def test_storage_that_fails_makes_no_dead_letters(spark, layout, monkeypatch, tmp_path):
    consumer = consumers.Consumer("raw_data.received", numbers, OUT)
    log(spark, layout, "a", ["1", "2", "poison"])
    (tmp_path / "file").touch()
    with monkeypatch.context() as patch:
        patch.setattr(consumers, "scratch_path", lambda *_: str(tmp_path / "file" / "below"))
        with pytest.raises(consumers.ConsumersFailed):
            consumers.run_all(spark, layout, {"c": consumer})
    assert not dead(spark, layout)
    assert consumers.run_all(spark, layout, {"c": consumer}) == {"c": None}
    assert consumers.read_consumed(spark, layout, "c", consumer).count() == 2
    assert set(dead(spark, layout)) == {"poison"}


@pytest.mark.parametrize("end", ["consumed/plain", "consumed/strict", "dlq"])
def test_the_registered_query_is_whole_or_fails(spark, monkeypatch, tmp_path, end):
    days = [datetime(2024, 1, day, tzinfo=timezone.utc) for day in (2, 30)]
    rows = [(i + k, at, 7, "view", 1.0, '{"k": 9}') for k, at in enumerate(days) for i in (10, 776)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    star = Star(spark, str(tmp_path))
    found = {(r.consumer, r.event_id, r.n, r.reason) for r in streams.consumer_queries(star).collect()}
    handled = {("plain", i, 9, None) for i in ("10", "776", "11", "777")} | {("strict", i, 9, None) for i in ("10", "776", "11")}
    assert found == handled | {("dead letter", "777", None, "strict")}
    failing(monkeypatch, end)
    with pytest.raises(consumers.ConsumersFailed):
        streams.consumer_queries(star)
