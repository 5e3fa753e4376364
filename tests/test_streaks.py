"""Failure streaks as keyed state, and streamed validation that reads the buckets it touches."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tidemark.operators import alerts as batch_alerts
from tidemark.plans.pipeline import Layout
from tidemark.sources import tables
from tidemark.streaming import streaks, validate

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
RUN = "run_id string, dataset_id string, started_at timestamp, status string, error string"


def runs(spark, rows):
    return spark.createDataFrame([(i, d, T0 + timedelta(hours=h), s, e) for i, d, h, s, e in rows], RUN)


def feed(spark, tmp_path, parts, **kw):
    """Each part is a file and a run of the query of its own, so state is restored in between."""
    layout = Layout(str(tmp_path))
    for part in parts:
        runs(spark, part).coalesce(1).write.mode("append").parquet(layout.path("in"))
        stream = spark.readStream.schema(RUN).parquet(layout.path("in"))
        streaks.failure_streaks(stream, layout.path("alerts"), layout.path("checkpoint"), "s", **kw).awaitTermination()
    return layout


def standing(spark, layout):
    return sorted(map(tuple, streaks.read_streaks(spark, layout.path("checkpoint")).collect()))


def wanted(spark, rows):
    return sorted(map(tuple, batch_alerts.failure_streaks(runs(spark, rows)).collect()))


def history(seed, size):
    pick = random.Random(seed)
    return [
        (f"r{i}", f"d{pick.randrange(6)}", i // 2, pick.choice(["failed", "failed", "success", "partial"]), pick.choice([None, "a", "b"]))
        for i in range(size)
    ]


def test_any_order_repeats_and_restarts_give_the_same_streaks(spark, tmp_path):
    rows = history(1, 60)
    shuffled = random.Random(2).sample(rows, len(rows)) + rows[:20]
    layout = feed(spark, tmp_path, [shuffled[:30], shuffled[30:55], shuffled[55:]])
    assert standing(spark, layout) == wanted(spark, rows)
    found = streaks.standing_alerts(spark, layout.path("checkpoint"), layout.path("alerts"))
    expect = batch_alerts.consecutive_failure_alerts(runs(spark, rows))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expect.collect()))


def test_old_failures_become_a_count(spark, tmp_path):
    rows = [(f"r{i:03d}", "d", 24 * i, "failed", f"e{i}") for i in range(12)] + [("ok", "other", 24 * 30, "success", None)]
    layout = feed(spark, tmp_path, [rows[:6], rows[6:12], rows[12:], [("r012", "d", 24 * 30, "failed", "last")]], delay="2 days")
    assert standing(spark, layout) == [("d", 13, "r012", "last")]
    kept = spark.read.format("statestore").option("path", layout.path("checkpoint")).option("stateVarName", "failures").load()
    assert kept.count() == 1  # eleven and more are a number now
    feed(spark, tmp_path, [[("good", "d", 24 * 31, "success", None)]], delay="2 days")
    assert standing(spark, layout) == []


def test_silent_datasets_are_forgotten(spark, tmp_path):
    parts = [
        [("a1", "a", 0, "failed", None), ("b1", "b", 0, "failed", None)],
        [("b2", "b", 24 * 20, "failed", None)],
        [("b3", "b", 24 * 21, "failed", None)],
        [("b4", "b", 24 * 21 + 1, "failed", None)],
    ]
    layout = feed(spark, tmp_path, parts, delay="1 day", forget_days=10)
    assert standing(spark, layout) == [("b", 4, "b4", None)]
    state = spark.read.format("statestore").option("path", layout.path("checkpoint")).option("stateVarName", "streak").load()
    assert {r.dataset_id for r in state.select("key.dataset_id").collect()} == {"b"}


def test_touched_buckets_alone_are_read(spark, tmp_path):
    path = str(tmp_path / "received")
    rows = spark.range(200).select(F.concat(F.lit("b"), F.col("id") % 50).alias("batch_id"), F.col("id").cast("string").alias("line"))
    for n, part in enumerate((rows.where("line < '5'"), rows.where("line >= '5' and batch_id in ('b1', 'b2')"))):
        made = part.withColumn(validate.BUCKET, validate.bucket_of(F.col("batch_id")))
        tables.write_batch(made, path, "q", n, (validate.BUCKET,))
    own = F.col(tables.BATCH_COLUMN) == tables.slice_name("q", 1)
    whole = validate.touched_batches(spark, path, rows.schema, own)
    buckets = {r[0] for r in whole.select(validate.BUCKET).distinct().collect()}
    assert len(buckets) <= 2 and {r.batch_id for r in whole.collect()} == {"b1", "b2"}
    want = rows.where("batch_id in ('b1', 'b2')").count()
    assert whole.count() == want
    plan = whole._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert any("bucket" in x and ("IN" in x or "=" in x) for x in filters)
