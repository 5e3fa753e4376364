"""Mismatches between two deliveries: a verdict that only a checksum decides, and the keys behind it."""

import json
import random

from pyspark.sql import functions as F

from tests.test_admission import CONTRACT
from tidemark.operators.quality import reconcile, rows, verdict


def records(spark, made):
    lines = [(b, json.dumps(r)) for b, r in made]
    return rows.from_json_text(spark.createDataFrame(lines, "batch_id string, line string"), "batch_id", "line")


def row(series, day, value, **extra):
    base = {"observed_at": f"2024-01-{day:02d}T00:00:00Z", "value": value, "source_id": "s", "series_id": series}
    return {**base, "realtime_start": "2024-02-01", "realtime_end": "2024-02-01", **extra}


def test_a_checksum_alone_decides(spark):
    here = [("a", row("x", 1, "1")), ("a", row("x", 2, "2")), ("b", row("x", 1, "1"))]
    there = [("a", row("x", 2, "1")), ("a", row("x", 1, "2")), ("b", row("x", 1, "1"))]
    control = reconcile.checksums(records(spark, there), CONTRACT)
    batches = spark.createDataFrame([("a",), ("b",), ("c",)], "batch_id string")
    results = verdict.evaluate(batches, records(spark, here), CONTRACT, source_control=control)
    status = {r.batch_id: r.status for r in verdict.by_status(results, "failed").where("rule_id = 'FR-QUAL-007'").collect()}
    assert status == {"a": "failed"}
    rest = {r.batch_id: r.status for r in results.where("rule_id = 'FR-QUAL-007'").collect()}
    assert rest["b"] == "passed" and rest["c"] == "skipped"


def test_located_keys_equal_a_comparison_of_all_rows(spark):
    pick = random.Random(4)
    here = [(f"b{i % 7}", row(f"s{pick.randrange(40)}", 1 + pick.randrange(28), str(pick.randrange(5)))) for i in range(900)]
    here += [("b1", row(None, 3, "1")), ("b1", row(None, 3, "1"))]
    there = list(here)
    for i in pick.sample(range(900), 12):
        there[i] = (there[i][0], {**there[i][1], "value": "99"})
    there = [r for i, r in enumerate(there) if i % 211] + [("b9", row("only", 1, "5"))]

    def keyed(made):
        out = {}
        for b, r in made:
            out.setdefault((b, r["series_id"], r["observed_at"], r["realtime_start"]), []).append(json.dumps(r, sort_keys=True))
        return {k: sorted(v) for k, v in out.items()}

    a, b = keyed(here), keyed(there)
    want = {k: "missing there" if k not in b else "missing here" if k not in a else "differs" for k in a.keys() | b.keys() if a.get(k) != b.get(k)}
    for levels in ((6, 12, 20), (1,), ()):
        got = reconcile.locate(records(spark, here), records(spark, there), CONTRACT, levels=levels).collect()
        assert {(r.batch_id, r.series_id, r.observed_at, r.realtime_start): r.problem for r in got} == want
    assert reconcile.locate(records(spark, here), records(spark, here), CONTRACT).count() == 0


def test_order_and_absent_fields(spark):
    one = records(spark, [("a", row("x", 1, None)), ("a", row("y", 1, "2"))])
    two = one.orderBy(F.col("record").cast("string").desc())
    assert reconcile.checksums(one, CONTRACT).collect() == reconcile.checksums(two, CONTRACT).collect()
