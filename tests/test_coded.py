"""Index-coded payloads against hand-checked rows."""

import json
from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.operators import coded
from tidemark.sources import landing

AT = datetime(2024, 5, 1, tzinfo=timezone.utc)


def body(series, areas=("US", "XX"), kinds=("CPI",), times=("2024-01", "2024-Q2", "2023")):
    values = lambda codes: [{"id": c} for c in codes]
    return {
        "header": {"prepared": "2024-04-30"},
        "structure": {
            "dimensions": {
                "series": [{"id": "AREA", "values": values(areas)}, {"id": "KIND", "values": values(kinds)}],
                "observation": [{"id": "TIME_PERIOD", "values": values(times)}],
            }
        },
        "dataSets": [{"series": {k: {"observations": v} for k, v in series.items()}}],
    }


def conform(spark, *payloads):
    rows = [("s", "d", AT, bytearray(p if isinstance(p, bytes) else json.dumps(p).encode())) for p in payloads]
    schema = "source_id string, dataset_id string, retrieved_at timestamp, payload binary"
    stored = landing.address(spark.createDataFrame(rows, schema)).withColumn("bronze_id", F.sha2("raw_object_key", 256))
    lists = {
        "AREA": spark.createDataFrame([("US", "us"), ("DE", None)], "code string, canonical string"),
        "KIND": spark.createDataFrame([("CPI", "cpi")], "code string, canonical string"),
    }
    indicators = spark.createDataFrame([("cpi", "index", "sa")], "indicator_id string, unit string, seasonal_adjustment string")
    return coded.conform(stored, {"AREA": "geo_code", "KIND": "indicator_id"}, lists, indicators, AT)


def test_positions_become_codes_and_periods(spark):
    out = conform(spark, body({"0:0": {"0": ["1.5"], "1": [2], "2": ["3", 9], "7": ["4"]}}))
    rows = {(r.indicator_id, r.geo_code, r.period_start): r.value for r in out.rows.collect()}
    assert rows == {
        ("cpi", "us", date(2024, 1, 1)): Decimal("1.5"),
        ("cpi", "us", date(2024, 4, 1)): Decimal(2),
        ("cpi", "us", date(2023, 1, 1)): Decimal(3),
    }
    assert {r.vintage_date for r in out.rows.collect()} == {date(2024, 4, 30)}
    assert [r.reason for r in out.quarantined.collect()] == ["no value at the position of the period"]


def test_what_is_unknown_is_held_back_with_its_reason(spark):
    series = {k: {"0": ["1"]} for k in ("1:0", "5:0", "0", "0:0:0", "0:-1", "x:0", "0:0")}
    out = conform(spark, body(series), b"no json", {"header": {}}, body({"0:0": {"0": ["1"]}}, areas=("DE",)))
    assert out.rows.count() == 1
    reasons = sorted(r.reason for r in out.quarantined.collect())
    assert reasons == sorted(
        ["unknown AREA: XX", "unknown AREA: DE", "payload is not JSON", "payload has no dimensions"]
        + ["no value at the position of AREA"] * 2
        + ["no value at the position of KIND"]
        + ["key does not fit the dimensions"] * 2
    )


def test_empty_payloads_and_tables_give_nothing(spark):
    out = conform(spark, body({}), body({"0:0": {}}))
    assert out.rows.count() == 0 and out.quarantined.count() == 0
    nothing = conform(spark)
    assert nothing.rows.count() == 0
