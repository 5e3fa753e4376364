"""Rules one by one, the verdict, and the type grammar against the standard library."""

import datetime as dt
import json
import math
from datetime import timedelta, timezone
from decimal import Decimal, InvalidOperation

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.contracts import ContractError, DataContract, contracts_frame, load_contract, typed_record
from tidemark.functions import periods
from tidemark.functions import records as R
from tidemark.operators import adjacency
from tidemark.functions import keys
from tidemark.operators.quality import metadata, rows, sets, verdict

NOW = dt.datetime(2024, 2, 1, tzinfo=timezone.utc)
BASE = {
    "observed_at": "2024-01-01T00:00:00+00:00",
    "value": "812.25",
    "source_id": "bureau",
    "series_id": "RENT-INDEX",
    "realtime_start": "2024-01-15",
    "realtime_end": "2024-01-15",
}
RAW = {
    "dataset": "d",
    "owner": "o",
    "source": "bureau",
    "version": "1.0.0",
    "primary_key": ["source_id", "observed_at"],
    "schema": {
        "observed_at": "timestamp_utc",
        "value": "decimal(20,8)",
        "source_id": "string",
        "series_id": "string",
        "realtime_start": "date",
        "realtime_end": "date",
    },
    "quality_rules": ["value_positive"],
    "metadata": {"units": "index", "seasonal_adjustment": "sa"},
}
CONTRACT = DataContract.from_mapping(RAW)
BAR_CONTRACT = DataContract.from_mapping(
    {**RAW, "schema": {n: "decimal(20,8)" for n in ("open", "high", "low", "close")}, "quality_rules": []}
)


def batches_of(spark, batches):
    lines = [(b, json.dumps(r)) for b, records in batches.items() for r in records]
    text = spark.createDataFrame(lines, "batch_id string, line string")
    ids = spark.createDataFrame([(b,) for b in batches], "batch_id string")
    return ids, rows.from_json_text(text, "batch_id", "line")


def judge(spark, batches, contract=CONTRACT, **context):
    ids, records = batches_of(spark, batches)
    found = verdict.evaluate(ids, records, contract, **context).collect()
    return {(r.batch_id, r.rule_id[-3:]): (r.status, r.failed_rows) for r in found}


def changed(**fields):
    return {**BASE, **fields}


def without(name):
    return {k: v for k, v in BASE.items() if k != name}


def test_schema_findings(spark):
    _, records = batches_of(
        spark,
        {
            "clean": [BASE],
            "missing": [without("series_id")],
            "extra": [changed(note="x")],
            "type": [changed(value="not-a-number")],
            "null": [changed(value=None)],
            "number": [changed(value=300)],
            "number_as_text": [changed(source_id=5)],
            "bool": [changed(value=True)],
        },
    )
    found = {
        r.batch_id: (r.missing, r.extra, r.type_errors) for r in rows.check_schema(records, CONTRACT).collect()
    }
    assert found == {
        "clean": ([], [], []),
        "missing": (["series_id"], [], []),
        "extra": ([], ["note"], []),
        "type": ([], [], ["value"]),
        "null": ([], [], ["value"]),
        "number": ([], [], []),
        "number_as_text": ([], [], ["source_id"]),
        "bool": ([], [], ["value"]),
    }
    assert rows.schema_violations(records, CONTRACT).count() == 6


def test_native_types_fit(spark):
    one = spark.range(1)
    packed = rows.from_columns(
        one,
        F.lit("b"),
        {
            "observed_at": F.current_timestamp(),
            "value": F.lit(1.5),
            "source_id": F.lit("s"),
            "series_id": F.lit("x"),
            "realtime_start": F.current_date(),
            "realtime_end": F.current_timestamp(),
        },
    )
    row = rows.check_schema(packed, CONTRACT).first()
    assert row.type_errors == ["realtime_end"]


def test_one_clean_record_without_context(spark):
    found = judge(spark, {"b": [BASE]})
    assert {rule for (_, rule), (status, _) in found.items() if status == "skipped"} == {
        "002",
        "004",
        "006",
        "007",
        "008",
    }
    assert {s for s, _ in found.values()} == {"passed", "skipped"}


def test_full_context(spark):
    keys = spark.createDataFrame([("bureau",)], "source_id string")
    calendar = spark.createDataFrame(
        [("good", BASE["observed_at"]), ("gap", BASE["observed_at"]), ("gap", "2024-02-01T00:00:00+00:00")],
        "batch_id string, expected_key string",
    )
    control = spark.createDataFrame(
        [("good", 1, None, None), ("gap", 2, None, None), ("bad", None, "abc", "def"), ("same", 1, "a", "a")],
        "batch_id string, source_count long, source_checksum string, local_checksum string",
    )
    found = judge(
        spark,
        {"good": [BASE], "gap": [BASE], "bad": [changed(source_id="who", value="-1.0")], "same": [BASE], "none": []},
        expected=calendar,
        now=NOW,
        max_lag=timedelta(days=40),
        known_keys={"source_id": keys},
        source_control=control,
    )
    assert found["good", "002"] == ("passed", 0) and found["gap", "002"] == ("failed", 1)
    assert found["bad", "002"] == ("skipped", 0)
    assert found["good", "004"] == ("passed", 0) and found["none", "004"] == ("failed", 1)
    assert found["bad", "005"] == ("failed", 1)
    assert found["good", "006"] == ("passed", 0) and found["bad", "006"] == ("failed", 1)
    assert [found[b, "007"][0] for b in ("good", "gap", "bad", "same", "none")] == [
        "passed",
        "failed",
        "failed",
        "passed",
        "skipped",
    ]
    assert found["none", "001"] == ("passed", 0) and found["none", "003"] == ("passed", 0)


def test_freshness_limit_is_strict(spark):
    lag = timedelta(days=31)
    assert judge(spark, {"b": [BASE]}, now=NOW, max_lag=lag)["b", "004"][0] == "passed"
    assert judge(spark, {"b": [BASE]}, now=NOW, max_lag=lag - timedelta(seconds=1))["b", "004"][0] == "failed"
    unreadable = [changed(observed_at="soon")]
    assert judge(spark, {"b": unreadable}, now=NOW, max_lag=lag)["b", "004"][0] == "failed"


def test_uniqueness_counts_keys_and_keeps_types_apart(spark):
    batches = {
        "twice": [BASE, BASE, BASE],
        "null": [changed(source_id=None), without("source_id")],
        "kinds": [changed(source_id="1"), changed(source_id=1)],
        "numbers": [changed(source_id=1), changed(source_id=1.0)],
    }
    found = judge(spark, batches)
    assert [found[b, "003"] for b in batches] == [("failed", 1), ("failed", 1), ("passed", 0), ("failed", 1)]


@pytest.mark.parametrize(
    "bar,bad",
    [
        ((10, 5, 1, 3), True),
        ((3, 5, 1, 4), False),
        ((5, 5, 5, 5), False),
        (("3", "5", "1", "4"), False),
        ((3, "NaN", 1, 4), True),
        ((3, "x", 1, 4), False),
        ((3, None, 1, 4), False),
        ((3, "inf", "-inf", 4), False),
    ],
)
def test_ohlc(spark, bar, bad):
    record = dict(zip(("open", "high", "low", "close"), bar, strict=True))
    status = judge(spark, {"b": [record]}, BAR_CONTRACT)["b", "005"]
    assert status == (("failed", 1) if bad else ("passed", 0))


def test_range_is_skipped_when_nothing_applies(spark):
    plain = DataContract.from_mapping({**RAW, "quality_rules": []})
    assert judge(spark, {"b": [changed(value="-5")]}, plain)["b", "005"][0] == "skipped"


def test_positive_value_ignores_what_is_no_number(spark):
    batches = {v: [changed(value=v)] for v in ("-1", "0", "nan", "1d", "x", " 2 ", "-inf", "1_0")}
    found = judge(spark, batches)
    assert {b for b in batches if found[b, "005"][0] == "failed"} == {"-1", "0", "-inf"}


def test_outlier_flags_but_does_not_quarantine(spark):
    def month(n, value):
        return changed(observed_at=f"2024-{n:02d}-01T00:00:00Z", value=value)

    batches = {
        "jump": [month(1, "300"), month(2, "4000")],
        "calm": [month(1, "300"), month(2, "301")],
        "zero": [month(1, "0.0"), month(2, "9")],
        "nan": [month(1, "1"), month(2, "nan"), month(3, "1")],
        "late": [month(2, "1"), month(1, "5000")],
        "exact": [month(1, "1"), month(2, "11")],
    }
    plain = DataContract.from_mapping({**RAW, "quality_rules": []})
    ids, records = batches_of(spark, batches)
    results = verdict.evaluate(ids, records, plain)
    flags = {r.batch_id: r.failed_rows for r in results.where("rule_id like '%008'").collect()}
    assert flags == {"jump": 1, "calm": 0, "zero": 0, "nan": 0, "late": 0, "exact": 0}
    outcome = {r.batch_id: (r.outcome, r.flagged_rules) for r in verdict.verdicts(results).collect()}
    assert outcome["jump"] == ("validated", ["FR-QUAL-008"])


def test_verdict_report_and_routing(spark):
    ids, records = batches_of(spark, {"ok": [BASE], "bad": [changed(value="-1", note=1)]})
    results = verdict.evaluate(ids, records, CONTRACT)
    judged = verdict.verdicts(results)
    outcome = {r.batch_id: (r.outcome, r.failed_rules) for r in judged.collect()}
    assert outcome == {"ok": ("validated", []), "bad": ("quarantined", ["FR-QUAL-001", "FR-QUAL-005"])}
    good, bad = verdict.route(records, judged)
    assert [r.batch_id for r in good.collect()] == ["ok"] and [r.batch_id for r in bad.collect()] == ["bad"]
    report = {r.batch_id: (r.failed, r.skipped, r.has_failures) for r in verdict.report(results).collect()}
    assert report == {"ok": (0, 5, False), "bad": (2, 5, True)}
    stored = {r.test_id: (r.status, r.failed_rows) for r in verdict.quality_results(results, "t", "r", NOW).collect()}
    assert stored["FR-QUAL-001"] == ("fail", 1) and "FR-QUAL-002" not in stored


def test_staging_does_not_change_results(spark, tmp_path):
    from tidemark.sources import tables

    batches = {"a": [BASE, BASE], "b": [changed(value="x")]}
    staged = judge(spark, batches, stage=lambda df: tables.staged(df, str(tmp_path / "s")))
    assert staged == judge(spark, batches)


def test_semantic_metadata(spark):
    def contract(**meta):
        return DataContract.from_mapping({**RAW, "dataset": json.dumps(meta), "metadata": meta})

    contracts = [
        contract(units="u", seasonal_adjustment="sa"),
        contract(seasonal_adjustment="sa"),
        contract(units=" ", seasonal_adjustment="sa"),
        contract(units="u", seasonal_adjustment="sa", index_base=""),
        contract(units="u", seasonal_adjustment="sa", index_base="2015"),
    ]
    frame = metadata.semantic_metadata(contracts_frame(spark, contracts))
    got = {r.dataset_id: r.missing_metadata for r in frame.collect()}
    assert [got[c.dataset] for c in contracts] == [[], ["units"], ["units"], ["index_base"], []]
    for c in contracts:
        status = judge(spark, {"b": [BASE]}, c)["b", "009"]
        assert status[1] == len(got[c.dataset])


def test_contract_loading(tmp_path):
    with pytest.raises(ContractError):
        DataContract.from_mapping(["a"])
    for name in ("dataset", "owner", "source", "version", "primary_key", "schema"):
        with pytest.raises(ContractError, match=name):
            DataContract.from_mapping({k: v for k, v in RAW.items() if k != name})
    path = tmp_path / "contract.yaml"
    path.write_text(json.dumps({**RAW, "version": 2}))
    loaded = load_contract(str(path))
    assert loaded.version == "2" and loaded.change_policy == {} and loaded.series_key() == ("source_id",)
    assert loaded.struct_type().fields[1].dataType.simpleString() == "decimal(20,8)"
    with pytest.raises(FileNotFoundError):
        load_contract(str(tmp_path / "absent.yaml"))
    assert DataContract.from_mapping({**RAW, "primary_key": "source_id"}).primary_key == ("source_id",)
    with pytest.raises(ContractError, match="owner.*schema"):
        DataContract.from_mapping({**RAW, "owner": None, "schema": ["value"]})


def test_moves_of_decimals_and_zero(spark):
    rows = [("s", NOW + dt.timedelta(hours=k), Decimal(v)) for k, v in enumerate(("0", "5", "500", "0"))]
    frame = spark.createDataFrame(rows, "s string, at timestamp, value decimal(28,8)")
    found = adjacency.extreme_moves(frame, ["s"], F.col("at"), F.col("value")).collect()
    assert [(r.from_value, r.to_value) for r in found] == [(5.0, 500.0)]


def test_equal_nans_are_no_change_whatever_the_partitions(spark):
    frame = spark.range(40).selectExpr("'s' as s", "id", "double('nan') as v")
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 8):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert adjacency.changes(frame, ["s"], ["id"], ["v"]).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_fingerprint_tells_separators_and_nulls_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("x", None), (None, "x"), (None, None), ("", "")]
    frame = spark.createDataFrame(rows, "a string, b string")
    assert frame.select(keys.row_fingerprint("a", "b").alias("f")).distinct().count() == len(rows)


def test_typed_records(spark):
    _, records = batches_of(spark, {"b": [BASE]})
    row = records.select(*typed_record(CONTRACT)).first()
    assert row.value == Decimal("812.25000000") and row.realtime_start == dt.date(2024, 1, 15)


def test_reconciliation_and_dangling_counts(spark):
    facts = spark.createDataFrame([("a", 1), ("a", 9), ("a", 9), ("b", None)], "batch string, k int")
    dims = spark.createDataFrame([(1,), (1,)], "id int")
    counts = {r.batch: r.dangling_rows for r in sets.dangling_counts(facts, ["batch"], "k", dims, "id").collect()}
    assert counts == {"a": 2, "b": 1}


DAY = st.one_of(
    st.dates(dt.date(1000, 1, 1), dt.date(9998, 12, 31)).map(str),
    st.dates(dt.date(1000, 1, 1), dt.date(9998, 12, 31)).map(lambda d: d.strftime("%Y%m%d")),
    st.dates(dt.date(1000, 1, 1), dt.date(9998, 12, 31)).map(lambda d: "%d-W%02d-%d" % d.isocalendar()),
    st.from_regex(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\Z"),
    st.from_regex(r"\A2020W[0-9]{2}[0-9]?\Z"),
)
CLOCK = st.from_regex(r"\A(?:[0-2][0-9](?::[0-6][0-9](?::[0-6][0-9](?:[.,][0-9]{1,7})?)?)?|[0-2][0-9][0-6][0-9](?:[0-6][0-9])?)\Z")
ZONE = st.sampled_from(["", "Z", "+00:00", "-05:30", "+14", "+0530", "-17:59"])
MOMENT = st.one_of(DAY, st.tuples(DAY, st.sampled_from("T _"), CLOCK, ZONE).map("".join), st.text(max_size=12))
NUMBER = st.one_of(
    st.from_regex(r"\A\s?[+-]?[0-9_]{0,4}\.?[0-9_]{0,4}(?:[eE][+-]?[0-9]{1,2})?\s?\Z"),
    st.sampled_from(["NaN", "sNaN", "Infinity", "-inf", "1d", "0x1", "", " ", ".", "1e", "nan5", "1,000"]),
)


def texts(strategy, n):
    found: set[str] = set()

    @settings(max_examples=n, database=None, deadline=None, derandomize=True)
    @given(strategy)
    def gather(text):
        found.add(text)

    gather()
    return sorted(t for t in found if "\x00" not in t and t.isascii())


def test_dates_and_instants_like_the_standard_library(spark):
    def day(t):
        try:
            return dt.date.fromisoformat(t)
        except ValueError:
            return None

    def instant(t):
        try:
            v = dt.datetime.fromisoformat(t.replace("Z", "+00:00"))
        except ValueError:
            return None
        return v.replace(tzinfo=None) - (v.utcoffset() or timedelta(0))

    frame = spark.createDataFrame([(t,) for t in texts(MOMENT, 1500)], "t string")
    got = frame.select(
        "t", periods.iso_date("t").alias("d"), periods.iso_instant("t").cast("timestamp_ntz").alias("i")
    )
    wrong = [(r.t, r.d, r.i) for r in got.collect() if (r.d, r.i) != (day(r.t), instant(r.t))]
    assert wrong == []


def test_numbers_like_the_standard_library(spark):
    def is_decimal(t):
        try:
            Decimal(t)
        except InvalidOperation:
            return False
        return True

    def as_float(t):
        try:
            return float(t)
        except ValueError:
            return None

    frame = spark.createDataFrame([(t,) for t in texts(NUMBER, 800)], "t string")
    got = frame.select("t", R.is_decimal_text(F.col("t")).alias("d"), R.float_of_text(F.col("t")).alias("f"))
    for r in got.collect():
        assert r.d == is_decimal(r.t), r.t
        expected = as_float(r.t)
        same = r.f == expected or (expected is not None and r.f is not None and math.isnan(r.f) and math.isnan(expected))
        assert same, r.t


def brute_force(points, threshold):
    out = []
    for series in sorted({p[0] for p in points}):
        ordered = sorted(p[1:] for p in points if p[0] == series)
        for (a, _, v), (b, i, w) in zip(ordered, ordered[1:], strict=False):
            with_zero = v == 0
            if not with_zero and abs((w - v) / v) * 100 > threshold:
                out.append((series, i, a, b))
    return sorted(out)


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_extreme_moves_across_ranges(spark, partitions):
    """One series holds most rows, so it spreads over ranges and pairs straddle their edges."""
    special = [0.0, float("nan"), float("inf"), -1.0, 1.0, 50.0, 3000.0]
    points = [
        ("hot" if n % 10 else f"cold{n % 7}", n // 2, n, special[(n * 37) % 7] if n % 3 else float(n % 5 + 1))
        for n in range(3000)
    ]
    rows_ = [(s, dt.datetime(2024, 1, 1) + timedelta(seconds=t), i, v) for s, t, i, v in points]
    frame = spark.createDataFrame(rows_, "s string, t timestamp, i long, v double")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        moves = adjacency.extreme_moves(frame, ["s"], F.col("t"), F.col("v"), ["i"], 1000.0).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    start = dt.datetime(2024, 1, 1)
    got = sorted((m.s, m.i, (m.from_at - start).seconds, (m.to_at - start).seconds) for m in moves)
    assert got == brute_force(points, 1000.0) and got


def test_extreme_moves_of_nothing(spark):
    frame = spark.createDataFrame([], "s string, t timestamp, v double")
    assert adjacency.extreme_moves(frame, ["s"], F.col("t"), F.col("v")).count() == 0
