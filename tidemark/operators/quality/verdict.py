"""Nine rules over many batches, a verdict per batch, and routing on it.

Row-level findings, duplicate keys and freshness come out of one scan: rows are reduced to one
per (batch, primary key), then to one per batch. The other rules add one reduced frame each.
Everything after that is batch-sized.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import DataContract
from tidemark.functions import records as R
from tidemark.operators import adjacency
from tidemark.operators.quality import reconcile, rows, sets

# Rule identifiers.
SCHEMA, COMPLETENESS, UNIQUENESS, FRESHNESS, RANGE = (f"FR-QUAL-00{n}" for n in range(1, 6))
REFERENTIAL, RECONCILIATION, OUTLIER, SEMANTIC = (f"FR-QUAL-00{n}" for n in range(6, 10))
ALL_RULES = (
    SCHEMA,
    COMPLETENESS,
    UNIQUENESS,
    FRESHNESS,
    RANGE,
    REFERENTIAL,
    RECONCILIATION,
    OUTLIER,
    SEMANTIC,
)


Stage = Callable[[DataFrame], DataFrame]


def evaluate(
    batches: DataFrame,
    records: DataFrame,
    contract: DataContract,
    *,
    expected: DataFrame | None = None,
    key_field: str = "observed_at",
    now: datetime | None = None,
    max_lag: timedelta | None = None,
    known_keys: Mapping[str, DataFrame] | None = None,
    source_control: DataFrame | None = None,
    threshold_pct: float = 1000.0,
    stage: Stage | None = None,
) -> DataFrame:
    """One row per batch and rule: ``batch_id, rule_id, status, failed_rows, message``.

    ``batches`` lists every batch (``batch_id``), including ones without records.
    ``expected`` is a calendar (``batch_id``, ``expected_key`` text); batches not in it are skipped.
    ``known_keys`` maps a field to a one-column frame of valid values. ``source_control`` has
    ``batch_id, source_count, source_checksum`` (see ``reconcile.checksums``); unless it brings a
    ``local_checksum``, that is computed in the scan of the records. Context that is not given leaves its
    rule skipped, never passed.

    ``stage`` stores the parsed form of the records between parsing and the rules (for example
    ``tables.staged``); without it each rule that needs its own grouping parses them again.
    """
    summed = source_control is not None and "local_checksum" not in source_control.columns
    shaped = _shape(records, contract, key_field, list(known_keys or ()), summed)
    if stage is not None:
        shaped = stage(shaped)
    wide = (
        batches.select("batch_id")
        .distinct()
        .join(_scan(shaped, contract), "batch_id", "left")
        .withColumn("records", F.coalesce("records", F.lit(0)))
    )
    if expected is not None:
        wide = wide.join(_completeness(expected, shaped), "batch_id", "left")
    if known_keys:
        wide = wide.join(_referential(shaped, known_keys), "batch_id", "left")
    if source_control is not None:
        wide = wide.join(source_control, "batch_id", "left")
    if "value" in contract.schema:
        wide = wide.join(_outliers(shaped, contract, threshold_pct), "batch_id", "left")
    results = F.array(
        _schema_result(),
        _completeness_result(expected is not None),
        _counted(UNIQUENESS, F.col("duplicate_keys"), "failed", "duplicated primary keys"),
        _freshness_result(now, max_lag),
        _range_result(contract),
        _referential_result(bool(known_keys)),
        _reconciliation_result(source_control is not None),
        _outlier_result("value" in contract.schema),
        _semantic_result(contract),
    )
    return wide.select("batch_id", F.inline(results))


def _shape(
    records: DataFrame, contract: DataContract, key_field: str, known: list[str], summed: bool = False
) -> DataFrame:
    """What the rules need of each record, in narrow typed columns; the record itself stays behind."""
    names = [*contract.schema, *contract.primary_key, "observed_at", "value", key_field, *known]
    fields = R.unpack(records, names)
    findings = rows.schema_findings(contract)
    flags = rows.range_flags(contract)
    return fields.select(
        "batch_id",
        *[R.field(n).identity().alias(f"key_{n}") for n in contract.primary_key],
        *[F.struct(R.field(n).present.alias("present"), R.field(n).text.alias("text")).alias(f"fk_{n}") for n in known],
        R.field(key_field).text.alias("expected_key"),
        R.field("observed_at").as_instant().alias("at"),
        R.field("value").as_float().alias("value"),
        *[flag.alias(name) for name, flag in flags.items()],
        *[(F.size(found) > 0).alias(f"has_{name}") for name, found in findings.items()],
        *([reconcile.fingerprint(contract).alias("fingerprint")] if summed else []),
    )


def _scan(shaped: DataFrame, contract: DataContract) -> DataFrame:
    key = [f"`key_{n}`" for n in contract.primary_key]
    flags = [c for c in ("value_bad", "ohlc_bad", "volume_bad") if c in shaped.columns]
    bad_range = sum((F.count_if(F.col(c)) for c in flags), F.lit(0))
    summed = "fingerprint" in shaped.columns
    bad_schema = F.col("has_missing") | F.col("has_extra") | F.col("has_type_errors")
    per_key = shaped.groupBy("batch_id", *key).agg(
        F.count("*").alias("_n"),
        F.count_if(bad_schema).alias("_schema"),
        bad_range.cast("bigint").alias("_range"),
        F.max("at").alias("_at"),
        *([F.sum("fingerprint").alias("_sum")] if summed else []),
    )
    return per_key.groupBy("batch_id").agg(
        F.sum("_n").alias("records"),
        F.sum("_schema").alias("schema_rows"),
        F.sum("_range").alias("range_rows"),
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
        F.max("_at").alias("latest"),
        *([F.sum("_sum").cast("string").alias("local_checksum")] if summed else []),
    )


def _completeness(expected: DataFrame, shaped: DataFrame) -> DataFrame:
    """Expected keys start as misses, records as hits; one aggregate per key settles both.

    Records collapse to one row per key on the map side, and no join is needed.
    """
    wanted = expected.select("batch_id", "expected_key", F.lit(1).alias("wanted"), F.lit(0).alias("seen"))
    found = shaped.select("batch_id", "expected_key", F.lit(0).alias("wanted"), F.lit(1).alias("seen"))
    per_key = (
        wanted.unionByName(found)
        .groupBy("batch_id", "expected_key")
        .agg(F.max("wanted").alias("wanted"), F.max("seen").alias("seen"))
    )
    gap = (F.col("wanted") == 1) & (F.col("seen") == 0)
    return (
        per_key.groupBy("batch_id")
        .agg(F.max("wanted").alias("wanted"), F.count_if(gap).alias("missing_rows"))
        .select("batch_id", F.when(F.col("wanted") == 1, F.col("missing_rows")).alias("missing_rows"))
    )


def _referential(shaped: DataFrame, known_keys: Mapping[str, DataFrame]) -> DataFrame:
    """Fields are unfolded in place, so all foreign keys share one scan and one anti join, which
    sees one row per (batch, field, key)."""
    fields = F.array(
        *[
            F.struct(
                F.lit(name).alias("field"),
                F.col(f"`fk_{name}`.present").alias("present"),
                F.col(f"`fk_{name}`.text").alias("key"),
            )
            for name in known_keys
        ]
    )
    present = shaped.select("batch_id", F.inline(fields)).where("present")
    per_key = present.groupBy("batch_id", "field", "key").agg(F.count("*").alias("n"))
    known = None
    for name, frame in known_keys.items():
        values = frame.select(
            F.lit(name).alias("field"), F.col(frame.columns[0]).cast("string").alias("key")
        ).distinct()
        known = values if known is None else known.unionByName(values)
    return (
        per_key.join(known, ["field", "key"], "left_anti")
        .groupBy("batch_id")
        .agg(F.sum("n").alias("dangling_rows"))
    )


def _outliers(shaped: DataFrame, contract: DataContract, threshold_pct: float) -> DataFrame:
    series = [f"key_{n}" for n in contract.series_key()]
    narrow = shaped.select("batch_id", *[f"`{c}`" for c in series], "at", "value")
    readable = R.keep(narrow, F.col("at").isNotNull() & F.col("value").isNotNull())
    moves = adjacency.extreme_moves(
        readable, ["batch_id", *series], F.col("at"), F.col("value"), ["value"], threshold_pct
    )
    return moves.groupBy("batch_id").agg(F.count("*").alias("outlier_rows"))


def _result(rule: str, status: Column, failed: Column, message: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule_id"),
        status.alias("status"),
        F.coalesce(failed, F.lit(0)).cast("bigint").alias("failed_rows"),
        message.alias("message"),
    )


def _skipped(rule: str, why: str) -> Column:
    return _result(rule, F.lit("skipped"), F.lit(0), F.lit(why))


def _counted(rule: str, count: Column, bad_status: str, what: str) -> Column:
    count = F.coalesce(count, F.lit(0))
    return _result(
        rule,
        F.when(count > 0, bad_status).otherwise("passed"),
        count,
        F.format_string(f"%d {what}", count.cast("bigint")),
    )


def _schema_result() -> Column:
    return _counted(SCHEMA, F.col("schema_rows"), "failed", "records outside the contract schema")


def _completeness_result(given: bool) -> Column:
    if not given:
        return _skipped(COMPLETENESS, "no calendar of expected keys given")
    base = _counted(COMPLETENESS, F.col("missing_rows"), "failed", "expected records missing")
    return F.when(F.col("missing_rows").isNull(), _skipped(COMPLETENESS, "no calendar of expected keys given")).otherwise(base)


def _freshness_result(now: datetime | None, max_lag: timedelta | None) -> Column:
    if max_lag is None:
        return _skipped(FRESHNESS, "no maximum lag given")
    if now is None:
        raise ValueError("freshness needs the evaluation time as well as the maximum lag")
    status = sets.freshness_status(F.col("latest"), now, max_lag)
    message = F.coalesce(
        F.concat(F.lit("latest record at "), F.date_format("latest", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.lit("no readable timestamp to judge by"),
    )
    return _result(FRESHNESS, status, F.when(status == "failed", 1).otherwise(0), message)


def _range_result(contract: DataContract) -> Column:
    if not (contract.checks_positive_value or contract.checks_ohlc or contract.checks_volume):
        return _skipped(RANGE, "the contract declares no range rule")
    return _counted(RANGE, F.col("range_rows"), "failed", "range violations")


def _referential_result(given: bool) -> Column:
    if not given:
        return _skipped(REFERENTIAL, "no dimension keys given")
    return _counted(REFERENTIAL, F.col("dangling_rows"), "failed", "foreign keys without a dimension row")


def _reconciliation_result(given: bool) -> Column:
    if not given:
        return _skipped(RECONCILIATION, "no source count or checksum given")
    status = sets.reconciliation_status(
        F.col("records"), F.col("source_count"), F.col("local_checksum"), F.col("source_checksum")
    )
    message = F.format_string("%d records here", F.col("records").cast("bigint"))
    return _result(RECONCILIATION, status, F.when(status == "failed", 1).otherwise(0), message)


def _outlier_result(has_value: bool) -> Column:
    if not has_value:
        return _skipped(OUTLIER, "the contract has no value field")
    counted = _counted(OUTLIER, F.col("outlier_rows"), "flagged", "extreme moves to review")
    return F.when(F.col("records") < 2, _skipped(OUTLIER, "fewer than two records")).otherwise(counted)


def _semantic_result(contract: DataContract) -> Column:
    """Same for every batch of a contract, so decided on the driver from the contract itself."""
    keys = ["units", "seasonal_adjustment", *(["index_base"] if "index_base" in contract.metadata else [])]
    gaps = [k for k in keys if not str(contract.metadata.get(k, "")).strip()]
    return _result(
        SEMANTIC,
        F.lit("failed" if gaps else "passed"),
        F.lit(len(gaps)),
        F.lit("metadata missing: " + ", ".join(gaps) if gaps else "metadata complete"),
    )


def verdicts(results: DataFrame) -> DataFrame:
    """Per batch: failed and flagged rules in order, and validated or quarantined.

    A flag alone never quarantines. Nine rows per batch at most, so the lists are bounded.
    """

    def having(status: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("status") == status, F.col("rule_id"))))

    grouped = results.groupBy("batch_id").agg(
        having("failed").alias("failed_rules"), having("flagged").alias("flagged_rules")
    )
    return grouped.withColumn(
        "outcome", F.when(F.size("failed_rules") > 0, "quarantined").otherwise("validated")
    )


def report(results: DataFrame) -> DataFrame:
    """Per batch: rules by status, and whether any failed or was flagged."""
    counts = [
        F.count_if(F.col("status") == s).alias(s) for s in ("passed", "failed", "flagged", "skipped")
    ]
    return results.groupBy("batch_id").agg(
        *counts,
        F.bool_or(F.col("status") == "failed").alias("has_failures"),
        F.bool_or(F.col("status") == "flagged").alias("has_flags"),
    )


def by_status(results: DataFrame, status: str) -> DataFrame:
    return results.where(F.col("status") == status)


def route(records: DataFrame, verdict: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(validated, quarantined) records; the verdict side has one narrow row per batch."""
    bad = verdict.where("outcome = 'quarantined'").select("batch_id")
    return (
        records.join(bad, "batch_id", "left_anti"),
        records.join(bad, "batch_id", "left_semi"),
    )


def quality_results(results: DataFrame, table_name: str, run_id: str, evaluated_at: datetime) -> DataFrame:
    """Rule outcomes of a run summed over its batches, as quality-result rows.

    passed, failed and flagged become pass, fail and warn; a rule skipped everywhere has no row.
    """
    ran = results.where("status <> 'skipped'").groupBy("rule_id").agg(
        F.bool_or(F.col("status") == "failed").alias("failed"),
        F.bool_or(F.col("status") == "flagged").alias("flagged"),
        F.sum("failed_rows").alias("failed_rows"),
    )
    return ran.select(
        F.col("rule_id").alias("test_id"),
        F.lit(table_name).alias("table_name"),
        F.lit(run_id).alias("run_id"),
        F.when(F.col("failed"), "fail").when(F.col("flagged"), "warn").otherwise("pass").alias("status"),
        F.col("failed_rows").cast("bigint").alias("failed_rows"),
        F.lit(evaluated_at).cast("timestamp").alias("evaluated_at"),
    )
