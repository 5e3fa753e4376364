"""Row-level rules: narrow expressions over dynamically typed records, no shuffle.

A record set has ``batch_id`` and ``record`` (VARIANT, field names as in the contract).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import DataContract
from tidemark.functions import records as R

OHLC = ("open", "high", "low", "close")


def from_json_text(df: DataFrame, batch_id: str, text: str) -> DataFrame:
    """Records from JSON text; text that is no JSON object becomes an empty record."""
    parsed = F.when(F.col(text).rlike(r"^\s*\{"), F.try_parse_json(text))
    return df.select(
        F.col(batch_id).alias("batch_id"),
        F.coalesce(parsed, F.parse_json(F.lit("{}"))).alias("record"),
    )


def from_columns(df: DataFrame, batch_id: str | Column, fields: Mapping[str, Column]) -> DataFrame:
    """Records from typed columns; native dates, timestamps and numbers keep their type."""
    batch = F.col(batch_id) if isinstance(batch_id, str) else batch_id
    packed = F.to_variant_object(F.struct(*[c.alias(n) for n, c in fields.items()]))
    return df.select(batch.alias("batch_id"), packed.alias("record"))


def from_observations(parsed: DataFrame, series_id: Column) -> DataFrame:
    """Contract-shaped records of parsed observation payloads, one batch per raw object.

    Shares the parse step with Silver, so a payload is decoded once for both.
    """
    return from_columns(
        parsed,
        "bronze_id",
        {
            "observed_at": F.concat("date_text", F.lit("T00:00:00+00:00")),
            "value": F.col("value_text"),
            "source_id": F.col("source_id"),
            "series_id": series_id,
            "realtime_start": F.col("vintage_text"),
            "realtime_end": F.col("vintage_text"),
        },
    )


def schema_findings(contract: DataContract) -> dict[str, Column]:
    """Missing and extra field names, and present fields whose value does not fit, each sorted."""
    declared = F.array(*[F.lit(n) for n in sorted(contract.schema)])
    present = R.field_names("record")
    misfits = [
        F.when(R.field(name).present & ~R.field(name).matches(spec), F.lit(name))
        for name, spec in sorted(contract.schema.items())
    ]
    return {
        "missing": F.array_except(declared, present),
        "extra": F.sort_array(F.array_except(present, declared)),
        "type_errors": R.without_nulls(misfits),
    }


def check_schema(records: DataFrame, contract: DataContract) -> DataFrame:
    """Adds the three findings and ``schema_bad`` (and the unpacked fields they rest on)."""
    found = R.unpack(records, contract.schema).withColumns(schema_findings(contract))
    bad = (F.size("missing") > 0) | (F.size("extra") > 0) | (F.size("type_errors") > 0)
    return found.withColumn("schema_bad", bad)


def schema_violations(records: DataFrame, contract: DataContract) -> DataFrame:
    """Records outside the contract with what is wrong about each."""
    found = check_schema(records, contract)
    return R.keep(
        found.select("batch_id", "record", "missing", "extra", "type_errors", "schema_bad"), F.col("schema_bad")
    ).drop("schema_bad")


def value_violation(value: Column) -> Column:
    """Not a number counts as no violation: every comparison with it is false."""
    return F.coalesce((value <= 0) & ~F.isnan(value), F.lit(False))


def ohlc_violation(open_: Column, high: Column, low: Column, close: Column) -> Column:
    """Violation unless low <= open <= high and low <= close <= high; a bar with a gap is ignored.

    A bar holding NaN fails every comparison and so is a violation.
    """
    has_nan = F.isnan(open_) | F.isnan(high) | F.isnan(low) | F.isnan(close)
    ordered = (low <= open_) & (open_ <= high) & (low <= close) & (close <= high)
    complete = open_.isNotNull() & high.isNotNull() & low.isNotNull() & close.isNotNull()
    return complete & (has_nan | ~ordered)


def volume_violation(volume: Column) -> Column:
    return F.coalesce((volume < 0) & ~F.isnan(volume), F.lit(False))


def range_flags(contract: DataContract) -> dict[str, Column]:
    """Range rules a contract declares, over unpacked records; others are absent from the result."""
    flags: dict[str, Column] = {}
    if contract.checks_positive_value:
        flags["value_bad"] = value_violation(R.field("value").as_float())
    if contract.checks_ohlc:
        flags["ohlc_bad"] = ohlc_violation(*[R.field(n).as_float() for n in OHLC])
    if contract.checks_volume:
        flags["volume_bad"] = volume_violation(R.field("volume").as_float())
    return flags


def row_flags(records: DataFrame, contract: DataContract) -> DataFrame:
    """All row-level rules in one pass."""
    return check_schema(records, contract).withColumns(range_flags(contract))


def quality_status(bad: Sequence[Column], flagged: Sequence[Column]) -> Column:
    """Row status a consumer sees: quarantined before flagged before ok."""
    status = F.lit("ok")
    for condition in flagged:
        status = F.when(F.coalesce(condition, F.lit(False)), "flagged").otherwise(status)
    for condition in bad:
        status = F.when(F.coalesce(condition, F.lit(False)), "quarantined").otherwise(status)
    return status
