"""Data contracts: YAML on the driver, Spark expressions and types on the executors."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fields a contract file must have.
REQUIRED_FIELDS = ("dataset", "owner", "source", "version", "primary_key", "schema")


class ContractError(Exception):
    """The contract text is not a mapping or lacks a required field."""


def _word(value: Any) -> str:
    if value is None or isinstance(value, Mapping | list | tuple):
        raise ContractError("is missing" if value is None else "is not a single value")
    return str(value)


def _names(value: Any) -> tuple[str, ...]:
    """A list of names; one name alone counts as a list of one."""
    if value is None or isinstance(value, Mapping):
        raise ContractError("is missing" if value is None else "is not a list of names")
    return (value,) if isinstance(value, str) else tuple(map(_word, value))


def _section(value: Any) -> dict[str, Any]:
    if not isinstance(value, Mapping):
        raise ContractError("is missing" if value is None else "is not a mapping")
    return dict(value)


# Which shape each field of a contract file must have.
FIELD_KINDS = {
    **dict.fromkeys(("dataset", "owner", "source", "version", "freshness_slo"), _word),
    **dict.fromkeys(("primary_key", "quality_rules"), _names),
    **dict.fromkeys(("schema", "metadata", "change_policy"), _section),
}


@dataclass(frozen=True)
class DataContract:
    dataset: str
    owner: str
    source: str
    version: str
    primary_key: tuple[str, ...]
    schema: Mapping[str, str]
    freshness_slo: str = ""
    quality_rules: tuple[str, ...] = ()
    metadata: Mapping[str, Any] = field(default_factory=dict)
    change_policy: Mapping[str, Any] = field(default_factory=dict)

    @classmethod
    def from_mapping(cls, raw: Any, origin: str = "contract") -> DataContract:
        if not isinstance(raw, Mapping):
            raise ContractError(f"{origin} does not hold a YAML mapping")
        values, faults = {}, []
        for name, kind in FIELD_KINDS.items():
            value = raw.get(name)
            if value is None and name not in REQUIRED_FIELDS:
                continue
            try:
                values[name] = kind(value)
            except ContractError as fault:
                faults.append(f"{name} {fault}")
        if faults:
            raise ContractError(f"{origin}: {'; '.join(faults)}")
        return cls(**values)

    @property
    def checks_positive_value(self) -> bool:
        return "value_positive" in self.quality_rules and "value" in self.schema

    @property
    def checks_ohlc(self) -> bool:
        return {"open", "high", "low", "close"} <= set(self.schema)

    @property
    def checks_volume(self) -> bool:
        return "nonnegative_volume" in self.quality_rules and "volume" in self.schema

    def series_key(self, timestamp_field: str = "observed_at") -> tuple[str, ...]:
        """Primary key without its time field: what identifies one series in a batch."""
        return tuple(k for k in self.primary_key if k != timestamp_field)

    def struct_type(self) -> T.StructType:
        """Typed form of the contract schema, for writing validated records."""
        return T.StructType([T.StructField(n, spark_type(t), True) for n, t in self.schema.items()])


def spark_type(spec: str) -> T.DataType:
    text = spec.strip().lower()
    if text.startswith("decimal"):
        inner = text[len("decimal") :].strip(" ()")
        if not inner:
            return T.DecimalType(28, 8)
        precision, _, scale = inner.partition(",")
        return T.DecimalType(int(precision), int(scale or 0))
    return {"date": T.DateType(), "timestamp_utc": T.TimestampType()}.get(text, T.StringType())


def load_contract(path: str) -> DataContract:
    with open(path, encoding="utf-8") as handle:
        return DataContract.from_mapping(yaml.safe_load(handle), origin=str(path))


def contracts_frame(spark: SparkSession, contracts: Iterable[DataContract]) -> DataFrame:
    """One row per contract, so metadata rules run as a query over all of them.

    Goes through Arrow so the optimiser sees the true (small) size of the relation.
    """
    contracts = list(contracts)
    text = pa.string()
    table = pa.table(
        {
            "dataset_id": pa.array([c.dataset for c in contracts], text),
            "source_id": pa.array([c.source for c in contracts], text),
            "owner": pa.array([c.owner for c in contracts], text),
            "contract_version": pa.array([c.version for c in contracts], text),
            "units": pa.array([_text(c.metadata, "units") for c in contracts], text),
            "seasonal_adjustment": pa.array(
                [_text(c.metadata, "seasonal_adjustment") for c in contracts], text
            ),
            "index_base": pa.array([_text(c.metadata, "index_base") for c in contracts], text),
            "has_index_base": pa.array(["index_base" in c.metadata for c in contracts], pa.bool_()),
        }
    )
    return spark.createDataFrame(table)


def _text(metadata: Mapping[str, Any], key: str) -> str | None:
    return None if key not in metadata else str(metadata[key])


def typed_record(contract: DataContract, record: str = "record") -> list:
    """Columns of a validated variant record in the contract's types."""
    out = []
    for name, spec in contract.schema.items():
        kind = spark_type(spec).simpleString()
        out.append(F.try_variant_get(record, f'$["{name}"]', "string").try_cast(kind).alias(name))
    return out
