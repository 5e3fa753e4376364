"""Reading dynamically typed records: one VARIANT column keeps JSON types and unknown keys."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import periods

# Fixed patterns: number text accepted for decimal fields and for float comparisons.
_BLANK = r"[\s\x85\p{Z}]"
_DECIMAL_BLANK = r"[\s\x1c-\x1f\x85\p{Z}]"
_DECIMAL_TEXT = rf"(?i)^{_DECIMAL_BLANK}*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?|s?nan\d*){_DECIMAL_BLANK}*$"
_DIGITS = r"\d+(?:_\d+)*"
_FLOAT_TEXT = (
    rf"(?i)^{_BLANK}*[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    rf"|inf(?:inity)?|nan){_BLANK}*$"
)


TYPE, TEXT = "_type_", "_text_"


@dataclass(frozen=True)
class Field:
    """One unpacked field: its variant type name (null when absent) and its value as text."""

    type: Column
    text: Column

    @property
    def present(self) -> Column:
        return self.type.isNotNull()

    @property
    def is_text(self) -> Column:
        return self.type == "STRING"

    @property
    def is_number(self) -> Column:
        return self.type.rlike("^(?:BIGINT|DOUBLE|FLOAT|DECIMAL)")

    @property
    def is_timestamp(self) -> Column:
        return self.type.startswith("TIMESTAMP")

    def as_float(self) -> Column:
        return F.when(self.is_text | self.is_number, float_of_text(self.text)).when(
            self.type == "BOOLEAN", F.when(self.text == "true", 1.0).otherwise(0.0)
        )

    def as_instant(self) -> Column:
        """Instant of a text or native timestamp; a native date is not an instant."""
        return F.when(self.is_text, periods.iso_instant(self.text)).when(
            self.is_timestamp, self.text.try_cast("timestamp")
        )

    def identity(self) -> Column:
        """Comparable form of the raw value: its type class and text, so 1 and "1" stay distinct."""
        number = F.coalesce(self.text.try_cast("double").cast("string"), self.text)
        return (
            F.when(self.is_text, F.concat(F.lit("text:"), self.text))
            .when(self.is_number, F.concat(F.lit("number:"), number))
            .when(self.type != "VOID", F.concat(self.type, F.lit(":"), self.text))
        )

    def matches(self, spec: str) -> Column:
        """Does the value fit a contract type? Null never fits; an unknown type always does."""
        spec = spec.strip().lower()
        if spec == "string":
            fits = self.is_text
        elif spec.startswith("decimal"):
            fits = self.is_number | (self.is_text & is_decimal_text(self.text))
        elif spec == "date":
            fits = (self.type == "DATE") | (self.is_text & periods.iso_date(self.text).isNotNull())
        elif spec == "timestamp_utc":
            fits = self.is_timestamp | (self.is_text & periods.iso_instant(self.text).isNotNull())
        else:
            fits = self.type != "VOID"
        return F.coalesce(fits, F.lit(False))


def path(name: str) -> str:
    return f'$["{name}"]'


def unpack(records: DataFrame, names: Iterable[str], record: str = "record") -> DataFrame:
    """Adds type and text columns of the named fields.

    All fields come out of the variant in one go, into a projection of their own, so rules that
    use a field several times do not read the variant several times.
    """
    names = list(dict.fromkeys(names))
    shape = "struct<" + ", ".join(f"`{n}`: variant" for n in names) + ">"
    opened = records.withColumn("_fields", F.try_variant_get(record, "$", shape))
    types = {TYPE + n: F.schema_of_variant(F.col("_fields").getField(n)) for n in names}
    texts = {TEXT + n: F.col("_fields").getField(n).try_cast("string") for n in names}
    return opened.withColumns({**types, **texts}).drop("_fields")


def field(name: str) -> Field:
    """A field of an unpacked record set."""
    return Field(F.col(f"`{TYPE}{name}`"), F.col(f"`{TEXT}{name}`"))


def keep(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on computed columns, evaluated where it stands.

    A plain filter would be pushed below the projections that compute its columns, and the
    optimiser would copy their expressions into it: every record would be parsed twice.
    """
    return df.select(F.inline(F.when(condition, F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns])))))


def without_nulls(items: list[Column]) -> Column:
    """Array of the non-null items (distinct), free of the lambda that would stop code generation."""
    return F.array_except(F.array(*items), F.array(F.lit(None).cast("string")))


def field_text(record: Column | str, name: str) -> Column:
    return F.try_variant_get(record, path(name), "string")


def field_names(record: Column | str) -> Column:
    record = F.col(record) if isinstance(record, str) else record
    return F.map_keys(record.cast("map<string,variant>"))


def is_decimal_text(text: Column) -> Column:
    return F.coalesce(F.regexp_replace(text, "_", "").rlike(_DECIMAL_TEXT), F.lit(False))


def float_of_text(text: Column) -> Column:
    """Double from number text, null for anything else (Spark alone would accept '1d')."""
    return F.when(text.rlike(_FLOAT_TEXT), F.regexp_replace(text, rf"{_BLANK}|_", "").try_cast("double"))
