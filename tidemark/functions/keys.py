"""Content addresses, deterministic ids and order-independent checksums."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layout of a raw object key and the text a request hash is taken over.
KEY_PATTERN = r"raw/([^/]+)/([^/]+)/date=(\d{4}-\d{2}-\d{2})/([0-9a-f]{64})\.json"
REQUEST_TEMPLATE = "GET %s/series/observations?series_id=%s"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def payload_sha256(payload: Column | str) -> Column:
    return F.sha2(_col(payload), 256)


def object_key(source: Column | str, dataset: Column | str, day: Column | str, sha: Column | str) -> Column:
    return F.format_string(
        "raw/%s/%s/date=%s/%s.json",
        _col(source),
        _col(dataset),
        F.date_format(_col(day), "yyyy-MM-dd"),
        _col(sha),
    )


def key_parts(path: Column | str) -> dict[str, Column]:
    """Lineage read back from a raw object key or a full path ending in one."""
    path = _col(path)
    return {
        "source_id": F.regexp_extract(path, KEY_PATTERN, 1),
        "dataset_id": F.regexp_extract(path, KEY_PATTERN, 2),
        "landed_on": F.regexp_extract(path, KEY_PATTERN, 3).try_cast("date"),
        "raw_sha256": F.regexp_extract(path, KEY_PATTERN, 4),
    }


def bronze_id(key: Column | str) -> Column:
    return F.sha2(_col(key), 256)


def derived_id(*parts: Column | str) -> Column:
    """Id that a retried task recomputes identically, unlike a random uuid."""
    return F.sha2(_unambiguous(parts), 256)


def _unambiguous(columns: Iterable[Column | str]) -> Column:
    """Each value after its length, and null as a sign of its own: neither separators in the data nor
    nulls make different rows look alike."""
    texts = [_col(c).cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def request_hash(
    base_url: Column | str,
    series_id: Column | str,
    realtime_start: Column | str | None = None,
    realtime_end: Column | str | None = None,
) -> Column:
    """SHA-256 of the canonical request text; credentials never take part."""
    text = F.format_string(REQUEST_TEMPLATE, _col(base_url), _col(series_id))
    for name, value in (("realtime_start", realtime_start), ("realtime_end", realtime_end)):
        if value is not None:
            value = _col(value)
            given = F.coalesce(value, F.lit("")) != ""
            text = F.concat(text, F.when(given, F.concat(F.lit(f"&{name}="), value)).otherwise(""))
    return F.sha2(text, 256)


def row_fingerprint(*columns: Column | str) -> Column:
    """First 15 hex digits of the row's md5 as a bigint, cast so that sums cannot overflow."""
    return F.conv(F.substring(F.md5(_unambiguous(columns)), 1, 15), 16, 10).cast("decimal(38,0)")


def batch_checksum(*columns: Column | str) -> Column:
    """Aggregate: commutative checksum of a batch, so partial sums combine before the shuffle."""
    return F.sum(row_fingerprint(*columns))
