"""Table schemas and enumerations of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, B, D, TS = (
    T.StringType(),
    T.IntegerType(),
    T.BooleanType(),
    T.DateType(),
    T.TimestampType(),
)


def _table(*columns: tuple) -> T.StructType:
    """Columns as (name, type) when required, (name, type, True) when nullable."""
    return T.StructType([T.StructField(c[0], c[1], len(c) > 2 and c[2]) for c in columns])


BRONZE = _table(
    ("bronze_id", S),
    ("source_id", S),
    ("dataset_id", S),
    ("raw_object_key", S),
    ("raw_sha256", S),
    ("retrieved_at", TS),
    ("code_version", S),
    ("ingested_at", TS),
    ("payload", T.BinaryType()),
)

DIM_SOURCE = _table(
    ("source_id", S),
    ("publisher", S, True),
    ("license_url", S, True),
    ("terms_version", S, True),
    ("redistribution_allowed", B, True),
    ("attribution_text", S, True),
    ("trust_tier", S, True),
    ("rate_limit_notes", S, True),
    ("source_retrieved_at", TS, True),
)

DIM_INDICATOR = _table(
    ("indicator_id", S),
    ("name", S, True),
    ("unit", S, True),
    ("seasonal_adjustment", S, True),
    ("methodology_url", S, True),
)

DATASET_INDICATOR_MAP = _table(
    ("dataset_id", S),
    ("source_id", S, True),
    ("indicator_id", S),
    ("geo_code", S),
    ("frequency", S, True),
)

DIM_DATASET = _table(
    ("dataset_id", S),
    ("source_id", S),
    ("frequency", S, True),
    ("update_policy", S, True),
    ("owner", S, True),
    ("contract_version", S, True),
)

DIM_INSTRUMENT = _table(
    ("instrument_id", S),
    ("symbol", S),
    ("isin", S, True),
    ("asset_class", S),
    ("exchange_code", S, True),
)

OBSERVATION = _table(
    ("indicator_id", S),
    ("geo_code", S),
    ("period", S),
    ("period_start", D),
    ("period_end", D),
    ("vintage_date", D),
    ("value", T.DecimalType(28, 8)),
    ("unit", S, True),
    ("seasonal_adjustment", S, True),
    ("published_at", TS, True),
    ("retrieved_at", TS),
    ("processed_at", TS),
)

# The stored form also names the Bronze row a value came from.
STORED_OBSERVATION = T.StructType([*OBSERVATION.fields, T.StructField("bronze_id", S, False)])

KPI = _table(
    ("indicator_id", S),
    ("geo_code", S),
    ("period", S),
    ("period_start", D),
    ("value", T.DecimalType(28, 8)),
    ("mom_pct_change", T.DoubleType(), True),
    ("yoy_pct_change", T.DoubleType(), True),
)

MARKET_OHLCV = _table(
    ("source_id", S),
    ("instrument_id", S),
    ("interval", S),
    ("observed_at", TS),
    ("open", T.DecimalType(20, 8)),
    ("high", T.DecimalType(20, 8)),
    ("low", T.DecimalType(20, 8)),
    ("close", T.DecimalType(20, 8)),
    ("volume", T.DecimalType(28, 8)),
    ("data_quality_status", S, True),
)

TRADE_OBSERVATION = _table(
    ("reporter", S),
    ("partner", S),
    ("commodity_code", S),
    ("period", S),
    ("trade_value", T.DecimalType(28, 2)),
    ("trade_flow", S),
)

CRYPTO_MARKET = _table(
    ("asset_id", S),
    ("observed_at", TS),
    ("price", T.DecimalType(28, 10)),
    ("market_cap", T.DecimalType(28, 2), True),
    ("volume_24h", T.DecimalType(28, 2), True),
    ("data_quality_status", S, True),
)

INGESTION_RUN = _table(
    ("run_id", S),
    ("dataset_id", S),
    ("connector_version", S),
    ("started_at", TS),
    ("finished_at", TS),
    ("status", S),
    ("request_hash", S),
    ("retry_count", I),
    ("raw_storage_path", S, True),
    ("error", S, True),
)

QUALITY_RESULT = _table(
    ("test_id", S),
    ("table_name", S),
    ("run_id", S),
    ("status", S),
    ("failed_rows", T.LongType()),
    ("evaluated_at", TS),
)

DLQ = _table(
    ("event_id", S),
    ("event_type", S),
    ("producer", S),
    ("dataset_id", S),
    ("correlation_id", S, True),
    ("payload_reference", S, True),
    ("metadata", S, True),
    ("failure_reason", S),
    ("quarantined_at", TS),
    ("status", S),
    ("replayed_at", TS, True),
)

DLQ_REPLAY = _table(("event_id", S), ("replayed_at", TS))

EVENT = _table(
    ("event_id", S),
    ("event_type", S),
    ("occurred_at", TS),
    ("producer", S),
    ("schema_version", S),
    ("dataset_id", S),
    ("correlation_id", S, True),
    ("payload_reference", S, True),
    ("metadata", S, True),
)

RETRIEVAL = _table(("raw_object_key", S), ("retrieved_at", TS))

# Named columns of landed objects, without their bytes.
OBJECT_NAME = _table(
    ("raw_object_key", S),
    ("path", S),
    ("source_id", S),
    ("dataset_id", S),
    ("raw_sha256", S),
    ("retrieved_at", TS),
    ("length", T.LongType()),
)

BATCH_VERDICT = _table(
    ("batch_id", S),
    ("raw_object_key", S),
    ("dataset_id", S),
    ("failed_rules", T.ArrayType(S)),
    ("flagged_rules", T.ArrayType(S)),
    ("outcome", S),
    ("attempt", I),
    ("judged_at", TS),
)

ALERT = _table(
    ("alert_id", S),
    ("alert_type", S),
    ("dataset_id", S),
    ("message", S),
    ("details", S, True),
)

# Primary keys of the model.
OBSERVATION_KEY = ("indicator_id", "geo_code", "period", "vintage_date")
OHLCV_KEY = ("source_id", "instrument_id", "interval", "observed_at")
TRADE_KEY = ("reporter", "partner", "commodity_code", "period")
QUALITY_RESULT_KEY = ("test_id", "table_name")

# Enumerations of the model.
TRUST_TIERS = ("official", "licensed_commercial", "reputable_media_analytics", "community_unofficial")
SEASONAL_ADJUSTMENTS = ("sa", "nsa", "unknown")
FREQUENCIES = ("realtime", "daily", "weekly", "monthly", "quarterly", "annual")
ASSET_CLASSES = ("equity", "etf", "index", "fx", "crypto", "bond")
BAR_INTERVALS = ("1m", "5m", "1h", "1d")
TRADE_FLOWS = ("import", "export")
DATA_QUALITY_STATUSES = ("ok", "flagged", "quarantined")
RUN_STATUSES = ("success", "failed", "partial", "quarantined")
QUALITY_STATUSES = ("pass", "fail", "warn")
DLQ_STATUSES = ("pending", "replayed")
RULE_STATUSES = ("passed", "failed", "flagged", "skipped")
EVENT_SCHEMA_VERSION = "1.0.0"
EVENT_TYPES = (
    "schedule.triggered",
    "ingestion.requested",
    "raw_data.received",
    "raw_data.validated",
    "raw_data.quarantined",
    "bronze_data.written",
    "silver_data.transformed",
    "gold_data.published",
    "data_product.ready",
)
