"""Adapters: star-schema and event tables given the shapes of the data model.

They only rename, cast and aggregate the given tables; nothing is generated.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.contracts import DataContract
from tidemark.functions import keys, periods
from tidemark.functions.records import without_nulls
from tidemark.operators import bronze, events, serve, silver
from tidemark.session import tune
from tidemark.sources import landing

RUN_AT = datetime(2002, 2, 1, tzinfo=timezone.utc)
NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
CODE_VERSION = "1.0.0"
SALES_SOURCE = "orders_feed"
SHIPMENTS_SOURCE = "shipments_feed"


_SCHEMAS: dict[str, T.StructType] = {}


class Star:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        path = f"{self.sf_dir}/{name}.parquet"
        # A table is opened once and its schema inferred once: inference is a job of its own.
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        table = self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        setattr(self, name, table)
        return table


def vintage_digit() -> Column:
    """Leading digit of the order priority: days after month end at which a value became known."""
    return F.substring("o_orderpriority", 1, 1).cast("int")


def places(star: Star) -> DataFrame:
    """Customers with their region: two small dimensions joined first, then the customers."""
    nations = star.nation.join(star.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "r_name"
    )
    return star.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("c_mktsegment").alias("indicator_id"), F.col("r_name").alias("geo_code")
    )


def monthly_sales(star: Star, by_priority: bool = True) -> DataFrame:
    """Order value per segment, region and month (and priority)."""
    grain = ["indicator_id", "geo_code", "period_start", *(["digit"] if by_priority else [])]
    return (
        star.orders.join(places(star), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "indicator_id",
            "geo_code",
            F.trunc("o_orderdate", "MM").alias("period_start"),
            vintage_digit().alias("digit"),
            F.col("o_totalprice").cast("decimal(28,8)").alias("value"),
        )
        .groupBy(*grain)
        .agg(F.sum("value").cast("decimal(28,8)").alias("value"))
    )


def dataset_id(prefix: str) -> Column:
    return F.lower(
        F.concat_ws(
            "_",
            F.lit(prefix),
            "indicator_id",
            F.regexp_replace("geo_code", " ", "-"),
            F.col("digit").cast("string"),
        )
    )


def retrieved_at() -> Column:
    return F.timestamp_micros(F.lit(1009843200000000) + F.col("digit").cast("bigint") * 86400000000)


def delivered_objects(star: Star) -> DataFrame:
    """Sales payloads as they might be delivered: those of machinery at the lowest priority come as credits
    (negative values), and those of building at the lowest but one lack their last byte."""
    credit = (F.col("indicator_id") == "MACHINERY") & (F.col("digit") == 5)
    sold = sales_objects(star, F.when(credit, -F.col("value")).otherwise(F.col("value")))
    cut = F.col("dataset_id").rlike("^sales_building_.*_4$")
    shorter = F.expr("substring(payload, 1, octet_length(payload) - 1)")
    return landing.address(sold.withColumn("payload", F.when(cut, shorter).otherwise(F.col("payload"))))


def sales_objects(star: Star, value: Column | None = None) -> DataFrame:
    """Monthly sales as raw JSON payloads, one per segment, region and priority.

    The payload array holds one element per calendar month, which bounds it at any data size.
    """
    item = F.struct(
        F.date_format("period_start", "yyyy-MM-dd").alias("date"),
        (F.col("value") if value is None else value).cast("string").alias("value"),
        F.date_format(F.date_add(F.last_day("period_start"), F.col("digit")), "yyyy-MM-dd").alias("realtime_start"),
    )
    payloads = (
        monthly_sales(star)
        .groupBy("indicator_id", "geo_code", "digit")
        .agg(F.sort_array(F.collect_list(item)).alias("observations"))
        .select(
            F.lit(SALES_SOURCE).alias("source_id"),
            dataset_id("sales").alias("dataset_id"),
            retrieved_at().alias("retrieved_at"),
            F.encode(F.to_json(F.struct("observations")), "UTF-8").alias("payload"),
        )
    )
    return landing.address(payloads)


def shipment_objects(star: Star) -> DataFrame:
    """A second source with other field names: shipped quantity per return flag and month."""
    monthly = (
        star.lineitem.select(
            F.col("l_returnflag").alias("flag"),
            F.trunc("l_shipdate", "MM").alias("month"),
            F.col("l_quantity").cast("decimal(28,8)").alias("quantity"),
        )
        .groupBy("flag", "month")
        .agg(F.sum("quantity").cast("decimal(28,8)").alias("quantity"))
    )
    item = F.struct(
        F.date_format("month", "yyyy-MM-dd").alias("obs_time"),
        F.col("quantity").cast("string").alias("obs_value"),
        F.date_format(F.last_day("month"), "yyyy-MM-dd").alias("released"),
    )
    payloads = (
        monthly.groupBy("flag")
        .agg(F.sort_array(F.collect_list(item)).alias("series"))
        .select(
            F.lit(SHIPMENTS_SOURCE).alias("source_id"),
            F.concat(F.lit("shipments_"), F.lower("flag")).alias("dataset_id"),
            F.timestamp_micros(F.lit(1009843200000000)).alias("retrieved_at"),
            F.encode(F.to_json(F.struct("series")), "UTF-8").alias("payload"),
        )
    )
    return landing.address(payloads)


def coded_objects(star: Star) -> DataFrame:
    """Monthly sales as index-coded payloads, one per priority: regions and segments are positions in lists.

    The list of segments of the lowest priority lacks its last entry. Lists and maps hold an element per region,
    segment or calendar month, which bounds them at any data size.
    """
    sales = monthly_sales(star).withColumn("month", F.date_format("period_start", "yyyy-MM"))
    lists = sales.groupBy("digit").agg(
        *[F.array_sort(F.collect_set(c)).alias(f"{c}s") for c in ("geo_code", "indicator_id", "month")]
    )
    place = lambda c: (F.array_position(f"{c}s", F.col(c)) - 1).cast("string")
    series = (
        sales.join(lists, "digit")
        .groupBy("digit", F.concat_ws(":", place("geo_code"), place("indicator_id")).alias("key"))
        .agg(F.map_from_entries(F.collect_list(F.struct(place("month"), F.array(F.col("value").cast("string"))))).alias("observations"))
    )
    bodies = series.groupBy("digit").agg(
        F.map_from_entries(F.collect_list(F.struct("key", F.struct("observations")))).alias("series")
    )

    def dimension(name: str, values: Column) -> Column:
        return F.struct(F.lit(name).alias("id"), F.transform(values, lambda v: F.struct(v.alias("id"))).alias("values"))

    segments = F.when(F.col("digit") == 5, F.slice("indicator_ids", 1, F.greatest(F.size("indicator_ids") - 1, F.lit(1)))).otherwise(F.col("indicator_ids"))
    payload = F.struct(
        F.struct(F.format_string("2002-01-%02d", "digit").alias("prepared")).alias("header"),
        F.struct(
            F.struct(
                F.array(dimension("REF_AREA", F.col("geo_codes")), dimension("SEGMENT", segments)).alias("series"),
                F.array(dimension("TIME_PERIOD", F.col("months"))).alias("observation"),
            ).alias("dimensions")
        ).alias("structure"),
        F.array(F.struct("series")).alias("dataSets"),
    )
    return landing.address(
        bodies.join(lists, "digit").select(
            F.lit("coded_feed").alias("source_id"),
            F.format_string("coded_%d", "digit").alias("dataset_id"),
            retrieved_at().alias("retrieved_at"),
            F.encode(F.to_json(payload), "UTF-8").alias("payload"),
        )
    )


PARSERS = {
    SALES_SOURCE: silver.OBSERVATIONS_PARSER,
    SHIPMENTS_SOURCE: silver.json_parser("series", "obs_time", "obs_value", "released"),
}
SALES_PARSERS = {SALES_SOURCE: PARSERS[SALES_SOURCE]}


def sales_map(star: Star) -> DataFrame:
    """Dataset map of the sales payloads: segments and regions that exist, five priorities each."""
    digits = F.explode(F.sequence(F.lit(1), F.lit(5)))
    pairs = places(star).select("indicator_id", "geo_code").distinct().withColumn("digit", digits)
    return pairs.select(dataset_id("sales").alias("dataset_id"), "indicator_id", "geo_code")


def shipments_map(star: Star) -> DataFrame:
    flags = star.lineitem.select(F.col("l_returnflag").alias("flag")).distinct()
    return flags.select(
        F.concat(F.lit("shipments_"), F.lower("flag")).alias("dataset_id"),
        F.concat(F.lit("SHIPPED_"), "flag").alias("indicator_id"),
        F.lit("WORLD").alias("geo_code"),
    )


def indicators(star: Star) -> DataFrame:
    segments = star.customer.select(F.col("c_mktsegment").alias("indicator_id")).distinct()
    return segments.select(
        "indicator_id",
        F.initcap("indicator_id").alias("name"),
        F.lit("usd").alias("unit"),
        F.when(F.col("indicator_id") == "BUILDING", "sa").otherwise("nsa").alias("seasonal_adjustment"),
    )


def shipment_indicators(star: Star) -> DataFrame:
    return shipments_map(star).select(
        "indicator_id",
        F.col("indicator_id").alias("name"),
        F.lit("pieces").alias("unit"),
        F.lit("unknown").alias("seasonal_adjustment"),
    )


def bronze_rows(objects: DataFrame) -> DataFrame:
    return bronze.lineage(objects, CODE_VERSION, RUN_AT)


def observations(star: Star) -> DataFrame:
    """Observation-table rows taken straight from monthly sales, every priority a vintage."""
    shaped = monthly_sales(star).select(
        "indicator_id",
        "geo_code",
        periods.period_label("period_start").alias("period"),
        "period_start",
        F.last_day("period_start").alias("period_end"),
        F.date_add(F.last_day("period_start"), F.col("digit")).alias("vintage_date"),
        "value",
        F.lit("usd").alias("unit"),
        F.when(F.col("indicator_id") == "BUILDING", "sa").otherwise("nsa").alias("seasonal_adjustment"),
        F.lit(None).cast("timestamp").alias("published_at"),
        retrieved_at().alias("retrieved_at"),
        F.lit(RUN_AT).cast("timestamp").alias("processed_at"),
    )
    return shaped


def document_objects(star: Star) -> DataFrame:
    """Documents as raw objects: source and language name the dataset, the text is the payload."""
    return landing.address(
        star.documents.select(
            "doc_id",
            F.col("source").alias("source_id"),
            F.col("lang").alias("dataset_id"),
            F.timestamp_micros(F.lit(1704067200000000) + F.col("n_chars") * 1000000).alias("retrieved_at"),
            F.encode("text", "UTF-8").alias("payload"),
        )
    )


def labelled(star: Star, objects: DataFrame) -> DataFrame:
    return objects.join(star.labels.select("doc_id"), "doc_id", "left_semi")


def prop_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def user_dataset() -> Column:
    return F.concat(F.lit("user_"), F.col("user_id").cast("string"))


def runs(star: Star) -> DataFrame:
    """Events as ingestion runs of one dataset per user; ``error`` events failed."""
    failed = F.col("event_type") == "error"
    return star.events.select(
        F.col("event_id").cast("string").alias("run_id"),
        user_dataset().alias("dataset_id"),
        F.lit(CODE_VERSION).alias("connector_version"),
        F.col("ts").alias("started_at"),
        F.timestamp_micros(
            F.unix_micros("ts") + (F.col("value").cast("decimal(20,2)") * 1000000).cast("bigint")
        ).alias("finished_at"),
        F.when(failed, "failed").when(F.col("event_type") == "signup", "partial").otherwise("success").alias("status"),
        keys.request_hash(F.lit("https://example.org"), F.col("user_id").cast("string")).alias("request_hash"),
        prop_k().alias("retry_count"),
        F.lit(None).cast("string").alias("raw_storage_path"),
        F.when(failed, F.col("props")).alias("error"),
    )


def user_datasets(star: Star) -> DataFrame:
    """Datasets that should report: every customer key no greater than the greatest user id.

    Keys without events are datasets that never ran.
    """
    greatest = star.events.agg(F.max("user_id")).scalar()
    return star.customer.where(F.col("c_custkey") <= greatest).select(
        F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("dataset_id")
    )


# Event type of the envelope each kind of source event stands for.
ENVELOPE_TYPES = {
    "signup": "ingestion.requested",
    "view": "raw_data.received",
    "click": "raw_data.validated",
    "error": "raw_data.quarantined",
    "purchase": "gold_data.published",
}


def envelopes(star: Star) -> DataFrame:
    """Events as envelopes. A quarantined one names the rules its value and ``k`` break, if any."""
    kind = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in ENVELOPE_TYPES.items()])
    broken = without_nulls(
        [F.when(prop_k() > 50, "FR-QUAL-001"), F.when(F.col("value") > 100, "FR-QUAL-005")]
    )
    rules = F.to_json(F.struct(broken.alias("failed_rules")))
    return star.events.select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("event_id"),
        kind.alias("event_type"),
        F.col("ts").alias("occurred_at"),
        F.lit("events").alias("producer"),
        F.when(prop_k() < 5, "2.0.0").otherwise("1.0.0").alias("schema_version"),
        user_dataset().alias("dataset_id"),
        F.col("event_id").cast("string").alias("correlation_id"),
        F.concat(F.lit("k/"), prop_k().cast("string")).alias("payload_reference"),
        F.when(F.col("event_type") == "error", rules).otherwise(F.col("props")).alias("metadata"),
    ).select(*events.COLUMNS)


def bars(star: Star) -> DataFrame:
    """Daily bars per event type in the columns of the OHLCV table, volume being the tick count."""
    price = F.col("value").cast("decimal(20,8)")
    built = serve.bars_from_ticks(star.events, "event_type", F.col("ts"), price, "event_id")
    return built.select(
        F.lit("events").alias("source_id"),
        "instrument_id",
        F.lit("1d").alias("interval"),
        "observed_at",
        "open",
        "high",
        "low",
        "close",
        F.col("ticks").cast("decimal(28,8)").alias("volume"),
        F.lit("ok").alias("data_quality_status"),
    )


def instruments(star: Star) -> DataFrame:
    """One instrument per event type; money-like types are crypto, the rest index."""
    kinds = star.events.select("event_type").distinct()
    return kinds.select(
        F.col("event_type").alias("instrument_id"),
        F.upper("event_type").alias("symbol"),
        F.lit(None).cast("string").alias("isin"),
        F.when(F.col("event_type") == "purchase", "crypto").otherwise("index").alias("asset_class"),
        F.lit(None).cast("string").alias("exchange_code"),
    )


def trade_rows(star: Star) -> DataFrame:
    """Trade between the customer's and the supplier's region per part type and month."""
    suppliers = star.supplier.join(star.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey"), F.col("n_name").alias("partner")
    )
    reporters = star.customer.join(star.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey"), F.col("n_name").alias("reporter")
    )
    ordered = star.orders.select("o_orderkey", "o_custkey").join(
        reporters, F.col("o_custkey") == F.col("c_custkey")
    )
    return (
        star.lineitem.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(star.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "reporter",
            "partner",
            F.col("p_type").alias("commodity_code"),
            F.date_format("l_shipdate", "yyyy-MM").alias("period"),
            F.col("l_extendedprice").cast("decimal(28,2)").alias("price"),
        )
        .groupBy(*schemas.TRADE_KEY)
        .agg(F.sum("price").cast("decimal(28,2)").alias("trade_value"))
        .withColumn("trade_flow", F.lit("import"))
    )


EVENT_CONTRACT = DataContract.from_mapping(
    {
        "dataset": "event_values",
        "owner": "events",
        "source": "events",
        "version": "1.0.0",
        "primary_key": ["series_id", "observed_at"],
        "schema": {
            "observed_at": "timestamp_utc",
            "value": "decimal(20,8)",
            "source_id": "string",
            "series_id": "string",
            "realtime_start": "date",
            "realtime_end": "date",
        },
        "quality_rules": ["value_positive"],
        "metadata": {"units": "points", "seasonal_adjustment": "nsa"},
    }
)


def event_batch() -> Column:
    return F.concat_ws("_", "event_type", F.date_format("ts", "yyyy-MM-dd"))


def event_json(star: Star) -> DataFrame:
    """Events as JSON records in daily batches per type.

    Readings are hourly and 0.10 below the event value. Some record types come with a defect:
    views with k = 0 lack ``realtime_start``, clicks with k >= 98 have unreadable values and
    signups with k = 1 carry a surplus field.
    """
    kind, k = F.col("event_type"), prop_k()
    reading = (F.col("value").cast("decimal(20,2)") - F.lit("0.10").cast("decimal(20,2)")).cast("decimal(20,2)")
    day = F.date_format("ts", "yyyy-MM-dd")
    body = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:00:00'Z'").alias("observed_at"),
        F.when((kind == "click") & (k >= 98), "n/a").otherwise(reading.cast("string")).alias("value"),
        kind.alias("source_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("series_id"),
        F.when((kind != "view") | (k != 0), day).alias("realtime_start"),
        day.alias("realtime_end"),
        F.when((kind == "signup") & (k == 1), "surplus").alias("note"),
    )
    return star.events.select("event_id", event_batch().alias("batch_id"), F.to_json(body).alias("line"))
