"""Queries over raw, Bronze, Silver and Gold operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.contracts import DataContract, typed_record
from tidemark.functions import keys, periods
from tidemark.functions import records as R
from tidemark.operators import admission, bronze, coded, gold, serve, silver
from tidemark.operators.quality import assertions, rows
from tidemark.plans import pipeline
from tidemark.plans.registry import KPI_SELECT, MONTHLY, OBSERVATIONS, query
from tidemark.session import scratch_path
from tidemark.sources import landing, seeds, star as S, tables
from tidemark.sources.star import Star


def _empty_bronze(star: Star) -> DataFrame:
    return star.spark.createDataFrame([], schemas.BRONZE)


def _built(star: Star) -> pipeline.Built:
    return pipeline.build(
        S.sales_objects(star),
        _empty_bronze(star),
        pipeline.Dimensions(S.sales_map(star), S.indicators(star)),
        S.RUN_AT,
        S.CODE_VERSION,
        S.SALES_PARSERS,
    )


def _sales_silver(star: Star) -> silver.Conformed:
    return silver.conform(
        S.bronze_rows(S.sales_objects(star)), S.sales_map(star), S.indicators(star), S.RUN_AT, S.SALES_PARSERS
    )


@query(
    "PIPE-01 SRC-04 SRC-06 BRZ-01 BRZ-02 BRZ-03 BRZ-05 SLV-01 SLV-02 SLV-03 SLV-04 SLV-05 SLV-06 SLV-07 "
    "SLV-08 SLV-13 SLV-14 SLV-15 SLV-18 GLD-01 GLD-02 GLD-03 GLD-04 GLD-05",
    f"with {OBSERVATIONS} {KPI_SELECT}",
)
def flagship_kpi(star: Star) -> DataFrame:
    return _built(star).gold


@query("GLD-01 GLD-02 GLD-03 GLD-04 GLD-05", f"with {OBSERVATIONS} {KPI_SELECT}")
def gold_kpi(star: Star) -> DataFrame:
    return gold.kpi(gold.latest_vintage(S.observations(star)))


def _nation_months(star: Star) -> DataFrame:
    """High-priority finished orders per nation: a thin series with months missing."""
    placed = star.customer.join(star.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "n_name", "c_mktsegment"
    )
    chosen = star.orders.where("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'")
    return (
        chosen.join(placed, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("c_mktsegment").alias("indicator_id"),
            F.col("n_name").alias("geo_code"),
            F.trunc("o_orderdate", "MM").alias("period_start"),
            F.col("o_totalprice").cast("decimal(28,8)").alias("value"),
        )
        .groupBy("indicator_id", "geo_code", "period_start")
        .agg(F.sum("value").cast("decimal(28,8)").alias("value"))
        .withColumn("period", periods.period_label("period_start"))
    )


@query(
    "GLD-04 GLD-05",
    """with latest as (
  select c_mktsegment as indicator_id, n_name as geo_code,
    cast(date_trunc('month', o_orderdate) as date) as period_start,
    cast(sum(cast(o_totalprice as decimal(28,8))) as decimal(28,8)) as value
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  where o_orderstatus = 'F' and o_orderpriority = '1-URGENT' group by 1, 2, 3)
select a.indicator_id, a.geo_code, strftime(a.period_start, '%Y-%m') as period, a.period_start, a.value,
  round((a.value - m.value) / nullif(m.value, 0) * 100, 4) as mom_pct_change,
  round((a.value - y.value) / nullif(y.value, 0) * 100, 4) as yoy_pct_change
from latest a
left join latest m on m.indicator_id = a.indicator_id and m.geo_code = a.geo_code
  and m.period_start = a.period_start - interval '1 month'
left join latest y on y.indicator_id = a.indicator_id and y.geo_code = a.geo_code
  and y.period_start = a.period_start - interval '12 months'""",
)
def gold_kpi_calendar(star: Star) -> DataFrame:
    return gold.kpi(_nation_months(star), calendar_aware=True)


@query(
    "GLD-06",
    f"""with {OBSERVATIONS}, kpi as ({KPI_SELECT})
select indicator_id, geo_code, period, value, mom_pct_change, yoy_pct_change from kpi
where indicator_id = 'BUILDING'""",
)
def gold_dashboard(star: Star) -> DataFrame:
    return gold.dashboard(gold.kpi(gold.latest_vintage(S.observations(star))), "BUILDING")


@query("GLD-07", f"with {OBSERVATIONS}, kpi as ({KPI_SELECT}) select * from kpi where period = '1997-03'")
def gold_point_lookup(star: Star) -> DataFrame:
    return gold.at_period(gold.kpi(gold.latest_vintage(S.observations(star))), "1997-03")


@query(
    "GLD-08",
    f"with {OBSERVATIONS} select indicator_id, geo_code, period, vintage_date, value from observations",
)
def silver_history(star: Star) -> DataFrame:
    return gold.vintage_history(S.observations(star))


@query(
    "SLV-09 SLV-10 SLV-11 SLV-12 SLV-13 SLV-15 SLV-16 SLV-17 SLV-18",
    f"""with {OBSERVATIONS} select indicator_id, geo_code, period, period_start, period_end, vintage_date,
  value, unit, seasonal_adjustment, cast(null as timestamp) as published_at, retrieved_at, processed_at
from observations""",
)
def silver_observations(star: Star) -> DataFrame:
    return _sales_silver(star).rows.select(*silver.observation_columns())


@query(
    "SLV-12",
    """select cast(o_orderkey as varchar) as record_id,
  strftime(o_orderdate, '%Y-%m-%d') as date_text,
  case when o_orderstatus = 'P' then 'pending' else strftime(o_orderdate, '%Y-%m-%d') end as vintage_text,
  'unreadable vintage date' as reason
from orders where o_orderstatus = 'P'""",
)
def silver_quarantine(star: Star) -> DataFrame:
    """Orders still in process have no settled vintage and are held back."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    records = star.orders.select(
        F.col("o_orderkey").cast("string").alias("bronze_id"),
        F.lit("orders").alias("dataset_id"),
        day.alias("date_text"),
        F.when(F.col("o_orderstatus") == "P", "pending").otherwise(day).alias("vintage_text"),
        F.col("o_totalprice").cast("decimal(28,2)").cast("string").alias("value_text"),
    )
    return silver.undated(silver.type_records(records)).select(
        F.col("bronze_id").alias("record_id"), "date_text", "vintage_text", "reason"
    )


@query(
    "SLV-04 SLV-19",
    """select cast(doc_id as varchar) as record_id, case when json_valid(text)
  then 'payload has no array observations' else 'payload is not JSON' end as reason from documents
union all
select cast(event_id as varchar), 'payload has no array observations' from events""",
)
def silver_unreadable(star: Star) -> DataFrame:
    """Texts and event properties taken for observation payloads: each is held back with its reason."""
    texts = star.documents.select(F.col("doc_id").cast("string").alias("bronze_id"), F.col("text").alias("body"))
    bodies = texts.unionByName(star.events.select(F.col("event_id").cast("string").alias("bronze_id"), F.col("props").alias("body")))
    payloads = bodies.select("bronze_id", F.lit("d").alias("dataset_id"), F.encode("body", "UTF-8").alias("payload"))
    held = silver.unreadable(silver.OBSERVATIONS_PARSER(payloads))
    return held.select(F.col("bronze_id").alias("record_id"), "reason")


@query(
    "SLV-19 SLV-06",
    f"""with {OBSERVATIONS}, shipped as (
  select 'SHIPPED_' || l_returnflag as indicator_id, 'WORLD' as geo_code,
    cast(date_trunc('month', l_shipdate) as date) as period_start,
    cast(sum(cast(l_quantity as decimal(28,8))) as decimal(28,8)) as value
  from lineitem group by 1, 2, 3)
select indicator_id, geo_code, period, vintage_date, value, unit from observations
union all
select indicator_id, geo_code, strftime(period_start, '%Y-%m'), last_day(period_start), value, 'pieces'
from shipped""",
)
def second_source(star: Star) -> DataFrame:
    """Two feeds with different payload shapes in one observation table."""
    objects = S.sales_objects(star).unionByName(S.shipment_objects(star))
    conformed = silver.conform(
        S.bronze_rows(objects),
        S.sales_map(star).unionByName(S.shipments_map(star)),
        S.indicators(star).unionByName(S.shipment_indicators(star)),
        S.RUN_AT,
        S.PARSERS,
    )
    return conformed.rows.select("indicator_id", "geo_code", "period", "vintage_date", "value", "unit")


_CODE_LIST = """codes as (
  select n_nationkey as code, n_name as geo_code from nation
  where n_nationkey in (select s_nationkey from supplier where s_acctbal < 3000))"""


@query(
    "SLV-20",
    f"""with {_CODE_LIST}
select c_custkey, c_nationkey, geo_code, cast(null as varchar) as reason
from customer join codes on c_nationkey = code
union all
select c_custkey, c_nationkey, null, 'unknown c_nationkey: ' || c_nationkey
from customer where c_nationkey not in (select code from codes)""",
)
def code_list_resolution(star: Star) -> DataFrame:
    listed = star.supplier.where("s_acctbal < 3000").select(F.col("s_nationkey").alias("n_nationkey"))
    codes = star.nation.join(listed, "n_nationkey", "left_semi").select(
        F.col("n_nationkey").alias("code"), F.col("n_name").alias("geo_code")
    )
    found = silver.resolve_codes(
        star.customer.select("c_custkey", "c_nationkey"), "c_nationkey", codes, "code", "geo_code"
    )
    text = F.lit(None).cast("string")
    return found.rows.select("c_custkey", "c_nationkey", "geo_code", text.alias("reason")).unionByName(
        found.quarantined.select("c_custkey", "c_nationkey", text.alias("geo_code"), "reason")
    )


@query(
    "SLV-15 SNK-03",
    """select l_orderkey, l_linenumber, l_shipdate, l_quantity, l_partkey, l_suppkey from (
  select *, row_number() over (partition by l_orderkey, l_linenumber
    order by l_shipdate desc, l_quantity desc, l_partkey desc, l_suppkey desc) as rn from lineitem)
where rn = 1""",
)
def latest_by_key(star: Star) -> DataFrame:
    lines = star.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_partkey", "l_suppkey")
    return tables.latest_by_key(lines, ("l_orderkey", "l_linenumber"), ("l_shipdate", "l_quantity"))


@query(
    "SLV-03 SLV-05 SLV-07 SLV-08",
    """select event_id, json_extract_string(props, '$.k') as k_text,
  try_cast(json_extract_string(props, '$.k') as decimal(28,8)) as k_value from events""",
)
def json_extract_cast(star: Star) -> DataFrame:
    text = F.from_json("props", "struct<k: string>").k
    return star.events.select(
        "event_id", text.alias("k_text"), text.try_cast(silver.VALUE_TYPE).alias("k_value")
    )


@query(
    "SLV-09 SLV-10 SLV-11",
    """select o_orderkey, strftime(o_orderdate, '%Y-%m') as period,
  cast(date_trunc('month', o_orderdate) as date) as period_start,
  last_day(cast(o_orderdate as date)) as period_end from orders""",
)
def period_fields(star: Star) -> DataFrame:
    return serve.period_columns(star.orders, "o_orderdate").select(
        "o_orderkey", "period", "period_start", "period_end"
    )


_OBJECTS = """objects as (
  select doc_id, source as source_id, lang as dataset_id, text, n_chars,
    timestamp '2024-01-01' + to_seconds(n_chars) as retrieved_at, sha256(text) as raw_sha256,
    'raw/' || source || '/' || lang || '/date='
      || strftime(timestamp '2024-01-01' + to_seconds(n_chars), '%Y-%m-%d') || '/' || sha256(text)
      || '.json' as raw_object_key
  from documents)"""


@query(
    "SRC-04 SRC-05 SRC-06 BRZ-01",
    f"""with {_OBJECTS} select doc_id, raw_object_key, source_id, dataset_id,
  cast(retrieved_at as date) as landed_on, raw_sha256, sha256(raw_object_key) as bronze_id from objects""",
)
def object_keys(star: Star) -> DataFrame:
    addressed = S.document_objects(star).select("doc_id", "raw_object_key")
    part = keys.key_parts("raw_object_key")
    return addressed.select(
        "doc_id",
        "raw_object_key",
        *[c.alias(n) for n, c in part.items()],
        keys.bronze_id("raw_object_key").alias("bronze_id"),
    )


@query(
    "SRC-02 SRC-03",
    f"""with {_OBJECTS}, landed as (
  select distinct raw_object_key from objects where doc_id in (select doc_id from labels))
select raw_object_key, min(source_id) as source_id, min(dataset_id) as dataset_id,
  min(retrieved_at) as retrieved_at, cast(min(n_chars) as bigint) as n_chars
from objects where raw_object_key not in (select raw_object_key from landed) group by raw_object_key""",
)
def landing_new(star: Star) -> DataFrame:
    """Write-once landing: labelled documents are there already, copies land once."""
    objects = S.document_objects(star)
    landed = S.labelled(star, objects)
    fresh = landing.new_objects(objects.drop("doc_id"), landed)
    return fresh.select(
        "raw_object_key",
        "source_id",
        "dataset_id",
        "retrieved_at",
        F.char_length(F.decode("payload", "UTF-8")).cast("bigint").alias("n_chars"),
    )


@query(
    "SRC-03 SRC-01",
    f"""with {_OBJECTS}, landed as (
  select distinct raw_object_key from objects where doc_id in (select doc_id from labels))
select doc_id, raw_object_key from objects where raw_object_key in (select raw_object_key from landed)""",
)
def landing_exists(star: Star) -> DataFrame:
    objects = S.document_objects(star).select("doc_id", "raw_object_key")
    return landing.already_landed(objects, S.labelled(star, objects)).select("doc_id", "raw_object_key")


@query(
    "BRZ-02 BRZ-05 SRC-10",
    f"""with {_OBJECTS}
select sha256(raw_object_key) as bronze_id, min(source_id) as source_id, min(dataset_id) as dataset_id,
  raw_object_key, min(raw_sha256) as raw_sha256, min(retrieved_at) as retrieved_at,
  '1.0.0' as code_version, timestamp '2002-02-01' as ingested_at,
  cast(min(octet_length(encode(text))) as bigint) as n_bytes
from objects where raw_object_key not in (
  select raw_object_key from objects where doc_id in (select doc_id from labels))
group by raw_object_key""",
)
def bronze_idempotent(star: Star) -> DataFrame:
    objects = S.document_objects(star)
    existing = S.bronze_rows(S.labelled(star, objects))
    loaded = bronze.load(objects.drop("doc_id"), existing, S.CODE_VERSION, S.RUN_AT)
    return loaded.rows.select(
        "bronze_id",
        "source_id",
        "dataset_id",
        "raw_object_key",
        "raw_sha256",
        "retrieved_at",
        "code_version",
        "ingested_at",
        F.octet_length("payload").cast("bigint").alias("n_bytes"),
    )


@query(
    "BRZ-03",
    """select d.doc_id, sha256(text) as actual_sha256,
  case when toxic = 1 then sha256(lower(text)) else sha256(text) end as expected_sha256,
  sha256(text) = case when toxic = 1 then sha256(lower(text)) else sha256(text) end as checksum_ok
from documents d left join labels l on d.doc_id = l.doc_id""",
)
def checksum_split(star: Star) -> DataFrame:
    """Documents marked toxic come with the checksum of an edited text and fail the gate."""
    marked = star.documents.join(star.labels.select("doc_id", "toxic"), "doc_id", "left")
    stale = F.coalesce(F.col("toxic") == 1, F.lit(False))
    objects = marked.select(
        "doc_id",
        F.sha2(F.when(stale, F.lower("text")).otherwise(F.col("text")), 256).alias("raw_sha256"),
        F.encode("text", "UTF-8").alias("payload"),
    )
    return bronze.verify_checksum(objects).select(
        "doc_id", "actual_sha256", F.col("raw_sha256").alias("expected_sha256"), "checksum_ok"
    )


@query(
    "BRZ-04",
    f"""with {_OBJECTS} select doc_id, raw_object_key, source_id, dataset_id, 'Raw object missing' as reason
from objects where raw_object_key not in (
  select raw_object_key from objects where doc_id in (select doc_id from labels))""",
)
def missing_objects(star: Star) -> DataFrame:
    manifest = S.document_objects(star).select("doc_id", "raw_object_key", "source_id", "dataset_id")
    landed = S.labelled(star, manifest)
    return landing.missing_objects(manifest, landed).select(
        "doc_id", "raw_object_key", "source_id", "dataset_id", F.lit(bronze.REJECT_MISSING).alias("reason")
    )


@query(
    "BRZ-06",
    f"""with {_OBJECTS} select sha256(raw_object_key) as bronze_id, raw_object_key, raw_sha256, retrieved_at
from objects where raw_object_key in (
  select raw_object_key from objects where doc_id in (select doc_id from labels where quality = 1))""",
)
def bronze_lookup(star: Star) -> DataFrame:
    objects = S.document_objects(star)
    wanted = objects.join(star.labels.where("quality = 1").select("doc_id"), "doc_id", "left_semi")
    found = bronze.by_keys(S.bronze_rows(objects), wanted)
    return found.select("bronze_id", "raw_object_key", "raw_sha256", "retrieved_at")


@query(
    "BRZ-07",
    """select event_id, case event_type
    when 'view' then ts - interval '2 hours' when 'click' then ts + interval '5 hours' + interval '30 minutes'
    when 'purchase' then ts when 'signup' then ts end as instant, event_type = 'error' as rejected
from events""",
)
def utc_normalise(star: Star) -> DataFrame:
    """Timestamp text in several zones to UTC; text without a zone is rejected."""
    zones = {"view": "+02:00", "click": "-05:30", "purchase": "Z", "signup": "+00"}
    suffix = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in zones.items()], F.lit(""))
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), suffix)
    read = star.events.select("event_id", periods.aware_instant(text).alias("instant"))
    return read.withColumn("rejected", F.col("instant").isNull())


@query(
    "OPS-11",
    f"""with {MONTHLY} select lower('sales_' || indicator_id || '_' || replace(geo_code, ' ', '-') || '_' || digit)
  as dataset_id, cast(count(*) as integer) as observation_count from monthly
group by indicator_id, geo_code, digit""",
)
def observation_counts(star: Star) -> DataFrame:
    return S.sales_objects(star).select(
        "dataset_id", silver.observation_count("payload").alias("observation_count")
    )


@query(
    "DQ-00 QRY-11",
    f"""with {OBSERVATIONS}
select lower('sales_' || indicator_id || '_' || replace(geo_code, ' ', '-') || '_' || digit) as dataset_id,
  period || '-01T00:00:00+00:00' as observed_at, cast(value as varchar) as value,
  'orders_feed' as source_id, cast(vintage_date as varchar) as realtime_start, true as fits_contract
from observations""",
)
def record_shaping(star: Star) -> DataFrame:
    """Raw payloads as contract-shaped records, checked against the contract."""
    stored = S.bronze_rows(S.sales_objects(star))
    parsed = silver.parse(stored, S.SALES_PARSERS)
    shaped = rows.from_observations(parsed, F.col("dataset_id"))
    checked = rows.check_schema(shaped, S.EVENT_CONTRACT)
    return checked.select(
        R.field_text("record", "series_id").alias("dataset_id"),
        *[R.field_text("record", n).alias(n) for n in ("observed_at", "value", "source_id", "realtime_start")],
        (~F.col("schema_bad")).alias("fits_contract"),
    )


@query(
    "PIPE-03 BRZ-08",
    f"""with {OBSERVATIONS} select cast(null as varchar) as indicator_id, cast(null as varchar) as geo_code,
  cast(null as varchar) as period, cast(null as date) as vintage_date, cast(null as decimal(28,8)) as value,
  cast(null as varchar) as only_in from observations where false""",
)
def rebuild_differences(star: Star) -> DataFrame:
    """Silver rebuilt from raw payloads that arrive twice equals Silver built once."""
    columns = ["indicator_id", "geo_code", "period", "vintage_date", "value"]
    once = _sales_silver(star).rows.select(*columns)
    objects = S.sales_objects(star)
    loaded = bronze.load(objects.unionByName(objects), _empty_bronze(star), S.CODE_VERSION, S.RUN_AT)
    again = silver.conform(
        loaded.rows, S.sales_map(star), S.indicators(star), S.RUN_AT, S.SALES_PARSERS
    ).rows.select(*columns)
    return pipeline.differences(once, again)


@query(
    "PIPE-03 BRZ-08",
    f"""with {OBSERVATIONS}, n as (select count(*) as n, sum(value) as total from observations)
select 'once' as build, n, total from n union all select 'again', n, total from n
union all select 'differences', 0, null""",
)
def rebuild_counts(star: Star) -> DataFrame:
    """Rows and sums of two stored builds from the same landed payloads, and of what differs between them."""
    spark, layout = star.spark, pipeline.Layout(scratch_path(star.spark, "rebuilt"))
    objects = S.sales_objects(star)
    columns = ["indicator_id", "geo_code", "period", "vintage_date", "value"]
    builds = []
    for name, arriving in (("once", objects), ("again", objects.unionByName(objects))):
        loaded = bronze.load(arriving, _empty_bronze(star), S.CODE_VERSION, S.RUN_AT)
        rows_ = silver.conform(loaded.rows, S.sales_map(star), S.indicators(star), S.RUN_AT, S.SALES_PARSERS).rows
        tables.replace(rows_, layout.path(name), "indicator_id")
        builds.append((name, tables.read_replaced(spark, layout.path(name), schemas.STORED_OBSERVATION).select(*columns)))
    builds.append(("differences", pipeline.differences(builds[0][1], builds[1][1])))
    counted = [
        rows_.agg(F.count("*").alias("n"), F.sum("value").alias("total")).withColumn("build", F.lit(name)) for name, rows_ in builds
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2]).select("build", "n", "total")


@query(
    "SRC-01 SRC-06 BRZ-03",
    f"""with {OBSERVATIONS}
select lower('sales_' || indicator_id || '_' || replace(geo_code, ' ', '-') || '_' || digit) as dataset_id,
  count(*) as observations, true as intact from observations group by 1""",
)
def landed_bytes(star: Star) -> DataFrame:
    """Payloads landed as files and read back through the file source: all bytes, and what is in them."""
    root = scratch_path(star.spark, "landed")
    landing.land_files(S.sales_objects(star), root)
    read = bronze.verify_checksum(landing.read_landed(star.spark, root))
    counted = silver.observation_count("payload").cast("bigint").alias("observations")
    return read.select("dataset_id", counted, F.col("checksum_ok").alias("intact"))


@query("GLD-07 SNK-01", f"with {OBSERVATIONS}, kpi as ({KPI_SELECT}) select * from kpi where period = '1997-03'")
def stored_point_lookup(star: Star) -> DataFrame:
    """One period out of stored Gold."""
    path = scratch_path(star.spark, "gold")
    tables.replace(gold.kpi(gold.latest_vintage(S.observations(star))), path, "indicator_id")
    return gold.at_period(tables.read_replaced(star.spark, path, schemas.KPI), "1997-03")


@query(
    "PIPE-02",
    f"""with {OBSERVATIONS}, silver as (
  select indicator_id, count(*) as n from observations group by 1), gold as (
  select indicator_id, count(*) as n from latest group by 1)
select 'silver_data.transformed' as event_type, 'silver' as producer, indicator_id as dataset_id,
  '{{"rows":' || n || '}}' as metadata from silver
union all select 'gold_data.published', 'gold', indicator_id, '{{"rows":' || n || '}}' from gold
union all select 'data_product.ready', 'gold', indicator_id, '{{"rows":' || n || '}}' from gold""",
)
def stage_events(star: Star) -> DataFrame:
    observations = S.observations(star)
    kpis = gold.latest_vintage(observations)
    stages = pipeline.stage_events(observations, "silver_data.transformed", "silver", S.RUN_AT)
    for kind in ("gold_data.published", "data_product.ready"):
        stages = stages.unionByName(pipeline.stage_events(kpis, kind, "gold", S.RUN_AT))
    return stages.select("event_type", "producer", "dataset_id", "metadata")


# Deliveries that the gate refuses, with the rule that refuses them.
_DELIVERED = f"""{OBSERVATIONS}, delivered as (
  select *, lower('sales_' || indicator_id || '_' || replace(geo_code, ' ', '-') || '_' || digit) as dataset_id,
    case when indicator_id = 'MACHINERY' and digit = 5 then 'FR-QUAL-005'
      when indicator_id = 'BUILDING' and digit = 4 then 'FR-QUAL-001' end as refused
  from observations),
batches as (select distinct dataset_id, refused from delivered),
good as (select * from delivered where refused is null)"""


def _gated_run(star: Star) -> pipeline.Layout:
    """The stored flow over landed files, validation included; times come from the manifest."""
    layout = pipeline.Layout(scratch_path(star.spark, "gated"))
    root = layout.path("landing")
    landing.land(S.delivered_objects(star), root, layout.path("retrievals"), "delivery")
    dimensions = pipeline.Dimensions(S.sales_map(star), S.indicators(star))
    gate = admission.Gate({S.SALES_SOURCE: S.EVENT_CONTRACT}, S.SALES_PARSERS)
    pipeline.run(star.spark, root, layout, dimensions, S.RUN_AT, S.CODE_VERSION, S.SALES_PARSERS, gate=gate)
    return layout


@query(
    "PIPE-01 PIPE-02 DQ-12 DQ-19 DLQ-01",
    f"""with {_DELIVERED}
select 'raw_data.received' as event_type, 'landing' as producer, dataset_id, cast(null as varchar) as detail from batches
union all select 'raw_data.validated', 'validation.engine', dataset_id, null from batches where refused is null
union all select 'raw_data.quarantined', 'validation.engine', dataset_id,
  'data-quality rule(s) failed: ' || refused from batches where refused is not null
union all select 'bronze_data.written', 'bronze', dataset_id, null from batches where refused is null
union all select 'silver_data.transformed', 'silver', indicator_id, cast(count(*) as varchar) from good group by 3
union all select k, 'gold', indicator_id, cast(n as varchar) from (
  select indicator_id, count(distinct (geo_code, period)) as n from good group by 1),
  (values ('gold_data.published'), ('data_product.ready')) as kinds(k)""",
)
def pipeline_stages(star: Star) -> DataFrame:
    """The seven stages as the event log has them, with the dead letter of each refused batch."""
    layout = _gated_run(star)
    log = pipeline.read_events(star.spark, layout)
    letters = pipeline.read_dlq(star.spark, layout).select("event_id", "failure_reason")
    rows_ = F.get_json_object("metadata", "$.rows")
    return log.join(letters, "event_id", "left").select(
        "event_type", "producer", "dataset_id", F.coalesce("failure_reason", rows_).alias("detail")
    )


@query(
    "BRZ-05 SNK-01 SRC-01 BRZ-08 PIPE-01",
    f"""with {_DELIVERED} select indicator_id, geo_code, period, vintage_date, value, retrieved_at from good""",
)
def gated_observations(star: Star) -> DataFrame:
    """Silver of the admitted batches, read through its pointer, with retrieval times of the manifest."""
    stored = pipeline.read_observations(star.spark, _gated_run(star))
    return stored.select("indicator_id", "geo_code", "period", "vintage_date", "value", "retrieved_at")


_CODED = f"""{OBSERVATIONS}, coded as (
  select *, digit = 5 and indicator_id = (select max(c_mktsegment) from customer) as lost from observations)"""


def _coded(star: Star) -> silver.Conformed:
    regions = star.region.where("r_name <> 'ASIA'").select(F.col("r_name").alias("code"), F.initcap("r_name").alias("canonical"))
    segments = S.indicators(star).select(F.col("indicator_id").alias("code"), F.col("indicator_id").alias("canonical"))
    return coded.conform(
        S.bronze_rows(S.coded_objects(star)),
        {"REF_AREA": "geo_code", "SEGMENT": "indicator_id"},
        {"REF_AREA": regions, "SEGMENT": segments},
        S.indicators(star),
        S.RUN_AT,
    )


@query(
    "SLV-20 SLV-19 SLV-04",
    f"""with {_CODED} select indicator_id,
  case geo_code when 'MIDDLE EAST' then 'Middle East' else geo_code[1] || lower(geo_code[2:]) end as geo_code,
  period, cast(timestamp '2002-01-01' + (digit - 1) * interval '1 day' as date) as vintage_date, value, unit
from coded where not lost and geo_code <> 'ASIA'""",
)
def coded_observations(star: Star) -> DataFrame:
    """Payloads of positions decoded through the lists they carry, regions resolved by a code list."""
    return _coded(star).rows.select("indicator_id", "geo_code", "period", "vintage_date", "value", "unit")


@query(
    "SLV-20",
    f"""with {_CODED} select 'coded_' || digit as dataset_id,
  case when lost then 'no value at the position of SEGMENT' else 'unknown REF_AREA: ASIA' end as reason, count(*) as n
from coded where lost or geo_code = 'ASIA' group by 1, 2""",
)
def coded_held_back(star: Star) -> DataFrame:
    """Positions outside their list and codes outside the code list, counted by reason."""
    return _coded(star).quarantined.groupBy("dataset_id", "reason").agg(F.count("*").alias("n"))


@query(
    "PIPE-04 GLD-01",
    f"""with {OBSERVATIONS} select o.indicator_id, o.geo_code, o.period, count(*) as vintages,
  max(l.value) as latest_value from observations o
join latest l on l.indicator_id = o.indicator_id and l.geo_code = o.geo_code and l.period = o.period
group by 1, 2, 3""",
)
def revision_check(star: Star) -> DataFrame:
    """Every revision is a row of its own and Gold shows the newest."""
    return S.observations(star).groupBy("indicator_id", "geo_code", "period").agg(
        F.count("*").alias("vintages"), F.max_by("value", "vintage_date").alias("latest_value")
    )


@query(
    "DQ-14 DQ-15 DQ-16",
    """select 'not_null_customer_c_custkey' as test_id, 'customer' as table_name,
  count(*) filter (c_custkey is null) as failed_rows from customer
union all select 'accepted_values_customer_c_mktsegment', 'customer',
  count(*) filter (c_mktsegment not in ('BUILDING', 'MACHINERY')) from customer
union all select 'unique_customer_c_custkey', 'customer', count(*) from (
  select c_custkey from customer where c_custkey is not null group by 1 having count(*) > 1)
union all select 'unique_lineitem_l_orderkey', 'lineitem', count(*) from (
  select l_orderkey from lineitem where l_orderkey is not null group by 1 having count(*) > 1)""",
)
def table_assertions(star: Star) -> DataFrame:
    checks = assertions.column_tests(
        star.customer,
        "customer",
        not_null=["c_custkey"],
        accepted={"c_mktsegment": ["BUILDING", "MACHINERY"]},
    )
    return checks.unionByName(assertions.unique_test(star.customer, "customer", "c_custkey")).unionByName(
        assertions.unique_test(star.lineitem, "lineitem", "l_orderkey")
    )


_MODEL_TESTS = f"""{OBSERVATIONS}, obs as (
  select *, case when geo_code <> 'ASIA' then geo_code end as geo, case when indicator_id = 'BUILDING' then 'x' else 'sa' end as sa
  from observations), maps as (
  select dataset_id, geo_code from (select distinct indicator_id, lower('sales_' || indicator_id || '_' || replace(geo_code, ' ', '-')
      || '_' || digit) as dataset_id, geo_code from (select distinct c_mktsegment as indicator_id, r_name as geo_code from customer
      join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey) p
    cross join (select unnest(range(1, 6)) as digit) d), (select unnest(range(0, 2)) as copy) where copy = 0 or indicator_id = 'BUILDING')"""


@query(
    "DQ-14 DQ-15 DQ-16",
    f"""with {_MODEL_TESTS}
select 'not_null_fact_economic_observation_' || c as test_id,
  case when c = 'geo_code' then (select count(*) from obs where geo is null) else 0 end as failed_rows
from (select unnest(['indicator_id', 'geo_code', 'period', 'period_start', 'period_end', 'vintage_date', 'value',
  'retrieved_at', 'processed_at']) as c)
union all select 'accepted_values_fact_economic_observation_seasonal_adjustment', count(*) from obs where sa = 'x'
union all select 'not_null_fact_economic_kpi_' || c, case when c = 'value' then (
    select count(*) from (select distinct indicator_id, geo_code from observations)) else 0 end
from (select unnest(['indicator_id', 'geo_code', 'period', 'value']) as c)
union all select 'not_null_dim_source_source_id', 0
union all select 'accepted_values_dim_source_trust_tier', count(*) from nation where n_regionkey = 2
union all select 'unique_dim_source_source_id', 0
union all select 'not_null_dim_indicator_indicator_id', 0
union all select 'accepted_values_dim_indicator_seasonal_adjustment', 0
union all select 'unique_dim_indicator_indicator_id', 0
union all select 'not_null_dataset_indicator_map_' || c, 0
from (select unnest(['dataset_id', 'indicator_id', 'geo_code']) as c)
union all select 'unique_dataset_indicator_map_dataset_id', count(*) from (
  select dataset_id from maps group by 1 having count(*) > 1)""",
)
def model_tests(star: Star) -> DataFrame:
    """The tests that the model declares, over its own tables with some fields spoilt."""
    observations = S.observations(star)
    spoilt = observations.withColumns(
        {
            "geo_code": F.when(F.col("geo_code") != "ASIA", F.col("geo_code")),
            "seasonal_adjustment": F.when(F.col("indicator_id") == "BUILDING", "x").otherwise("sa"),
        }
    )
    kpis = gold.kpi(gold.latest_vintage(observations))
    kpis = kpis.withColumn("value", F.when(F.col("mom_pct_change").isNotNull(), F.col("value")))
    sources = star.nation.select(
        F.col("n_name").alias("source_id"), F.when(F.col("n_regionkey") == 2, "hearsay").otherwise("official").alias("trust_tier")
    )
    dataset_map = S.sales_map(star)
    doubled = dataset_map.unionByName(dataset_map.where("indicator_id = 'BUILDING'"))
    checks = assertions.observation_tests(spoilt).unionByName(assertions.kpi_tests(kpis))
    return checks.unionByName(assertions.seed_tests(sources, S.indicators(star), doubled)).select("test_id", "failed_rows")


@query(
    "DQ-17",
    """select indicator_id, geo_code, period, vintage_date, count(*) as n from (
  select c_mktsegment as indicator_id, r_name as geo_code, strftime(o_orderdate, '%Y-%m') as period,
    cast(o_orderdate as date) as vintage_date
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey) group by 1, 2, 3, 4 having count(*) > 1""",
)
def primary_key_test(star: Star) -> DataFrame:
    """Single orders taken as observations: days with several orders of a series repeat the key."""
    orders = star.orders.join(S.places(star), F.col("o_custkey") == F.col("c_custkey")).select(
        "indicator_id",
        "geo_code",
        periods.period_label("o_orderdate").alias("period"),
        F.to_date("o_orderdate").alias("vintage_date"),
    )
    return assertions.primary_key_test(orders)


@query(
    "DQ-18",
    """select c_mktsegment as indicator_id, cast(o_orderkey as varchar) as geo_code,
  strftime(o_orderdate, '%Y-%m') as period, cast(o_orderdate as date) as vintage_date
from orders join customer on o_custkey = c_custkey
where cast(o_orderdate as date) = last_day(cast(o_orderdate as date))
   or timestamp '2001-01-01' < o_orderdate""",
)
def time_fields_test(star: Star) -> DataFrame:
    """Orders with the order day as period start: month-end days collapse the period, late orders
    come after the processing time."""
    rows_ = star.orders.join(star.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("indicator_id"),
        F.col("o_orderkey").cast("string").alias("geo_code"),
        periods.period_label("o_orderdate").alias("period"),
        F.to_date("o_orderdate").alias("vintage_date"),
        F.to_date("o_orderdate").alias("period_start"),
        periods.period_end("o_orderdate").alias("period_end"),
        F.lit("2001-01-01").cast("timestamp").alias("processed_at"),
        F.col("o_orderdate").alias("retrieved_at"),
    )
    return assertions.time_fields_test(rows_)


@query(
    "SRC-07",
    """select lower('sales_' || c_mktsegment || '_' || replace(r_name, ' ', '-') || '_' || digit) as dataset_id,
  'orders_feed' as source_id, c_mktsegment as indicator_id, r_name as geo_code, 'monthly' as frequency
from (select distinct c_mktsegment, r_name from customer join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey) p cross join (select unnest(range(1, 6)) as digit) d""",
)
def seed_scan(star: Star) -> DataFrame:
    """The dataset map written as a seed file and read back with its fixed schema."""
    path = scratch_path(star.spark, "seed")
    seed = S.sales_map(star).select(
        "dataset_id",
        F.lit(S.SALES_SOURCE).alias("source_id"),
        "indicator_id",
        "geo_code",
        F.lit("monthly").alias("frequency"),
    )
    seed.write.option("header", True).csv(path)
    return seeds.read_dataset_map(star.spark, path)


@query(
    "SNK-01 SRC-08",
    f"""with {OBSERVATIONS} select indicator_id, geo_code, period, vintage_date, value from observations
where indicator_id = 'BUILDING' and vintage_date <= date '1998-06-30'""",
)
def stored_observations(star: Star) -> DataFrame:
    """The observation table rebuilt by indicator, then read in place with pruned slices."""
    path = scratch_path(star.spark, "observations")
    everything = S.observations(star)
    tables.replace(everything.where("indicator_id <> 'BUILDING'"), path, "indicator_id")
    tables.replace(everything.where("indicator_id = 'BUILDING'"), path, "indicator_id", slices_only=True)
    stored = tables.read_replaced(star.spark, path, schemas.OBSERVATION)
    return stored.where("indicator_id = 'BUILDING' and vintage_date <= date '1998-06-30'").select(
        "indicator_id", "geo_code", "period", "vintage_date", "value"
    )


_ORDER_CONTRACT = DataContract.from_mapping(
    {
        "dataset": "order_values",
        "owner": "orders",
        "source": "orders",
        "version": 1,
        "primary_key": ["order_id", "observed_at"],
        "schema": {
            "order_id": "string",
            "observed_at": "timestamp_utc",
            "booked_on": "date",
            "value": "decimal(20,8)",
        },
    }
)


@query(
    "SRC-09 DQ-00",
    """select cast(o_orderkey as varchar) as order_id, o_orderdate as observed_at,
  cast(o_orderdate as date) as booked_on, cast(o_totalprice as decimal(20,8)) as value from orders""",
)
def contract_types(star: Star) -> DataFrame:
    """Text records brought into the types their contract declares."""
    packed = rows.from_columns(
        star.orders,
        F.lit("orders"),
        {
            "order_id": F.col("o_orderkey").cast("string"),
            "observed_at": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            "booked_on": F.date_format("o_orderdate", "yyyy-MM-dd"),
            "value": F.col("o_totalprice").cast("decimal(20,2)").cast("string"),
        },
    )
    return packed.select(*typed_record(_ORDER_CONTRACT))
