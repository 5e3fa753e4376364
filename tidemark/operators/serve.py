"""Read-side queries: point in time, bars, trade, catalog, lineage, revisions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import periods
from tidemark.functions.records import without_nulls
from tidemark.operators import adjacency
from tidemark.operators.gold import SERIES
from tidemark.sources import tables


def as_of(observations: DataFrame, day: date) -> DataFrame:
    """Newest vintage not later than ``day`` per (indicator, geo, period), all columns."""
    return newest(observations.where(F.col("vintage_date") <= F.lit(day)))


def newest(observations: DataFrame, key: Sequence[str] = (*SERIES, "period")) -> DataFrame:
    return tables.latest_by_key(observations, key, ("vintage_date",))


def as_of_many(observations: DataFrame, days: Sequence[date]) -> DataFrame:
    """Point-in-time rows for several dates in one pass.

    Each vintage holds until the next one, so it is unfolded only into the dates it answers:
    no join, and exactly the result rows are produced. A group has one row per vintage date.
    """
    following = Window.partitionBy(*SERIES, "period").orderBy("vintage_date")
    spans = observations.where(F.col("vintage_date") <= F.lit(max(days))).withColumn(
        "_until", F.lead("vintage_date").over(following)
    )
    asked = F.array(*[F.lit(d) for d in sorted(set(days))])
    answered = F.filter(
        asked,
        lambda d: (d >= F.col("vintage_date")) & (F.col("_until").isNull() | (d < F.col("_until"))),
    )
    return spans.withColumn("as_of", F.explode(answered)).drop("_until")


def latest_period(observations: DataFrame) -> DataFrame:
    """Newest period of each series, in its newest vintage."""
    return tables.latest_by_key(observations, SERIES, ("period_start", "vintage_date"))


def in_periods(
    observations: DataFrame,
    period_from: str | None = None,
    period_to: str | None = None,
    geo_code: str | None = None,
    indicator_id: str | None = None,
) -> DataFrame:
    """Period range and geography as plain predicates, which reach the scan."""
    out = observations
    for column, value in (("geo_code", geo_code), ("indicator_id", indicator_id)):
        if value is not None:
            out = out.where(F.col(column) == value)
    if period_from is not None:
        out = out.where(F.col("period") >= period_from)
    if period_to is not None:
        out = out.where(F.col("period") <= period_to)
    return out


def indicator_response(
    observations: DataFrame, quality: DataFrame | None = None, day: date | None = None, latest_only: bool = False
) -> DataFrame:
    """Observations as served: one vintage per period, decimals as text, quality status on each.

    ``quality`` gives ``data_quality_status`` by observation key; a row it does not mention is ok.
    """
    known = observations if day is None else observations.where(F.col("vintage_date") <= F.lit(day))
    chosen = latest_period(known) if latest_only else newest(known)
    status = F.lit("ok")
    if quality is not None:
        chosen = chosen.join(quality, list(schemas.OBSERVATION_KEY), "left")
        status = F.coalesce(F.col("data_quality_status"), F.lit("ok"))
    return chosen.select(
        *SERIES,
        "unit",
        "seasonal_adjustment",
        "period",
        F.col("value").cast("string").alias("value"),
        "vintage_date",
        status.alias("data_quality_status"),
    )


def align(observations: DataFrame, left: str, right: str) -> DataFrame:
    """Two indicators side by side on (geo, period end); a period only one has stays, with a null.

    One grouped pass over both instead of a join of the table with itself.
    """
    both = newest(observations.where(F.col("indicator_id").isin(left, right)))
    return both.groupBy("geo_code", "period_end").agg(
        F.max(F.when(F.col("indicator_id") == left, F.col("value"))).alias("left_value"),
        F.max(F.when(F.col("indicator_id") == right, F.col("value"))).alias("right_value"),
    )


def bars_from_ticks(
    ticks: DataFrame, instrument: str, at: Column, price: Column, tiebreak: str, unit: str = "day"
) -> DataFrame:
    """Open, high, low, close and count per instrument and interval, combined on the map side."""
    shaped = ticks.select(
        F.col(instrument).alias("instrument_id"),
        F.date_trunc(unit, at).alias("observed_at"),
        F.struct(at.alias("at"), F.col(tiebreak).alias("tie")).alias("place"),
        price.alias("price"),
    )
    return shaped.groupBy("instrument_id", "observed_at").agg(
        F.min_by("price", "place").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "place").alias("close"),
        F.count("*").alias("ticks"),
    )


def bars(
    ohlcv: DataFrame,
    dim_instrument: DataFrame,
    asset_class: str,
    symbol: str,
    interval: str,
    start: datetime | None = None,
    stop: datetime | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Bars of one instrument in time order: all of them, or the first ``limit`` as a page.

    The next page starts after the last ``observed_at`` of a full one; asking for one row more than is
    shown tells whether there is a next page.
    """
    if limit is not None and limit < 1:
        raise ValueError("limit must be positive")
    if interval not in schemas.BAR_INTERVALS:
        raise ValueError(f"unsupported interval {interval!r}")
    wanted = dim_instrument.where(
        (F.col("asset_class") == asset_class) & (F.col("symbol") == symbol)
    ).select("instrument_id")
    rows = ohlcv.where(F.col("interval") == interval)
    if start is not None:
        rows = rows.where(F.col("observed_at") >= F.lit(start).cast("timestamp"))
    if stop is not None:
        rows = rows.where(F.col("observed_at") <= F.lit(stop).cast("timestamp"))
    ordered = rows.join(wanted, "instrument_id", "left_semi").orderBy("observed_at", "instrument_id")
    return ordered if limit is None else ordered.limit(limit)


def newest_bars(ohlcv: DataFrame, n: int, key: Sequence[str] = ("instrument_id",)) -> DataFrame:
    """The ``n`` newest bars of every instrument; ranks are limited before the shuffle as well."""
    if n < 1:
        raise ValueError("n must be positive")
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("observed_at").desc()))
    return ohlcv.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def upsert_bars(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Bars after an upsert on the bar key."""
    return tables.upsert_view(existing, incoming, schemas.OHLCV_KEY, ())


def with_gaps(expected: DataFrame, bars: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every expected bar, with ``is_gap`` where there is none; measures of a gap stay null, so
    aggregates pass over it."""
    present = bars.withColumn("_present", F.lit(True))
    joined = expected.join(present, list(key), "left")
    return joined.withColumn("is_gap", F.col("_present").isNull()).drop("_present")


def trade(
    observations: DataFrame,
    reporter: str | None = None,
    partner: str | None = None,
    commodity_code: str | None = None,
    period_from: str | None = None,
    period_to: str | None = None,
) -> DataFrame:
    out = observations
    for column, value in (
        ("reporter", reporter),
        ("partner", partner),
        ("commodity_code", commodity_code),
    ):
        if value is not None:
            out = out.where(F.col(column) == value)
    return in_periods(out, period_from, period_to)


def catalog(
    datasets: DataFrame,
    dim_source: DataFrame,
    runs: DataFrame,
    now: datetime,
    max_lag: timedelta,
    domain: str | None = None,
    search: str | None = None,
) -> DataFrame:
    """Datasets with trust tier, licence, last success and freshness.

    ``datasets`` has ``dataset_id, source_id, domain, name``; filters apply before any join.
    """
    chosen = datasets
    if domain is not None:
        chosen = chosen.where(F.col("domain") == domain)
    if search is not None:
        text = F.concat_ws(" ", "dataset_id", "name")
        chosen = chosen.where(F.contains(F.lower(text), F.lit(search.lower())))
    updated = runs.where("status = 'success'").groupBy("dataset_id").agg(
        F.max("finished_at").alias("last_updated_at")
    )
    age = F.lit(now).cast("timestamp") - F.col("last_updated_at")
    freshness = F.when(F.col("last_updated_at").isNull(), "unknown").when(
        age > F.lit(max_lag), "stale"
    ).otherwise("ok")
    return (
        chosen.join(dim_source.select("source_id", "trust_tier", "license_url"), "source_id", "left")
        .join(updated, "dataset_id", "left")
        .select(
            "dataset_id",
            "domain",
            "source_id",
            "trust_tier",
            "license_url",
            "last_updated_at",
            freshness.alias("freshness_status"),
        )
    )


def lineage(kpis: DataFrame, observations: DataFrame, bronze: DataFrame) -> DataFrame:
    """Each indicator value back to the vintage, the Bronze row and the raw object behind it."""
    used = newest(observations.select(*SERIES, "period", "vintage_date", "bronze_id"))
    raw = bronze.select("bronze_id", "raw_object_key", "raw_sha256")
    return (
        kpis.select(*SERIES, "period", "value")
        .join(used, [*SERIES, "period"])
        .join(raw, "bronze_id")
    )


def history_ceiling(rows: DataFrame, key: Sequence[str], at: Column, requested_from: datetime) -> DataFrame:
    """Per key: earliest available instant and whether the requested range starts before it."""
    earliest = rows.groupBy(*key).agg(F.min(at).alias("available_from"))
    return earliest.withColumn(
        "truncated", F.col("available_from") > F.lit(requested_from).cast("timestamp")
    )


def revisions(observations: DataFrame) -> DataFrame:
    """Every vintage with its number, the previous vintage's value and the change.

    The window holds one row per vintage date of a period, since vintage is part of the key.
    """
    vintages = Window.partitionBy(*SERIES, "period").orderBy("vintage_date")
    return observations.select(
        *SERIES,
        "period",
        "vintage_date",
        "value",
        F.row_number().over(vintages).cast("bigint").alias("revision"),
        F.lag("value").over(vintages).alias("previous_value"),
    ).withColumn("change", F.col("value") - F.col("previous_value"))


def metadata_changes(snapshots: DataFrame, key: str, at: str, fields: Sequence[str]) -> DataFrame:
    """Snapshots whose metadata differs from the one before, with the names of changed fields."""
    compared = adjacency.changes(snapshots, [key], [at], fields)
    names = [F.when(~F.col(f).eqNullSafe(F.col(adjacency.PREV + f)), F.lit(f)) for f in fields]
    return compared.withColumn("changed_fields", without_nulls(names))


def period_columns(df: DataFrame, day: str) -> DataFrame:
    return df.withColumns(
        {
            "period": periods.period_label(day),
            "period_start": periods.period_start(day),
            "period_end": periods.period_end(day),
        }
    )
