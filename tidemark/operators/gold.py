"""Gold: period-over-period indicators from the latest (or an as-of) vintage."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import periods

SERIES = ("indicator_id", "geo_code")


def latest_vintage(observations: DataFrame, as_of: date | None = None) -> DataFrame:
    """Newest vintage per (indicator, geo, period), optionally as known on ``as_of``.

    ``max_by`` over fixed-width columns is a hash aggregate with map-side combine: revisions of
    one hot period collapse before the shuffle.
    """
    known = observations if as_of is None else observations.where(F.col("vintage_date") <= F.lit(as_of))
    return (
        known.groupBy(*SERIES, "period_start")
        .agg(
            F.max_by("value", "vintage_date").alias("value"),
            F.max("vintage_date").alias("vintage_date"),
        )
        .withColumn("period", periods.period_label("period_start"))
    )


def pct_change(value: Column, prior: Column) -> Column:
    """Rounded percentage change; null without a prior value or with a prior of zero."""
    base = F.nullif(prior.cast("double"), F.lit(0.0))
    return F.round((value - prior).cast("double") / base * 100, 4)


def kpi(latest: DataFrame, calendar_aware: bool = False) -> DataFrame:
    """Month-over-month and year-over-year change.

    By default the prior values sit 1 and 12 *rows* back, so a missing month widens the span.
    ``calendar_aware`` looks exactly 1 and 12 *months* back and yields null across a gap.
    The window holds one row per calendar month of a series, which bounds it whatever the input.
    """
    series = Window.partitionBy(*SERIES)
    if calendar_aware:
        by_month = series.orderBy(periods.month_index("period_start"))
        month = F.first("value").over(by_month.rangeBetween(-1, -1))
        year = F.first("value").over(by_month.rangeBetween(-12, -12))
    else:
        by_row = series.orderBy("period_start")
        month, year = F.lag("value", 1).over(by_row), F.lag("value", 12).over(by_row)
    priors = latest.select(
        *SERIES,
        "period",
        "period_start",
        "value",
        month.alias("prior_month"),
        year.alias("prior_year"),
    )
    return priors.select(
        *SERIES,
        "period",
        "period_start",
        "value",
        pct_change(F.col("value"), F.col("prior_month")).alias("mom_pct_change"),
        pct_change(F.col("value"), F.col("prior_year")).alias("yoy_pct_change"),
    )


def dashboard(kpis: DataFrame, indicator_id: str | None = None) -> DataFrame:
    """The chart read: KPI rows in period order."""
    chosen = kpis if indicator_id is None else kpis.where(F.col("indicator_id") == indicator_id)
    return chosen.select(
        *SERIES, "period", "value", "mom_pct_change", "yoy_pct_change"
    ).orderBy("period", *SERIES)


def at_period(kpis: DataFrame, period: str) -> DataFrame:
    """Point lookup; the first-day column carries the predicate to partition or row-group pruning."""
    return kpis.where(
        (F.col("period_start") == F.lit(f"{period}-01").cast("date")) & (F.col("period") == period)
    )


def vintage_history(observations: DataFrame) -> DataFrame:
    return observations.select(*SERIES, "period", "vintage_date", "value").orderBy(
        *SERIES, "period", "vintage_date"
    )
