"""Index-coded payloads: series and observations named by positions in lists that the payload carries.

The root holds the dimensions, each with its list of values, and data sets whose series are keyed by positions
("0:3:1": value 0 of the first dimension, 3 of the second, 1 of the third) and whose observations are keyed by a
position in the time dimension. Positions are decoded per series, inside the row that holds the lists, before
observations are unfolded, so the lists are neither copied per observation nor shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import silver

# Field names of the payload.
_DIMENSION = "struct<id: string, values: array<struct<id: string>>>"
_SERIES = "map<string, struct<observations: map<string, array<string>>>>"
PAYLOAD = (
    "struct<header: struct<prepared: string>, "
    f"structure: struct<dimensions: struct<series: array<{_DIMENSION}>, observation: array<{_DIMENSION}>>>, "
    f"dataSets: array<struct<series: {_SERIES}>>>"
)
NO_STRUCTURE = "payload has no dimensions"


def _code(values: Column, position: Column) -> Column:
    """The code at a position written as text; null for a position outside the list."""
    place = position.try_cast("int")
    return F.when(place >= 0, F.get(values, place)["id"])


def decode(key: Column, dimensions: Column) -> Column:
    """Map of dimension to code for a key of positions, with null for positions that name nothing."""
    places = F.split(key, ":")
    entries = F.transform(
        dimensions, lambda d, i: F.struct(d["id"].alias("key"), _code(d["values"], F.get(places, i)).alias("value"))
    )
    return F.map_from_entries(entries)


def period_text(period: Column) -> Column:
    """First day of a period as ISO text: a day, month (2024-03), quarter (2024-Q1) or year."""
    quarter = F.regexp_extract(period, r"^\d{4}-Q([1-4])$", 1)
    month = F.lpad((quarter.try_cast("int") * 3 - 2).cast("string"), 2, "0")
    return (
        F.when(period.rlike(r"^\d{4}-\d{2}$"), F.concat(period, F.lit("-01")))
        .when(quarter != "", F.concat(F.substring(period, 1, 4), F.lit("-"), month, F.lit("-01")))
        .when(period.rlike(r"^\d{4}$"), F.concat(period, F.lit("-01-01")))
        .otherwise(period)
    )


def parse(bronze: DataFrame) -> DataFrame:
    """A row per observation: carried columns, series_key, codes, date_text, value_text, vintage_text, problem.

    Unreadable payloads give one row that names its problem, and so does every observation whose key holds a
    position outside its list, or more or fewer positions than there are dimensions.
    """
    carried = [c for c in bronze.columns if c != "payload"]
    text = F.decode("payload", "UTF-8")
    body = bronze.select(*carried, F.from_json(text, PAYLOAD).alias("b"), F.try_parse_json(text).isNull().alias("bad"))
    dimensions = F.col("b.structure.dimensions.series")
    times = F.get(F.col("b.structure.dimensions.observation"), 0)["values"]
    sets = F.flatten(F.transform("b.dataSets", lambda d: F.map_entries(d["series"])))
    decoded = F.transform(
        sets,
        lambda s: F.struct(
            s["key"].alias("series_key"),
            decode(s["key"], dimensions).alias("codes"),
            (F.size(F.split(s["key"], ":")) == F.size(dimensions)).alias("fits"),
            F.transform(
                F.map_entries(s["value"]["observations"]),
                lambda o: F.struct(_code(times, o["key"]).alias("period"), F.get(o["value"], 0).alias("value_text")),
            ).alias("observations"),
        ),
    )
    problem = F.when(F.col("bad"), silver.NOT_JSON).when(dimensions.isNull() | times.isNull(), NO_STRUCTURE)
    kind = "array<struct<series_key:string,codes:map<string,string>,fits:boolean,observations:array<struct<period:string,value_text:string>>>>"
    blank = F.array(F.lit(None)).cast(kind)
    rows = body.select(
        *carried,
        problem.alias("whole"),
        F.col("b.header.prepared").alias("vintage_text"),
        F.explode(F.when(problem.isNull(), decoded).otherwise(blank)).alias("s"),
    )
    none = F.array(F.lit(None)).cast("array<struct<period:string,value_text:string>>")
    rows = rows.select(*carried, "whole", "vintage_text", "s", F.explode(F.when(F.col("whole").isNull(), F.col("s.observations")).otherwise(none)).alias("o"))
    lost = F.array_sort(F.map_keys(F.map_filter("s.codes", lambda k, v: v.isNull())))
    trouble = (
        F.when(F.col("whole").isNotNull(), F.col("whole"))
        .when(~F.col("s.fits"), "key does not fit the dimensions")
        .when(F.size(lost) > 0, F.concat(F.lit("no value at the position of "), F.array_join(lost, ", ")))
        .when(F.col("o.period").isNull(), "no value at the position of the period")
    )
    return rows.select(
        *carried,
        F.col("s.series_key").alias("series_key"),
        F.col("s.codes").alias("codes"),
        period_text(F.col("o.period")).alias("date_text"),
        F.col("o.value_text").alias("value_text"),
        "vintage_text",
        trouble.alias("problem"),
    )


def conform(
    bronze: DataFrame,
    roles: Mapping[str, str],
    code_lists: Mapping[str, DataFrame],
    dim_indicator: DataFrame,
    run_at: datetime,
) -> silver.Conformed:
    """Observation rows from index-coded payloads; what a code list does not know is held back, not dropped.

    ``roles`` says which dimension gives ``indicator_id`` and which ``geo_code``; ``code_lists`` holds a frame
    (code, canonical) per such dimension. Code lists join as dimensions do, on one row per observation.
    """
    parsed = parse(bronze)
    rows = parsed.where("problem is null")
    held = [silver.unreadable(parsed)]
    for dimension, field in roles.items():
        rows = rows.withColumn("code", F.element_at("codes", dimension))
        listed = code_lists[dimension].select(F.col("code").alias("listed"), F.col("canonical").alias(field))
        rows = rows.join(listed, F.col("code") == F.col("listed"), "left").drop("listed")
        unknown = rows.where(F.col(field).isNull()).withColumn(
            "problem", F.concat(F.lit(f"unknown {dimension}: "), F.coalesce("code", F.lit("null")))
        )
        held.append(silver.unreadable(unknown))
        rows = rows.where(F.col(field).isNotNull()).drop("code")
    typed = silver.type_records(rows)
    held.append(silver.undated(typed))
    usable = typed.where("observed_date is not null and vintage_date is not null and value is not null")
    return silver.Conformed(
        silver.described(silver.newest_retrieval(usable), dim_indicator, run_at), reduce(DataFrame.unionByName, held)
    )
