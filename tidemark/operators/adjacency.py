"""Comparing neighbours in very long series without one task per series.

A window over a series puts the whole series into one task. Here rows are range-partitioned on
(series, order), so a series of any length spreads over as many tasks as it needs, and each task
compares the neighbours inside its range. Every task also emits its first and last row; the pairs
that straddle two tasks are found among those, at most two rows per task.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The functions below run in Python workers; shipped by value they work on executors where the
# package is not installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

INSIDE, FIRST, LAST = 0, 1, 2
PREV = "_prev_"

ArrowTest = Callable[[pa.Table, pa.Table], np.ndarray]


def neighbours(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    carried: Sequence[str],
    arrow_test: ArrowTest,
    column_test: Column,
) -> DataFrame:
    """Rows that pass a test against the row before them in their series, with ``_prev_`` columns
    of the carried ones.

    The test comes twice: ``arrow_test`` over (rows, rows before) inside a range and
    ``column_test`` over a column and its ``_prev_`` column for pairs across ranges.
    """
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in series]
    keyed = df.withColumn("_key", F.concat_ws("\u0001", *parts))
    ordered = keyed.repartitionByRange("_key", *order).sortWithinPartitions("_key", *order)
    before = [T.StructField(PREV + c, keyed.schema[c].dataType) for c in carried]
    schema = T.StructType([*keyed.schema.fields, *before, T.StructField("_edge", T.IntegerType())])
    found = ordered.mapInArrow(_scanner(list(carried), arrow_test), schema)

    # Pairs inside a range are already decided and only need to stay out of the way of the edges: each
    # task's pairs are a lane of their own.
    inside = F.col("_edge") == INSIDE
    found = found.withColumn("_lane", F.when(inside, 1 + F.spark_partition_id()).otherwise(0))
    edges = Window.partitionBy("_key", "_lane").orderBy(*order, "_edge")
    paired = found.withColumns(
        {
            **{
                PREV + c: F.when(inside, F.col(PREV + c)).otherwise(F.lag(c).over(edges)) for c in carried
            },
            "_has_prev": inside | F.lag("_edge").over(edges).isNotNull(),
        }
    )
    straddling = (F.col("_edge") == FIRST) & F.col("_has_prev") & column_test
    return paired.where(inside | straddling).drop("_key", "_edge", "_lane", "_has_prev")


def _scanner(carried: list[str], test: ArrowTest):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: pa.Table | None = None
        seen = 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = pa.Table.from_batches([batch])
            if carry is None:
                yield from _marked(rows.slice(0, 1), None, carried, FIRST)
            else:
                rows = pa.concat_tables([carry, rows])
            seen += batch.num_rows
            if rows.num_rows > 1:
                later, earlier = rows.slice(1), rows.slice(0, rows.num_rows - 1)
                same = pc.equal(later.column("_key"), earlier.column("_key")).to_numpy()
                hit = pa.array(np.flatnonzero(same & test(later, earlier)))
                if len(hit):
                    yield from _marked(later.take(hit), earlier.take(hit), carried, INSIDE)
            carry = rows.slice(rows.num_rows - 1, 1)
        if carry is not None and seen > 1:
            yield from _marked(carry, None, carried, LAST)

    return scan


def _marked(rows: pa.Table, before: pa.Table | None, carried: list[str], edge: int) -> Iterator[pa.RecordBatch]:
    for name in carried:
        kind = rows.schema.field(name).type
        prev = pa.nulls(rows.num_rows, kind) if before is None else before.column(name)
        rows = rows.append_column(PREV + name, prev)
    rows = rows.append_column("_edge", pa.array(np.full(rows.num_rows, edge, dtype=np.int32)))
    yield from rows.combine_chunks().to_batches()


def extreme_moves(
    df: DataFrame,
    series: Sequence[str],
    at: Column,
    value: Column,
    tiebreak: Sequence[str] = (),
    threshold_pct: float = 1000.0,
) -> DataFrame:
    """Adjacent pairs whose absolute change exceeds ``threshold_pct`` percent of the earlier value.

    Rows without a time or value take no part; a pair whose earlier value is zero is passed over.
    Result: the series columns, ``from_at``, ``to_at``, ``from_value``, ``to_value``,
    ``pct_change`` and the tie-break columns of the later row.
    """
    rows = df.select(*series, *tiebreak, F.unix_micros(at).alias("_at"), value.cast("double").alias("_value")).where(
        F.col("_at").isNotNull() & F.col("_value").isNotNull()
    )
    now, before = F.col("_value"), F.col(PREV + "_value")
    change = F.abs((now - before) / F.nullif(before, F.lit(0.0))) * 100
    moves = neighbours(
        rows,
        series,
        ["_at", *tiebreak],
        ["_at", "_value"],
        _moves_more_than(threshold_pct),
        (change > threshold_pct) & ~F.isnan(change),
    )
    return moves.select(
        *series,
        *tiebreak,
        F.timestamp_micros(PREV + "_at").alias("from_at"),
        F.timestamp_micros("_at").alias("to_at"),
        before.alias("from_value"),
        now.alias("to_value"),
        change.alias("pct_change"),
    )


def _moves_more_than(threshold_pct: float) -> ArrowTest:
    def test(later: pa.Table, earlier: pa.Table) -> np.ndarray:
        now, before = later.column("_value").to_numpy(), earlier.column("_value").to_numpy()
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            return (before != 0) & (np.abs((now - before) / before) * 100 > threshold_pct)

    return test


def changes(df: DataFrame, series: Sequence[str], order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Rows that differ from the row before them in any of ``fields``; null equals null and NaN NaN."""
    differs = F.lit(False)
    for name in fields:
        differs = differs | ~F.col(name).eqNullSafe(F.col(PREV + name))
    return neighbours(df, series, order, fields, _differ_in(list(fields)), differs)


def _differ_in(fields: list[str]) -> ArrowTest:
    def test(later: pa.Table, earlier: pa.Table) -> np.ndarray:
        out = np.zeros(later.num_rows, dtype=bool)
        for name in fields:
            a, b = later.column(name), earlier.column(name)
            one_null = pc.xor(pc.is_null(a), pc.is_null(b))
            unequal = pc.fill_null(pc.not_equal(a, b), False)
            if pa.types.is_floating(a.type):  # NaN equals NaN, as between ranges
                unequal = pc.and_not(unequal, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
            out |= pc.or_(unequal, one_null).to_numpy()
        return out

    return test
