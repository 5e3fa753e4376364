"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS], one JSON line.

Each query runs once to warm up and then $BENCH_RUNS times; the median counts. Results go to
Spark's no-op sink, so the whole result is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidemark import schemas
from tidemark.operators import gold
from tidemark.plans import catalogue
from tidemark.session import local_session, scratch_path
from tidemark.sources import tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "flagship_kpi gold_kpi gold_kpi_calendar gold_dashboard gold_point_lookup silver_observations second_source "
    "latest_by_key bronze_idempotent checksum_split json_extract_cast period_fields dq_schema dq_uniqueness "
    "dq_completeness dq_freshness dq_ohlc dq_referential dq_reconciliation dq_outliers dq_verdict alert_consecutive "
    "alert_freshness dlq_first_wins dlq_replay as_of as_of_dates alignment ohlcv_bars trade_observations lineage "
    "revision_diff stream_event_counts"
).split()


def timed(spark, name: str) -> float:
    began = time.perf_counter()
    catalogue.ENTRIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def stored_gold_reads(spark) -> dict[str, float]:
    """Median seconds of the two reads over a stored Gold table that have targets: dashboard 5 s, lookup 1 s."""
    path = scratch_path(spark, "bench-gold")
    kpis = catalogue.ENTRIES["gold_kpi"](spark, SF_DIR)
    tables.replace(kpis, path, "indicator_id")

    def read(rows) -> float:
        began = time.perf_counter()
        rows(tables.read_replaced(spark, path, schemas.KPI)).collect()
        return time.perf_counter() - began

    def median(rows) -> float:
        read(rows)
        return round(statistics.median(read(rows) for _ in range(20)), 3)

    return {
        "stored_gold_read": median(lambda kpis: gold.dashboard(kpis, "BUILDING")),
        "stored_gold_lookup": median(lambda kpis: gold.at_period(kpis, "1997-03")),
    }


def main() -> None:
    spark = local_session(CPUS, int(CPUS) if CPUS.isdigit() else 8)
    wanted = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in wanted:
        timed(spark, name)
        seconds[name] = round(statistics.median(timed(spark, name) for _ in range(RUNS)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    if not sys.argv[1:]:
        seconds |= stored_gold_reads(spark)
    print(
        json.dumps(
            {
                "metric": "total of median warm seconds over the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
