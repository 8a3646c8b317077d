"""Times the headline queries and prints one JSON line.

The domain tables are stored first, facts by fiscal year, so that a query starts from
a table as it would in use. Every query is run to completion into the no-op sink, once
to warm up and then ``BENCH_REPEATS`` times (default 2), of which the best counts. Where
the tables of a tenth of the size lie beside the given ones, they are timed as well:
``fixed`` is what a query costs without rows and ``rows_per_second`` the facts it gets
through beyond that.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from periodica import build_session
from periodica.workload.registry import load
from periodica.workload.views import Views

HEADLINE = (
    "core_financials", "core_financials_latest_parts", "facts_normalized", "balance_effective", "fx_asof",
    "asof_by_key", "quality_issues", "field_coverage", "company_overview", "financial_series", "ratios",
    "compare_companies", "latest_annual", "pit_facts", "pit_facts_dates", "members_at", "membership_sanity",
    "pit_universe", "facts_provenance", "price_latest", "dup_facts", "integrity_audit", "stub_companies",
    "unit_distribution", "dedup_keep_first", "insert_new_result", "companyfacts_explode", "facts_ingest",
    "join_interval", "overlapping_listings", "insert_table", "prices_table", "snapshot_refresh", "fx_rates_table",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_driver_memory="16g",
        spark_ui_enabled="false", spark_ui_showConsoleProgress="false",
        spark_checkpoint_dir=tempfile.mkdtemp(prefix="periodica-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    times, facts = timed(spark, folder, names, repeats)
    smaller = os.path.join(os.path.dirname(folder.rstrip("/")), {"sf0.1": "sf0.01", "sf0.01": "sf0.001"}.get(
        os.path.basename(folder.rstrip("/")), "none"))
    fixed, rates = {}, {}
    if os.path.isdir(smaller):
        before, fewer = timed(spark, smaller, names, repeats)
        for name in names:
            slope = (times[name] - before[name]) / (facts - fewer)
            fixed[name] = round(max(times[name] - max(slope, 0.0) * facts, 0.0), 3)
            # Where the input hardly grows, the difference is noise and gives no rate.
            if times[name] - before[name] > 0.1:
                rates[name] = round(1 / slope)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "facts": facts, "fixed": fixed,
                "rows_per_second": rates,
            }
        )
    )


def timed(spark, folder: str, names, repeats: int) -> tuple[dict[str, float], int]:
    """Best seconds of each query over stored tables, and the number of facts."""
    views = Views(spark, folder).stored(tempfile.mkdtemp(prefix="periodica-tables-") + "/t", {"financial_facts": "fiscal_year"})
    queries, times = load(), {}
    for name in names:
        best = None
        for turn in range(repeats + 1):
            begun = time.perf_counter()
            queries[name].over(views).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - begun
            if turn and (best is None or took < best):
                best = took
        times[name] = round(best, 3)
        print(f"{os.path.basename(folder)} {name} {best:.3f}", file=sys.stderr, flush=True)
    return times, views["financial_facts"].count()


if __name__ == "__main__":
    main()
