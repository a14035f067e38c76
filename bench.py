"""Benchmark: the full refresh (gold D21, silver D22, views) at one scale.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

1. The 42 operational source tables are derived once from the driver's
   tables and written as catalog tables, the account-keyed ones bucketed on
   the account key (``BENCH_LAYOUT=bucketed``, default; ``parquet`` writes
   plain folders); this set-up time is reported, not part of the value.
2. Each product is then built from those tables and written (gold, silver)
   or fully evaluated (views); wall seconds per product.

Prints ONE JSON line: metric, value (wall seconds of the whole refresh),
unit, queries (seconds per product step; independent gold steps and views
run as concurrent jobs, ``BENCH_PARALLEL``, default 4), sf. ``BENCH_REPEAT``
> 1 repeats the refresh and reports medians. ``BENCH_SERIAL=1`` adds a serial
refresh (``serial_wall_sec``, ``serial_queries``), whose step seconds no other
step disturbs. ``BENCH_PARTITIONS`` sets the
shuffle partitions and the bucket count (default 2 x cpus).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.params import Params  # noqa: E402
from ledgerline.plans import pipeline  # noqa: E402
from ledgerline.session import cluster_conf, get_session  # noqa: E402
from ledgerline.sources import Sources, write_source_tables, write_sources  # noqa: E402

STEP_KEYS = {
    "PortfolioEventSummary": "event_summary", "RowLaws": "row_laws",
    "Portfolio": "d01_portfolio", "Business": "d02_business", "Portfolio_Row": "d03_portfolio_row",
    "Portfolio_Aggregate": "d04_portfolio_aggregate", "Portfolio_Bid": "d05_portfolio_bid",
    "Complaints": "d06_complaints", "Complaint_Aggregate": "d07_complaint_aggregate", "PostSale": "d12_postsale",
    "PortfolioEvents": "d14_portfolio_events", "PortfolioFunding": "d15_portfolio_funding",
    "AccountFold": "account_fold", "RowAggregates": "d16_row_aggregates", "BidAggregates": "d17a_bid_aggregates",
    "PostSaleAggregates": "d17b_postsale_aggregates", "ComplaintsByBuyer": "d17c_complaints_by_buyer",
    "ComplaintsByPortfolio": "d17d_complaints_by_pid", "SilverBase": "d18_silver_base",
    "FormulaComplete": "d20_formula_complete", "_EC_Portfolio_Expanded": "d13_silver_expanded",
    "VW_Bidders": "d08_bidders", "VW_Boardmembers_EC_Portfolio_Bid": "d09_board_bid",
    "VW_Boardmembers_Buyer_Activity": "d10_buyer_activity", "VW_Boardmembers_ForwardFlow": "d11_forward_flow",
}


def _event_log_conf() -> dict[str, str]:
    """BENCH_EVENT_LOG_DIR: write Spark's event log there (stage/task times)."""
    d = os.environ.get("BENCH_EVENT_LOG_DIR")
    return {"spark.eventLog.enabled": "true", "spark.eventLog.dir": d} if d else {}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "1")))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    scratch = tempfile.mkdtemp(prefix="ledgerline-bench-")
    parts = int(os.environ.get("BENCH_PARTITIONS", str(max(8, 2 * cpus))))
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=parts, app="ledgerline-bench",
                        driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                        warehouse_dir=os.path.join(scratch, "warehouse"),
                        extra_conf={**cluster_conf(0, buckets=parts), **_event_log_conf()})
    layout = os.environ.get("BENCH_LAYOUT", "bucketed")
    params = Params.testing()

    t0 = time.monotonic()
    if layout == "bucketed":
        # account-keyed tables bucketed on the account key (sources/layout.py)
        write_source_tables(spark, Sources.from_testdata(spark, sf_dir), "ll_sources", parts, files=parts)
        src = Sources.from_catalog(spark, "ll_sources")
    else:
        # BENCH_SOURCES_DIR: reuse plain parquet source tables of an earlier run
        sources_dir = os.environ.get("BENCH_SOURCES_DIR") or os.path.join(scratch, "sources")
        if not os.path.exists(os.path.join(sources_dir, "portfolio")):
            write_sources(Sources.from_testdata(spark, sf_dir), sources_dir, files=parts)
        src = Sources.from_tables(spark, sources_dir)
    setup = time.monotonic() - t0

    parallel = int(os.environ.get("BENCH_PARALLEL", "4"))
    # the row laws are work of their own, which earlier rounds' figures do not hold: timed with BENCH_VERIFY=1
    verify = os.environ.get("BENCH_VERIFY", "0") == "1"
    runs: list[dict[str, float]] = []
    walls: list[float] = []
    for i in range(repeat):
        gold_root = os.path.join(scratch, f"run{i}", "gold")
        silver_root = os.path.join(scratch, f"run{i}", "silver")
        secs: dict[str, float] = {}
        w0 = time.monotonic()
        secs.update(pipeline.refresh_gold(spark, src, gold_root, params, max_parallel=parallel, verify=verify))
        secs.update(pipeline.refresh_silver(spark, src, gold_root, silver_root, params))
        secs.update(pipeline.run_views(spark, src, gold_root, silver_root, params, max_parallel=parallel))
        walls.append(time.monotonic() - w0)
        runs.append(secs)

    queries = {STEP_KEYS[k]: round(statistics.median(r[k] for r in runs), 3) for k in runs[0]}
    serial: dict[str, object] = {}
    if os.environ.get("BENCH_SERIAL", "0") == "1":
        gold_root, silver_root = os.path.join(scratch, "serial", "gold"), os.path.join(scratch, "serial", "silver")
        w0 = time.monotonic()
        secs = pipeline.refresh_gold(spark, src, gold_root, params, max_parallel=1, verify=verify)
        secs.update(pipeline.refresh_silver(spark, src, gold_root, silver_root, params))
        secs.update(pipeline.run_views(spark, src, gold_root, silver_root, params, max_parallel=1))
        serial = {"serial_wall_sec": round(time.monotonic() - w0, 3),
                  "serial_queries": {STEP_KEYS[k]: round(v, 3) for k, v in secs.items()}}
    print(json.dumps({
        "metric": "refresh_wall_sec",
        "value": round(statistics.median(walls), 3),
        "unit": "sec",
        "queries": queries,
        "sf": sf,
        "setup_sources_sec": round(setup, 3),
        "cpus": cpus,
        "partitions": parts,
        "layout": layout,
        "repeat": repeat,
        "parallel_steps": parallel,
        "row_laws_checked": verify,
        "sum_of_step_sec": round(sum(queries.values()), 3),
        **serial,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
