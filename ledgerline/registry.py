"""
DuckDB oracles. ``__spark_entry__`` exposes these to the driver.

Every query reads the driver's tables in ``sf_dir`` through the fixture
projections, so its work grows with the data; parameters are the fixed test
parameters of FIXTURES.md (``Params.testing()``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .checks import oracle_gold, oracle_parts, oracle_silver
from .checks.oracle import render
from .params import Params
from .plans import gold, parts, silver, staging, views
from .session import apply_conf
from .sources import Sources

_SOURCES: dict[tuple[str, str], Sources] = {}


def sources_for(spark: SparkSession, sf_dir: str) -> Sources:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SOURCES:
        apply_conf(spark)
        _SOURCES[key] = Sources.from_testdata(spark, sf_dir, cache=True)
    return _SOURCES[key]


def _product(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(sources_for(spark, sf_dir), Params.testing())

    run.__name__ = getattr(fn, "__name__", "query")
    return run


# name -> (spark builder, oracle SQL over helper bodies)
def _entries() -> dict[str, tuple[Callable, str]]:
    e: dict[str, tuple[Callable, str]] = {
        "d01_portfolio": (gold.d01_portfolio, "select * from g_portfolio"),
        "d02_business": (gold.d02_business, "select * from g_business"),
        "d03_portfolio_row": (gold.d03_portfolio_row, "select * from g_portfolio_row"),
        "d04_portfolio_aggregate": (gold.d04_portfolio_aggregate, "select * from g_portfolio_aggregate"),
        "d05_portfolio_bid": (gold.d05_portfolio_bid, "select * from g_portfolio_bid"),
        "d06_complaints": (gold.d06_complaints, "select * from g_complaints"),
        "d07_complaint_aggregate": (gold.d07_complaint_aggregate, "select * from g_complaint_aggregate"),
        "d12_postsale": (gold.d12_postsale, "select * from g_postsale"),
        "d13_silver_expanded": (silver.d13_silver_expanded, "select * from s_expanded"),
        "d14_portfolio_events": (staging.d14_portfolio_events, "select * from st_portfolio_events"),
        "d15_portfolio_funding": (staging.d15_portfolio_funding, "select * from st_portfolio_funding"),
        "d16_row_aggregates": (staging.d16_row_aggregates, "select * from st_row_aggregates"),
        "d17a_bid_aggregates": (staging.d17a_bid_aggregates, "select * from st_bid_aggregates"),
        "d17b_postsale_aggregates": (staging.d17b_postsale_aggregates, "select * from st_postsale_aggregates"),
        "d17c_complaints_by_buyer": (staging.d17c_complaints_by_buyer, "select * from st_complaints_by_buyer"),
        "d17d_complaints_by_pid": (staging.d17d_complaints_by_pid, "select * from st_complaints_by_pid"),
        "d18_silver_base": (staging.d18_silver_base, "select * from st_silver_base"),
        "d20_formula_complete": (staging.d20_formula_complete, "select * from st_formula"),
        "d08_bidders": (views.d08_bidders, "select * from v_bidders"),
        "d09_board_bid": (views.d09_board_bid, "select * from v_board_bid"),
        "d10_buyer_activity": (views.d10_buyer_activity, "select * from v_buyer_activity"),
        "d11_forward_flow": (views.d11_forward_flow, "select * from v_forward_flow"),
    }
    part_sql = oracle_parts.queries(Params.testing())
    for name in parts.PARTS:
        e[name] = (getattr(parts, name), part_sql[name])
    return e


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _product(fn) for k, (fn, _) in _entries().items()}


def oracle_sql() -> dict[str, str]:
    prm = Params.testing()
    bodies = {**oracle_gold.bodies(prm), **oracle_silver.bodies(prm)}
    return {k: render(sql, bodies) for k, (_, sql) in _entries().items() if sql}
