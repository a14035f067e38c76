"""Silver product D13: the expanded portfolio table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.core import month_i, quarter_i, year_i
from ..operators import broadcast_if_small
from ..params import Params
from ..sources import Sources
from . import common as C
from . import staging

GOAL_COL = "GoalPercentageOfPostSaleRequestsCompletedIn30DaysOrLess"  # name as published (C20)


def goals_by_month(src: Sources, prm: Params) -> DataFrame:
    """The goal metric by year and month ('YYYYMM' or 'YYYY-MM')."""
    g = src["goals"].filter(F.col("Metric") == prm.goal_metric)
    return g.select(F.col("Value").alias(GOAL_COL),
                    F.left(F.col("YearMonth"), F.lit(4)).cast("int").alias("GoalYear"),
                    F.right(F.col("YearMonth"), F.lit(2)).cast("int").alias("GoalMonth"))


def macro_by_quarter(src: Sources) -> DataFrame:
    """SELECT DISTINCT * of the macro table plus its year/month/quarter."""
    m = src["macro"].distinct()
    return m.select("*", year_i("FormattedDate").alias("MacroeconomicDateYear"),
                    month_i("FormattedDate").alias("MacroeconomicDateMonth"),
                    quarter_i("FormattedDate").alias("MacroeconomicDateQuarter"))


def with_goal(formula: DataFrame, src: Sources, prm: Params) -> DataFrame:
    """J14 (month): left join the goal of the listed month (fans out on repeats)."""
    g = broadcast_if_small(goals_by_month(src, prm))
    j = formula.join(g, (g["GoalYear"] == formula["ListedUtcYear"]) & (g["GoalMonth"] == formula["ListedUtcMonth"]),
                     "left")
    return j.select(*[formula[f"`{c}`"] for c in formula.columns], GOAL_COL)


def with_close_parts(df: DataFrame) -> DataFrame:
    return df.select("*", month_i("PortfolioCloseUtc").alias("PortfolioCloseUtcMonth"),
                     year_i("PortfolioCloseUtc").alias("PortfolioCloseUtcYear"),
                     quarter_i("PortfolioCloseUtc").alias("PortfolioCloseUtcQuarter"))


def d13_silver_expanded(src: Sources, params: Params | None = None, formula: DataFrame | None = None, narrow: bool = False) -> DataFrame:
    prm = C.params_or_default(params)
    f15 = formula if formula is not None else staging.d20_formula_complete(src, prm, narrow=narrow)
    f1 = with_close_parts(with_goal(f15, src, prm))
    m = broadcast_if_small(macro_by_quarter(src))
    j = f1.join(m, (f1["PortfolioCloseUtcQuarter"] == m["MacroeconomicDateQuarter"])
                & (f1["PortfolioCloseUtcYear"] == m["MacroeconomicDateYear"]), "left")
    j = j.filter(C.p_null_keeping_exclude("SellerLegalName", prm.excluded_seller_legal_name)
                 & C.p_null_keeping_exclude("SellerClientName", prm.excluded_seller_client))
    avg_wo = F.col(f"`{staging.AVG_WRITE_OFF}`")
    return j.select(
        *[f1[f"`{c}`"] for c in f1.columns], *[m[c] for c in m.columns],
        R.warehoused("PSAConfirmedUtc", "PSAConfirmedUtc", avg_wo).alias("WarehousedAvgWriteOfftoPSAConfirmed"),
        R.warehoused("PortfolioCloseUtc", "PSAConfirmedUtc", avg_wo).alias("WarehousedAvgWriteOfftoPortfolioClosed"),
        R.warehoused("SoldUtc", "PSAConfirmedUtc", avg_wo).alias("WarehousedAvgWriteOfftoSold"),
    )
