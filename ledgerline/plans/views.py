"""Live views D08–D11 over the gold / silver products.

Each takes the products it reads as optional DataFrames (the persisted
tables, in a refresh) and otherwise builds them from the sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import month_i, year_i
from ..operators import broadcast_if_small
from ..params import Params
from ..sources import Sources
from . import common as C
from . import gold, silver


COLLATION = "UTF8_LCASE_RTRIM"


def ci(c) -> F.Column:
    """Case-insensitive comparison key (F08/J12): the reference compares these
    ids under a collation that ignores case and trailing spaces and tells
    accents, kana and width apart."""
    return F.collate(c, COLLATION)


def plain(c) -> F.Column:
    """A key that is equal wherever ``ci`` is equal: the lower case, in which
    the collation takes a final sigma for any other. Collated text itself is
    neither hashed nor sorted as bytes."""
    return F.translate(F.lower(F.rtrim(c)), "\u03c2", "\u03c3")


def ci_equal(a, b) -> F.Column:
    """``ci(a) = ci(b)`` for pairs that meet on ``plain``: as two bounds, which
    the planner does not take for join keys."""
    return (ci(a) <= ci(b)) & (ci(a) >= ci(b))


def d08_bidders(src: Sources, params: Params | None = None, expanded: DataFrame | None = None,
                bids: DataFrame | None = None, business: DataFrame | None = None) -> DataFrame:
    """Distinct bidder client / buyer name / close month / close year."""
    prm = C.params_or_default(params)
    pe = expanded if expanded is not None else silver.d13_silver_expanded(src, prm, narrow=True)
    pb = bids if bids is not None else gold.d05_portfolio_bid(src, prm, narrow=True)
    b = business if business is not None else gold.d02_business(src, prm)

    ev = src["portfolio_event"].filter(C.p_viewer_events("EventType")).select("PortfolioId", "UserId")
    u = src["app_user"].select(F.col("Id").alias("_u_id"), F.col("TenantId").alias("_u_tenant"))
    bv = b.select(F.col("ClientTenantId").alias("_v_tenant"), F.col("ClientId").alias("C_ClientId"), "IsBuyer")
    viewers = (ev.join(u, ev["UserId"] == u["_u_id"], "left")
               .join(bv, ci(F.col("_u_tenant")) == ci(F.col("_v_tenant")), "left")
               .filter(F.col("IsBuyer") == 1)
               .select(F.col("PortfolioId").alias("C_PID"), "C_ClientId"))

    # The view keeps only DISTINCT (client, name, month, year) of rows with a
    # bid, so every side is reduced to its distinct rows before it meets the
    # next. The viewers depend on the portfolio alone: they meet it first.
    p = pe.select(F.col("Id").alias("_pe_id"), "PortfolioNumber", "BuyerClientId", "PortfolioCloseUtc", "Status")
    closed = (p.join(viewers, (ci(viewers["C_PID"]) == ci(p["_pe_id"])) & (ci(p["BuyerClientId"]) == ci(viewers["C_ClientId"])), "full")
              .filter((F.year("PortfolioCloseUtc") > prm.min_close_year) & (F.col("Status") != "Purged"))
              .select("PortfolioNumber", month_i("PortfolioCloseUtc").alias("BidderMonth"), year_i("PortfolioCloseUtc").alias("BidderYear"))
              .distinct().withColumn("_number", plain("PortfolioNumber")))
    # a portfolio holding a third of all bids brings at most one row per buyer
    # into the join, not every bid (reduced map-side)
    bidders = (pb.filter(F.col("Status").isNotNull())
               .select(F.col("PortfolioNumber").alias("PB_PortfolioNumber"), F.col("BuyerId").alias("PB_BuyerId"))
               .distinct().withColumn("PB_Status", F.lit("bid")).withColumn("_pb_number", plain("PB_PortfolioNumber")))
    offers = (closed.join(bidders, (F.col("_pb_number") == F.col("_number")) & ci_equal("PB_PortfolioNumber", "PortfolioNumber"), "left")
              .filter(F.col("PB_Status").isNotNull())
              .select("PB_BuyerId", "BidderMonth", "BidderYear").distinct().withColumn("_buyer", plain("PB_BuyerId")))
    firm = (b.select(F.col("Id").alias("_bb_id"), F.col("ClientId").alias("BidderClientId")).distinct()
            .withColumn("_firm", plain("_bb_id")))
    called = broadcast_if_small(b.select(F.col("Id").alias("_bn_id"), F.col("BusinessName").alias("BuyerName")).distinct()
                                .withColumn("_called", plain("_bn_id")))
    j = (offers.join(firm, (F.col("_buyer") == F.col("_firm")) & ci_equal("PB_BuyerId", "_bb_id"), "left")
         .join(called, (F.col("_buyer") == F.col("_called")) & ci_equal("PB_BuyerId", "_bn_id"), "left"))
    return j.select("BidderClientId", "BuyerName", "BidderMonth", "BidderYear").distinct()


def d09_board_bid(src: Sources, params: Params | None = None) -> DataFrame:
    """Joined bid table + the buyer's client id and client name."""
    pb = src["joined_portfolio_bid"]
    b = broadcast_if_small(src["business"].select(F.col("Id").alias("_b_id"), F.col("ClientId").alias("ClientId")))
    c = broadcast_if_small(src["client"].select(F.col("Id").alias("_c_id"), F.col("Name").alias("ClientName")))
    j = pb.join(b, pb["BuyerId"] == b["_b_id"], "left").join(c, F.col("ClientId") == c["_c_id"], "left")
    return j.select(*[pb[x] for x in pb.columns], "ClientId", "ClientName")


def d10_buyer_activity(src: Sources, params: Params | None = None, expanded: DataFrame | None = None) -> DataFrame:
    """First / last close date per buyer client (HAVING max IS NOT NULL)."""
    pe = expanded if expanded is not None else silver.d13_silver_expanded(src, params)
    return (pe.filter(F.col("BuyerClientId").isNotNull()).groupBy("BuyerClientId")
            .agg(F.max("PortfolioCloseUtc").alias("MaxDate"), F.min("PortfolioCloseUtc").alias("MinDate"))
            .filter(F.col("MaxDate").isNotNull()))


def forward_flow_portfolios(expanded: DataFrame) -> DataFrame:
    """Agreements with more than one expanded row, with the latest upload."""
    return (expanded.filter(F.col("ForwardFlowAgreementId").isNotNull()).groupBy("ForwardFlowAgreementId")
            .agg(F.max("UploadDateUtc").alias("MaxUploadDate"), F.count(F.lit(1)).alias("PortfolioCount"))
            .filter(F.col("PortfolioCount") > 1))


def d11_forward_flow(src: Sources, params: Params | None = None, expanded: DataFrame | None = None) -> DataFrame:
    """Agreements with at least two expanded rows, their end date and latest upload."""
    pe = expanded if expanded is not None else silver.d13_silver_expanded(src, params)
    ptj = forward_flow_portfolios(pe)
    ffa = src["forward_flow_agreement"].select("Id", "EndDate")
    j = ffa.join(ptj, ffa["Id"] == ptj["ForwardFlowAgreementId"], "left").filter(
        F.col("ForwardFlowAgreementId").isNotNull())
    return j.select("Id", "EndDate", "ForwardFlowAgreementId", "MaxUploadDate")
