"""Operator-level queries: each predicate, join, aggregate, window and rule of
the products use. Keys follow the survey's Query column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.core import quarter_i, year_i
from ..operators import broadcast_if_small, current_names, prev_period_join
from ..params import Params
from ..sources import Sources
from . import common as C
from . import gold, silver, staging, views


def _p(params):
    return C.params_or_default(params)


# ------------------------------------------------------------------ predicates
def p_exclude_party(src: Sources, params: Params | None = None) -> DataFrame:
    return src["portfolio"].filter(C.p_exclude_party("SellerId", _p(params).excluded_seller)).select("Id", "SellerId")


def p_not_in_or_null(src: Sources, params: Params | None = None) -> DataFrame:
    return src["portfolio"].filter(C.p_not_in_or_null("BuyerId", _p(params).excluded_buyers)).select("Id", "BuyerId")


def p_not_in(src: Sources, params: Params | None = None) -> DataFrame:
    return src["business"].filter(C.p_not_in("Id", _p(params).excluded_businesses)).select("Id")


def p_status_in(src: Sources, params: Params | None = None) -> DataFrame:
    return src["portfolio"].filter(C.p_status_in("Status")).select("Id", "Status")


def p_event_type(src: Sources, params: Params | None = None) -> DataFrame:
    return src["portfolio_event"].filter(F.col("EventType") == "Awarded").select("Id", "PortfolioId", "EventType")


def p_viewer_events(src: Sources, params: Params | None = None) -> DataFrame:
    return src["portfolio_event"].filter(C.p_viewer_events("EventType")).select("Id", "PortfolioId", "EventType")


def p_open_name(src: Sources, params: Params | None = None) -> DataFrame:
    return current_names(src["business_name"], "BusinessId", "Name", "StartDateUtc")


def p_null_keeping_exclude(src: Sources, params: Params | None = None) -> DataFrame:
    prm = _p(params)
    return src["business"].filter(C.p_null_keeping_exclude("LegalName", prm.excluded_seller_legal_name)).select(
        "Id", "LegalName")


# ------------------------------------------------------------------ aggregates
def a_last_download(src, params=None):
    return C.last_downloads(src)


def a_bid_stats(src, params=None):
    return gold.bid_stats(src)


def a_seller_stats(src, params=None):
    return gold.party_portfolio_stats(src, "SellerId", _p(params).as_of_utc)


def a_buyer_stats(src, params=None):
    return gold.party_portfolio_stats(src, "BuyerId", _p(params).as_of_utc)


def a_awarded_events(src, params=None):
    return gold.awarded_events(src)


def a_login_stats(src, params=None):
    return gold.login_stats(src, _p(params))


def a_active_parties(src: Sources, params: Params | None = None) -> DataFrame:
    prm = _p(params)
    s = gold.active_parties(src, "SellerId", prm.as_of_utc).select(F.lit("Seller").alias("Role"),
                                                                   F.col("SellerId").alias("PartyId"))
    b = gold.active_parties(src, "BuyerId", prm.as_of_utc).select(F.lit("Buyer").alias("Role"),
                                                                  F.col("BuyerId").alias("PartyId"))
    return s.unionByName(b)


def a_min_name_start(src, params=None):
    return C.open_name_min_start(src)


def a_listed_dates(src, params=None):
    return C.listed_dates(src, present_only=True)


def a_awarded_dates_ci(src, params=None):
    return C.awarded_dates_ci(src, present_only=True)


def a_awarded_dates(src, params=None):
    return C.awarded_dates(src, present_only=True)


def a_postsale_counts(src, params=None):
    return C.postsale_counts(src)


def a_close_dates(src, params=None):
    return C.close_dates(src)


def a_macro_distinct(src, params=None):
    return silver.macro_by_quarter(src)


# ------------------------------------------------------------------ windows (first hit per account)
def w_deceased_hits(src, params=None):
    return C.deceased_hits(src)


def w_bankruptcy_hits(src, params=None):
    return C.bankruptcy_hits(src)


def w_scra_hits(src, params=None):
    return C.scra_hits(src)


def w_pifsif_hits(src, params=None):
    return C.pifsif_hits(src)


def w_account_closed(src, params=None):
    return C.account_closed_hits(src)


def w_first_hit(src: Sources, params: Params | None = None) -> DataFrame:
    """Every account left-joined to its first deceased hit."""
    pr = src["portfolio_row"].select("PortfolioRowGuid")
    d = C.deceased_hits(src).withColumnRenamed("DebtAccountId", "_d_id")
    j = pr.join(d, pr["PortfolioRowGuid"] == d["_d_id"], "left")
    return j.select("PortfolioRowGuid", "DateOfDeath",
                    F.coalesce(F.col("TotalDeceasedHits"), F.lit(0)).alias("TotalDeceasedHits"))


# ------------------------------------------------------------------ joins
def j_inner_dim(src: Sources, params: Params | None = None) -> DataFrame:
    p = src["portfolio"].select("Id", "PortfolioTypeId")
    pt = broadcast_if_small(C.renamed(src["portfolio_type"], {"Id": "_pt_id", "TypeName": "TypeName"}))
    return p.join(pt, p["PortfolioTypeId"] == pt["_pt_id"], "inner").select("Id", "TypeName")


def j_current_name(src: Sources, params: Params | None = None) -> DataFrame:
    p = src["portfolio"].select("Id", "SellerId")
    n = broadcast_if_small(C.business_with_open_name(src, "_bs_id", "SellerName"))
    return p.join(n, p["SellerId"] == n["_bs_id"], "inner").select("Id", "SellerName")


def j_left_dim(src: Sources, params: Params | None = None) -> DataFrame:
    p = src["portfolio"].select("Id")
    a = C.renamed(src["auction"], {"PortfolioId": "_a_pid", "Id": "AuctionId", "AuctionType": "AuctionType"})
    return p.join(a, p["Id"] == a["_a_pid"], "left").select("Id", "AuctionId", "AuctionType")


def j_left_preagg(src: Sources, params: Params | None = None) -> DataFrame:
    p = src["portfolio"].select("Id", "BuyerId")
    d = broadcast_if_small(C.renamed(C.last_downloads(src), {"BusinessId": "_d_id", "MaxDownloadedUtc": "BuyerDownloaded"}))
    return p.join(d, p["BuyerId"] == d["_d_id"], "left").select("Id", "BuyerId", "BuyerDownloaded")


def j_role_playing(src: Sources, params: Params | None = None) -> DataFrame:
    """Business and Client joined twice, as buyer and as seller."""
    p = src["portfolio"].select("Id", "BuyerId", "SellerId")
    bus = src["business"].select(F.col("Id").alias("_b_id"), F.col("ClientId").alias("_b_cid"))
    cli = broadcast_if_small(src["client"].select(F.col("Id").alias("_c_id"), F.col("Name").alias("_c_name")))
    bc = broadcast_if_small(bus.join(cli, F.col("_b_cid") == F.col("_c_id"), "inner").select("_b_id", "_c_name"))
    bb = bc.select(F.col("_b_id").alias("_bb"), F.col("_c_name").alias("BuyerClient"))
    bs = bc.select(F.col("_b_id").alias("_bs"), F.col("_c_name").alias("SellerClient"))
    return (p.join(bb, p["BuyerId"] == bb["_bb"], "inner").join(bs, p["SellerId"] == bs["_bs"], "inner")
            .select("Id", "BuyerClient", "SellerClient"))


def j_first_last_award(src: Sources, params: Params | None = None) -> DataFrame:
    """Composite-key joins of the seller's first / last portfolio number to
    the first-awarded dates."""
    s = gold.party_portfolio_stats(src, "SellerId", _p(params).as_of_utc).select("SellerId", "MinPid", "MaxPid")
    ae = gold.awarded_events(src)
    f = C.renamed(ae, {"SellerId": "_f_sid", "PortfolioNumber": "_f_pn", "EventUtc": "FirstPidAwardedDate"})
    last = C.renamed(ae, {"SellerId": "_l_sid", "PortfolioNumber": "_l_pn", "EventUtc": "LastPidAwardedDate"})
    j = (s.join(f, (f["_f_sid"] == s["SellerId"]) & (f["_f_pn"] == s["MinPid"]), "left")
         .join(last, (last["_l_sid"] == s["SellerId"]) & (last["_l_pn"] == s["MaxPid"]), "left"))
    return j.select("SellerId", "MinPid", "MaxPid", "FirstPidAwardedDate", "LastPidAwardedDate")


def j_prev_month(src: Sources, params: Params | None = None) -> DataFrame:
    a = src["complaint_aggregate"]
    j = prev_period_join(a, a, ["AggregateType"], ["BuyerGuid", "SellerGuid", "AgencyGuid"], "Month", "Year",
                         {"Value": "PreviousMonthValue"})
    return j.select(*a.columns, "PreviousMonthValue")


def j_full_outer(src: Sources, params: Params | None = None) -> DataFrame:
    """Full outer join on two keys – bids per (portfolio, buyer) against
    the (portfolio, buyer) pairs of sold portfolios."""
    bids = src["portfolio_bid"].groupBy("PortfolioId", "BuyerId").agg(F.count(F.lit(1)).alias("Bids"))
    owners = src["portfolio"].filter(F.col("BuyerId").isNotNull()).select(
        F.col("Id").alias("_o_pid"), F.col("BuyerId").alias("_o_bid"))
    j = bids.join(owners, (bids["PortfolioId"] == owners["_o_pid"]) & (bids["BuyerId"] == owners["_o_bid"]), "full")
    return j.select(F.coalesce("PortfolioId", "_o_pid").alias("PortfolioId"),
                    F.coalesce("BuyerId", "_o_bid").alias("BuyerId"),
                    F.coalesce("Bids", F.lit(0)).alias("Bids"),
                    R.exists_flag("_o_pid").alias("IsOwner"))


def j_case_insensitive(src: Sources, params: Params | None = None) -> DataFrame:
    """Users to clients on tenant ids compared case-insensitively."""
    u = src["app_user"].select(F.col("Id").alias("UserId"), F.col("TenantId").alias("_u_t"))
    c = broadcast_if_small(src["client"].select(F.col("Id").alias("ClientId"), F.col("TenantId").alias("_c_t")))
    return u.join(c, views.ci(F.col("_u_t")) == views.ci(F.col("_c_t")), "inner").select("UserId", "ClientId")


def j_left_filtered_right(src: Sources, params: Params | None = None) -> DataFrame:
    """The right-side predicate (open name) sits in the join, so complaints
    without a named creator keep their row."""
    ct = src["complaint"].select("Id", "CreatedByBusinessId")
    n = broadcast_if_small(current_names(src["business_name"]).select(F.col("BusinessId").alias("_n_id"),
                                                                      F.col("Name").alias("CreatorName")))
    return ct.join(n, ct["CreatedByBusinessId"] == n["_n_id"], "left").select("Id", "CreatedByBusinessId",
                                                                              "CreatorName")


def j_goal_month(src: Sources, params: Params | None = None) -> DataFrame:
    """Goal of the month in which the portfolio was first listed."""
    prm = _p(params)
    p = src["portfolio"].select("Id")
    ld = C.listed_dates(src).withColumnRenamed("PortfolioId", "_ld_pid")
    x = p.join(ld, p["Id"] == ld["_ld_pid"], "left").select(
        "Id", F.year("ListedUtc").cast("int").alias("ListedUtcYear"),
        F.month("ListedUtc").cast("int").alias("ListedUtcMonth"))
    return silver.with_goal(x, src, prm)


def j_macro_quarter(src: Sources, params: Params | None = None) -> DataFrame:
    """J14 (quarter): macro rows of the close quarter (fans out)."""
    p = src["portfolio"].select("Id", year_i("PortfolioCloseUtc").alias("_y"), quarter_i("PortfolioCloseUtc").alias("_q"))
    m = broadcast_if_small(silver.macro_by_quarter(src))
    j = p.join(m, (p["_y"] == m["MacroeconomicDateYear"]) & (p["_q"] == m["MacroeconomicDateQuarter"]), "left")
    return j.select("Id", "FormattedDate", "MacroIndex")


def j_satellite_fanout(src: Sources, params: Params | None = None) -> DataFrame:
    """Optional 1:N satellites left-joined to requests, not de-duplicated."""
    r = src["request"].select("Id")
    lg = C.renamed(src["legal"], {"RequestId": "_lg", "Explanation": "LegalExplanation"})
    ot = C.renamed(src["other"], {"RequestId": "_ot", "Explanation": "OtherExplanation"})
    fr = C.renamed(src["fraud"], {"RequestId": "_fr", "Explanation": "FraudExplanation"})
    ps = C.renamed(src["pifsif"], {"RequestId": "_ps", "PifSifType": "PifSifType"})
    j = (r.join(lg, r["Id"] == lg["_lg"], "left").join(ot, r["Id"] == ot["_ot"], "left")
         .join(fr, r["Id"] == fr["_fr"], "left").join(ps, r["Id"] == ps["_ps"], "left"))
    return j.select(F.col("Id").alias("RequestId"), "LegalExplanation", "OtherExplanation", "FraudExplanation",
                    "PifSifType")


def j_subtype_chain(src: Sources, params: Params | None = None) -> DataFrame:
    """Buyer subtype -> business -> open name; NULL unless the subtype row exists."""
    a = src["complaint_aggregate"].select("AggregateType", "BuyerGuid", "Month", "Year")
    names = (C.renamed(src["business_buyer"], {"Id": "_bb_id"})
             .join(C.business_with_open_name(src, "_b_id", "BuyerBusinessName"), F.col("_bb_id") == F.col("_b_id"),
                   "left").drop("_b_id"))
    j = a.join(broadcast_if_small(names), a["BuyerGuid"] == F.col("_bb_id"), "left")
    return j.select("AggregateType", "BuyerGuid", "Month", "Year", "BuyerBusinessName")


# ------------------------------------------------------------------ rules
def c_asset_type(src, params=None):
    pr = src["portfolio_row"]
    return pr.select("PortfolioRowGuid", "Product", R.asset_class_folded("Product").alias("AssetType"))


def c_asset_type_cs(src, params=None):
    pr = src["portfolio_row"]
    return pr.select("PortfolioRowGuid", "Product", R.asset_class_exact("Product").alias("AssetType"))


def c_license_type(src, params=None):
    return src["portfolio"].select("Id", F.col("LicenseType").alias("RawLicenseType"),
                                   R.license_class("LicenseType").alias("LicenseType"))


def c_removed_reason(src: Sources, params: Params | None = None) -> DataFrame:
    pr = src["portfolio_row"].select("PortfolioRowGuid", "RemoveComment")
    bk = C.bankruptcy_hits(src).select(F.col("DebtAccountId").alias("_bk"), "Chapter")
    sc = C.scra_hits(src).select(F.col("DebtAccountId").alias("_sc"), "ActiveDutyStatus")
    j = pr.join(bk, pr["PortfolioRowGuid"] == bk["_bk"], "left").join(sc, pr["PortfolioRowGuid"] == sc["_sc"], "left")
    return j.select("PortfolioRowGuid", "RemoveComment",
                    R.removed_reason("RemoveComment", "Chapter", "ActiveDutyStatus").alias("RemovedReason"))


def _rows_with_portfolio(src: Sources) -> DataFrame:
    pr = src["portfolio_row"]
    p = src["portfolio"].select(F.col("Id").alias("_p_id"), "SoldUtc", "PurchasePricePercent", "BuyerFeePercent",
                                "SellerFeePercent")
    return pr.join(p, pr["PortfolioId"] == p["_p_id"], "inner")


def c_sold_flag(src, params=None):
    j = _rows_with_portfolio(src)
    return j.select("PortfolioRowGuid", R.sold_flag("RemovedUTCDate").alias("SOLD"),
                    R.year_sold("RemovedUTCDate", "SoldUtc").alias("YearSold"))


def m_prices_and_fees(src, params=None):
    j = _rows_with_portfolio(src)
    total = R.total_balance()
    price = R.account_price(total)
    return j.select("PortfolioRowGuid", total.alias("TotalBalance"), price.alias("AccountPurchacePrice"),
                    R.pct_or_zero("BuyerFeePercent").alias("BuyerFeePercent"),
                    R.pct_or_zero("SellerFeePercent").alias("SellerFeePercent"),
                    (R.pct_or_zero("BuyerFeePercent") + R.pct_or_zero("SellerFeePercent")).alias("TotalFeePercent"),
                    R.total_fee_amount(price).alias("TotalFeeAmount"))


def _requests_with_rows(src: Sources) -> DataFrame:
    r = src["request"].select(F.col("Id").alias("RequestId"), "DebtAccountId")
    j = _rows_with_portfolio(src)
    bk = C.renamed(src["portfolio_bk_data"], {"PortfolioId": "_bk_pid", "FinalPurchasePricePercent": "_bk_pct"})
    return (r.join(j, r["DebtAccountId"] == j["PortfolioRowGuid"], "inner")
            .join(bk, F.col("_p_id") == bk["_bk_pid"], "left"))


def c_postsale_price(src, params=None):
    j = _requests_with_rows(src)
    return j.select("RequestId", R.postsale_price(R.total_balance(), "BKPoc").alias("PurchasePriceAmount"))


def c_postsale_percent(src, params=None):
    j = _requests_with_rows(src)
    return j.select("RequestId", R.postsale_percent("BKPoc", "_bk_pct").alias("PurchasePricePercent"))


def c_request_category(src, params=None):
    return src["request"].select("Id", R.request_category().alias("Category"))


def c_initiator(src, params=None):
    return src["request"].select("Id", "InitiatedByBuyer", R.initiated_by().alias("InitiatedBy"))


def c_out_of_business(src: Sources, params: Params | None = None) -> DataFrame:
    b = src["business"].select("Id", "Status")
    n = current_names(src["business_name"]).select(F.col("BusinessId").alias("_n"), F.col("Name").alias("_name"))
    return b.join(n, b["Id"] == n["_n"], "left").select(
        "Id", R.out_of_business_name("Status", "_name").alias("DisplayName"))


def _requests_with_close(src: Sources) -> DataFrame:
    r = src["request"].select("Id", "Status", "Created")
    cd = C.renamed(C.close_dates(src), {"RequestId": "_cd", "CloseDate": "CloseDate"})
    return r.join(cd, r["Id"] == cd["_cd"], "left")


def c_req_status_open(src, params=None):
    return _requests_with_close(src).select("Id", R.req_status_open().alias("ReqStatusOpen"))


def c_closed_age_days(src, params=None):
    return _requests_with_close(src).select("Id", R.closed_age_days().alias("ClosedRejectedWithdrawnReqsAgeDays"))


def c_age_days(src, params=None):
    return src["request"].select("Id", R.age_days("Created", _p(params).as_of_local).alias("AgeInDays"))


def c_existence_flags(src: Sources, params: Params | None = None) -> DataFrame:
    b = src["business"].select("Id")
    ba = src["business_agency"].select(F.col("Id").alias("_ba"))
    bb = src["business_buyer"].select(F.col("Id").alias("_bb"))
    bs = src["business_seller"].select(F.col("Id").alias("_bs"))
    j = (b.join(ba, b["Id"] == ba["_ba"], "left").join(bb, b["Id"] == bb["_bb"], "left")
         .join(bs, b["Id"] == bs["_bs"], "left"))
    return j.select("Id", R.exists_flag("_ba").alias("IsAgency"), R.exists_flag("_bb").alias("IsBuyer"),
                    R.exists_flag("_bs").alias("IsSeller"))


def c_active_flags(src: Sources, params: Params | None = None) -> DataFrame:
    prm = _p(params)
    b = src["business"].select("Id")
    bb = src["business_buyer"].select(F.col("Id").alias("_bb"))
    bs = src["business_seller"].select(F.col("Id").alias("_bs"))
    ab = gold.active_parties(src, "BuyerId", prm.as_of_utc).select(F.col("BuyerId").alias("_ab"))
    asl = gold.active_parties(src, "SellerId", prm.as_of_utc).select(F.col("SellerId").alias("_as"))
    j = (b.join(bb, b["Id"] == bb["_bb"], "left").join(bs, b["Id"] == bs["_bs"], "left")
         .join(ab, b["Id"] == ab["_ab"], "left").join(asl, b["Id"] == asl["_as"], "left"))
    return j.select("Id", R.active_flag("_ab", "_bb").alias("ActiveBuyer"),
                    R.active_flag("_as", "_bs").alias("ActiveSeller"))


def c_created_by(src: Sources, params: Params | None = None) -> DataFrame:
    prm = _p(params)
    j = j_left_filtered_right(src, prm)
    return j.select("Id", R.created_by("CreatedByBusinessId", "CreatorName", prm.compliance_creator).alias("CreatedBy"))


def c_placed_hours(src: Sources, params: Params | None = None) -> DataFrame:
    pb = src["portfolio_bid"].select("Id", "PortfolioId", "PlacedUtc")
    a = C.renamed(src["auction"], {"PortfolioId": "_a_pid", "BidCloseUtc": "BidCloseUtc"})
    j = pb.join(a, pb["PortfolioId"] == a["_a_pid"], "left")
    return j.select("Id", R.placed_hours("PlacedUtc", "BidCloseUtc").alias("PlacedHours"))


def c_origination_diff(src: Sources, params: Params | None = None) -> DataFrame:
    pr = src["portfolio_row"].select("PortfolioRowGuid", "OriginationDate")
    d = C.deceased_hits(src).select(F.col("DebtAccountId").alias("_d"), "DateOfDeath")
    bk = C.bankruptcy_hits(src).select(F.col("DebtAccountId").alias("_bk"), "FileDate")
    j = pr.join(d, pr["PortfolioRowGuid"] == d["_d"], "left").join(bk, pr["PortfolioRowGuid"] == bk["_bk"], "left")
    return j.select("PortfolioRowGuid",
                    R.origination_diff("OriginationDate", "DateOfDeath").alias("Deceased_OriginationDateDiff"),
                    R.origination_diff("OriginationDate", "FileDate").alias("BK_OriginationDateDiff"))


def c_warehoused_flag(src: Sources, params: Params | None = None) -> DataFrame:
    """C19/P13 on the portfolio: PSA date from D14, mean write-off from D16."""
    prm = _p(params)
    p = src["portfolio"].select("Id", "PortfolioCloseUtc", "SoldUtc")
    ev = staging.d14_portfolio_events(src, prm).select(F.col("PortfolioId").alias("_e"), "PSAConfirmedUtc")
    ra = staging.d16_row_aggregates(src, prm).select(F.col("PortfolioId").alias("_r"),
                                                     F.col(f"`{staging.AVG_WRITE_OFF}`").alias("_avg"))
    j = p.join(ev, p["Id"] == ev["_e"], "left").join(ra, p["Id"] == ra["_r"], "left")
    return j.select("Id",
                    R.warehoused("PSAConfirmedUtc", "PSAConfirmedUtc", "_avg").alias("WarehousedAvgWriteOfftoPSAConfirmed"),
                    R.warehoused("PortfolioCloseUtc", "PSAConfirmedUtc", "_avg").alias("WarehousedAvgWriteOfftoPortfolioClosed"),
                    R.warehoused("SoldUtc", "PSAConfirmedUtc", "_avg").alias("WarehousedAvgWriteOfftoSold"))


PARTS = [
    "m_prices_and_fees", "w_first_hit", "p_exclude_party", "p_not_in_or_null", "p_not_in", "p_status_in",
    "p_event_type", "p_viewer_events", "p_open_name", "c_asset_type", "a_login_stats", "a_active_parties",
    "p_null_keeping_exclude", "c_warehoused_flag", "j_left_filtered_right", "j_inner_dim", "j_current_name",
    "j_left_dim", "j_left_preagg", "j_role_playing", "j_first_last_award", "j_prev_month", "j_full_outer",
    "j_case_insensitive", "j_goal_month", "j_macro_quarter", "j_satellite_fanout", "j_subtype_chain",
    "a_last_download", "a_bid_stats", "a_seller_stats", "a_buyer_stats", "a_awarded_events", "a_min_name_start",
    "a_listed_dates", "a_awarded_dates_ci", "a_awarded_dates", "a_postsale_counts", "a_close_dates",
    "a_macro_distinct", "w_deceased_hits", "w_bankruptcy_hits", "w_scra_hits", "w_pifsif_hits", "w_account_closed",
    "c_asset_type_cs", "c_license_type", "c_removed_reason", "c_sold_flag", "c_postsale_price",
    "c_postsale_percent", "c_request_category", "c_initiator", "c_out_of_business", "c_req_status_open",
    "c_closed_age_days", "c_age_days", "c_existence_flags", "c_active_flags", "c_created_by", "c_placed_hours",
    "c_origination_diff",
]
