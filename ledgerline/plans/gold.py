"""

Each product is a pure function ``(sources, params) -> DataFrame`` with no
action inside. Joins are written dimension-side first where that shrinks the
fact side early; the planner picks broadcast or shuffle per join from sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.core import concat_nullsafe, months_crossed, sha256_hex_upper, ts_lit
from ..operators import broadcast_if_small, current_names, dealt_by_key, fits_broadcast, keyed_join, likely_keys, lookups_by_key, only_keys, prev_period_join
from ..params import Params
from ..sources import CONTRACTS, Sources
from . import common as C

# ============================================================== D01 Portfolio
D01_PORTFOLIO_COLS = list(CONTRACTS["portfolio"])


def d01_portfolio(src: Sources, params: Params | None = None, narrow: bool = False, with_id: bool | None = None) -> DataFrame:
    """``narrow``: the caller reads few of the columns, and plain joins move
    less than lists of what they find (the same rows; also in D05 and D18).
    ``with_id``: only the portfolios with (without) an id, for a caller that
    joins more on the id: a union of both loses how they are dealt out."""
    prm = C.params_or_default(params)
    p = src["portfolio"].filter(
        C.p_exclude_party("SellerId", prm.excluded_seller) & C.p_not_in_or_null("BuyerId", prm.excluded_buyers)
    ).select(*D01_PORTFOLIO_COLS)
    if with_id is not None:
        p = p.filter(F.col("Id").isNotNull() if with_id else F.col("Id").isNull())
    pt = broadcast_if_small(C.renamed(src["portfolio_type"], {"Id": "_pt_id", "TypeName": "PortfolioTypeName"}))
    a = C.renamed(src["auction"], {"PortfolioId": "_a_pid", "Id": "AuctionId", "AuctionType": "AuctionType",
                                   "BidCloseUtc": "AuctionBidCloseUtc",
                                   "BuyerBidAccessOption": "AuctionBuyerBidAccessOption"})
    pd = C.renamed(src["portfolio_data"], {"PortfolioId": "_pd_pid", "ReservePrice": "PortfolioReservePrice"})
    dl = C.last_downloads(src)
    bd = C.renamed(broadcast_if_small(dl), {"BusinessId": "_bd_id", "MaxDownloadedUtc": "BuyerDownloaded"})
    sd = C.renamed(broadcast_if_small(dl), {"BusinessId": "_sd_id", "MaxDownloadedUtc": "SellerDownloaded"})

    def by_id(rows: DataFrame) -> DataFrame:
        return (rows.join(pt, F.col("PortfolioTypeId") == pt["_pt_id"], "left")
                .join(a, F.col("Id") == a["_a_pid"], "left")
                .join(pd, pd["_pd_pid"] == F.col("Id"), "left"))

    def by_party(rows: DataFrame) -> DataFrame:
        return (rows.join(bd, bd["_bd_id"] == F.col("BuyerId"), "left")
                .join(sd, sd["_sd_id"] == F.col("SellerId"), "left"))

    def keyed() -> DataFrame:
        # the portfolios are wide: shuffled on their id alone
        some = p.filter(F.col("Id").isNotNull())
        return lookups_by_key(by_id(some), "Id", {"BuyerId": {"MaxDownloadedUtc": "BuyerDownloaded"},
                                                  "SellerId": {"MaxDownloadedUtc": "SellerDownloaded"}}, dl, "BusinessId", links_of=some)

    if narrow or with_id is False or fits_broadcast(dl):
        out = by_party(by_id(p))
    elif with_id:
        out = keyed()
    else:
        unkeyed = p.filter(F.col("Id").isNull()).join(pt, F.col("PortfolioTypeId") == pt["_pt_id"], "left")
        out = keyed().unionByName(by_party(unkeyed), allowMissingColumns=True)
    return out.select(*D01_PORTFOLIO_COLS, "PortfolioTypeName", "AuctionId", "AuctionType", "AuctionBidCloseUtc",
                      "AuctionBuyerBidAccessOption", "PortfolioReservePrice", "BuyerDownloaded", "SellerDownloaded")


# ============================================================== D02 Business
BUSINESS_COLS = list(CONTRACTS["business"])
AGENCY_MAP = {"WebSiteUrl": "AgencyWebSiteUrl", "PaymentSiteUrl": "AgencyPaymentSiteUrl",
              "MembershipEstablished": "AgencyMembershipEstablished", "OnSiteAudit": "AgencyOnSiteAudit",
              "RecertificationFrequency": "AgencyRecertificationFrequency"}
_BUYER_RENAMES = {"DTCanUploadDownloadPSA": "BuyerDTCanUploadDownloadPsa",
                  "PermissionsLastUpdatedUTC": "BuyerPermissionsLastUpdatedUtc"}
BUYER_MAP = {c: _BUYER_RENAMES.get(c, "Buyer" + c) for c in CONTRACTS["business_buyer"][5:]}
_SELLER_RENAMES = {"DTCanUploadDownloadPSA": "SellerDTCanUploadDownloadPsa",
                   "PermissionsLastUpdatedUTC": "SellerPermissionsLastUpdatedUtc",
                   "RequireBCOFinancials": "SellerRequireBcoFinancials",
                   "FF_PSA_SignatureRequired": "SellerFf_Psa_SignatureRequired",
                   "BusinessDevelopmentRepresentative": "BusinessDevelopmentRepresentative"}
SELLER_MAP = {c: _SELLER_RENAMES.get(c, "Seller" + c) for c in CONTRACTS["business_seller"][5:]}
SUBTYPE_SHARED = ["DefaultBankAccountId", "FeePercent", "EnforceMinimumFee", "MinimumFee"]


def bid_stats(src: Sources) -> DataFrame:
    """Bid statistics per buyer."""
    pb = src["portfolio_bid"]
    return pb.groupBy("BuyerId").agg(
        F.max("PlacedUtc").alias("BuyerLastBidDate"),
        F.min("PlacedUtc").alias("BuyerFirstBidDate"),
        F.count("Id").alias("BuyerTotalBids"),
        F.count(F.when(F.col("Status") == "Won", F.col("Id"))).alias("BuyerTotalWon"),
    )


def party_portfolio_stats(src: Sources, party: str, as_of) -> DataFrame:
    """Per seller or buyer over non-purged portfolios: first/last
    portfolio number (lexicographic), accounts, accounts sold in the last 12
    calendar months before ``as_of``."""
    p = src["portfolio"].filter(F.lower(F.col("Status")) != "purged")
    recent = months_crossed("SoldUtc", ts_lit(as_of)) <= 11
    return p.groupBy(party).agg(
        F.min("PortfolioNumber").alias("MinPid"),
        F.max("PortfolioNumber").alias("MaxPid"),
        F.sum("NumberOfAccounts").cast("bigint").alias("TotalAccounts"),
        F.sum(F.when(recent, F.col("NumberOfAccounts")).otherwise(F.lit(0))).cast("bigint").alias("PurchLast12"),
    )


def awarded_events(src: Sources) -> DataFrame:
    """First 'Awarded' event per (seller, portfolio number) of non-purged
    portfolios; NULL when a portfolio has none. Events are reduced to one row
    per portfolio before the join."""
    p = src["portfolio"].filter(F.lower(F.col("Status")) != "purged").select("Id", "SellerId", "PortfolioNumber")
    ev = C.event_dates(src, "AwardedEventUtc").withColumnRenamed("AwardedEventUtc", "_first")
    j = p.join(ev, p["Id"] == ev["PortfolioId"], "left")
    return j.groupBy("SellerId", "PortfolioNumber").agg(F.min("_first").alias("EventUtc"))


def login_stats(src: Sources, params: Params | None = None) -> DataFrame:
    """first/last login per client: UserAction -> User -> Tenant -> Client."""
    prm = C.params_or_default(params)
    ua = src["user_action"].filter(F.col("ActionDate") > ts_lit(prm.login_cutoff))
    u = C.renamed(src["app_user"], {"Id": "_u_id", "TenantId": "_u_tenant"})
    t = broadcast_if_small(C.renamed(src["tenant"], {"Id": "_t_id"}))
    c = broadcast_if_small(C.renamed(src["client"], {"Id": "ClientId", "TenantId": "_c_tenant"}))
    j = (ua.join(u, ua["UserId"] == u["_u_id"], "inner")
         .join(t, F.col("_u_tenant") == t["_t_id"], "inner")
         .join(c, F.col("_t_id") == c["_c_tenant"], "inner"))
    return j.groupBy("ClientId").agg(F.min("ActionDate").alias("FirstLoginDateTime"),
                                     F.max("ActionDate").alias("LastLoginDateTime"))


def active_parties(src: Sources, party: str, as_of) -> DataFrame:
    """Distinct parties with a portfolio closing in the year before ``as_of``."""
    cutoff = ts_lit(as_of) - F.expr("INTERVAL 1 YEAR")
    return src["portfolio"].filter(F.col("PortfolioCloseUtc") > cutoff).select(party).distinct()


def party_activity(src: Sources, party: str, as_of) -> DataFrame:
    """A03/A04 + A07 in ONE pass over the portfolios per party: the statistics
    over non-purged portfolios (conditional aggregates) and whether a
    portfolio closed in the year before ``as_of``. A party whose portfolios
    are all purged gets NULL statistics, which is what the left join of the
    separate aggregate gives it too."""
    live = F.lower(F.col("Status")) != "purged"
    recent = months_crossed("SoldUtc", ts_lit(as_of)) <= 11
    cutoff = ts_lit(as_of) - F.expr("INTERVAL 1 YEAR")
    return src["portfolio"].groupBy(party).agg(
        F.min(F.when(live, F.col("PortfolioNumber"))).alias("MinPid"),
        F.max(F.when(live, F.col("PortfolioNumber"))).alias("MaxPid"),
        F.sum(F.when(live, F.col("NumberOfAccounts"))).cast("bigint").alias("TotalAccounts"),
        F.sum(F.when(live, F.when(recent, F.col("NumberOfAccounts")).otherwise(F.lit(0)))).cast("bigint")
        .alias("PurchLast12"),
        F.max(F.when(F.col("PortfolioCloseUtc") > cutoff, F.lit(1))).alias("Active"),
    )


def d02_business(src: Sources, params: Params | None = None) -> DataFrame:
    prm = C.params_or_default(params)
    b = src["business"].filter(C.p_not_in("Id", prm.excluded_businesses)).select(*BUSINESS_COLS)
    bn = current_names(src["business_name"]).select(F.col("BusinessId").alias("_bn_id"),
                                                    F.trim(F.col("Name")).alias("BusinessName"))
    cl = broadcast_if_small(C.renamed(src["client"], {"Id": "_c_id", "Name": "ClientName", "Status": "ClientStatus",
                                                      "TenantId": "ClientTenantId"}))
    bnmin = C.renamed(C.open_name_min_start(src), {"BusinessId": "_bnm_id", "MinNameStartDateUtc": "MinNameStartDateUtc"})
    ba = C.renamed(src["business_agency"], {"Id": "_ba_id", **AGENCY_MAP})
    bb = C.renamed(src["business_buyer"], {"Id": "_bb_id", **{c: f"_bb_{c}" for c in SUBTYPE_SHARED}, **BUYER_MAP})
    bs = C.renamed(src["business_seller"], {"Id": "_bs_id", **{c: f"_bs_{c}" for c in SUBTYPE_SHARED}, **SELLER_MAP})
    bagg = C.renamed(bid_stats(src), {"BuyerId": "_bagg_id", "BuyerLastBidDate": "BuyerLastBidDate",
                                      "BuyerFirstBidDate": "BuyerFirstBidDate", "BuyerTotalBids": "BuyerTotalBids",
                                      "BuyerTotalWon": "BuyerTotalWon"})
    pagg_b = C.renamed(party_activity(src, "BuyerId", prm.as_of_utc),
                       {"BuyerId": "_pb_id", "MaxPid": "BuyerLastPortfolio", "TotalAccounts": "BuyerActsPurch",
                        "PurchLast12": "PurchLast12", "Active": "_ab_active"})
    pagg_s = C.renamed(party_activity(src, "SellerId", prm.as_of_utc),
                       {"SellerId": "_ps_id", "MinPid": "SellerFirstPidListed", "MaxPid": "SellerLastPidListed",
                        "Active": "_as_active"})
    ls = C.renamed(login_stats(src, prm), {"ClientId": "_ls_cid", "FirstLoginDateTime": "FirstLoginDateTime",
                                           "LastLoginDateTime": "LastLoginDateTime"})
    ae = awarded_events(src)
    ae_first = C.renamed(ae, {"SellerId": "_aef_sid", "PortfolioNumber": "_aef_pn", "EventUtc": "SellerFirstPidAwardedDate"})
    ae_last = C.renamed(ae, {"SellerId": "_ael_sid", "PortfolioNumber": "_ael_pn", "EventUtc": "SellerLastPidAwardedDate"})

    j = (
        b.join(bn, b["Id"] == bn["_bn_id"], "inner")
        .join(cl, b["ClientId"] == cl["_c_id"], "inner")
        .join(bnmin, b["Id"] == bnmin["_bnm_id"], "left")
        .join(ba, b["Id"] == ba["_ba_id"], "left")
        .join(bb, b["Id"] == bb["_bb_id"], "left")
        .join(bs, b["Id"] == bs["_bs_id"], "left")
        .join(bagg, b["Id"] == bagg["_bagg_id"], "left")
        .join(pagg_b, b["Id"] == pagg_b["_pb_id"], "left")
        .join(pagg_s, F.col("_bs_id") == pagg_s["_ps_id"], "left")
        .join(ls, b["ClientId"] == ls["_ls_cid"], "left")
        .join(ae_first, (ae_first["_aef_sid"] == F.col("_bs_id")) & (ae_first["_aef_pn"] == F.col("SellerFirstPidListed")), "left")
        .join(ae_last, (ae_last["_ael_sid"] == F.col("_bs_id")) & (ae_last["_ael_pn"] == F.col("SellerLastPidListed")), "left")
    )
    return j.select(
        *BUSINESS_COLS, "BusinessName", "MinNameStartDateUtc", "ClientName", "ClientStatus", "ClientTenantId",
        *[F.coalesce(F.col(f"_bb_{c}"), F.col(f"_bs_{c}")).alias(c) for c in SUBTYPE_SHARED],
        R.exists_flag("_ba_id").alias("IsAgency"), *AGENCY_MAP.values(),
        R.exists_flag("_bb_id").alias("IsBuyer"), *BUYER_MAP.values(),
        R.active_flag(F.when(F.col("_ab_active") == 1, F.lit(1)), "_bb_id").alias("ActiveBuyer"),
        "BuyerLastBidDate", "BuyerFirstBidDate", "BuyerTotalBids", "BuyerTotalWon",
        "BuyerLastPortfolio", "BuyerActsPurch", "PurchLast12",
        R.exists_flag("_bs_id").alias("IsSeller"), *SELLER_MAP.values(),
        R.active_flag(F.when(F.col("_as_active") == 1, F.lit(1)), "_bs_id").alias("ActiveSeller"),
        "SellerFirstPidListed", "SellerLastPidListed", "SellerFirstPidAwardedDate", "SellerLastPidAwardedDate",
        "FirstLoginDateTime", "LastLoginDateTime",
    )


# ============================================================== D03 Portfolio_Row
def sale_portfolio_scan(src: Sources, prm: Params) -> DataFrame:
    """Portfolios in a sale status, minus excluded parties."""
    return src["portfolio"].filter(
        C.p_status_in("Status") & C.p_exclude_party("SellerId", prm.excluded_seller)
        & C.p_not_in_or_null("BuyerId", prm.excluded_buyers)
    ).select(F.col("Id").alias("_p_id"), "SellerName", "SellerId", "BuyerName", "BuyerId", "PortfolioNumber",
             "PortfolioTypeId", "Status", "AssetTypes", "PurchasePricePercent", "PurchasePriceAmount", "SoldUtc",
             "PortfolioCloseUtc", "ForwardFlowAgreementId",
             # portfolio-level rules, evaluated once per portfolio
             R.pct_or_zero("BuyerFeePercent").alias("BuyerFeePercent"),
             R.pct_or_zero("SellerFeePercent").alias("SellerFeePercent"),
             (R.pct_or_zero("BuyerFeePercent") + R.pct_or_zero("SellerFeePercent")).alias("TotalFeePercent"),
             R.license_class("LicenseType").alias("LicenseType"))


def sale_portfolios(src: Sources, prm: Params) -> DataFrame:
    """Portfolio side of D03: the sale portfolios with type, buyer/seller
    client names and first listed date – at most one row per portfolio (every
    lookup is on a unique key)."""
    p = sale_portfolio_scan(src, prm)
    pt = broadcast_if_small(C.renamed(src["portfolio_type"], {"Id": "_pt_id", "TypeName": "PortfolioTypeStr"}))
    bus = src["business"].select(F.col("Id").alias("_b_id"), F.col("ClientId").alias("_b_cid"))
    cli = src["client"].select(F.col("Id").alias("_c_id"), F.col("Name").alias("_c_name"))
    bc = broadcast_if_small(bus.join(broadcast_if_small(cli), F.col("_b_cid") == F.col("_c_id"), "inner")
                            .select("_b_id", "_c_name"), basis=bus)
    bbc = bc.select(F.col("_b_id").alias("_bb_id"), F.col("_c_name").alias("BuyerClient"))
    bsc = bc.select(F.col("_b_id").alias("_bs_id"), F.col("_c_name").alias("SellerClient"))
    ld = C.renamed(C.listed_dates(src), {"PortfolioId": "_ld_pid", "ListedUtc": "Listed"})
    by_id = p.join(pt, p["PortfolioTypeId"] == pt["_pt_id"], "inner").join(ld, ld["_ld_pid"] == p["_p_id"], "left").drop("_pt_id", "_ld_pid")
    if fits_broadcast(bc, basis=bus):
        return (by_id.join(bbc, F.col("BuyerId") == bbc["_bb_id"], "inner")
                .join(bsc, F.col("SellerId") == bsc["_bs_id"], "inner").drop("_bb_id", "_bs_id"))
    # shuffled on the portfolio id alone; portfolios without one have no accounts
    refs = {f"{x}Id": {"_c_name": f"{x}Client", "_hit": f"_{x}_hit"} for x in ("Buyer", "Seller")}
    found = lookups_by_key(by_id, "_p_id", refs, bc.withColumn("_hit", F.lit(True)), "_b_id", links_of=p)
    return found.filter(F.col("_Buyer_hit") & F.col("_Seller_hit")).drop("_Buyer_hit", "_Seller_hit")


def d03_portfolio_row(src: Sources, params: Params | None = None) -> DataFrame:
    prm = C.params_or_default(params)
    pid = sale_portfolios(src, prm)
    scan = sale_portfolio_scan(src, prm)  # bounds the rows of ``pid``
    # Accounts outside the sale portfolios go before anything is joined to
    # them; account-level rules on the scan side.
    accounts = only_keys(src["portfolio_row"], pid, "PortfolioId", "_p_id", basis=scan.select("_p_id"))
    pr = accounts.select(
        "*", R.asset_class_folded("Product").alias("AssetType"),
        F.trim(F.upper(F.col("StateCode"))).alias("ConsumerState"), F.trim(F.col("City")).alias("ConsumerCity"),
        R.total_balance().alias("TotalBalance"))
    cd = src["portfolio_row_commercial"]
    prcd = cd.select(cd["PortfolioRowGuid"].alias("_cd_guid"),
                     sha256_hex_upper("BusinessDBA", prm.hash_encoding).alias("BusinessDBAHashed"),
                     sha256_hex_upper("BusinessLegalName", prm.hash_encoding).alias("BusinessLegalNameHashed"),
                     F.coalesce(F.col("BusinessCity"), F.lit("")).alias("_bcity"),
                     F.coalesce(F.col("BusinessState"), F.lit("")).alias("_bstate"))
    psc = C.renamed(C.postsale_counts(src), {"DebtAccountId": "_psc_id", "CountPostSaleRequest": "_psc_n"})
    dec = C.deceased_hits(src).withColumnRenamed("DebtAccountId", "_dec_id")
    bk = C.bankruptcy_hits(src).withColumnRenamed("DebtAccountId", "_bk_id")
    scra = C.scra_hits(src).withColumnRenamed("DebtAccountId", "_scra_id")
    pif = C.pifsif_hits(src).withColumnRenamed("DebtAccountId", "_pif_id")
    closed = C.account_closed_hits(src).withColumnRenamed("DebtAccountId", "_ac_id")
    guid = pr["PortfolioRowGuid"]
    # Account-keyed joins first: the satellites are aggregated on the account
    # key, so the fact meets all of them under one partitioning (none at all
    # when the sources are bucketed on it, see sources/layout.py); the
    # portfolio side (one row per sale portfolio) comes last.
    j = (
        pr.join(prcd, prcd["_cd_guid"] == guid, "left")
        .join(psc, psc["_psc_id"] == guid, "left")
        .join(dec, dec["_dec_id"] == guid, "left")
        .join(bk, bk["_bk_id"] == guid, "left")
        .join(scra, scra["_scra_id"] == guid, "left")
        .join(pif, pif["_pif_id"] == guid, "left")
        .join(closed, closed["_ac_id"] == guid, "left")
    )
    # where the portfolio side is too large to broadcast, portfolios with very
    # many accounts are salted
    j = keyed_join(j, pid, "PortfolioId", "_p_id", "PortfolioRowGuid", basis=scan, keys_of=accounts)
    price = R.account_price(F.col("TotalBalance"))
    return j.select(
        "SellerName", "SellerClient", "SellerId", "BuyerName", "BuyerClient", "BuyerId",
        F.col("PortfolioNumber").alias("PID"), "PortfolioTypeId", pr["Product"],
        F.col("Status").alias("PortfolioStatus"), "Lender", "LenderLoanId", "AssetType",
        F.col("AssetTypes").alias("PortfolioAssetTypes"), "ConsumerState", "ConsumerCity",
        F.coalesce(F.col("BusinessDBAHashed"), F.lit("")).alias("BusinessDBAHashed"),
        F.coalesce(F.col("BusinessLegalNameHashed"), F.lit("")).alias("BusinessLegalNameHashed"),
        F.coalesce(F.col("_bcity"), F.lit("")).alias("BusinessCity"),
        F.coalesce(F.col("_bstate"), F.lit("")).alias("BusinessState"),
        "OriginalLoanAmount", "PrincipalBalance", "InterestBalance", "OtherFeesBalance",
        F.col("OriginationDate").alias("FundDate"), "WriteOffDate", "DefaultDate", "FirstDelinquencyDate",
        "LastPaymentDate", "LastPaymentAmount",
        "TotalBalance",
        F.col("PurchasePricePercent").alias("PurchaseRate"),
        price.alias("AccountPurchacePrice"),
        F.col("PurchasePriceAmount").alias("PortfolioPurchasePrice"),
        F.col("SoldUtc").alias("PortfolioSoldDate"),
        F.col("PortfolioCloseUtc").alias("PortfolioCloseDate"),
        "Listed", "BuyerFeePercent", "SellerFeePercent", "TotalFeePercent",
        R.total_fee_amount(price).alias("TotalFeeAmount"),
        guid.alias("PortfolioRowGuid"), "ChainOfTitleId",
        F.col("ComplianceHoldStatus").alias("DTComplianceHold"), "SFComplaintId", "ChargeOffBalance",
        "TotalPaymentsSinceChargeOff",
        R.year_sold("RemovedUTCDate", "SoldUtc").alias("YearSold"),
        "ForwardFlowAgreementId",
        F.col("RemovedUTCDate").alias("RemovedDate"), "RemoveComment",
        R.removed_reason("RemoveComment", "Chapter", "ActiveDutyStatus").alias("RemovedReason"),
        R.sold_flag("RemovedUTCDate").alias("SOLD"),
        "LicenseType",
        "PortfolioTypeStr",
        F.coalesce(F.col("_psc_n"), F.lit(0)).alias("CountPostSaleRequest"),
        F.col("DateOfDeath").alias("Deceased_DateOfDeath"),
        R.origination_diff("OriginationDate", "DateOfDeath").alias("Deceased_OriginationDateDiff"),
        R.exists_flag("DateOfDeath").alias("IsDeceased"),
        F.coalesce(F.col("TotalDeceasedHits"), F.lit(0)).alias("TotalDeceasedHits"),
        "DeceasedScrubReceived",
        F.col("FileDate").alias("BK_FileDate"),
        R.origination_diff("OriginationDate", "FileDate").alias("BK_OriginationDateDiff"),
        F.col("Chapter").alias("BK_Chapter"), F.col("CaseStatus").alias("BK_CaseStatus"),
        F.col("CaseNumber").alias("BK_CaseNumber"), F.col("BarDate").alias("BK_BarDate"),
        F.col("CourtCity").alias("BK_CourtCity"), F.col("CourtState").alias("BK_StateCode"),
        F.col("CourtZip").alias("BK_CourtZip"), F.col("PlanFiledDate").alias("BK_PlanFileDate"),
        F.col("ConfirmationHearingDate").alias("BK_ConfirmationHearingDate"),
        F.col("PlanConfirmationDate").alias("BK_PlanConfirmationDate"),
        F.col("LastDateToObjectToDischarge").alias("BK_LastDateToObjectToDischarge"),
        R.exists_flag("CaseNumber").alias("IsBk"),
        F.coalesce(F.col("TotalBankruptyHits"), F.lit(0)).alias("TotalBankruptyHits"),
        "BankruptcyScrubReceived",
        F.col("ActiveDutyStatus").alias("SCRA_ActiveDutyStatus"),
        F.col("ActiveDutyStartDate").alias("SCRA_ActiveDutyStartDate"),
        F.col("ActiveDutyEndDate").alias("SCRA_ActiveDutyEndDate"),
        F.col("ServiceAgency").alias("SCRA_ServiceAgency"),
        R.exists_flag("ActiveDutyStatus").alias("IsSCRA"),
        F.coalesce(F.col("TotalSCRAHits"), F.lit(0)).alias("TotalSCRAHits"),
        "ScraScrubReceived",
        F.col("PaymentDate").alias("PifSifPaymentDate"), F.col("PaymentAmount").alias("PifSifPaymentAmount"),
        F.coalesce(F.col("TotalPifSif"), F.lit(0)).alias("TotalPifSifRequest"),
        F.col("ClosedDate").alias("AccountClosedDate"),
        F.coalesce(F.col("TotalAccountClosed"), F.lit(0)).alias("TotalAccountClosedRequest"),
    )


# ============================================================== D04 Portfolio_Aggregate
def d04_portfolio_aggregate(src: Sources, params: Params | None = None) -> DataFrame:
    pa = src["portfolio_aggregate"]
    p = C.renamed(src["portfolio"], {"Id": "_p_id", "SellerId": "_p_sid", "PortfolioNumber": "PortfolioNumber",
                                     "Status": "PortfolioStatus", "AssetTypes": "PortfolioAssetTypes"})
    sn = broadcast_if_small(C.business_with_open_name(src, "_bs_id", "SellerName"), basis=src["business_name"])
    j = pa.join(p, p["_p_id"] == pa["PortfolioId"], "inner").join(sn, F.col("_p_sid") == sn["_bs_id"], "inner")
    return j.select(*[pa[c] for c in pa.columns], "PortfolioNumber", "PortfolioStatus", "PortfolioAssetTypes",
                    "SellerName",
                    (pa["TotalPrincipal"] + pa["TotalInterest"] + pa["TotalFees"]).alias("TotalFaceValue"))


# ============================================================== D05 Portfolio_Bid
def d05_portfolio_bid(src: Sources, params: Params | None = None, narrow: bool = False) -> DataFrame:
    prm = C.params_or_default(params)
    pb = src["portfolio_bid"].filter(C.p_exclude_party("BuyerId", prm.excluded_bidder))
    p = C.renamed(src["portfolio"], {"Id": "_p_id", "PortfolioNumber": "PortfolioNumber", "Status": "PortfolioStatus",
                                     "AssetTypes": "AssetTypes", "SoldUtc": "Sold", "Issuers": "Issuers",
                                     "SellerId": "_p_sid"})
    a = C.renamed(src["auction"], {"PortfolioId": "_a_pid", "BidCloseUtc": "BidClose"})
    names = src["business_name"]
    nb = broadcast_if_small(C.business_with_open_name(src, "_bb_id", "Buyer"), basis=names)
    seller = (C.business_with_open_name(src, "_bs_id", "Seller_Name", {"ClientId": "_bs_cid"})
              .join(broadcast_if_small(C.renamed(src["client"], {"Id": "_cs_id", "Name": "SellerClient"})),
                    F.col("_bs_cid") == F.col("_cs_id"), "inner"))
    ns = broadcast_if_small(seller, basis=names)
    su = C.renamed(src["app_user"], {"Id": "_su_id", "FirstName": "_fn", "LastName": "_ln"})
    dates = C.renamed(C.event_summary(src, prm), {"PortfolioId": "_ev_pid", "ListedUtc": "Listed", "AwardedUtc": "Awarded"})
    # the portfolio side once, with both dates from one read of the summary;
    # the bids then meet it in a single shuffle on the portfolio id
    sold_by = p.join(ns, F.col("_p_sid") == ns["_bs_id"], "inner")

    def dated(rows: DataFrame) -> DataFrame:
        return (rows.join(a, F.col("_p_id") == a["_a_pid"], "left")
                .join(dates, F.col("_p_id") == dates["_ev_pid"], "left"))

    portfolios = dated(sold_by)
    if narrow:
        # The left joins come last, where the planner drops those that a
        # reader of distinct rows takes nothing from.
        bids = pb.join(nb, pb["BuyerId"] == nb["_bb_id"], "inner")
        j = dated(keyed_join(bids, sold_by, "PortfolioId", "_p_id", "Id", basis=p, keys_of=pb))
        j = j.join(broadcast_if_small(su), pb["PlacedByUserId"] == su["_su_id"], "left")
    elif fits_broadcast(nb, basis=names):
        # The user joins the narrow bid: broadcast where small, else on its own
        # shuffle before the bid carries the portfolio's columns.
        bids = (pb.join(nb, pb["BuyerId"] == nb["_bb_id"], "inner")
                .join(broadcast_if_small(su), pb["PlacedByUserId"] == su["_su_id"], "left"))
        j = keyed_join(bids, portfolios, "PortfolioId", "_p_id", "Id", basis=p, keys_of=pb)
    else:
        # The bids are wide: shuffled once, to their portfolio, where the names
        # of buyers and users come back in lists. Auctions and dates meet the
        # portfolio where it meets the bids.
        bids, sold_by, a, dates = dealt_by_key(pb, sold_by, "PortfolioId", "_p_id", "Id", "_deal", more=[(a, "_a_pid"), (dates, "_ev_pid")])
        portfolios = (sold_by.join(a, F.col("_deal_of") == F.col("_deal_of1"), "left")
                      .join(dates, F.col("_deal_of") == F.col("_deal_of2"), "left"))
        j = bids.join(portfolios, F.col("_deal") == F.col("_deal_of"), "inner")
        j = lookups_by_key(j, "_deal", {"BuyerId": {"Buyer": "Buyer", "_hit": "_hit"}}, nb.withColumn("_hit", F.lit(True)), "_bb_id", links_of=bids)
        j = j.filter(F.col("_hit"))
        if fits_broadcast(su):
            j = j.join(F.broadcast(su), F.col("PlacedByUserId") == su["_su_id"], "left")
        else:
            j = lookups_by_key(j, "_deal", {"PlacedByUserId": {"_fn": "_fn", "_ln": "_ln"}}, su, "_su_id", links_of=bids)
    return j.select(
        pb["Id"], F.col("_p_id").alias("PortfolioId"), "PortfolioNumber", "PortfolioStatus", "AssetTypes",
        "BidClose", "Listed", "Awarded", "Sold", "Seller_Name", "SellerClient", "Issuers", "Buyer",
        pb["Status"], "BidType", "BidPercent", "ForwardFlowBidMonths", "ForwardFlowMaxFaceValue", pb["BuyerId"],
        "BidContingency", "BidPortfolioCloseDate", "BidFundingDate",
        concat_nullsafe("_fn", F.lit(" "), "_ln").alias("PlacedBy"), "PlacedUtc",
        R.placed_hours("PlacedUtc", "BidClose").alias("PlacedHours"),
    )


# ============================================================== D06 Complaints
COMPLAINT_PASS_1 = ["Status", "Category", "SourceType", "ViolationType", "Outcome", "AccountStatus", "Summary",
                    "AgencyId"]
COMPLAINT_PASS_2 = ["AgencyName_External", "ComplainantName", "ComplainantPhone", "ComplainantEmail",
                    "AttorneyContacted", "FollowUpRequired", "DocumentsRequired", "EmployeesInvolved",
                    "AgencyAction", "AgencyResponse", "AgencyPreventionSteps"]


def d06_complaints(src: Sources, params: Params | None = None) -> DataFrame:
    prm = C.params_or_default(params)
    ct = src["complaint"]
    # few accounts are complained about
    held = likely_keys(src["portfolio_row"], ct, "PortfolioRowGuid", "PortfolioRowId")
    pr = C.renamed(held, {"PortfolioRowGuid": "DebtTraderID", "PortfolioId": "_pr_pid",
                          "Lender": "Lender", "LenderLoanId": "LenderLoanId",
                          "ComplianceHoldStatus": "ComplianceHoldStatus",
                          "SFComplaintId": "SFComplaintId", "Product": "Product",
                          "StateCode": "State"})
    pid = C.renamed(src["portfolio"], {"Id": "_p_id", "PortfolioNumber": "PID", "SellerId": "_p_sid",
                                       "BuyerId": "_p_bid"})
    names = src["business_name"]
    ns = broadcast_if_small(C.business_with_open_name(src, "_ns_id", "Seller_Issuer"), basis=names)
    nb = broadcast_if_small(C.business_with_open_name(src, "_nb_id", "Buyer"), basis=names)
    # LEFT JOIN Business CB, LEFT JOIN open name NCB: NCB exists only through CB
    ncb = broadcast_if_small(C.business_with_open_name(src, "_ncb_id", "_creator_name"), basis=names)
    # The complaint is wide: the accounts complained about meet the portfolio
    # and its parties first, then the complaint once, on the account key.
    asked = ct.select(F.col("PortfolioRowId").alias("_asked")).distinct()
    accounts = (
        pr.join(asked, pr["DebtTraderID"] == F.col("_asked"), "left_semi")
        .join(pid.join(ns, F.col("_p_sid") == ns["_ns_id"], "inner").join(nb, F.col("_p_bid") == nb["_nb_id"], "inner"),
              pid["_p_id"] == F.col("_pr_pid"), "inner")
    )
    j = ct.join(accounts, F.col("DebtTraderID") == ct["PortfolioRowId"], "inner")
    if fits_broadcast(ncb, basis=names):
        j = j.join(ncb, ncb["_ncb_id"] == ct["CreatedByBusinessId"], "left")
    else:
        j = lookups_by_key(j, "PortfolioRowId", {"CreatedByBusinessId": {"_creator_name": "_creator_name"}}, ncb, "_ncb_id", links_of=ct)
    return j.select(
        ct["Id"], "Seller_Issuer", "Buyer", "PID", "DebtTraderID", "Lender", "LenderLoanId", "ComplianceHoldStatus",
        "SFComplaintId", "Product", "State", *[ct[c] for c in COMPLAINT_PASS_1],
        F.coalesce(ct["AgencyName"], F.lit("Unknown")).alias("AgencyName"),
        *[ct[c] for c in COMPLAINT_PASS_2],
        R.created_by(ct["CreatedByBusinessId"], "_creator_name", prm.compliance_creator).alias("CreatedBy"),
        ct["CreatedByBusinessId"],
        (ct["DateSubmitted"] + F.expr("INTERVAL 8 HOURS")).alias("DateSubmitted"),
        ct["ComplaintResolution"], ct["DebtTraderActions"].alias("PlatformActions"),
    )


# ============================================================== D07 Complaint_Aggregate
def d07_complaint_aggregate(src: Sources, params: Params | None = None) -> DataFrame:
    a = src["complaint_aggregate"]
    buyer_names = (C.renamed(src["business_buyer"], {"Id": "_bb_id"})
                   .join(C.business_with_open_name(src, "_b_id", "BuyerBusinessName"),
                         F.col("_bb_id") == F.col("_b_id"), "left").drop("_b_id"))
    seller_names = (C.renamed(src["business_seller"], {"Id": "_bsl_id"})
                    .join(C.business_with_open_name(src, "_s_id", "SellerBusinessName"),
                          F.col("_bsl_id") == F.col("_s_id"), "left").drop("_s_id"))
    names = src["business_name"]
    j = (a.join(broadcast_if_small(buyer_names, basis=names), a["BuyerGuid"] == F.col("_bb_id"), "left")
         .join(broadcast_if_small(seller_names, basis=names), a["SellerGuid"] == F.col("_bsl_id"), "left"))
    j = prev_period_join(j, a, ["AggregateType"], ["BuyerGuid", "SellerGuid", "AgencyGuid"], "Month", "Year",
                         {"Value": "PreviousMonthValue"})
    return j.select(*[F.col(c) for c in a.columns], R.bcr("Value").alias("BCR"), "PreviousMonthValue",
                    R.bcr("PreviousMonthValue").alias("PreviousMonthBCR"), "BuyerBusinessName", "SellerBusinessName")


# ============================================================== D12 PostSale
REQUEST_PASS = ["BulkUploadDataRowId"]
REQUEST_PASS_2 = ["CreatedByAppUserId"]
REQUEST_PASS_3 = ["FundingAmount", "RejectComment", "Escalated", "CSRAction", "FundingNotificationId", "Closed",
                  "ClosedByAppUserId", "LastUpdatedAppUserId", "LastUpdatedSqlId", "LastUpdated", "SysEndTime",
                  "EffortExausted"]


POSTSALE_PORTFOLIO = {"Id": "_p_id", "SellerId": "SellerId", "BuyerId": "BuyerId", "AssetTypes": "AssetTypes", "SellerFeePercent": "_sfp",
                      "BuyerFeePercent": "_bfp", "PurchasePricePercent": "_ppp", "PortfolioNumber": "PortfolioNumber",
                      "Status": "PortfolioStatus", "SoldUtc": "PortfolioSoldUtc", "SellerUploadTemplateId": "_tpl"}


def postsale_portfolios(src: Sources) -> DataFrame:
    """Portfolio side of D12: template (inner), bankruptcy override, seller and
    buyer business / open name / client (left)."""
    p = C.renamed(src["portfolio"], POSTSALE_PORTFOLIO)
    t = broadcast_if_small(C.renamed(src["template"], {"Id": "_t_id", "Name": "TemplateName"}))
    bk = C.renamed(src["portfolio_bk_data"], {"PortfolioId": "_bk_pid", "FinalPurchasePricePercent": "_bk_pct"})

    def party(prefix: str) -> DataFrame:
        b = C.renamed(src["business"], {"Id": f"_{prefix}_id", "ClientId": f"_{prefix}_cid", "Status": f"_{prefix}_st"})
        n = current_names(src["business_name"]).select(F.col("BusinessId").alias(f"_{prefix}n_id"),
                                                       F.col("Name").alias(f"_{prefix}n_name"))
        c = C.renamed(src["client"], {"Id": f"_{prefix}c_id", "Name": f"_{prefix}c_name"})
        j = (b.join(n, F.col(f"_{prefix}_id") == F.col(f"_{prefix}n_id"), "left")
             .join(broadcast_if_small(c), F.col(f"_{prefix}_cid") == F.col(f"_{prefix}c_id"), "left"))
        # C11 once per business, not per request
        return j.withColumn(f"_{prefix}_display", R.out_of_business_name(f"_{prefix}_st", f"_{prefix}n_name"))

    ad = C.renamed(C.awarded_dates(src), {"PortfolioId": "_ad_pid", "PortfolioAwardedUtc": "PortfolioAwardedUtc"})
    names = src["business_name"]
    by_id = (p.join(t, F.col("_tpl") == t["_t_id"], "inner")
             .join(bk, F.col("_p_id") == bk["_bk_pid"], "left")
             .join(ad, F.col("_ad_pid") == F.col("_p_id"), "left"))
    if fits_broadcast(names, basis=names):
        return (by_id.join(F.broadcast(party("bs")), F.col("SellerId") == F.col("_bs_id"), "left")
                .join(F.broadcast(party("bb")), F.col("BuyerId") == F.col("_bb_id"), "left"))
    # shuffled on the portfolio id alone; portfolios without an id have no
    # accounts and so no requests
    refs = {ref: {"_bs_cid": f"_{x}_cid", "_bs_display": f"_{x}_display", "_bsc_name": f"_{x}c_name"} for ref, x in (("SellerId", "bs"), ("BuyerId", "bb"))}
    return lookups_by_key(by_id, "_p_id", refs, party("bs"), "_bs_id", links_of=p)


def d12_postsale(src: Sources, params: Params | None = None) -> DataFrame:
    prm = C.params_or_default(params)
    req = src["request"]
    by = req["InitiatedByBuyer"]
    # request-level rules on the request side, before any join
    r = req.select("*", F.col("Id").alias("_rid"), R.initiated_by(by).alias("InitiatedBy"), F.lower(req["Status"]).alias("RequestStatus"),
                   R.age_days(req["Created"], prm.as_of_local).alias("AgeInDays"),
                   R.request_category(req["Status"], req["RequestType"], by).alias("Category"))
    rt = broadcast_if_small(C.renamed(src["request_type"], {"Id": "_rt_id", "RequestTypeStr": "_rt_str"}))
    held = likely_keys(src["portfolio_row"], req, "PortfolioRowGuid", "DebtAccountId")  # few accounts have requests
    pr = C.renamed(held, {
        "PortfolioRowGuid": "_pr_guid", "PortfolioId": "_pr_pid", "LenderLoanId": "LenderLoanId",
        "Lender": "LenderName", "Product": "Product", "StateCode": "StateCode", "City": "City",
        "OriginationDate": "OriginationDate", "OriginalLoanAmount": "OriginalLoanAmount",
        "PrincipalBalance": "PrincipalBalance", "InterestBalance": "InterestBalance",
        "OtherFeesBalance": "OtherFeesBalance", "WriteOffDate": "WriteOffDate", "DefaultDate": "DefaultDate",
        "LastPaymentDate": "LastPaymentDate", "LastPaymentAmount": "LastPaymentAmount", "BKPoc": "BKPoc"})
    # account-level rules on the account side
    pr = pr.select("*", R.asset_class_exact("Product").alias("AssetType"),
                   R.total_balance().alias("AccountTotalBalance"))
    fund = C.renamed(src["funding_notification"], {"Id": "_f_id", "Status": "FundingStatus",
                                                   "Amount": "FundingCheckAmount", "Mailed": "FundingCheckMailDate",
                                                   "ReferenceOrCheckNumber": "FundingReferenceOrCheckNumber",
                                                   "ConfirmedReceived": "FundingConfirmedReceived",
                                                   "ConfirmedSent": "FundingConfirmedSent"})
    pin = C.renamed(src["info"], {"RequestId": "_pin_rid", "InfoRequested": "InfoRequested"})
    lg = C.renamed(src["legal"], {"RequestId": "_lg_rid", "Explanation": "_lg_x"})
    ot = C.renamed(src["other"], {"RequestId": "_ot_rid", "Explanation": "_ot_x"})
    fr = C.renamed(src["fraud"], {"RequestId": "_fr_rid", "Explanation": "_fr_x"})
    bkr = C.renamed(src["bankrupt"], {"RequestId": "_bkr_rid", "Chapter": "bk_chapter"})
    ps = C.renamed(src["pifsif"], {"RequestId": "_ps_rid", "PaymentDate": "PifSifPaymentDate",
                                   "PaymentAmount": "PifSifPaymentAmount", "PifSifType": "PifSifType"})
    cd = C.renamed(C.close_dates(src), {"RequestId": "_cd_rid", "CloseDate": "CloseDate"})
    pdim = postsale_portfolios(src)
    rid = r["Id"]
    # Most requests have no notification: only those that have one meet the
    # notifications, and the result is one more satellite keyed by request, so
    # no task gets all the NULL keys.
    notified = (req.where(req["FundingNotificationId"].isNotNull())
                .select(F.col("Id").alias("_fn_rid"), F.col("FundingNotificationId").alias("_fn_id")))
    fund = notified.join(fund, F.col("_fn_id") == F.col("_f_id"), "inner").drop("_fn_id", "_f_id")
    # The request-keyed satellites first, on the narrow request (one shuffle
    # on the request id), then the account, then the portfolio.
    j = (
        r.join(rt, r["RequestType"] == rt["_rt_id"], "inner")
        .join(fund, F.col("_fn_rid") == rid, "left")
        .join(pin, pin["_pin_rid"] == rid, "left")
        .join(lg, lg["_lg_rid"] == rid, "left")
        .join(ot, ot["_ot_rid"] == rid, "left")
        .join(fr, fr["_fr_rid"] == rid, "left")
        .join(bkr, bkr["_bkr_rid"] == rid, "left")
        .join(ps, ps["_ps_rid"] == rid, "left")
        .join(cd, cd["_cd_rid"] == rid, "left")
        .join(pr, r["DebtAccountId"] == pr["_pr_guid"], "inner")
    )
    # portfolios with very many requests are salted where the portfolio side
    # is too large to broadcast; they are counted on the accounts, narrow
    asked = (src["request"].select("DebtAccountId").join(held.select("PortfolioRowGuid", F.col("PortfolioId").alias("_pr_pid")),
                                                         F.col("DebtAccountId") == F.col("PortfolioRowGuid"), "inner"))
    j = keyed_join(j, pdim, "_pr_pid", "_p_id", "_rid", basis=C.renamed(src["portfolio"], POSTSALE_PORTFOLIO), keys_of=asked)
    total = F.col("AccountTotalBalance")
    by = r["InitiatedByBuyer"]
    return j.select(
        rid.alias("RequestId"), by, "InitiatedBy",
        R.pick_by_initiator(by, "_bbc_name", "_bsc_name").alias("RequestedBy"),
        R.pick_by_initiator(by, "_bsc_name", "_bbc_name").alias("RequestedTo"),
        "RequestStatus", r["RequestType"],
        F.upper(F.col("_rt_str")).alias("RequestTypeStr"), r["DebtAccountId"], *[r[c] for c in REQUEST_PASS],
        "AgeInDays", r["Created"].alias("CreatedDateStr"), *[r[c] for c in REQUEST_PASS_2], "CloseDate",
        *[r[c] for c in REQUEST_PASS_3],
        "SellerId", "BuyerId", "AssetTypes",
        (total * F.col("_sfp")).alias("DT_SellerFee"), (total * F.col("_bfp")).alias("DT_BuyerFee"),
        "LenderLoanId", "LenderName", "Product", "AssetType",
        "StateCode", "City", "OriginationDate", "OriginalLoanAmount", "AccountTotalBalance",
        "PrincipalBalance", "InterestBalance", "OtherFeesBalance", "WriteOffDate", "DefaultDate",
        "LastPaymentDate", "LastPaymentAmount",
        R.postsale_price(total, "BKPoc", "_ppp").alias("PurchasePriceAmount"),
        R.postsale_percent("BKPoc", "_bk_pct", "_ppp").alias("PurchasePricePercent"),
        "PortfolioNumber", F.col("_p_id").alias("PortfolioId"), "PortfolioStatus", "PortfolioAwardedUtc",
        "PortfolioSoldUtc", "TemplateName",
        "Category",
        F.col("_bs_cid").alias("SellerClientId"), F.col("_bb_cid").alias("BuyerClientId"),
        F.col("_bs_display").alias("SellerName"),
        F.col("_bsc_name").alias("ClientName_Seller"),
        F.col("_bb_display").alias("BuyerName"),
        F.col("_bbc_name").alias("ClientName_Buyer"),
        "FundingStatus", "FundingCheckAmount", "FundingCheckMailDate", "FundingReferenceOrCheckNumber",
        "FundingConfirmedReceived", "FundingConfirmedSent", "InfoRequested",
        F.coalesce("_lg_x", "_ot_x", "_fr_x").alias("Explanation"), "bk_chapter",
        "PifSifPaymentDate", "PifSifPaymentAmount", "PifSifType",
        R.req_status_open("CloseDate", r["Status"]).alias("ReqStatusOpen"),
        R.closed_age_days(r["Status"], r["Created"], "CloseDate").alias("ClosedRejectedWithdrawnReqsAgeDays"),
    )
