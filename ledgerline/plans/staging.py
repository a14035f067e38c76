"""Staging products D14–D18 and D20.

The reference ships these procedures as stubs (header comment + TODO); only a
one-line purpose each and the columns the silver step reads are known. The
definitions below are therefore OUR OWN, built from those purpose lines and
knowable content and is not built.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators import broadcast_if_small, fits_broadcast, likely_keys, lookups_by_key
from ..params import Params
from ..sources import Sources
from . import common as C
from . import gold

AVG_WRITE_OFF = "Update.AverageWriteOffDate"

# Request categories (C09) counted per portfolio -> column names.
CATEGORY_COUNTS = {
    "completed": "CompletedRequests", "pending funding": "PendingFundingRequests", "pif-sif": "PifSifRequests",
    "info": "InfoRequests", "innacurate-data": "InaccurateDataRequests", "direct-pay": "DirectPayRequests",
    "legal": "LegalRequests", "put-back": "PutBackRequests", "buy-back": "BuyBackRequests",
}


def d14_portfolio_events(src: Sources, params: Params | None = None) -> DataFrame:
    """Listed / awarded / PSA-confirmed / sold event dates per portfolio
    (earliest), for portfolios with at least one of them."""
    cols = {"D14ListedUtc": "ListedUtc", "D14AwardedUtc": "AwardedUtc", "PSAConfirmedUtc": "PSAConfirmedUtc",
            "SoldEventUtc": "SoldEventUtc"}
    s = C.event_summary(src, params)
    any_event = F.coalesce(*[F.col(c) for c in cols])
    return s.filter(any_event.isNotNull()).select("PortfolioId", *[F.col(a).alias(b) for a, b in cols.items()])


def event_columns(src: Sources, params: Params | None = None) -> DataFrame:
    """The columns of D14 and D15 side by side, from one read of the summary."""
    s = C.event_summary(src, params)
    funded = F.col("FundingEventCount") > 0
    return s.select("PortfolioId", F.col("D14ListedUtc").alias("ListedUtc"), F.col("D14AwardedUtc").alias("AwardedUtc"), "PSAConfirmedUtc",
                    "SoldEventUtc", *[F.when(funded, F.col(c)).alias(c) for c in ("FirstFundingUtc", "LastFundingUtc", "FundingEventCount")])


def d15_portfolio_funding(src: Sources, params: Params | None = None) -> DataFrame:
    """First / last funding event and number of funding events per portfolio."""
    s = C.event_summary(src, params)
    return s.filter(F.col("FundingEventCount") > 0).select("PortfolioId", "FirstFundingUtc", "LastFundingUtc",
                                                          "FundingEventCount")


def _row_aggregates(account: Column | None = None) -> list:
    """``account``: NULL in rows that are no accounts."""
    one = F.lit(1) if account is None else account
    mean_day = F.floor(F.avg(F.unix_date(F.col("WriteOffDate")))).cast("int")
    return [
        F.count(one).alias("AccountCount"),
        F.count(F.when(F.col("RemovedUTCDate").isNull(), one)).alias("ActiveAccountCount"),
        F.sum("PrincipalBalance").alias("RowTotalPrincipal"),
        F.sum("InterestBalance").alias("RowTotalInterest"),
        F.sum("OtherFeesBalance").alias("RowTotalFees"),
        F.date_from_unix_date(mean_day).alias(AVG_WRITE_OFF),
    ]


def d16_row_aggregates(src: Sources, params: Params | None = None) -> DataFrame:
    """Account-level aggregates per portfolio, incl. the mean write-off date."""
    return src["portfolio_row"].groupBy("PortfolioId").agg(*_row_aggregates())


def requests_by_account(src: Sources) -> DataFrame:
    r = src["request"].select("DebtAccountId", R.request_category("Status", "RequestType", "InitiatedByBuyer").alias("_cat"))
    return r.groupBy(F.col("DebtAccountId").alias("_r_guid")).agg(
        F.count(F.lit(1)).alias("RequestCount"), *[F.count(F.when(F.col("_cat") == k, F.lit(1))).alias(v) for k, v in CATEGORY_COUNTS.items()])


def complaints_by_account(src: Sources) -> DataFrame:
    return src["complaint"].groupBy(F.col("PortfolioRowId").alias("_c_guid")).agg(F.count(F.lit(1)).alias("ComplaintCount"))


def accounts_asked(src: Sources) -> DataFrame:
    """The accounts, beyond the broadcast size without most of those that no request names."""
    return likely_keys(src["portfolio_row"], src["request"], "PortfolioRowGuid", "DebtAccountId")


def complaints_of(src: Sources) -> DataFrame:
    """(PortfolioId, ComplaintCount) of each account complained about."""
    filed = complaints_by_account(src)
    pr = likely_keys(src["portfolio_row"], src["complaint"], "PortfolioRowGuid", "PortfolioRowId").select("PortfolioRowGuid", "PortfolioId")
    return pr.join(filed, F.col("PortfolioRowGuid") == F.col("_c_guid"), "inner").select("PortfolioId", "ComplaintCount")


def account_fold(src: Sources, params: Params | None = None, filed: DataFrame | None = None) -> DataFrame:
    """D16, D17b and D17d in ONE pass over the accounts: requests and
    complaints are reduced to one row per account, meet the account on its key
    (no shuffle of it in the bucketed layout), and a single aggregation per
    portfolio yields the columns of all three. Portfolios without requests or
    complaints have NULL there, as after the left joins of the separate ones.
    Accounts far beyond the broadcast size are not shuffled on their key: they
    go to the aggregation from their scan, beside the counts of those that
    have requests or complaints, the only ones that meet them. ``filed``:
    ``complaints_of``, kept by a caller that reads it too."""
    asked = requests_by_account(src)
    pr = src["portfolio_row"]
    sums = ["RequestCount", *CATEGORY_COUNTS.values(), "ComplaintCount"]
    touched = accounts_asked(src)
    if touched is pr:
        by_account = complaints_by_account(src)
        j = (pr.join(asked, pr["PortfolioRowGuid"] == asked["_r_guid"], "left").join(by_account, pr["PortfolioRowGuid"] == by_account["_c_guid"], "left"))
        return j.groupBy("PortfolioId").agg(*_row_aggregates(), *[F.sum(c).alias(c) for c in sums])
    accounts = pr.select("PortfolioId", F.lit(1).alias("_account"), "RemovedUTCDate", "PrincipalBalance", "InterestBalance", "OtherFeesBalance", "WriteOffDate")
    links = touched.select("PortfolioRowGuid", "PortfolioId")
    requests = links.join(asked, F.col("PortfolioRowGuid") == F.col("_r_guid"), "inner").drop("PortfolioRowGuid", "_r_guid")
    rows = accounts.unionByName(requests, allowMissingColumns=True).unionByName(complaints_of(src) if filed is None else filed, allowMissingColumns=True)
    return rows.groupBy("PortfolioId").agg(*_row_aggregates(F.col("_account")), *[F.sum(c).alias(c) for c in sums])


def from_fold(fold: DataFrame) -> dict[str, DataFrame]:
    """The staging products D16, D17b and D17d of a fold."""
    rows = ["AccountCount", "ActiveAccountCount", "RowTotalPrincipal", "RowTotalInterest", "RowTotalFees", f"`{AVG_WRITE_OFF}`"]
    return {
        "RowAggregates": fold.select("PortfolioId", *rows),
        "PostSaleAggregates": fold.filter(F.col("RequestCount").isNotNull()).select("PortfolioId", "RequestCount", *CATEGORY_COUNTS.values()),
        "ComplaintsByPortfolio": fold.filter(F.col("ComplaintCount").isNotNull()).select("PortfolioId", "ComplaintCount"),
    }


def d17a_bid_aggregates(src: Sources, params: Params | None = None) -> DataFrame:
    """Bid statistics per portfolio."""
    pb = src["portfolio_bid"]
    return pb.groupBy("PortfolioId").agg(
        F.count("Id").alias("BidCount"),
        F.count(F.when(F.col("Status") == "Won", F.col("Id"))).alias("WonBidCount"),
        F.max("BidPercent").alias("MaxBidPercent"),
        F.min("PlacedUtc").alias("FirstBidUtc"),
    )


def d17b_postsale_aggregates(src: Sources, params: Params | None = None) -> DataFrame:
    """Post-sale requests per portfolio, in total and per category."""
    r = src["request"].select("DebtAccountId", "Status", "RequestType", "InitiatedByBuyer")
    pr = src["portfolio_row"].select(F.col("PortfolioRowGuid").alias("_guid"), "PortfolioId")
    j = r.join(pr, r["DebtAccountId"] == pr["_guid"], "inner").withColumn(
        "_cat", R.request_category("Status", "RequestType", "InitiatedByBuyer"))
    return j.groupBy("PortfolioId").agg(
        F.count(F.lit(1)).alias("RequestCount"),
        *[F.count(F.when(F.col("_cat") == k, F.lit(1))).alias(v) for k, v in CATEGORY_COUNTS.items()],
    )


def _complaint_portfolios(src: Sources) -> DataFrame:
    ct = src["complaint"].select("Id", "PortfolioRowId")
    pr = src["portfolio_row"].select(F.col("PortfolioRowGuid").alias("_guid"), F.col("PortfolioId").alias("_pid"))
    return ct.join(pr, ct["PortfolioRowId"] == pr["_guid"], "inner")


def d17c_complaints_by_buyer(src: Sources, params: Params | None = None, by_pid: DataFrame | None = None) -> DataFrame:
    """Complaints per buyer of the account's portfolio (NULL buyer is a group):
    the counts per portfolio (D17d, one row each) summed by buyer."""
    p = src["portfolio"].select(F.col("Id").alias("_p_id"), "BuyerId")
    counts = by_pid if by_pid is not None else d17d_complaints_by_pid(src, params)
    j = counts.join(p, counts["PortfolioId"] == p["_p_id"], "inner")
    return j.groupBy("BuyerId").agg(F.sum("ComplaintCount").alias("ComplaintCount"))


def d17d_complaints_by_pid(src: Sources, params: Params | None = None) -> DataFrame:
    """Complaints per portfolio."""
    return (_complaint_portfolios(src).groupBy(F.col("_pid").alias("PortfolioId"))
            .agg(F.count(F.lit(1)).alias("ComplaintCount")))


BASE_PORTFOLIO_COLS = ["Id", "PortfolioNumber", "Status", "SellerId", "BuyerId", "UploadDateUtc",
                       "PortfolioCloseUtc", "SoldUtc", "ForwardFlowAgreementId", "NumberOfAccounts",
                       "PurchasePricePercent", "PurchasePriceAmount", "PortfolioTypeName", "AuctionId", "AuctionType"]


def party_names(business: DataFrame) -> DataFrame:
    """One row per business id from the Business product (whose open-name join
    may repeat an id): legal name, client id and client name."""
    return business.select("Id", "LegalName", "ClientId", "ClientName").distinct()


def d18_silver_base(src: Sources, params: Params | None = None, portfolio: DataFrame | None = None,
                    business: DataFrame | None = None, built: dict[str, DataFrame] | None = None, narrow: bool = False) -> DataFrame:
    """Portfolio product + seller and buyer names + D14–D17 per portfolio.
    ``portfolio``/``business`` may be the persisted gold tables, ``built`` the
    persisted staging tables (refresh). D14 and D15 come from one read of the
    event summary, D16, D17b and D17d from one read of the accounts
    (``account_fold``). ``narrow``: see D01."""
    prm = C.params_or_default(params)
    built = built or {}
    def portfolios(with_id: bool | None = None) -> DataFrame:
        if portfolio is None:
            return gold.d01_portfolio(src, prm, narrow, with_id).select(*BASE_PORTFOLIO_COLS)
        some = portfolio if with_id is None else portfolio.filter(F.col("Id").isNotNull() if with_id else F.col("Id").isNull())
        return some.select(*BASE_PORTFOLIO_COLS)

    named = party_names(business if business is not None else gold.d02_business(src, prm))
    names = broadcast_if_small(named, basis=src["business_name"])
    of_seller = {"LegalName": "SellerLegalName", "ClientName": "SellerClientName"}
    of_buyer = {"LegalName": "BuyerLegalName", "ClientId": "BuyerClientId", "ClientName": "BuyerClientName"}
    seller = C.renamed(names, {"Id": "_s_id", **of_seller})
    buyer = C.renamed(names, {"Id": "_b_id", **of_buyer})
    if "AccountFold" in built or accounts_asked(src) is src["portfolio_row"]:
        fold = built["AccountFold"] if "AccountFold" in built else account_fold(src, prm)
        complaints = from_fold(fold)["ComplaintsByPortfolio"]
    else:
        # narrow rows, kept: the fold and the complaints by buyer read them
        filed = complaints_of(src).persist(StorageLevel.MEMORY_AND_DISK)
        fold = account_fold(src, prm, filed)
        complaints = filed.groupBy("PortfolioId").agg(F.sum("ComplaintCount").alias("ComplaintCount"))
    per_portfolio = [
        event_columns(src, prm),
        fold.withColumnRenamed("ComplaintCount", "PortfolioComplaintCount"),
        built["BidAggregates"] if "BidAggregates" in built else d17a_bid_aggregates(src, prm),
    ]
    by_buyer = built["ComplaintsByBuyer"] if "ComplaintsByBuyer" in built else d17c_complaints_by_buyer(src, prm, complaints)
    cb = C.renamed(by_buyer, {"BuyerId": "_cb_id", "ComplaintCount": "BuyerComplaintCount"})

    def by_party(rows: DataFrame) -> DataFrame:
        return (rows.join(seller, F.col("SellerId") == seller["_s_id"], "left")
                .join(buyer, F.col("BuyerId") == buyer["_b_id"], "left"))

    def by_id(rows: DataFrame) -> DataFrame:
        for i, agg in enumerate(per_portfolio):
            a = agg.withColumnRenamed("PortfolioId", f"_pp{i}")
            rows = rows.join(a, F.col("Id") == a[f"_pp{i}"], "left")
        return rows

    def by_complaints(rows: DataFrame) -> DataFrame:
        return rows.join(cb, F.col("BuyerId") == cb["_cb_id"], "left")

    if narrow or fits_broadcast(named, basis=src["business_name"]):
        out = by_complaints(by_id(by_party(portfolios())))
    else:
        # the rows are wide: shuffled on the portfolio id alone
        links = portfolio if portfolio is not None else src["portfolio"]
        out = by_id(portfolios(with_id=True))
        out = lookups_by_key(out, "Id", {"SellerId": of_seller, "BuyerId": of_buyer}, named, "Id", links_of=links)
        out = lookups_by_key(out, "Id", {"BuyerId": {"BuyerComplaintCount": "BuyerComplaintCount"}}, cb, "_cb_id", links_of=links)
        out = out.unionByName(by_complaints(by_party(portfolios(with_id=False))), allowMissingColumns=True)
    parties = [*of_seller.values(), *of_buyer.values()]
    bids, asked = per_portfolio[2].columns[1:], ["RequestCount", *CATEGORY_COUNTS.values(), "PortfolioComplaintCount"]
    dated = [c for agg in per_portfolio[:2] for c in agg.columns[1:] if c not in asked]
    return out.select(*[f"`{c}`" for c in (*BASE_PORTFOLIO_COLS, *parties, *dated, *bids, *asked, "BuyerComplaintCount")])


def d20_formula_complete(src: Sources, params: Params | None = None, base: DataFrame | None = None, narrow: bool = False) -> DataFrame:
    """SilverBase + the listed year/month the silver step joins goals on."""
    b = base if base is not None else d18_silver_base(src, params, narrow=narrow)
    return b.select("*", F.year("ListedUtc").cast("int").alias("ListedUtcYear"),
                    F.month("ListedUtc").cast("int").alias("ListedUtcMonth"))
