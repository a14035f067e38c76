"""Row laws of the gold products: how many rows each must have, counted from
the sources on key columns alone.

A law is independent of the product's own plan. It reads keys only, reduces
every side to one row per key before it joins, and never touches the wide
columns, so it costs a small part of the product. ``exact`` laws give the
number of rows; the others leave out optional sides that can only multiply
rows and give the least number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import null_as_empty
from ..operators import current_names
from ..params import Params
from ..sources import Sources
from . import common as C


def _count(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(F.col(key).alias(f"_k_{name}")).agg(F.count(F.lit(1)).alias(name))


def _times(df: DataFrame, key: str, fact: DataFrame, name: str, how: str = "inner") -> DataFrame:
    """``df`` with the factor ``name`` of its key."""
    return df.join(fact, F.col(key) == F.col(f"_k_{name}"), how).drop(f"_k_{name}")


def _product(names: list[str]) -> Column:
    out = F.lit(1).cast("long")
    for n in names:
        out = out * F.coalesce(F.col(n), F.lit(1))
    return out


def _total(df: DataFrame, names: list[str]) -> DataFrame:
    return df.agg(F.coalesce(F.sum(_product(names)), F.lit(0)).alias("n"))


def _open_names(src: Sources, name: str) -> DataFrame:
    """Open names per business that exists."""
    each = _times(src["business"].select("Id"), "Id", _count(current_names(src["business_name"]), "BusinessId", "_names"), "_names")
    return each.groupBy(F.col("Id").alias(f"_k_{name}")).agg(F.sum("_names").alias(name))


def portfolio(src: Sources, prm: Params) -> DataFrame:
    p = src["portfolio"].filter(C.p_exclude_party("SellerId", prm.excluded_seller) & C.p_not_in_or_null("BuyerId", prm.excluded_buyers))
    p = _times(p.select("Id", "PortfolioTypeId"), "PortfolioTypeId", _count(src["portfolio_type"], "Id", "types"), "types", "left")
    p = _times(p, "Id", _count(src["auction"], "PortfolioId", "auctions"), "auctions", "left")
    p = _times(p, "Id", _count(src["portfolio_data"], "PortfolioId", "data"), "data", "left")
    return _total(p, ["types", "auctions", "data"])


def business(src: Sources, prm: Params) -> DataFrame:
    b = src["business"].filter(C.p_not_in("Id", prm.excluded_businesses)).select("Id", "ClientId")
    b = _times(b, "Id", _count(current_names(src["business_name"]), "BusinessId", "names"), "names")
    b = _times(b, "ClientId", _count(src["client"], "Id", "clients"), "clients")
    subtypes = ["agency", "buyer", "seller"]
    for s in subtypes:
        b = _times(b, "Id", _count(src[f"business_{s}"], "Id", s), s, "left")
    return _total(b, ["names", "clients", *subtypes])


def portfolio_row(src: Sources, prm: Params) -> DataFrame:
    """Accounts per sale portfolio, and the commercial rows of an account
    beyond its first, which only few accounts have."""
    p = src["portfolio"].filter(C.p_status_in("Status") & C.p_exclude_party("SellerId", prm.excluded_seller)
                                & C.p_not_in_or_null("BuyerId", prm.excluded_buyers)).select("Id", "PortfolioTypeId", "BuyerId", "SellerId")
    p = _times(p, "PortfolioTypeId", _count(src["portfolio_type"], "Id", "types"), "types")
    parties = _times(src["business"].select("Id", "ClientId"), "ClientId", _count(src["client"], "Id", "_clients"), "_clients")
    for side in ("Buyer", "Seller"):
        p = _times(p, f"{side}Id", parties.groupBy(F.col("Id").alias(f"_k_{side}")).agg(F.sum("_clients").alias(side)), side)
    sale = p.groupBy("Id").agg(F.sum(_product(["types", "Buyer", "Seller"])).alias("sales"))
    accounts = src["portfolio_row"]
    repeated = _count(src["portfolio_row_commercial"], "PortfolioRowGuid", "rows").filter(F.col("rows") > 1)
    extra = accounts.select("PortfolioRowGuid", "PortfolioId").join(repeated, F.col("PortfolioRowGuid") == F.col("_k_rows"))
    per = (accounts.groupBy("PortfolioId").agg(F.count(F.lit(1)).alias("accounts"))
           .unionByName(extra.groupBy("PortfolioId").agg(F.sum(F.col("rows") - 1).alias("accounts"))))
    return _total(per.join(sale, F.col("PortfolioId") == F.col("Id")), ["accounts", "sales"])


def _portfolios(src: Sources, **sides: str) -> DataFrame:
    """Portfolio ids with the product of the open names of their parties."""
    p = src["portfolio"].select("Id", *sides.values())
    for name, column in sides.items():
        p = _times(p, column, _open_names(src, name), name)
    return p.groupBy("Id").agg(F.sum(_product(list(sides))).alias("parties"))


def portfolio_aggregate(src: Sources, prm: Params) -> DataFrame:
    rows = _count(src["portfolio_aggregate"], "PortfolioId", "rows")
    return _total(_times(_portfolios(src, seller="SellerId"), "Id", rows, "rows"), ["rows", "parties"])


def portfolio_bid(src: Sources, prm: Params) -> DataFrame:
    """Least: the bidder's and seller's names and the auctions multiply; a
    bid's user only could."""
    bids = src["portfolio_bid"].filter(C.p_exclude_party("BuyerId", prm.excluded_bidder)).groupBy("PortfolioId", "BuyerId").agg(F.count(F.lit(1)).alias("bids"))
    bids = _times(bids, "BuyerId", _open_names(src, "buyer"), "buyer")
    per = bids.groupBy(F.col("PortfolioId").alias("_k_rows")).agg(F.sum(_product(["bids", "buyer"])).alias("rows"))
    p = src["portfolio"].select("Id", "SellerId")
    sellers = _times(src["business"].select("Id", "ClientId"), "ClientId", _count(src["client"], "Id", "clients"), "clients")
    sellers = _times(sellers, "Id", _count(current_names(src["business_name"]), "BusinessId", "names"), "names")
    p = _times(p, "SellerId", sellers.groupBy(F.col("Id").alias("_k_seller")).agg(F.sum(_product(["clients", "names"])).alias("seller")), "seller")
    p = _times(p, "Id", _count(src["auction"], "PortfolioId", "auctions"), "auctions", "left")
    return _total(_times(p, "Id", per, "rows"), ["seller", "auctions", "rows"])


def complaints(src: Sources, prm: Params) -> DataFrame:
    """Least: a complaint's creator only could multiply."""
    accounts = src["portfolio_row"].select("PortfolioRowGuid", "PortfolioId")
    met = _times(accounts, "PortfolioRowGuid", _count(src["complaint"], "PortfolioRowId", "filed"), "filed")
    per = met.groupBy(F.col("PortfolioId").alias("_k_rows")).agg(F.sum("filed").alias("rows"))
    return _total(_times(_portfolios(src, seller="SellerId", buyer="BuyerId"), "Id", per, "rows"), ["rows", "parties"])


def complaint_aggregate(src: Sources, prm: Params) -> DataFrame:
    """Open names of the buyer and the seller, and rows of the month before."""
    a = src["complaint_aggregate"]
    guids = ["BuyerGuid", "SellerGuid", "AgencyGuid"]
    keys = [F.col("AggregateType").alias("_type"), *(null_as_empty(g).alias(f"_{g}") for g in guids)]
    month = F.col("Year") * 12 + F.col("Month")
    before = a.groupBy(*keys, (month + 1).alias("_month")).agg(F.count(F.lit(1)).alias("before"))
    rows = a.select("BuyerGuid", "SellerGuid", *keys, month.alias("_month")).join(before, ["_type", *(f"_{g}" for g in guids), "_month"], "left")
    for side in ("Buyer", "Seller"):
        named = _times(src[f"business_{side.lower()}"].select("Id"), "Id", _open_names(src, "_open"), "_open", "left")
        names = named.groupBy(F.col("Id").alias(f"_k_{side}")).agg(F.sum(F.coalesce("_open", F.lit(1))).alias(side))
        rows = _times(rows, f"{side}Guid", names, side, "left")
    return _total(rows, ["before", "Buyer", "Seller"])


def postsale(src: Sources, prm: Params) -> DataFrame:
    """Least: satellites, names and notifications only could multiply."""
    r = _times(src["request"].select("DebtAccountId", "RequestType"), "RequestType", _count(src["request_type"], "Id", "types"), "types")
    met = _times(src["portfolio_row"].select("PortfolioRowGuid", "PortfolioId"), "PortfolioRowGuid",
                 r.groupBy(F.col("DebtAccountId").alias("_k_requests")).agg(F.sum("types").alias("requests")), "requests")
    per = met.groupBy(F.col("PortfolioId").alias("_k_rows")).agg(F.sum("requests").alias("rows"))
    p = _times(src["portfolio"].select("Id", "SellerUploadTemplateId"), "SellerUploadTemplateId", _count(src["template"], "Id", "templates"), "templates")
    return _total(_times(p, "Id", per, "rows"), ["templates", "rows"])


#: Table -> (law, whether it gives the number of rows or the least number).
GOLD_LAWS: dict[str, tuple[Callable[[Sources, Params], DataFrame], bool]] = {
    "Portfolio": (portfolio, True),
    "Business": (business, True),
    "Portfolio_Row": (portfolio_row, True),
    "Portfolio_Aggregate": (portfolio_aggregate, True),
    "Portfolio_Bid": (portfolio_bid, False),
    "Complaints": (complaints, False),
    "Complaint_Aggregate": (complaint_aggregate, True),
    "PostSale": (postsale, False),
}


class RowLawError(ValueError):
    """A built table has not the rows its sources call for."""


def expected(tables: Iterable[str], src: Sources, prm: Params) -> dict[str, int]:
    """What the laws of ``tables`` give, counted in one job: their stages run
    side by side and share what they count alike (names, clients)."""
    laws = [GOLD_LAWS[t][0](src, prm).select(F.lit(t).alias("table"), "n") for t in tables]
    return {r["table"]: r["n"] for r in reduce(DataFrame.unionByName, laws).collect()} if laws else {}


def check(table: str, rows: int, wanted: int) -> None:
    """Raise unless ``rows`` is what the table's law asks for."""
    exact = GOLD_LAWS[table][1]
    if rows != wanted if exact else rows < wanted:
        raise RowLawError(f"{table} was built with {rows} rows; its sources call for {'' if exact else 'at least '}{wanted}")
