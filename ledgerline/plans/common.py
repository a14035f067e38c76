"""Shared building blocks of the products: party filters, name lookups,
first-event dates and the per-account scrub / payment satellites."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import broadcast_if_small, current_names, first_hit, latest_by
from ..params import Params
from ..sources import Sources


def renamed(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Project ``df`` to ``{source column: output name}``."""
    return df.select(*[F.col(s).alias(d) for s, d in mapping.items()])


# ------------------------------------------------------------------ predicates
def p_exclude_party(c: str, value: str) -> Column:
    """``c <> value`` – drops NULL ``c`` (three-valued logic)."""
    return F.col(c) != F.lit(value)


def p_not_in_or_null(c: str, values) -> Column:
    """``c NOT IN (...) OR c IS NULL`` – keeps NULL ``c``."""
    return ~F.col(c).isin(list(values)) | F.col(c).isNull()


def p_not_in(c: str, values) -> Column:
    """``c NOT IN (...)`` – drops NULL ``c``."""
    return ~F.col(c).isin(list(values))


def p_null_keeping_exclude(c: str, value: str) -> Column:
    """``ISNULL(c,'') <> value`` – keeps NULL ``c``."""
    return F.coalesce(F.col(c), F.lit("")) != F.lit(value)


# FIXED VALUES – statuses of portfolios that were sold or are being sold.
SALE_STATUSES = ["closed", "funded", "awaiting seller fee", "pending buyer funding"]


def p_status_in(c: str = "Status") -> Column:
    """LOWER(Status) IN (closed, funded, awaiting seller fee, pending buyer funding)."""
    return F.lower(F.col(c)).isin(SALE_STATUSES)


# FIXED VALUES – portfolio events counted as views of a portfolio (VW_Bidders).
VIEWER_EVENTS = ["download data-masked", "download data-masked uri",
                 "download data-masked-additional-unmask uri", "read"]


def p_viewer_events(c: str = "EventType") -> Column:
    """P06."""
    return F.col(c).isin(VIEWER_EVENTS)


# ------------------------------------------------------------------ aggregates
def last_downloads(src: Sources) -> DataFrame:
    """Latest download per business (not per portfolio)."""
    return latest_by(src["portfolio_download"], "BusinessId", "DownloadedUtc", "MaxDownloadedUtc")


EVENT_SUMMARY = "portfolio_event_summary"


def event_summary(src: Sources, params: Params | None = None) -> DataFrame:
    """Every per-portfolio event date the products read, in ONE pass over the
    event log (SURVEY §4.2): first 'listed' (A09), first awarded case-folded
    (A10), first 'awarded' (A11), first 'Awarded' (A05), the staging event
    dates (D14) and the funding events (D15). Rows: portfolios with at least
    one of these events; joined LEFT everywhere, so a missing event is NULL
    exactly as with the separate aggregates. A refresh materialises it once
    (``Sources.with_tables``) and every product reads that table."""
    if EVENT_SUMMARY in src.derived:
        return src.derived[EVENT_SUMMARY]
    return summarise_events(src["portfolio_event"], params_or_default(params))


def summarise_events(events: DataFrame, prm: Params) -> DataFrame:
    """The event summary of some events. Its columns are minima, maxima and
    counts, so summaries of parts of the log merge (``merge_summaries``)."""
    et = F.col("EventType")
    funding = et.isin(list(prm.funding_events))
    specs = {
        "ListedUtc": et == "listed",
        "AwardedUtc": F.lower(et) == "awarded",
        "PortfolioAwardedUtc": et == "awarded",
        "AwardedEventUtc": et == "Awarded",
        "D14ListedUtc": et == prm.listed_event,
        "D14AwardedUtc": et == prm.awarded_event,
        "PSAConfirmedUtc": et == prm.psa_event,
        "SoldEventUtc": et == prm.sold_event,
    }
    cond = funding
    for p in specs.values():
        cond = cond | p
    ts = F.col("EventUtc")
    return events.filter(cond).groupBy("PortfolioId").agg(
        *[F.min(F.when(p, ts)).alias(n) for n, p in specs.items()],
        F.min(F.when(funding, ts)).alias("FirstFundingUtc"),
        F.max(F.when(funding, ts)).alias("LastFundingUtc"),
        F.count(F.when(funding, F.lit(1))).alias("FundingEventCount"),
    )


def merge_summaries(*summaries: DataFrame) -> DataFrame:
    """One event summary of what each summarises, in any order and with late
    events: the earliest, the latest and the sum per portfolio."""
    both = reduce(DataFrame.unionByName, summaries)
    how = {"LastFundingUtc": F.max, "FundingEventCount": F.sum}
    return both.groupBy("PortfolioId").agg(*[how.get(c, F.min)(c).alias(c) for c in both.columns if c != "PortfolioId"])


def event_dates(src: Sources, column: str, params: Params | None = None, present_only: bool = False) -> DataFrame:
    """(PortfolioId, column) from the event summary; ``present_only`` keeps only
    portfolios that have the event (the standalone aggregate's row set)."""
    df = event_summary(src, params).select("PortfolioId", column)
    return df.filter(F.col(column).isNotNull()) if present_only else df


def listed_dates(src: Sources, present_only: bool = False) -> DataFrame:
    """First 'listed' event per portfolio (exact case)."""
    return event_dates(src, "ListedUtc", present_only=present_only)


def awarded_dates_ci(src: Sources, present_only: bool = False) -> DataFrame:
    """A10: first awarded event per portfolio, case-folded."""
    return event_dates(src, "AwardedUtc", present_only=present_only)


def awarded_dates(src: Sources, present_only: bool = False) -> DataFrame:
    """First 'awarded' event per portfolio (exact lower-case spelling)."""
    return event_dates(src, "PortfolioAwardedUtc", present_only=present_only)


def postsale_counts(src: Sources) -> DataFrame:
    """Post-sale requests per account that are not withdrawn (NULL status dropped)."""
    r = src["request"].filter(F.lower(F.col("Status")) != "withdrawn")
    return r.groupBy("DebtAccountId").agg(F.count(F.lit(1)).alias("CountPostSaleRequest"))


def close_dates(src: Sources) -> DataFrame:
    """Latest 'closed' event per post-sale request."""
    ev = src["request_event"].filter(F.col("EventType") == "closed")
    return latest_by(ev, "RequestId", "Created", "CloseDate")


def open_name_min_start(src: Sources) -> DataFrame:
    """Earliest start of the open names per business."""
    bn = current_names(src["business_name"], "BusinessId", "StartDateUtc")
    return bn.groupBy("BusinessId").agg(F.min("StartDateUtc").alias("MinNameStartDateUtc"))


# ------------------------------------------------------------------ satellites
def _scrub_hits(src: Sources, results: DataFrame, payload: list[str], received_alias: str, count_alias: str) -> DataFrame:
    """First hit and number of hits per account, then the file of the first
    hit: the file table (unique ids) meets one row per account, not every
    scrub row."""
    own = [c for c in payload if c != received_alias]
    hits = first_hit(results, "DebtAccountId", ["Id"], [*own, "ResultFileId"], count_alias)
    return _with_result_file(src, hits, received_alias).select("DebtAccountId", count_alias, *payload)


def _with_result_file(src: Sources, df: DataFrame, received_alias: str) -> DataFrame:
    rf = broadcast_if_small(renamed(src["result_file"], {"Id": "_rf_id", "Received": received_alias}))
    return df.join(rf, df["ResultFileId"] == rf["_rf_id"], "left").drop("_rf_id")


def deceased_hits(src: Sources) -> DataFrame:
    """Deceased scrub hits per account, first hit by result id."""
    return _scrub_hits(src, src["deceased_result"], ["DateOfDeath", "DeceasedScrubReceived"], "DeceasedScrubReceived", "TotalDeceasedHits")


BK_PAYLOAD = ["FileDate", "Chapter", "CaseStatus", "CaseNumber", "BarDate", "CourtCity", "CourtState", "CourtZip",
              "PlanFiledDate", "ConfirmationHearingDate", "PlanConfirmationDate", "LastDateToObjectToDischarge",
              "BankruptcyScrubReceived"]


def bankruptcy_hits(src: Sources) -> DataFrame:
    """Bankruptcy scrub hits per account, first hit by result id."""
    return _scrub_hits(src, src["bankruptcy_result"], BK_PAYLOAD, "BankruptcyScrubReceived", "TotalBankruptyHits")


SCRA_PAYLOAD = ["ActiveDutyStatus", "ActiveDutyStartDate", "ActiveDutyEndDate", "ServiceAgency", "ScraScrubReceived"]


def scra_hits(src: Sources) -> DataFrame:
    """SCRA scrub hits per account, first hit by result id."""
    return _scrub_hits(src, src["scra_result"], SCRA_PAYLOAD, "ScraScrubReceived", "TotalSCRAHits")


def pifsif_hits(src: Sources) -> DataFrame:
    """paid/settled-in-full payments of closed requests (LOWER(Status) =
    'closed'); first by request id, then the satellite's own sequence."""
    r = src["request"].filter(F.lower(F.col("Status")) == "closed").select(
        F.col("Id").alias("_rid"), "DebtAccountId")
    # the satellite is the side to broadcast (size-checked): the request side
    # then streams and keeps its account-key partitioning for the aggregate
    ps = broadcast_if_small(src["pifsif"].select("RequestId", "Seq", "PaymentDate", "PaymentAmount"))
    j = r.join(ps, r["_rid"] == ps["RequestId"], "inner")
    return first_hit(j, "DebtAccountId", ["_rid", "Seq"], ["PaymentDate", "PaymentAmount"], "TotalPifSif")


def account_closed_hits(src: Sources) -> DataFrame:
    """Account-closed requests (Status = 'closed', exact case); first by
    request id, then closed date."""
    r = src["request"].filter(F.col("Status") == "closed").select(F.col("Id").alias("_rid"), "DebtAccountId")
    ac = broadcast_if_small(src["account_closed"].select("RequestId", "ClosedDate"))
    j = r.join(ac, r["_rid"] == ac["RequestId"], "inner")
    return first_hit(j, "DebtAccountId", ["_rid", "ClosedDate"], ["ClosedDate"], "TotalAccountClosed")


def business_with_open_name(src: Sources, id_alias: str, name_alias: str, extra: dict[str, str] | None = None
                            ) -> DataFrame:
    """Business joined to its open name(s): Id, name and chosen business columns."""
    b = renamed(src["business"], {"Id": id_alias, **(extra or {})})
    n = current_names(src["business_name"]).select(F.col("BusinessId").alias("_n_bid"), F.col("Name").alias(name_alias))
    return b.join(n, b[id_alias] == n["_n_bid"], "inner").drop("_n_bid")


def params_or_default(params: Params | None) -> Params:
    return params if params is not None else Params()
