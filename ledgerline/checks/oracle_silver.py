"""DuckDB oracle SQL for staging D14–D18/D20, silver D13 and views D08–D11.

D13 and the views are written from their definitions: the month goals and the
macro quarters attached to every portfolio, and, for the bidders, the distinct
(client, name, close month) of the bids on it.
"""

from __future__ import annotations

from ..params import Params
from ..plans import staging as S
from ..plans.silver import GOAL_COL
from .oracle import q, sql_list, sql_str
from .oracle_gold import category_sql


def bodies(prm: Params) -> dict[str, str]:
    b: dict[str, str] = {}
    lits = [prm.listed_event, prm.awarded_event, prm.psa_event, prm.sold_event]
    b["st_portfolio_events"] = f"""select PortfolioId,
 min(case when EventType = {sql_str(prm.listed_event)} then EventUtc end) as ListedUtc,
 min(case when EventType = {sql_str(prm.awarded_event)} then EventUtc end) as AwardedUtc,
 min(case when EventType = {sql_str(prm.psa_event)} then EventUtc end) as PSAConfirmedUtc,
 min(case when EventType = {sql_str(prm.sold_event)} then EventUtc end) as SoldEventUtc
from portfolio_event where EventType in {sql_list(lits)} group by PortfolioId"""
    b["st_portfolio_funding"] = f"""select PortfolioId, min(EventUtc) as FirstFundingUtc,
 max(EventUtc) as LastFundingUtc, count(*) as FundingEventCount
from portfolio_event where EventType in {sql_list(prm.funding_events)} group by PortfolioId"""
    b["st_row_aggregates"] = f"""select PortfolioId, count(*) as AccountCount,
 count(case when RemovedUTCDate is null then 1 end) as ActiveAccountCount,
 sum(PrincipalBalance) as RowTotalPrincipal, sum(InterestBalance) as RowTotalInterest,
 sum(OtherFeesBalance) as RowTotalFees,
 date '1970-01-01' + cast(floor(avg(date_diff('day', date '1970-01-01', WriteOffDate))) as integer) as {q(S.AVG_WRITE_OFF)}
from portfolio_row group by PortfolioId"""
    b["st_bid_aggregates"] = """select PortfolioId, count(Id) as BidCount,
 count(case when Status = 'Won' then Id end) as WonBidCount, max(BidPercent) as MaxBidPercent,
 min(PlacedUtc) as FirstBidUtc
from portfolio_bid group by PortfolioId"""
    cats = ",\n ".join(f"count(case when cat = {sql_str(k)} then 1 end) as {v}" for k, v in S.CATEGORY_COUNTS.items())
    b["st_postsale_aggregates"] = f"""select PortfolioId, count(*) as RequestCount,
 {cats}
from (select prw.PortfolioId, {category_sql('rq.Status', 'rq.RequestType', 'rq.InitiatedByBuyer')} as cat
      from request rq join portfolio_row prw on rq.DebtAccountId = prw.PortfolioRowGuid) x
group by PortfolioId"""
    b["st_complaints_by_buyer"] = """select p.BuyerId, count(*) as ComplaintCount
from complaint ct join portfolio_row prw on ct.PortfolioRowId = prw.PortfolioRowGuid
join portfolio p on prw.PortfolioId = p.Id group by p.BuyerId"""
    b["st_complaints_by_pid"] = """select prw.PortfolioId, count(*) as ComplaintCount
from complaint ct join portfolio_row prw on ct.PortfolioRowId = prw.PortfolioRowGuid group by prw.PortfolioId"""
    base = ", ".join(f"p.{c}" for c in S.BASE_PORTFOLIO_COLS)
    b["st_party_names"] = "select distinct Id, LegalName, ClientId, ClientName from g_business"
    b["st_silver_base"] = f"""select {base},
 s.LegalName as SellerLegalName, s.ClientName as SellerClientName,
 bu.LegalName as BuyerLegalName, bu.ClientId as BuyerClientId, bu.ClientName as BuyerClientName,
 e.ListedUtc, e.AwardedUtc, e.PSAConfirmedUtc, e.SoldEventUtc,
 f.FirstFundingUtc, f.LastFundingUtc, f.FundingEventCount,
 ra.AccountCount, ra.ActiveAccountCount, ra.RowTotalPrincipal, ra.RowTotalInterest, ra.RowTotalFees,
 ra.{q(S.AVG_WRITE_OFF)},
 ba.BidCount, ba.WonBidCount, ba.MaxBidPercent, ba.FirstBidUtc,
 pa.RequestCount, {", ".join("pa." + v for v in S.CATEGORY_COUNTS.values())},
 cp.ComplaintCount as PortfolioComplaintCount, cb.ComplaintCount as BuyerComplaintCount
from g_portfolio p
left join st_party_names s on p.SellerId = s.Id
left join st_party_names bu on p.BuyerId = bu.Id
left join st_portfolio_events e on p.Id = e.PortfolioId
left join st_portfolio_funding f on p.Id = f.PortfolioId
left join st_row_aggregates ra on p.Id = ra.PortfolioId
left join st_bid_aggregates ba on p.Id = ba.PortfolioId
left join st_postsale_aggregates pa on p.Id = pa.PortfolioId
left join st_complaints_by_pid cp on p.Id = cp.PortfolioId
left join st_complaints_by_buyer cb on p.BuyerId = cb.BuyerId"""
    b["st_formula"] = """select *, cast(year(ListedUtc) as integer) as ListedUtcYear,
 cast(month(ListedUtc) as integer) as ListedUtcMonth from st_silver_base"""

    # ---------------------------------------------------------------- D13
    b["s_goals"] = f"""select Value as {GOAL_COL}, cast(left(YearMonth, 4) as integer) as GoalYear,
 cast(right(YearMonth, 2) as integer) as GoalMonth
from goals where Metric = {sql_str(prm.goal_metric)}"""
    b["s_macro"] = """select distinct *, cast(year(FormattedDate) as integer) as MacroeconomicDateYear,
 cast(month(FormattedDate) as integer) as MacroeconomicDateMonth,
 cast(quarter(FormattedDate) as integer) as MacroeconomicDateQuarter from macro"""
    written_off = q(S.AVG_WRITE_OFF)

    def held(event: str) -> str:
        """1 unless the event lies between the mean write-off and the end of the sixth month after it."""
        inside = f"{event} between closing.{written_off} and last_day(closing.{written_off} + to_months(6))"
        return f"if(closing.PSAConfirmedUtc is null or {event} is null, null, if({inside}, 0, 1))"

    b["s_expanded"] = f"""with closing as (
 select all_rows.*, cast(year(PortfolioCloseUtc) as integer) as PortfolioCloseUtcYear, cast(quarter(PortfolioCloseUtc) as integer) as PortfolioCloseUtcQuarter,
  cast(month(PortfolioCloseUtc) as integer) as PortfolioCloseUtcMonth
 from st_formula all_rows
 where ifnull(SellerClientName, '') <> {sql_str(prm.excluded_seller_client)} and ifnull(SellerLegalName, '') <> {sql_str(prm.excluded_seller_legal_name)}
)
select closing.*, target.{GOAL_COL}, economy.*, cast({held('closing.PSAConfirmedUtc')} as integer) as WarehousedAvgWriteOfftoPSAConfirmed,
 cast({held('closing.PortfolioCloseUtc')} as integer) as WarehousedAvgWriteOfftoPortfolioClosed, cast({held('closing.SoldUtc')} as integer) as WarehousedAvgWriteOfftoSold
from closing
left join s_goals target on target.GoalMonth = closing.ListedUtcMonth and target.GoalYear = closing.ListedUtcYear
left join s_macro economy on economy.MacroeconomicDateYear = closing.PortfolioCloseUtcYear
 and economy.MacroeconomicDateQuarter = closing.PortfolioCloseUtcQuarter"""

    # ---------------------------------------------------------------- views
    # the viewers of a portfolio can only add rows without a bid, which the view drops: they are left out here
    b["v_bidders"] = f"""with offered as (select distinct lower(PortfolioNumber) as pid, lower(BuyerId) as bidder from g_portfolio_bid where Status is not null),
known as (select lower(Id) as bidder, ClientId, BusinessName from g_business),
closed as (select lower(PortfolioNumber) as pid, PortfolioCloseUtc from s_expanded where Status <> 'Purged' and year(PortfolioCloseUtc) > {prm.min_close_year})
select distinct firm.ClientId as BidderClientId, called.BusinessName as BuyerName, cast(month(closed.PortfolioCloseUtc) as integer) as BidderMonth,
 cast(year(closed.PortfolioCloseUtc) as integer) as BidderYear
from closed join offered on offered.pid = closed.pid left join known firm on firm.bidder = offered.bidder left join known called on called.bidder = offered.bidder"""
    b["v_board_bid"] = """select pb.*, bz.ClientId, cz.Name as ClientName
from joined_portfolio_bid pb left join business bz on pb.BuyerId = bz.Id left join client cz on bz.ClientId = cz.Id"""
    b["v_buyer_activity"] = """select BuyerClientId, max(PortfolioCloseUtc) as MaxDate, min(PortfolioCloseUtc) as MinDate
from s_expanded where BuyerClientId is not null group by BuyerClientId having max(PortfolioCloseUtc) is not null"""
    b["v_ff_portfolios"] = """select ForwardFlowAgreementId, max(UploadDateUtc) as MaxUploadDate, count(*) as PortfolioCount
from s_expanded where ForwardFlowAgreementId is not null group by ForwardFlowAgreementId having count(*) > 1"""
    b["v_forward_flow"] = """select ffa.Id, ffa.EndDate, ptj.ForwardFlowAgreementId, ptj.MaxUploadDate
from forward_flow_agreement ffa left join v_ff_portfolios ptj on ffa.Id = ptj.ForwardFlowAgreementId
where ptj.ForwardFlowAgreementId is not null"""
    return b
