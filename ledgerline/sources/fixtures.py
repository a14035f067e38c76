"""Fixture projections: derive the operational source tables from the driver's
synthetic carrier tables (TPC-H-like) for tests, correctness checks and benches.

Each projection is valid in both Spark SQL and DuckDB. Table references are
written as ``{name}`` placeholders: Spark binds them to DataFrames through
``spark.sql(text, **frames)``; the DuckDB oracle renders them as CTE names.
"""

FIXTURE_SQL: dict[str, str] = {}

FIXTURE_SQL["client"] = """
select 'C'||cast(n_nationkey as string) as Id, n_name as Name,
  case when n_nationkey%5=0 then 'Inactive' else 'Active' end as Status, 'T'||cast(n_nationkey as string) as TenantId
from {nation}
"""

FIXTURE_SQL["tenant"] = """
select 'T'||cast(n_nationkey as string) as Id
from {nation}
"""

FIXTURE_SQL["app_user"] = """
select 'U'||cast(c_custkey as string) as Id,
  case when c_custkey%2=0 then 'T' else 't' end||cast(c_nationkey as string) as TenantId,
  case when c_custkey%11=0 then null else 'First'||cast(c_custkey as string) end as FirstName,
  case when c_custkey%13=0 then null else 'Last'||cast(c_custkey as string) end as LastName
from {customer}
"""

FIXTURE_SQL["user_action"] = """
select event_id as Id, 'U'||cast(user_id as string) as UserId,
  case when event_id%50=0 then timestamp '1999-12-31 00:00:00' else cast(ts as timestamp) end as ActionDate
from {events}
"""

FIXTURE_SQL["business"] = """
select 'S'||cast(s_suppkey as string) as Id,'C'||cast(s_nationkey as string) as ClientId,
  case when s_acctbal<0 then 'Terminated - Out Of Business' else 'Active' end as Status, s_name as LegalName, 'ST'||cast(s_nationkey as string) as StateCode
from {supplier}
union all select 'B'||cast(c_custkey as string),'C'||cast(c_nationkey as string),
  case when c_acctbal<0 then 'Terminated - Out Of Business' else 'Active' end, c_name, 'ST'||cast(c_nationkey as string)
from {customer}
"""

FIXTURE_SQL["business_name"] = """
select Id as BusinessId, ' '||LegalName||' ' as Name, timestamp '1995-01-01 00:00:00' as StartDateUtc,
  cast(null as timestamp) as EndDateUtc
from {business}
union all select Id, LegalName||' (old)', timestamp '1990-01-01 00:00:00', timestamp '1995-01-01 00:00:00'
from {business}
where Id like '%3'
union all select Id, LegalName||' dba', timestamp '1996-01-01 00:00:00',
  cast(null as timestamp)
from {business}
where Id like '%77'
"""

FIXTURE_SQL["business_agency"] = """
select Id, 'https://'||Id||'.example.com' as WebSiteUrl
from {business}
where Id like '%5'
"""

FIXTURE_SQL["business_buyer"] = """
select Id, 'BB'||Id as DefaultBankAccountId,
  case when Id like '%2' then null else cast(0.02 as decimal(9,6)) end as FeePercent, 1 as EnforceMinimumFee,
  cast(25 as decimal(18,2)) as MinimumFee
from {business}
where Id like 'B%' and Id not like '%9'
"""

FIXTURE_SQL["business_seller"] = """
select Id, 'SB'||Id as DefaultBankAccountId,
  cast(0.03 as decimal(9,6)) as FeePercent, 0 as EnforceMinimumFee,
  cast(10 as decimal(18,2)) as MinimumFee
from {business}
where Id like 'S%' or Id like 'B%2'
"""

FIXTURE_SQL["portfolio_type"] = """
select distinct cast(o_orderkey%4 as int) as Id, 'Type '||cast(o_orderkey%4 as string) as TypeName
from {orders}
"""

FIXTURE_SQL["portfolio"] = """
select 'P'||cast(o_orderkey as string) as Id,
  cast(o_orderkey%4 as int) as PortfolioTypeId,
  cast(10000+o_orderkey as string) as PortfolioNumber,
  case o_orderpriority when '1-URGENT' then 'Closed' when '2-HIGH' then 'funded' when '3-MEDIUM' then 'Awaiting Seller Fee' when '4-NOT SPECIFIED' then 'pending buyer funding' else case when o_orderkey%2=0 then 'Purged' else 'Listed' end end as Status,
  case when o_orderkey%97=0 then null else 'S'||cast(o_orderkey%suppliers as string) end as SellerId,
  case when o_orderkey%9=0 then null else 'B'||cast(o_custkey as string) end as BuyerId,
  cast(o_orderdate as timestamp) as UploadDateUtc,
  cast(o_orderdate + interval '20' day as timestamp) as PortfolioCloseUtc,
  case when o_orderkey%7=0 then null else cast(o_orderdate + interval '15' day as timestamp) end as SoldUtc,
  cast(cast(o_orderkey%20 as decimal(9,6))*cast(0.005 as decimal(9,6)) as decimal(9,6)) as PurchasePricePercent,
  case when o_orderkey%5=0 then null else cast(0.02 as decimal(9,6)) end as BuyerFeePercent,
  case when o_orderkey%6=0 then null else cast(0.03 as decimal(9,6)) end as SellerFeePercent,
  cast(o_totalprice as decimal(18,2)) as PurchasePriceAmount,
  case when o_orderkey%3=0 then 'F'||cast(o_orderkey%50 as string) end as ForwardFlowAgreementId,
  cast(o_orderkey%100 as int) as NumberOfAccounts,
  cast(o_orderkey%3 as int) as SellerUploadTemplateId,
  case o_orderkey%7 when 0 then ' Sovereign ' when 1 then 'Lease to Own' when 2 then 'CSO' when 3 then 'Off Shore' when 4 then 'Other' when 5 then null else 'unknown' end as LicenseType, 'Mixed' as AssetTypes, 'Issuer '||cast(o_orderkey%5 as string) as Issuers
from {orders} cross join (select count(*) as suppliers from {supplier}) n
"""

FIXTURE_SQL["auction"] = """
select 'A'||cast(o_orderkey as string) as Id, 'P'||cast(o_orderkey as string) as PortfolioId, 'Sealed' as AuctionType,
  cast(o_orderdate + interval '10' day as timestamp) as BidCloseUtc
from {orders}
where o_orderkey%4<>0
union all select 'A2-'||cast(o_orderkey as string), 'P'||cast(o_orderkey as string), 'Open',
  cast(o_orderdate + interval '12' day as timestamp)
from {orders}
where o_orderkey%21=0
"""

FIXTURE_SQL["portfolio_data"] = """
select 'P'||cast(o_orderkey as string) as PortfolioId,
  cast(o_totalprice as decimal(18,2)) as ReservePrice
from {orders}
where o_orderkey%3<>0
"""

FIXTURE_SQL["portfolio_download"] = """
select case when event_id%3=0 then 'S'||cast(user_id%suppliers as string) else 'B'||cast(user_id as string) end as BusinessId,
  cast(ts as timestamp) as DownloadedUtc
from {events} cross join (select count(*) as suppliers from {supplier}) n
"""

FIXTURE_SQL["portfolio_event"] = """
select event_id as Id, 'P'||cast(event_id%fifth*5+event_id%fifth%5 as string) as PortfolioId,
  case event_type when 'click' then 'listed' when 'view' then 'read' when 'signup' then 'Awarded' when 'purchase' then 'awarded' else 'download data-masked' end as EventType,
  cast(ts as timestamp) as EventUtc, 'U'||cast(user_id as string) as UserId
from {events} cross join (select cast(floor(count(*)/5.0) as bigint) as fifth from {orders}) n
"""

FIXTURE_SQL["portfolio_bid"] = """
select cast(l_orderkey as string)||'-'||cast(l_linenumber as string)||'-'||cast(l_partkey as string)||'-'||cast(l_suppkey as string)||'-'||cast(cast(l_extendedprice as decimal(18,2)) as string) as Id, 'P'||cast(l_orderkey as string) as PortfolioId, 'B'||cast((l_orderkey+l_partkey)%customers as string) as BuyerId,
  case l_linenumber%4 when 0 then 'Won' when 1 then 'Placed' when 2 then 'won' else null end as Status, 'U'||cast(l_partkey%(customers+10) as string) as PlacedByUserId,
  cast(l_shipdate - interval '100' minute as timestamp) as PlacedUtc,
  cast(l_discount as decimal(9,6)) as BidPercent
from {lineitem} cross join (select count(*) as customers from {customer}) n
"""

FIXTURE_SQL["portfolio_row"] = """
select cast(l_orderkey as string)||'-'||cast(l_linenumber as string)||'-'||cast(l_partkey as string)||'-'||cast(l_suppkey as string)||'-'||cast(cast(l_extendedprice as decimal(18,2)) as string) as PortfolioRowGuid, 'P'||cast(l_orderkey as string) as PortfolioId,
  case l_partkey%16 when 0 then 'Auto Deficiency' when 1 then 'Installment Loan' when 2 then 'LINE OF CREDIT' when 3 then 'Business Installment Loan' when 4 then 'Small Business' when 5 then 'Online Payday Loan' when 6 then 'PDL' when 7 then 'Title Loan' when 8 then 'Bank Line A' when 9 then 'Consumer Unsecured' when 10 then 'MLA Loan' when 11 then 'consumer' when 12 then 'auto title' when 13 then 'Medical' when 14 then null else 'INSTALLMENT' end as Product,
  cast(l_extendedprice as decimal(18,2)) as PrincipalBalance,
  case when l_partkey%23=0 then null else cast(cast(l_extendedprice as decimal(12,2))*cast(l_tax as decimal(4,2)) as decimal(18,2)) end as InterestBalance,
  cast(l_quantity as decimal(18,2)) as OtherFeesBalance,
  cast(l_shipdate as date) as OriginationDate,
  case when l_partkey%8=0 then null else cast(l_shipdate + interval '30' day as date) end as WriteOffDate,
  case when l_returnflag='A' then cast(l_shipdate + interval '90' day as timestamp) end as RemovedUTCDate,
  case when l_returnflag='A' then case l_linenumber%4 when 0 then 'lci-bankrupt' when 1 then 'lci-deceased' when 2 then 'lci-scra' else 'manual' end end as RemoveComment,
  case when l_linenumber%5=0 then 1 else 0 end as BKPoc, ' st'||cast(l_suppkey%50 as string)||' ' as StateCode, ' City '||cast(l_suppkey%9 as string) as City, 'Lender '||cast(l_suppkey%4 as string) as Lender,
  cast(l_orderkey as string) as LenderLoanId,
  cast(l_partkey%30 as int) as bucket30
from {lineitem}
"""

FIXTURE_SQL["portfolio_row_commercial"] = """
select PortfolioRowGuid,
  case when bucket30=1 then null else ' Acme '||Lender end as BusinessDBA, ' Legal '||Lender as BusinessLegalName,
  case when bucket30=2 then null else City end as BusinessCity, StateCode as BusinessState
from {portfolio_row}
where bucket30<6
"""

FIXTURE_SQL["result_file"] = """
select distinct cast(o_orderkey%5 as int) as Id, timestamp '2001-01-01 00:00:00' as Received
from {orders}
"""

FIXTURE_SQL["deceased_result"] = """
select PortfolioRowGuid||'/1' as Id, PortfolioRowGuid as DebtAccountId,
  cast(OriginationDate + interval '400' day as date) as DateOfDeath, bucket30%7 as ResultFileId
from {portfolio_row}
where bucket30%5=1
union all select PortfolioRowGuid||'/2', PortfolioRowGuid,
  cast(OriginationDate + interval '500' day as date), 1
from {portfolio_row}
where bucket30%10=1
"""

FIXTURE_SQL["bankruptcy_result"] = """
select PortfolioRowGuid||'/1' as Id, PortfolioRowGuid as DebtAccountId,
  cast(OriginationDate + interval '40' day as date) as FileDate,
  case bucket30%3 when 0 then '7' when 1 then '13' end as Chapter, 'CN'||LenderLoanId as CaseNumber, 1 as ResultFileId
from {portfolio_row}
where bucket30%4=0
union all select PortfolioRowGuid||'/2', PortfolioRowGuid,
  cast(OriginationDate - interval '5' day as date), '11', null, 9
from {portfolio_row}
where bucket30%8=0
"""

FIXTURE_SQL["scra_result"] = """
select PortfolioRowGuid||'/1' as Id, PortfolioRowGuid as DebtAccountId,
  case when bucket30=3 then null when bucket30%2=0 then 'Y' else 'N' end as ActiveDutyStatus, 'Army' as ServiceAgency, 2 as ResultFileId
from {portfolio_row}
where bucket30%3=0
"""

FIXTURE_SQL["request_type"] = """
select distinct cast(o_orderkey%13 as int) as Id, 'type '||cast(o_orderkey%13 as string) as RequestTypeStr
from {orders}
"""

FIXTURE_SQL["request"] = """
select event_id as Id, r.g as DebtAccountId,
  cast(event_id%13 as int) as RequestType,
  case when event_id%17=0 then null when event_id%2=0 then 1 else 0 end as InitiatedByBuyer,
  case event_id%8 when 0 then 'Closed' when 1 then 'closed' when 2 then 'Withdrawn' when 3 then 'unresolved' when 4 then 'Pending Seller Funding' when 5 then 'rejected' else 'Open' end as Status,
  cast(ts as timestamp) as Created,
  case when event_id%6=0 then event_id end as FundingNotificationId
from {events} e cross join (select cast(floor(sum(held)/4.0) as bigint) as quarter from (select l_orderkey-l_orderkey%10000 as span, count(distinct l_orderkey) as held
from {lineitem}
where l_orderkey is not null
group by 1) h) n
left join (select k.g, b.before+row_number() over (partition by k.span order by k.l_orderkey)-1 as place
from (select l_orderkey, l_orderkey-l_orderkey%10000 as span, min(cast(l_orderkey as string)||'-'||cast(l_linenumber as string)||'-'||cast(l_partkey as string)||'-'||cast(l_suppkey as string)||'-'||cast(cast(l_extendedprice as decimal(18,2)) as string)) as g
from {lineitem}
where l_orderkey is not null
group by l_orderkey) k
join (select span, sum(held) over (order by span)-held as before
from (select l_orderkey-l_orderkey%10000 as span, count(distinct l_orderkey) as held
from {lineitem}
where l_orderkey is not null
group by 1) c) b on b.span=k.span) r on r.place=e.event_id%quarter*4+e.event_id%quarter%4
"""

FIXTURE_SQL["request_event"] = """
select Id as RequestId,
  case when Id%3=0 then 'closed' else 'opened' end as EventType,
  cast(Created + interval '50' hour as timestamp) as Created
from {request}
union all select Id, 'closed',
  cast(Created + interval '90' hour as timestamp)
from {request}
where Id%9=0
"""

FIXTURE_SQL["funding_notification"] = """
select FundingNotificationId as Id, 'Sent' as Status,
  cast(100 as decimal(18,2)) as Amount
from {request}
where FundingNotificationId is not null
"""

FIXTURE_SQL["pifsif"] = """
select Id as RequestId, 1 as Seq,
  cast(Created as date) as PaymentDate,
  cast(Id%500 as decimal(18,2)) as PaymentAmount, 'PIF' as PifSifType
from {request}
where Id%4=1
union all select Id, 2,
  cast(Created as date),
  cast(1 as decimal(18,2)), 'SIF'
from {request}
where Id%16=1
"""

FIXTURE_SQL["account_closed"] = """
select Id as RequestId,
  cast(Created as date) as ClosedDate
from {request}
where Id%2=1
"""

FIXTURE_SQL["info"] = """
select Id as RequestId, 'docs' as InfoRequested
from {request}
where RequestType=3
"""

FIXTURE_SQL["legal"] = """
select Id as RequestId,
  case when Id%2=0 then null else 'legal' end as Explanation
from {request}
where RequestType=4
"""

FIXTURE_SQL["other"] = """
select Id as RequestId, 'other' as Explanation
from {request}
where RequestType in (4,5)
"""

FIXTURE_SQL["fraud"] = """
select Id as RequestId, 'fraud' as Explanation
from {request}
where RequestType in (5,6)
"""

FIXTURE_SQL["bankrupt"] = """
select Id as RequestId, '13' as Chapter
from {request}
where RequestType=1
"""

FIXTURE_SQL["template"] = """
select distinct cast(o_orderkey%3 as int) as Id, 'Template '||cast(o_orderkey%3 as string) as Name
from {orders}
"""

FIXTURE_SQL["portfolio_bk_data"] = """
select Id as PortfolioId,
  case when NumberOfAccounts%2=0 then null else cast(0.01 as decimal(9,6)) end as FinalPurchasePricePercent
from {portfolio}
where NumberOfAccounts%3=0
"""

FIXTURE_SQL["portfolio_aggregate"] = """
select PortfolioId, coalesce(Product,'none') as Category,
  cast(sum(PrincipalBalance) as decimal(18,2)) as TotalPrincipal,
  cast(sum(InterestBalance) as decimal(18,2)) as TotalInterest,
  cast(sum(OtherFeesBalance) as decimal(18,2)) as TotalFees
from {portfolio_row}
group by PortfolioId, coalesce(Product,'none')
"""

FIXTURE_SQL["complaint"] = """
select 'K'||PortfolioRowGuid as Id, PortfolioRowGuid as PortfolioRowId, 'Open' as Status,
  case when bucket30=4 then null else 'CFPB' end as AgencyName,
  case bucket30 when 4 then null when 9 then 'B999999999' else 'S'||cast(bucket30%10 as string) end as CreatedByBusinessId,
  cast(OriginationDate as timestamp) + interval '20' hour as DateSubmitted
from {portfolio_row}
where bucket30%5=4
"""

FIXTURE_SQL["complaint_aggregate"] = """
select 'Buyer' as AggregateType, 'B'||cast(o_custkey as string) as BuyerGuid,
  case when o_orderkey%2=0 then 'S'||cast(o_orderkey%sellers as string) end as SellerGuid,
  cast(null as string) as AgencyGuid,
  cast(month(o_orderdate) as int) as Month,
  cast(year(o_orderdate) as int) as Year,
  cast(count(*) as int) as Value
from {orders} cross join (select count(*) as sellers from {supplier}) n
group by 1,2,3,4,5,6
union all select 'Total', null, null, null, null,
  cast(year(o_orderdate) as int),
  cast(count(*) as int)
from {orders}
group by 6
"""

FIXTURE_SQL["forward_flow_agreement"] = """
select distinct 'F'||cast(o_orderkey%60 as string) as Id, date '2002-01-01' as EndDate
from {orders}
"""

FIXTURE_SQL["joined_portfolio_bid"] = """
select Id, PortfolioId,
  case when Status='Won' then null else BuyerId end as BuyerId, BidPercent
from {portfolio_bid}
"""

FIXTURE_SQL["goals"] = """
select distinct cast(year(o_orderdate)*100+month(o_orderdate) as string) as YearMonth, 'NumberOfBidsPerAuction' as Metric,
  cast(month(o_orderdate) as int) as Value
from {orders}
where o_orderkey%2=0
union all select '199501','OtherMetric',7
from {region}
where r_regionkey=0
"""

FIXTURE_SQL["macro"] = """
select cast(date_trunc('month',o_orderdate) as date) as FormattedDate,
  cast(year(o_orderdate)*100+month(o_orderdate) as int) as MacroIndex
from {orders}
where o_orderkey%3=0
"""

# The requests in steps, for Spark: the same rows as FIXTURE_SQL["request"],
# whose inner queries group all line items by order three times over.
_HELD = """select l_orderkey-l_orderkey%10000 as span, count(distinct l_orderkey) as held
from {lineitem}
where l_orderkey is not null
group by 1"""
_FIRST_ACCOUNTS = FIXTURE_SQL["request"].split("from (", 2)[2].split(") k\n", 1)[0]
REQUEST_STEPS: dict[str, str] = {
    "request_order": _FIRST_ACCOUNTS,
    "request_span": "select span, count(*) as held from {request_order} group by span",
    "request": FIXTURE_SQL["request"].replace(f"({_HELD})", "{request_span}").replace(f"({_FIRST_ACCOUNTS})", "{request_order}"),
}

# Output columns of each projection (name, Spark SQL type).
FIXTURE_COLUMNS: dict[str, list[tuple[str, str]]] = {
    'client': [('Id', 'string'), ('Name', 'string'), ('Status', 'string'), ('TenantId', 'string')],
    'tenant': [('Id', 'string')],
    'app_user': [('Id', 'string'), ('TenantId', 'string'), ('FirstName', 'string'), ('LastName', 'string')],
    'user_action': [('Id', 'bigint'), ('UserId', 'string'), ('ActionDate', 'timestamp')],
    'business': [('Id', 'string'), ('ClientId', 'string'), ('Status', 'string'), ('LegalName', 'string'), ('StateCode', 'string')],
    'business_name': [('BusinessId', 'string'), ('Name', 'string'), ('StartDateUtc', 'timestamp'), ('EndDateUtc', 'timestamp')],
    'business_agency': [('Id', 'string'), ('WebSiteUrl', 'string')],
    'business_buyer': [('Id', 'string'), ('DefaultBankAccountId', 'string'), ('FeePercent', 'decimal(9,6)'), ('EnforceMinimumFee', 'int'), ('MinimumFee', 'decimal(18,2)')],
    'business_seller': [('Id', 'string'), ('DefaultBankAccountId', 'string'), ('FeePercent', 'decimal(9,6)'), ('EnforceMinimumFee', 'int'), ('MinimumFee', 'decimal(18,2)')],
    'portfolio_type': [('Id', 'int'), ('TypeName', 'string')],
    'portfolio': [('Id', 'string'), ('PortfolioTypeId', 'int'), ('PortfolioNumber', 'string'), ('Status', 'string'), ('SellerId', 'string'), ('BuyerId', 'string'), ('UploadDateUtc', 'timestamp'), ('PortfolioCloseUtc', 'timestamp'), ('SoldUtc', 'timestamp'), ('PurchasePricePercent', 'decimal(9,6)'), ('BuyerFeePercent', 'decimal(9,6)'), ('SellerFeePercent', 'decimal(9,6)'), ('PurchasePriceAmount', 'decimal(18,2)'), ('ForwardFlowAgreementId', 'string'), ('NumberOfAccounts', 'int'), ('SellerUploadTemplateId', 'int'), ('LicenseType', 'string'), ('AssetTypes', 'string'), ('Issuers', 'string')],
    'auction': [('Id', 'string'), ('PortfolioId', 'string'), ('AuctionType', 'string'), ('BidCloseUtc', 'timestamp')],
    'portfolio_data': [('PortfolioId', 'string'), ('ReservePrice', 'decimal(18,2)')],
    'portfolio_download': [('BusinessId', 'string'), ('DownloadedUtc', 'timestamp')],
    'portfolio_event': [('Id', 'bigint'), ('PortfolioId', 'string'), ('EventType', 'string'), ('EventUtc', 'timestamp'), ('UserId', 'string')],
    'portfolio_bid': [('Id', 'string'), ('PortfolioId', 'string'), ('BuyerId', 'string'), ('Status', 'string'), ('PlacedByUserId', 'string'), ('PlacedUtc', 'timestamp'), ('BidPercent', 'decimal(9,6)')],
    'portfolio_row': [('PortfolioRowGuid', 'string'), ('PortfolioId', 'string'), ('Product', 'string'), ('PrincipalBalance', 'decimal(18,2)'), ('InterestBalance', 'decimal(18,2)'), ('OtherFeesBalance', 'decimal(18,2)'), ('OriginationDate', 'date'), ('WriteOffDate', 'date'), ('RemovedUTCDate', 'timestamp'), ('RemoveComment', 'string'), ('BKPoc', 'int'), ('StateCode', 'string'), ('City', 'string'), ('Lender', 'string'), ('LenderLoanId', 'string'), ('bucket30', 'int')],
    'portfolio_row_commercial': [('PortfolioRowGuid', 'string'), ('BusinessDBA', 'string'), ('BusinessLegalName', 'string'), ('BusinessCity', 'string'), ('BusinessState', 'string')],
    'result_file': [('Id', 'int'), ('Received', 'timestamp')],
    'deceased_result': [('Id', 'string'), ('DebtAccountId', 'string'), ('DateOfDeath', 'date'), ('ResultFileId', 'int')],
    'bankruptcy_result': [('Id', 'string'), ('DebtAccountId', 'string'), ('FileDate', 'date'), ('Chapter', 'string'), ('CaseNumber', 'string'), ('ResultFileId', 'int')],
    'scra_result': [('Id', 'string'), ('DebtAccountId', 'string'), ('ActiveDutyStatus', 'string'), ('ServiceAgency', 'string'), ('ResultFileId', 'int')],
    'request_type': [('Id', 'int'), ('RequestTypeStr', 'string')],
    'request': [('Id', 'bigint'), ('DebtAccountId', 'string'), ('RequestType', 'int'), ('InitiatedByBuyer', 'int'), ('Status', 'string'), ('Created', 'timestamp'), ('FundingNotificationId', 'bigint')],
    'request_event': [('RequestId', 'bigint'), ('EventType', 'string'), ('Created', 'timestamp')],
    'funding_notification': [('Id', 'bigint'), ('Status', 'string'), ('Amount', 'decimal(18,2)')],
    'pifsif': [('RequestId', 'bigint'), ('Seq', 'int'), ('PaymentDate', 'date'), ('PaymentAmount', 'decimal(18,2)'), ('PifSifType', 'string')],
    'account_closed': [('RequestId', 'bigint'), ('ClosedDate', 'date')],
    'info': [('RequestId', 'bigint'), ('InfoRequested', 'string')],
    'legal': [('RequestId', 'bigint'), ('Explanation', 'string')],
    'other': [('RequestId', 'bigint'), ('Explanation', 'string')],
    'fraud': [('RequestId', 'bigint'), ('Explanation', 'string')],
    'bankrupt': [('RequestId', 'bigint'), ('Chapter', 'string')],
    'template': [('Id', 'int'), ('Name', 'string')],
    'portfolio_bk_data': [('PortfolioId', 'string'), ('FinalPurchasePricePercent', 'decimal(9,6)')],
    'portfolio_aggregate': [('PortfolioId', 'string'), ('Category', 'string'), ('TotalPrincipal', 'decimal(18,2)'), ('TotalInterest', 'decimal(18,2)'), ('TotalFees', 'decimal(18,2)')],
    'complaint': [('Id', 'string'), ('PortfolioRowId', 'string'), ('Status', 'string'), ('AgencyName', 'string'), ('CreatedByBusinessId', 'string'), ('DateSubmitted', 'timestamp')],
    'complaint_aggregate': [('AggregateType', 'string'), ('BuyerGuid', 'string'), ('SellerGuid', 'string'), ('AgencyGuid', 'string'), ('Month', 'int'), ('Year', 'int'), ('Value', 'int')],
    'forward_flow_agreement': [('Id', 'string'), ('EndDate', 'date')],
    'joined_portfolio_bid': [('Id', 'string'), ('PortfolioId', 'string'), ('BuyerId', 'string'), ('BidPercent', 'decimal(9,6)')],
    'goals': [('YearMonth', 'string'), ('Metric', 'string'), ('Value', 'int')],
    'macro': [('FormattedDate', 'date'), ('MacroIndex', 'int')],
}
