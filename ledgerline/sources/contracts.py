"""Column contracts of the operational source tables.

Every product reads a fixed set of columns from each source table. A contract
lists them; ``conform`` raises for a column the physical table lacks, and for
one whose type cannot hold what the products read from it (``kind``).
Columns the physical table has beyond the contract pass through untouched
(several products star-expand their input).

The reference declares no DDL, so kinds and the types of columns the test
fixtures make up follow a naming rule with listed exceptions.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Mapping
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns each product reads, per source table (reference column names).
CONTRACTS: dict[str, list[str]] = {
    "portfolio": [
        "Id", "PortfolioTypeId", "PortfolioNumber", "Status", "UploadDateUtc",
        "SellerUploadTemplateId", "FileDefinitionId", "SellerId", "SellerName",
        "BuyerId", "BuyerName", "PortfolioCloseUtc", "FundingDateUtc",
        "InitialPsaDateUtc", "SoldUtc", "WinningBidId", "TitleStatus",
        "MaxResalesAllowed", "LicenseType", "IsWarehoused", "WarehousedHowLong",
        "OriginalFaceValue", "PreScrubFaceValue", "FinalFaceValue",
        "PurchasePricePercent", "PurchasePriceAmount", "BuyerFeePercent",
        "BuyerFeeAmount", "SellerFeePercent", "SellerFeeAmount",
        "ForwardFlowAgreementId", "Issuers", "AssetTypes", "TotalFaceValue",
        "TotalPrincipal", "TotalInterest", "TotalFees", "NumberOfAccounts",
        "AverageBalance", "IsDisclosureEnabled", "DisclosureLastUpdateUTC",
        "SalesAgentId", "SalesAgentDisplayName", "NextActionBusinessId",
        "NextActionType", "PortfolioCountry", "AverageChargeOffBalance",
        "ListDateUtc", "BidCloseUtc", "AgreementTemplatePsaId",
        "AgreementTemplateBOSId", "AveragePrincipalBalance", "AverageFeeBalance",
        "AverageInterestBalance", "CutOffDateUtc", "NoDaysProvideMediaFiles",
        "FixedMonthlyFee", "ScrubEnabled", "ConfirmFundingEnabled",
    ],
    "portfolio_type": ["Id", "TypeName"],
    "auction": ["Id", "PortfolioId", "AuctionType", "BidCloseUtc", "BuyerBidAccessOption"],
    "portfolio_data": ["PortfolioId", "ReservePrice"],
    "portfolio_download": ["BusinessId", "DownloadedUtc"],
    "portfolio_event": ["Id", "PortfolioId", "EventType", "EventUtc", "UserId"],
    "portfolio_bid": [
        "Id", "PortfolioId", "BuyerId", "Status", "PlacedByUserId", "PlacedUtc",
        "BidPercent", "BidType", "ForwardFlowBidMonths", "ForwardFlowMaxFaceValue",
        "BidContingency", "BidPortfolioCloseDate", "BidFundingDate",
    ],
    "user_action": ["Id", "UserId", "ActionDate"],
    "app_user": ["Id", "TenantId", "FirstName", "LastName"],
    "tenant": ["Id"],
    "client": ["Id", "Name", "Status", "TenantId"],
    "business": [
        "Id", "ClientId", "Status", "LegalName", "StateCode", "BillingStateCode",
        "Street1", "Street2", "City", "PostalCode", "CorpHQPhoneNumber",
        "CustomerServiceEmail", "PrimaryContact_LastName", "PrimaryContact_FirstName",
        "PrimaryContact_EMail", "PrimaryContact_OfficePhone",
    ],
    "business_name": ["BusinessId", "Name", "StartDateUtc", "EndDateUtc"],
    "business_agency": [
        "Id", "WebSiteUrl", "PaymentSiteUrl", "MembershipEstablished", "OnSiteAudit",
        "RecertificationFrequency",
    ],
    "business_buyer": [
        "Id", "DefaultBankAccountId", "FeePercent", "EnforceMinimumFee", "MinimumFee",
        "DTCanPlaceBid", "DTCanUploadDownloadPSA", "DTCanConfirmFundsSent",
        "DTCanCreatePostSaleRequest", "DTCanRespondToPostSaleRequest",
        "DTCanClosePostSaleRequest", "DTCanMaintainComplaints",
        "PermissionsLastUpdatedByUserId", "PermissionsLastUpdatedUTC",
        "Signer_FullName", "Signer_Title", "TU_ScoringEnabled", "TU_UploadDirectory",
        "TU_ProductType", "BCOBuyerType", "BCOAgenciesCertified",
        "BCOOfficerBackgroundChecks", "BCOAttestation", "BCOComplianceNotes",
        "BCOEnabled", "BCOFinancials", "MembershipEstablished", "OnSiteAudit",
        "RecertificationFrequency",
    ],
    "business_seller": [
        "Id", "DefaultBankAccountId", "FeePercent", "EnforceMinimumFee", "MinimumFee",
        "SoftwareUsed", "ForwardFlowFeePercent", "IsOriginator", "HoldScrub",
        "IncludeTLODismissals", "DTCanList", "DTCanRemoveAccountsFromPortfolio",
        "DTCanAcceptBid", "DTCanUploadDownloadPSA", "DTCanConfirmFundsReceived",
        "DTCanCreatePostSaleRequest", "DTCanRespondToPostSaleRequest",
        "DTCanClosePostSaleRequest", "DTCanMaintainComplaints", "EnableBcoReport",
        "MilitaryScrub", "MilitaryCertificates", "PermissionsLastUpdatedByUserId",
        "PermissionsLastUpdatedUTC", "Signer_FullName", "Signer_Title",
        "BuyerBidAccessOption", "BidReviewQuantity", "ShowWinningBid",
        "RequireBCOFinancials", "AllowAdditionalUnmaskedData", "SellerTerms",
        "SalesAgentId", "SalesAgentDisplayName", "ClientSuccessUserId",
        "ScrubReviewThreshold", "OriginationState", "Disclosure",
        "ProjectedMonthlyPlacementVolumes", "FF_PSA_SignatureRequired",
        "AllowPortfolioSplit", "BusinessDevelopmentRepresentative",
    ],
    "portfolio_row": [
        "PortfolioRowGuid", "PortfolioId", "Product", "PrincipalBalance",
        "InterestBalance", "OtherFeesBalance", "OriginationDate", "WriteOffDate",
        "RemovedUTCDate", "RemoveComment", "BKPoc", "StateCode", "City", "Lender",
        "LenderLoanId", "OriginalLoanAmount", "DefaultDate", "FirstDelinquencyDate",
        "LastPaymentDate", "LastPaymentAmount", "ChainOfTitleId",
        "ComplianceHoldStatus", "SFComplaintId", "ChargeOffBalance",
        "TotalPaymentsSinceChargeOff",
    ],
    "portfolio_row_commercial": [
        "PortfolioRowGuid", "BusinessDBA", "BusinessLegalName", "BusinessCity",
        "BusinessState",
    ],
    "result_file": ["Id", "Received"],
    "deceased_result": ["Id", "DebtAccountId", "DateOfDeath", "ResultFileId"],
    "bankruptcy_result": [
        "Id", "DebtAccountId", "FileDate", "Chapter", "CaseNumber", "ResultFileId",
        "CaseStatus", "BarDate", "CourtCity", "CourtState", "CourtZip",
        "PlanFiledDate", "ConfirmationHearingDate", "PlanConfirmationDate",
        "LastDateToObjectToDischarge",
    ],
    "scra_result": [
        "Id", "DebtAccountId", "ActiveDutyStatus", "ServiceAgency", "ResultFileId",
        "ActiveDutyStartDate", "ActiveDutyEndDate",
    ],
    "request": [
        "Id", "DebtAccountId", "RequestType", "InitiatedByBuyer", "Status", "Created",
        "FundingNotificationId", "BulkUploadDataRowId", "CreatedByAppUserId",
        "FundingAmount", "RejectComment", "Escalated", "CSRAction", "Closed",
        "ClosedByAppUserId", "LastUpdatedAppUserId", "LastUpdatedSqlId",
        "LastUpdated", "SysEndTime", "EffortExausted",
    ],
    "request_type": ["Id", "RequestTypeStr"],
    "request_event": ["RequestId", "EventType", "Created"],
    "funding_notification": [
        "Id", "Status", "Amount", "Mailed", "ReferenceOrCheckNumber",
        "ConfirmedReceived", "ConfirmedSent",
    ],
    "pifsif": ["RequestId", "Seq", "PaymentDate", "PaymentAmount", "PifSifType"],
    "account_closed": ["RequestId", "ClosedDate"],
    "info": ["RequestId", "InfoRequested"],
    "legal": ["RequestId", "Explanation"],
    "other": ["RequestId", "Explanation"],
    "fraud": ["RequestId", "Explanation"],
    "bankrupt": ["RequestId", "Chapter"],
    "template": ["Id", "Name"],
    "portfolio_bk_data": ["PortfolioId", "FinalPurchasePricePercent"],
    "portfolio_aggregate": ["PortfolioId", "Category", "TotalPrincipal", "TotalInterest", "TotalFees"],
    "complaint": [
        "Id", "PortfolioRowId", "Status", "AgencyName", "CreatedByBusinessId",
        "DateSubmitted", "Category", "SourceType", "ViolationType", "Outcome",
        "AccountStatus", "Summary", "AgencyId", "AgencyName_External",
        "ComplainantName", "ComplainantPhone", "ComplainantEmail",
        "AttorneyContacted", "FollowUpRequired", "DocumentsRequired",
        "EmployeesInvolved", "AgencyAction", "AgencyResponse",
        "AgencyPreventionSteps", "ComplaintResolution", "DebtTraderActions",
    ],
    "complaint_aggregate": ["AggregateType", "BuyerGuid", "SellerGuid", "AgencyGuid", "Month", "Year", "Value"],
    "forward_flow_agreement": ["Id", "EndDate"],
    "joined_portfolio_bid": ["Id", "PortfolioId", "BuyerId", "BidPercent"],
    "goals": ["YearMonth", "Metric", "Value"],
    "macro": ["FormattedDate", "MacroIndex"],
}

_TS = re.compile(r"^(DateOf|LastDateTo)|(Utc|UTC|Date|Time|Received|Created|LastUpdated|Closed|Mailed|Established)$")
_PCT = re.compile(r"Percent$")
_MONEY = re.compile(r"(Amount|Balance|FaceValue|Fee|Principal|Interest|Fees|Price|Threshold)$")
_FLAG = re.compile(r"^(Is|DT|Has|Allow|Enable|Require|Show|Hold|Include|Military)|Enabled$|Required$|Allowed$|Quantity$|HowLong$|Files$|Escalated$|EffortExausted$")


def pad_type(column: str) -> str:
    """Spark SQL type for a contract column that the physical table lacks."""
    if _PCT.search(column):
        return "decimal(9,6)"
    if _MONEY.search(column):
        return "decimal(18,2)"
    if _TS.search(column):
        return "timestamp"
    if _FLAG.search(column):
        return "int"
    return "string"


# What a column may hold, where its name does not tell.
KINDS = {
    "Issuers": "text", "NumberOfAccounts": "number", "BKPoc": "number", "InitiatedByBuyer": "number", "Seq": "number", "Month": "number",
    "Year": "number", "Value": "number", "MacroIndex": "number", "RequestType": "key", "DateSubmitted": "instant", "BusinessId": "key",
    "PortfolioRowGuid": "key", "YearMonth": "key", "TU_ProductType": "text", "BCOBuyerType": "text",
}
_KEY = re.compile(r"(Id|ID|Guid|SqlId|ReferenceOrCheckNumber|PortfolioNumber)$")
# Column that identifies a row; it must not be NULL.
IDENTITY = {t: c[0] for t, c in CONTRACTS.items() if c[0] in ("Id", "PortfolioRowGuid") and t not in ("portfolio_row_commercial", "joined_portfolio_bid")}


def kind(column: str) -> str:
    """What a contract column holds: text, a number, an instant (date or
    timestamp) or a key (text or whole number)."""
    if column in KINDS:
        return KINDS[column]
    if _KEY.search(column):
        return "key"
    padded = pad_type(column)
    return "text" if padded == "string" else "instant" if padded == "timestamp" else "number"


def fits(kind_: str, dtype: T.DataType) -> bool:
    whole = isinstance(dtype, T.IntegralType) or isinstance(dtype, T.DecimalType) and dtype.scale == 0
    return {"text": isinstance(dtype, T.StringType), "key": isinstance(dtype, T.StringType) or whole,
            "number": isinstance(dtype, (T.NumericType, T.BooleanType)),
            "instant": isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))}[kind_]


def wrong_types(table: str, df: DataFrame) -> list[str]:
    """Contract columns whose type cannot hold what they are read as."""
    types = {f.name: f.dataType for f in df.schema.fields}
    asked = {"text": "text", "key": "text or a whole number", "number": "a number", "instant": "a date or timestamp"}
    return [f"{c} is {types[c].simpleString()}, not {asked[kind(c)]}" for c in CONTRACTS.get(table, [])
            if c in types and not isinstance(types[c], T.NullType) and not fits(kind(c), types[c])]


def null_identities(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Rows without an identity, per table that has such rows: one count over
    the identity column of every table, in a single job."""
    counts = [tables[t].agg(F.lit(t).alias("table"), F.count(F.when(F.col(c).isNull(), F.lit(1))).alias("n")) for t, c in IDENTITY.items()]
    return {r["table"]: r["n"] for r in reduce(DataFrame.unionByName, counts).filter(F.col("n") > 0).collect()}


def pad_value(column: str, key: str) -> str:
    """SQL (Spark's and DuckDB's) of the value the test fixtures give a
    contract column they do not carry: another one per column, so that a
    swapped pair of columns shows, and NULL in some rows."""
    place, dtype = zlib.crc32(column.encode()) % 9973, pad_type(column)
    if dtype == "string":
        value = f"concat('{column} ', cast({key} as string))"
    elif dtype == "timestamp":
        value = f"timestamp '{datetime(2000, 1, 1) + timedelta(hours=place):%Y-%m-%d %H:%M:%S}'"
    else:
        value = f"cast({place / 10000 if dtype == 'decimal(9,6)' else place} as {dtype})"
    return f"case when cast({key} as string) like '%3' then cast(null as {dtype}) else {value} end"


def missing_columns(table: str, present: list[str]) -> list[tuple[str, str]]:
    have = set(present)
    return [(c, pad_type(c)) for c in CONTRACTS.get(table, []) if c not in have]


def pad_key(table: str, present: list[str]) -> str:
    """The column the fixtures' values of absent columns are made from."""
    return next(c for c in CONTRACTS[table] if c in set(present))


def conform(table: str, df: DataFrame, pad: bool = False) -> DataFrame:
    """Check a source against its contract. An absent column and a column of a
    type that cannot hold what it is read as are errors that name it; only the
    test fixtures, which carry a part of each contract, have made-up values
    put in instead (``pad``)."""
    wrong = wrong_types(table, df)
    if wrong:
        raise ValueError(f"source table {table!r} has columns of a wrong type: {'; '.join(wrong)}")
    pads = missing_columns(table, df.columns)
    if not pads:
        return df
    if not pad:
        raise ValueError(f"source table {table!r} lacks the columns {[c for c, _ in pads]}")
    key = pad_key(table, df.columns)
    return df.select("*", *[F.expr(pad_value(c, f"`{key}`")).alias(c) for c, _ in pads])
