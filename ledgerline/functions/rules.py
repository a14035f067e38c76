"""

The value lists below are FIXED VALUES: they must equal the reference's lists
for identical results (spellings such as 'Soveriegn', 'State be State' and
'innacurate-data' included). They are stated once, in the reference's order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import col, days_crossed, flag, hours_crossed, month_end_after, ts_lit

# ----------------------------------------------------------------------------
# FIXED VALUES – asset class, case-folded (C01): product lists in lower case.
ASSET_AUTO_LC = ["auto deficiency", "auto finance", "auto skip", "skip auto", "auto deficiency ,skip",
                 "auto title", "auto secured", "deficiency"]
ASSET_INSTALLMENT_LC = ["ilp", "refinanced loan", "cso stil", "cso stil - checkless", "consumer"]
ASSET_LOC_LC = ["line of credit", "lineofcredit"]
ASSET_BUSINESS_LC = ["business installment loan", "small business", "merchant cash advance"]
ASSET_PAYDAY_LC = ["payday", "payday loan", "online payday loan", "consumer loan - check", "single pay", "pdl",
                   "cso_payday", "online short-term loan", "short term loan", "store front unsecure loan",
                   "retail short-term loan", "store front secure loan", "standard loan", "short-term loan",
                   "pra - check", "advance", "single payment loan"]
ASSET_TITLE_LC = ["title", "title loan", "title - express", "retail title loan", "titleloc"]
ASSET_OTHER_LC = ["mla loan", "mtil loan"]

# FIXED VALUES – asset class, exact case (C02): product lists as spelled.
ASSET_AUTO_CS = ["Auto Deficiency", "Auto Finance", "Auto Skip", "Skip auto", "Auto Deficiency ,Skip",
                 "Auto Title", "Auto Secured", "Deficiency"]
ASSET_INSTALLMENT_CS = ["ILP", "Refinanced Loan", "CSO STIL", "CSO STIL - Checkless", "Consumer"]
ASSET_LOC_CS = ["Line of Credit", "LineOfCredit", "LINE OF CREDIT"]
ASSET_BUSINESS_CS = ["Business Installment Loan", "Small Business", "Merchant Cash Advance"]
ASSET_PAYDAY_CS = ["Payday", "Payday Loan", "Online Payday Loan", "Consumer Loan - Check", "SINGLE PAY", "PDL",
                   "CSO_Payday", "Online Short-Term Loan", "Short Term Loan", "Store Front Unsecure Loan",
                   "Retail Short-Term Loan", "Store Front Secure Loan", "Standard Loan", "Short-term loan",
                   "PRA - Check", "Advance", "Single Payment Loan"]
ASSET_TITLE_CS = ["Title", "Title Loan", "Title - Express", "Retail Title Loan", "TitleLOC"]
ASSET_OTHER_CS = ["MLA Loan", "MTIL Loan"]

# FIXED VALUES – license type (C03), compared after TRIM.
LICENSE_TRIBAL = ["Sovereign", "Tribal Lending", "Tribal-Sovereign", "Soveriegn"]
LICENSE_STATE = ["State by State", "State-by-State", "State by state", "State be State", "STATE BY STATE", "State",
                 "CSO", "State by State, CSO", "Bank Charter", "State Licensed, Bank Charter, CSO",
                 "State Licensed, CSO", "State Licensed Bank Charter, CSO", "Single State Export"]
LICENSE_OFFSHORE = ["Off-Shore", "Off Shore"]

# FIXED VALUES – post-sale request categories.
STATUS_COMPLETED = ["closed", "withdrawn", "unresolved"]
STATUS_PENDING_FUNDING = ["pending seller funding", "pending buyer funding confirmation"]
BUYBACK_TYPES = [0, 1, 5, 6, 8, 9, 11, 12]
STATUS_NOT_OPEN = ["closed", "withdrawn", "rejected"]
STATUS_FINISHED = ["closed", "rejected", "withdrawn"]
OUT_OF_BUSINESS = "terminated - out of business"
POSTSALE_PRICE_BK_DEDUCTION = 25
BCR_FACTOR = 5000
# ----------------------------------------------------------------------------


def asset_class_folded(product="Product") -> Column:
    """Asset class on LOWER(Product); else LOWER(Product); NULL -> NULL."""
    p = F.lower(col(product))
    return (
        F.when(p.isin(ASSET_AUTO_LC), "Auto")
        .when(p.like("%installment%") | p.isin(ASSET_INSTALLMENT_LC), "Installment")
        .when(p.isin(ASSET_LOC_LC), "Line of Credit")
        .when(p.isin(ASSET_BUSINESS_LC), "Business Loan")
        .when(p.like("%payday%") | p.isin(ASSET_PAYDAY_LC), "Payday")
        .when(p.isin(ASSET_TITLE_LC), "Title")
        .when(p.like("%bank line%"), "Bank Line")
        .when(p.like("%consumer unsecured%"), "Consumer Unsecured")
        .when(p.isin(ASSET_OTHER_LC), "Other")
        .otherwise(p)
    )


def asset_class_exact(product="Product") -> Column:
    """Same branches on the raw, case-sensitive Product; else Product."""
    p = col(product)
    return (
        F.when(p.isin(ASSET_AUTO_CS), "Auto")
        .when(p.like("%installment%") | p.like("%Installment%") | p.isin(ASSET_INSTALLMENT_CS), "Installment")
        .when(p.isin(ASSET_LOC_CS), "Line of Credit")
        .when(p.isin(ASSET_BUSINESS_CS), "Business Loan")
        .when(p.like("%Payday%") | p.isin(ASSET_PAYDAY_CS), "Payday")
        .when(p.isin(ASSET_TITLE_CS), "Title")
        .when(p.like("%Bank Line%"), "Bank Line")
        .when(p.like("%Consumer Unsecured%"), "Consumer Unsecured")
        .when(p.isin(ASSET_OTHER_CS), "Other")
        .otherwise(p)
    )


def license_class(license_type="LicenseType") -> Column:
    """License class of TRIM(LicenseType); anything else (NULL too) -> 'Missing'."""
    t = F.trim(col(license_type))
    return (
        F.when(t.isin(LICENSE_TRIBAL), "Tribal")
        .when(t == "Lease to Own", "Lease to Own")
        .when(t.isin(LICENSE_STATE), "State by State")
        .when(t.isin(LICENSE_OFFSHORE), "Off-Shore")
        .when(t == "Other", "Other")
        .otherwise("Missing")
    )


def removed_reason(remove_comment, bk_chapter, scra_status) -> Column:
    """C04: 'BK-<chapter>' / 'Deceased' / 'SCRA-<status>'; NULL parts give NULL."""
    rc = col(remove_comment)
    return (
        F.when(rc == "lci-bankrupt", F.concat(F.lit("BK-"), col(bk_chapter).cast("string")))
        .when(rc == "lci-deceased", F.lit("Deceased"))
        .when(rc == "lci-scra", F.concat(F.lit("SCRA-"), col(scra_status)))
    )


def sold_flag(removed="RemovedUTCDate") -> Column:
    """C05: 'YES' for rows still in the portfolio, else 'NO'."""
    return F.when(col(removed).isNull(), "YES").otherwise("NO")


def year_sold(removed="RemovedUTCDate", sold="SoldUtc") -> Column:
    """Year of sale for rows still in the portfolio."""
    return F.when(col(removed).isNull(), F.year(col(sold)).cast("int"))


def total_balance(p="PrincipalBalance", i="InterestBalance", o="OtherFeesBalance") -> Column:
    """NULL part -> NULL total."""
    return col(p) + col(i) + col(o)


def account_price(total: Column, pct="PurchasePricePercent") -> Column:
    """ROUND(total * percent, 2), half away from zero."""
    return F.round(total * col(pct), 2)


def pct_or_zero(c) -> Column:
    return F.coalesce(col(c), F.lit(0))


def total_fee_amount(price: Column, buyer_pct="BuyerFeePercent", seller_pct="SellerFeePercent") -> Column:
    """price*buyer% + price*seller% with NULL fees as 0 (not rounded).
    The sum's type is pinned to decimal(38,6): the scale both Spark and the
    reference's warehouse reduce this product to once it passes 38 digits."""
    return (price * pct_or_zero(buyer_pct) + price * pct_or_zero(seller_pct)).cast("decimal(38,6)")


def postsale_price(total: Column, bk_poc="BKPoc", pct="PurchasePricePercent") -> Column:
    """(total*pct [- 25 if BKPoc=1]) rounded to cents, as decimal(18,2)."""
    base = total * col(pct)
    return (
        F.when(col(bk_poc) == 1, F.round(base - POSTSALE_PRICE_BK_DEDUCTION, 2).cast("decimal(18,2)"))
        .otherwise(F.round(base, 2).cast("decimal(18,2)"))
    )


def postsale_percent(bk_poc="BKPoc", override="FinalPurchasePricePercent", pct="PurchasePricePercent") -> Column:
    """Bankruptcy override of the purchase percent."""
    return F.when((col(bk_poc) == 1) & col(override).isNotNull(), col(override)).otherwise(col(pct))


def request_category(status="Status", rtype="RequestType", by_buyer="InitiatedByBuyer") -> Column:
    """Nine ordered branches; no match -> NULL."""
    s, t, b = F.lower(col(status)), col(rtype), col(by_buyer)
    return (
        F.when(s.isin(STATUS_COMPLETED), "completed")
        .when(s.isin(STATUS_PENDING_FUNDING), "pending funding")
        .when(t == 7, "pif-sif")
        .when(t == 3, "info")
        .when(t == 10, "innacurate-data")
        .when((t == 2) & (b == 1), "direct-pay")
        .when(t == 4, "legal")
        .when(t.isin(BUYBACK_TYPES) & (b == 1), "put-back")
        .when(t.isin(BUYBACK_TYPES) & (b == 0), "buy-back")
    )


def initiated_by(by_buyer="InitiatedByBuyer") -> Column:
    """NULL initiator counts as seller."""
    return F.when(col(by_buyer) == 1, "Buyer").otherwise("Seller")


def pick_by_initiator(by_buyer, if_buyer, if_seller) -> Column:
    """IIF(InitiatedByBuyer = 1, a, b)."""
    return F.when(col(by_buyer) == 1, col(if_buyer)).otherwise(col(if_seller))


def out_of_business_name(status, name) -> Column:
    """C11: append ' (Out of Business)' to the name of terminated businesses."""
    return F.when(F.lower(col(status)) == OUT_OF_BUSINESS, F.concat(col(name), F.lit(" (Out of Business)"))).otherwise(col(name))


def req_status_open(close_date="CloseDate", status="Status") -> Column:
    """Has a close date but is not closed/withdrawn/rejected; NULL status -> 0."""
    return flag(col(close_date).isNotNull() & ~F.lower(col(status)).isin(STATUS_NOT_OPEN))


def closed_age_days(status="Status", created="Created", close_date="CloseDate") -> Column:
    """Age of finished requests in days, else -1 (NULL close date -> NULL)."""
    return F.when(F.lower(col(status)).isin(STATUS_FINISHED), days_crossed(created, close_date)).otherwise(F.lit(-1))


def age_days(created, as_of) -> Column:
    """C14: days from creation to the as-of instant."""
    return days_crossed(created, ts_lit(as_of))


def exists_flag(c) -> Column:
    """C15."""
    return flag(col(c).isNotNull())


def active_flag(activity, subtype) -> Column:
    """Activity AND subtype row present."""
    return flag(col(activity).isNotNull() & col(subtype).isNotNull())


def created_by(creator_id, creator_name, fallback: str) -> Column:
    """C17: creator's current name, or fixed text when no creator is set."""
    return F.when(col(creator_id).isNotNull(), col(creator_name)).otherwise(F.lit(fallback))


def placed_hours(placed="PlacedUtc", close="BidCloseUtc") -> Column:
    """Hour boundaries between placing the bid and the bid close."""
    return hours_crossed(placed, close)


def warehoused(event, psa, avg_write_off) -> Column:
    """0 when the event lies in [avg write-off, EOMONTH(avg + 6 months)];
    NULL when the event or the PSA date is missing; else 1 (NULL average too)."""
    e, a = col(event), col(avg_write_off)
    return (
        F.when(e.isNull() | col(psa).isNull(), F.lit(None).cast("int"))
        .when((e <= month_end_after(a, 6)) & (e >= a), F.lit(0))
        .otherwise(F.lit(1))
    )


def origination_diff(origination, event_date) -> Column:
    """Days from origination to the scrub event (sign = event - origination)."""
    return days_crossed(origination, event_date)


def bcr(value="Value") -> Column:
    """Complaint ratio scaled by 5000, as a long: the count of a whole year passes the int range."""
    return col(value) * F.expr(f"{BCR_FACTOR}L")
