"""Literal-data tests for the scalar rules: one case per CASE branch, NULLs,
"""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import rules as R
from ledgerline.functions.core import concat_nullsafe, days_crossed, hours_crossed, months_crossed, sha256_hex_upper


def one(spark, schema, rows, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


@pytest.mark.parametrize("product, expected", [
    ("Auto Deficiency", "Auto"), ("business installment loan", "Installment"), ("Consumer", "Installment"),
    ("LineOfCredit", "Line of Credit"), ("Small Business", "Business Loan"), ("PDL", "Payday"),
    ("online payday loan", "Payday"), ("Title Loan", "Title"), ("Bank Line A", "Bank Line"),
    ("Consumer Unsecured", "Consumer Unsecured"), ("MLA Loan", "Other"), ("Medical", "medical"), (None, None),
])
def test_asset_class_folded(spark, product, expected):
    assert one(spark, "p string", [(product,)], R.asset_class_folded("p")) == [expected]


@pytest.mark.parametrize("product, expected", [
    ("INSTALLMENT", "INSTALLMENT"), ("Installment Loan", "Installment"), ("LINE OF CREDIT", "Line of Credit"),
    ("Business Installment Loan", "Installment"), ("auto title", "auto title"), ("Online Payday Loan", "Payday"),
    ("PDL", "Payday"), (None, None),
])
def test_asset_class_exact(spark, product, expected):
    assert one(spark, "p string", [(product,)], R.asset_class_exact("p")) == [expected]


@pytest.mark.parametrize("lic, expected", [
    (" Sovereign ", "Tribal"), ("Soveriegn", "Tribal"), ("Lease to Own", "Lease to Own"), ("CSO", "State by State"),
    ("State be State", "State by State"), ("Off Shore", "Off-Shore"), ("Other", "Other"), ("unknown", "Missing"),
    (None, "Missing"),
])
def test_license_class(spark, lic, expected):
    assert one(spark, "l string", [(lic,)], R.license_class("l")) == [expected]


@pytest.mark.parametrize("status, rtype, by, expected", [
    ("Closed", 7, 1, "completed"), ("Pending Seller Funding", 0, 1, "pending funding"), ("Open", 7, 0, "pif-sif"),
    ("Open", 3, 0, "info"), ("Open", 10, None, "innacurate-data"), ("Open", 2, 1, "direct-pay"),
    ("Open", 2, 0, None), ("Open", 4, 0, "legal"), ("Open", 5, 1, "put-back"), ("Open", 12, 0, "buy-back"),
    ("Open", 0, None, None), (None, 9, 1, "put-back"),
])
def test_request_category(spark, status, rtype, by, expected):
    got = one(spark, "s string, t int, b int", [(status, rtype, by)], R.request_category("s", "t", "b"))
    assert got == [expected]


def test_initiator_null_counts_as_seller(spark):
    assert one(spark, "b int", [(1,), (0,), (None,)], R.initiated_by("b")) == ["Buyer", "Seller", "Seller"]


def test_removed_reason_and_sold(spark):
    rows = [("lci-bankrupt", "7", None), ("lci-bankrupt", None, None), ("lci-deceased", None, None),
            ("lci-scra", None, "Y"), ("lci-scra", None, None), ("manual", "7", "Y")]
    got = one(spark, "c string, ch string, s string", rows, R.removed_reason("c", "ch", "s"))
    assert got == ["BK-7", None, "Deceased", "SCRA-Y", None, None]


def test_warehoused_flag_branches(spark):
    d = dt.date(2020, 1, 31)
    rows = [
        (None, dt.datetime(2020, 3, 1), d),                # event missing -> NULL
        (dt.datetime(2020, 3, 1), None, d),                # PSA missing -> NULL
        (dt.datetime(2020, 7, 31), dt.datetime(2020, 1, 1), d),  # inside [d, EOMONTH(d+6m)] -> 0
        (dt.datetime(2020, 7, 31, 10), dt.datetime(2020, 1, 1), d),  # 10:00 on the last day is after it -> 1
        (dt.datetime(2020, 1, 30), dt.datetime(2020, 1, 1), d),  # before the average -> 1
        (dt.datetime(2020, 3, 1), dt.datetime(2020, 1, 1), None),  # NULL average -> 1
    ]
    got = one(spark, "e timestamp, p timestamp, a date", rows, R.warehoused("e", "p", "a"))
    assert got == [None, None, 0, 1, 1, 1]


def test_boundary_counting_date_diffs(spark):
    rows = [(dt.datetime(2020, 1, 1, 23, 59), dt.datetime(2020, 1, 2, 0, 1))]
    schema = "a timestamp, b timestamp"
    assert one(spark, schema, rows, days_crossed("a", "b")) == [1]
    assert one(spark, schema, rows, hours_crossed("a", "b")) == [1]
    assert one(spark, schema, [(dt.datetime(2020, 1, 31), dt.datetime(2020, 2, 1))], months_crossed("a", "b")) == [1]
    assert one(spark, schema, [(dt.datetime(2020, 1, 1, 10, 5), dt.datetime(2020, 1, 1, 10, 55))],
               hours_crossed("a", "b")) == [0]


def test_concat_nullsafe_and_hash(spark):
    got = one(spark, "a string, b string", [("x", None), (None, None), ("x", "y")], concat_nullsafe("a", F.lit(" "), "b"))
    assert got == ["x ", " ", "x y"]
    h = one(spark, "a string", [(" acme ",), (None,)], sha256_hex_upper("a"))
    assert h[1] == "" and len(h[0]) == 64 and h[0] == h[0].upper()
    assert h[0] == one(spark, "a string", [("ACME",)], sha256_hex_upper("a"))[0]


def test_prices_round_half_away_and_postsale_price(spark):
    rows = [(Decimal("10.00"), Decimal("0.00"), Decimal("0.00"), Decimal("0.234500"), 0),
            (Decimal("10.00"), Decimal("0.00"), Decimal("0.00"), Decimal("0.234500"), 1),
            (Decimal("10.00"), None, Decimal("0.00"), Decimal("0.5"), 0)]
    schema = "p decimal(18,2), i decimal(18,2), o decimal(18,2), pct decimal(9,6), bk int"
    tot = R.total_balance("p", "i", "o")
    assert one(spark, schema, rows, R.account_price(tot, "pct")) == [Decimal("2.35"), Decimal("2.35"), None]
    assert one(spark, schema, rows, R.postsale_price(tot, "bk", "pct")) == [Decimal("2.35"), Decimal("-22.66"), None]


def test_status_rules(spark):
    rows = [(dt.datetime(2024, 1, 1), "Open", dt.datetime(2024, 1, 3)), (dt.datetime(2024, 1, 1), "Closed", None),
            (None, "Withdrawn", None), (dt.datetime(2024, 1, 1), None, dt.datetime(2024, 1, 3))]
    schema = "cd timestamp, s string, cr timestamp"
    assert one(spark, schema, rows, R.req_status_open("cd", "s")) == [1, 0, 0, 0]
    rows2 = [("Closed", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3)), ("Open", dt.datetime(2024, 1, 1), None),
             ("Rejected", dt.datetime(2024, 1, 1), None)]
    assert one(spark, "s string, c timestamp, d timestamp", rows2, R.closed_age_days("s", "c", "d")) == [2, -1, None]
    assert one(spark, "s string, n string", [("Terminated - Out Of Business", "Acme"), ("Active", "Acme")],
               R.out_of_business_name("s", "n")) == ["Acme (Out of Business)", "Acme"]


def test_timestamp_literal_ignores_python_zone(spark):
    import os
    import time

    from ledgerline.functions.core import ts_lit

    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/Los_Angeles"
    time.tzset()
    try:
        got = spark.range(1).select(F.date_format(ts_lit(dt.datetime(2001, 6, 30)), "yyyy-MM-dd HH:mm:ss")).first()[0]
    finally:
        if old is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old
        time.tzset()
    assert got == "2001-06-30 00:00:00"


def test_name_hash_in_both_encodings(spark):
    """F07 on literals: the digests of the bytes themselves."""
    import hashlib

    for encoding in ("UTF-8", "UTF-16LE"):
        got = one(spark, "a string", [(" Café ",)], sha256_hex_upper("a", encoding))[0]
        assert got == hashlib.sha256("CAFÉ".encode(encoding.lower())).hexdigest().upper()


def test_complaint_ratio_beyond_the_int_range(spark):
    assert one(spark, "v int", [(429_497,), (2_147_483_647,), (None,)], R.bcr("v")) == [2_147_485_000, 10_737_418_235_000, None]
    assert one(spark, "v decimal(10,2)", [(Decimal("1.50"),)], R.bcr("v")) == [Decimal("7500.00")]
