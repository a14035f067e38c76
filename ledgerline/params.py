"""Explicit parameters of the products.

The reference hard-codes party ids, names and clock calls in its SQL. Here
each becomes a parameter, so tests can pin the clock and the fixtures can use
their own ids. ``Params()`` holds the reference's values; ``Params.testing()``
the fixture values from FIXTURES.md.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import UTC, datetime


def _now_utc() -> datetime:
    """The current UTC instant as a naive datetime (the session clock is UTC)."""
    return datetime.now(UTC).replace(tzinfo=None, microsecond=0)


@dataclass(frozen=True)
class Params:
    # "now" for the business dimension (UTC clock calls) and for post-sale ages
    # (server clock call); the reference reads two different clocks.
    as_of_utc: datetime = field(default_factory=lambda: _now_utc())
    as_of_local: datetime = field(default_factory=lambda: _now_utc())

    # Fixed values that must equal the reference's own (party ids, names, years).
    excluded_seller: str = "47087737-7939-4ddd-8ec2-64bc54b92513"
    excluded_buyers: tuple[str, ...] = (
        "845eb6ad-c3cb-44bb-b353-d75090bd0ecd",
        "e396866a-7269-42b5-9948-e473545d86b5",
    )
    excluded_bidder: str = "845eb6ad-c3cb-44bb-b353-d75090bd0ecd"
    excluded_businesses: tuple[str, ...] = (
        "47087737-7939-4ddd-8ec2-64bc54b92513",
        "845eb6ad-c3cb-44bb-b353-d75090bd0ecd",
    )
    min_close_year: int = 2024  # VW_Bidders keeps close years strictly after this
    excluded_seller_legal_name: str = "Halifax Highland Loans"
    excluded_seller_client: str = "$DEF SELLERS - CANADA TEST"
    login_cutoff: datetime = datetime(2000, 1, 1)
    goal_metric: str = "NumberOfBidsPerAuction"
    # Creator text for complaints filed by the platform itself (the reference
    # uses its operator's name here; a neutral text is used instead).
    compliance_creator: str = "Platform Compliance"

    # Bytes that the business-name hashes are taken of (F07): "UTF-8", or
    # "UTF-16LE" where the names are stored as NVARCHAR.
    hash_encoding: str = "UTF-8"

    # Event-type literals of the staging products (own definitions; only
    # 'listed' and 'awarded' are known from the reference).
    listed_event: str = "listed"
    awarded_event: str = "awarded"
    psa_event: str = "psa confirmed"
    sold_event: str = "sold"
    funding_events: tuple[str, ...] = ("funding confirmed",)

    @classmethod
    def testing(cls) -> "Params":
        return cls(
            as_of_utc=datetime(2001, 6, 30),
            as_of_local=datetime(2024, 6, 30),
            excluded_seller="S7",
            excluded_buyers=("B5", "B6"),
            excluded_bidder="B5",
            excluded_businesses=("S7", "B5"),
            min_close_year=1999,
            excluded_seller_legal_name="Supplier#000000003",
            excluded_seller_client="NATION_3",
            psa_event="read",
            funding_events=("download data-masked",),
        )

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)
