from .contracts import CONTRACTS, conform, pad_type
from .loader import CARRIER_TABLES, SOURCE_TABLES, Sources, fixture_dependencies, write_sources
from .layout import ACCOUNT_KEYED, write_source_tables

__all__ = [
    "CONTRACTS", "conform", "pad_type", "Sources", "SOURCE_TABLES", "CARRIER_TABLES",
    "fixture_dependencies", "write_sources", "ACCOUNT_KEYED", "write_source_tables",
]
