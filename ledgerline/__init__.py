"""ledgerline – portfolio-marketplace analytics products on Spark DataFrames."""

from .params import Params
from .sources import Sources

__all__ = ["Params", "Sources"]
