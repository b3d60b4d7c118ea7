"""catloom: landed BI metadata to catalog entities and lineage, on Spark DataFrames."""

from catloom.context import RunContext, WireNames
from catloom.session import build_session, configure

__all__ = ["RunContext", "WireNames", "build_session", "configure"]
