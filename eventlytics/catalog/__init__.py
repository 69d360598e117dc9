"""Every operator as a query over the given tables, with its SQL counterpart."""

from eventlytics.catalog import (  # noqa: F401
    cards,
    extended,
    graphs,
    histories,
    joins,
    learning,
    pages,
    profiles,
    projections,
    rollups,
    scans,
    text,
)
from eventlytics.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
