"""Every operator as a query on the supplied tables, with the SQL that must give the same rows."""

from graphloom.catalog import (  # noqa: F401
    decoding,
    encoding,
    filters,
    functions,
    graph,
    joins,
    scans,
    shaping,
    streams,
    udfs,
    validation,
)
from graphloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
