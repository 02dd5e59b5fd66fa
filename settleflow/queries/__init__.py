"""Registered queries: importing this package fills the registry."""

from settleflow.queries import flows, formulas, scalars, settlement, streams, tables
from settleflow.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flows", "formulas", "scalars", "settlement", "streams", "tables"]
