"""Scalar functions over columns."""

from settleflow.functions import conditions, dates, numeric, settlement, text

__all__ = ["conditions", "dates", "numeric", "settlement", "text"]
