"""Settlement-style ETL on tables and file streams, as Spark DataFrame operators."""

from settleflow.session import configure, intermediates

__all__ = ["configure", "intermediates"]
