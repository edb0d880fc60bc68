"""Message ingestion and schema governance on Spark DataFrames."""

from tollgate.session import configure

__all__ = ["configure"]
