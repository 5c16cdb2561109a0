"""The registered queries over the driver's tables, and the SQL they are checked against."""

from tarmac.registry import ingestion, models, operators  # noqa: F401  (registers their queries)
from tarmac.registry.book import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
