"""All registered queries of the library proper."""

from __future__ import annotations

from . import audit, contracts, documents, filings, financials, joins, normalising, scenarios, selecting, sources, streams, voting  # noqa: F401
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
