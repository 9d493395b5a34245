"""Registered queries over the test tables and their SQL twins."""

from millrace.catalog import (  # noqa: F401
    bank,
    commerce,
    geography,
    history,
    lake,
    taxi,
    vaults,
)
from millrace.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
