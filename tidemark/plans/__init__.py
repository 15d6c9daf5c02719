"""The registered queries over the driver's tables."""

from . import bus, log, metrics, protocol, roundtrips, transactions, values  # noqa: F401
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
