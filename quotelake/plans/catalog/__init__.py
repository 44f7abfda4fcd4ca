"""Queries over the given tables, one per operator, with equivalent SQL where SQL can say it."""

from quotelake.plans.catalog import cleaning, incremental, indicators, integrity, landing, reports, star
from quotelake.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cleaning", "incremental", "indicators", "integrity", "landing", "reports", "star"]
