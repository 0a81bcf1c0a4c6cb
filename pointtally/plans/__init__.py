"""Registered queries over the driver's tables and their SQL oracles."""

from pointtally.plans.oracle import ORACLE
from pointtally.plans.queries import QUERIES

__all__ = ["ORACLE", "QUERIES"]
