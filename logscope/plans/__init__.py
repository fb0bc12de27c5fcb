"""Query catalog, oracle SQL and plan checks."""
from logscope.plans.catalog import QUERIES
from logscope.plans.oracle import ORACLE

__all__ = ["QUERIES", "ORACLE"]
