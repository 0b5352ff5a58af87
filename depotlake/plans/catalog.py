"""Importing this module registers every query."""

from depotlake.plans import (growth_queries, job_queries, lake_queries, mart_queries, order_queries,  # noqa: F401
                             recon_queries, report_queries, write_queries)
from depotlake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
