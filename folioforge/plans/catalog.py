"""All registered queries of the library; importing the modules fills the registry."""

from folioforge.plans import gold_queries, io_queries, mapping_queries, profile_queries, unit_queries, version_queries  # noqa: F401
from folioforge.plans import single_queries  # noqa: F401  (after the queries it takes parts of)
from folioforge.plans import facet_queries  # noqa: F401  (over their facets)
from folioforge.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
