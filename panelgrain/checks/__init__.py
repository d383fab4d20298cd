"""Every operator as a query over the driver tables."""

from panelgrain.checks import q_aggregate, q_conform, q_extract, q_filter, q_io, q_lookup, q_panel, q_plans, q_product, q_publish, q_quality  # noqa: F401
from panelgrain.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
