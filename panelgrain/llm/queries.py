"""All queries of the subpackage; importing the modules registers them."""

from panelgrain.llm import attention, decontaminate, fingerprints, fixity, licenses, mixing, near_dedup, negatives, pages, quality, recount, substring_dedup, tokens  # noqa: F401
from panelgrain.llm.shared import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
