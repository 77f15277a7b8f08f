"""Named queries over the driver tables."""

from palisade.plans import documents, inputs, intelligence, mapping_audit, report_set, reports, scalar_rules, silver_gold, worklists  # noqa: F401
from palisade.plans.registry import ORACLES, PLANS

__all__ = ["ORACLES", "PLANS"]
