"""Customer-order analytics on Spark: landed rows to clean tables to sales marts."""

from orderloom.config import LakeNames
from orderloom.plans.runs import absorb, refresh_gold, run_gold, run_silver
from orderloom.session import tune
from orderloom.sources.lake import Lake

__all__ = ["Lake", "LakeNames", "absorb", "refresh_gold", "run_gold", "run_silver", "tune"]
