"""roaslens: explain year-over-year ROAS change with Spark DataFrame plans.

The engine reads ad-performance rows, aligns the current and previous year,
rolls them up a four-level hierarchy (SUBSIDIARY > CHANNEL > DIVISION >
PRODUCT), splits each parent's ROAS change among its children with a
log-mean (LMDI) decomposition, drills into the children that matter, tags
the root cause (CPC / CVR / AOV) of each selected product, attaches an
action and writes ranked report tables.  Every step is a lazy DataFrame
plan that covers all subsidiaries at once.
"""

from roaslens.config import EngineConfig
from roaslens.schema import DIMENSIONS, ENGINE_COLUMNS, ENGINE_SCHEMA

__all__ = ["EngineConfig", "DIMENSIONS", "ENGINE_COLUMNS", "ENGINE_SCHEMA"]
