"""Print the formatted physical plans of the main steps (the plans quoted in PLANS.md).

Usage: python tools/explain.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roaslens.config import EngineConfig  # noqa: E402
from roaslens.operators.drill import drill, drill_candidates  # noqa: E402
from roaslens.operators.impact import all_child_impacts, select_children  # noqa: E402
from roaslens.operators.levels import level_rollup  # noqa: E402
from roaslens.session import cut, local_session  # noqa: E402
from roaslens.sources.ingest import engine_frame  # noqa: E402
from roaslens.sources.mapped import mapped_long_table  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    cfg = EngineConfig(2000, 1999)
    eng = engine_frame(mapped_long_table(spark, sf, (2000, 1999)), cfg)
    steps = [("engine frame", eng), ("level rollup", level_rollup(eng))]
    levels = cut(level_rollup(eng))
    steps.append(("LMDI + selection for every parent", select_children(cut(all_child_impacts(levels)), cfg)))
    d = drill(levels, cfg, 1, drill_candidates(levels, cfg))
    steps.append(("drill leaves", d.leaves))
    mtd = EngineConfig(2000, 1999, mtd_only=True)
    steps.append(("engine frame, month to date", engine_frame(mapped_long_table(spark, sf, (2000, 1999)), mtd)))
    for name, df in steps:
        print(f"\n######## {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
