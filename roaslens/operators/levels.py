"""Level aggregates (A2-A7) and the KPI pack.

All levels come from one ``rollup`` over the engine frame: Spark expands each
row once per level and aggregates partially on the map side, so the four
levels plus the grand total cost a single shuffle.  ``level`` is derived from
``grouping_id`` (dims are never null after normalisation, so the id is exact).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roaslens.functions.exprs import dsum, pct_change, safe_ratio
from roaslens.schema import DIMENSIONS, ENGINE_METRICS, SUM_COLUMNS, dims_of

# grouping_id of rollup(SUBSIDIARY, CHANNEL, DIVISION, PRODUCT) -> level
_GID_TO_LEVEL = {0: 4, 1: 3, 3: 2, 7: 1, 15: 0}


def level_rollup(engine: DataFrame) -> DataFrame:
    """All levels: ``level`` (0 = total ... 4 = leaf), 4 dims (null above the level), 8 sums."""
    gid = F.grouping_id(*DIMENSIONS)
    level = F.lit(None).cast("int")
    for g, lv in _GID_TO_LEVEL.items():
        level = F.when(gid == g, F.lit(lv)).otherwise(level)
    return (
        engine.rollup(*DIMENSIONS)
        .agg(*[dsum(m).alias(f"{m}_sum") for m in ENGINE_METRICS], level.alias("level"))
        .select("level", *DIMENSIONS, *SUM_COLUMNS)
    )


def level_rows(levels: DataFrame, level: int) -> DataFrame:
    """Rows of one level with only that level's dims."""
    return levels.filter(F.col("level") == level).select(*dims_of(level), *SUM_COLUMNS)


def kpi_pack(df: DataFrame, prefix: str = "") -> list:
    """Revenue / spend / CPC / CVR / AOV / ROAS for both years, YoY and deltas."""
    p = prefix
    rc, rp = F.col("Revenue_curr_sum"), F.col("Revenue_prev_sum")
    sc, sp = F.col("Spend_curr_sum"), F.col("Spend_prev_sum")
    cc, cp = F.col("Clicks_curr_sum"), F.col("Clicks_prev_sum")
    oc, op = F.col("Orders_curr_sum"), F.col("Orders_prev_sum")
    roas_c, roas_p = safe_ratio(rc, sc), safe_ratio(rp, sp)
    cpc_c, cpc_p = safe_ratio(sc, cc), safe_ratio(sp, cp)
    cvr_c, cvr_p = safe_ratio(oc, cc), safe_ratio(op, cp)
    aov_c, aov_p = safe_ratio(rc, oc), safe_ratio(rp, op)
    return [
        rc.alias(f"{p}rev_curr"), rp.alias(f"{p}rev_prev"), (rc - rp).alias(f"{p}rev_delta"),
        pct_change(rc, rp).alias(f"{p}rev_yoy"),
        sc.alias(f"{p}spend_curr"), sp.alias(f"{p}spend_prev"), pct_change(sc, sp).alias(f"{p}spend_yoy"),
        cpc_c.alias(f"{p}cpc_curr"), cpc_p.alias(f"{p}cpc_prev"), pct_change(cpc_c, cpc_p).alias(f"{p}cpc_yoy"),
        cvr_c.alias(f"{p}cvr_curr"), cvr_p.alias(f"{p}cvr_prev"), pct_change(cvr_c, cvr_p).alias(f"{p}cvr_yoy"),
        aov_c.alias(f"{p}aov_curr"), aov_p.alias(f"{p}aov_prev"), pct_change(aov_c, aov_p).alias(f"{p}aov_yoy"),
        roas_c.alias(f"{p}roas_curr"), roas_p.alias(f"{p}roas_prev"),
        (roas_c - roas_p).alias(f"{p}roas_delta"), pct_change(roas_c, roas_p).alias(f"{p}roas_yoy"),
    ]


def kpi_table(levels: DataFrame, level: int) -> DataFrame:
    """KPI pack for every row of a level (kpi_subsidiary / kpi_channel / ...)."""
    return level_rows(levels, level).select(*dims_of(level), *kpi_pack(level_rows(levels, level)))
