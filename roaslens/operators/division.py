"""Division-parallel contribution.

Per subsidiary the children are divisions (channel ignored).  Same LMDI as
the drill, except that the parent delta stays null when a year's ROAS is
undefined (Q13).  Per-parent sums are aggregated and joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roaslens.functions.exprs import dsum, fmt_pct, fmt_roas, log_mean, log_ratio, pct_change, safe_ratio
from roaslens.operators.levels import level_rows
from roaslens.schema import SUM_COLUMNS

DIVISION_COLUMNS = [
    "SUBSIDIARY", "DIVISION", "Revenue_curr_sum", "Revenue_prev_sum", "Spend_curr_sum", "Spend_prev_sum",
    "Revenue_delta", "Revenue_yoy_pct", "Spend_yoy_pct", "ROAS_curr", "ROAS_prev", "ROAS_delta", "ROAS_yoy_pct",
    "Impact_raw", "Impact_adj", "Impact_raw_method", "Residual_parent", "Residual_applied_flag", "Parent_roas_delta",
    "Contribution_to_total_delta_pct", "Contribution_to_decline_pct", "Contribution_to_growth_pct", "Contribution_label",
]


def subsidiary_division_sums(levels: DataFrame) -> DataFrame:
    """Sums by (SUBSIDIARY, DIVISION) across channels, from the leaf level (exact decimal sums)."""
    return level_rows(levels, 4).groupBy("SUBSIDIARY", "DIVISION").agg(*[dsum(c).alias(c) for c in SUM_COLUMNS])


def division_parallel(levels: DataFrame) -> DataFrame:
    """D15 rows (24 columns incl. summary text) plus ``division_rank`` (D16 order)."""
    div = subsidiary_division_sums(levels)
    parent = level_rows(levels, 1).select(
        "SUBSIDIARY",
        safe_ratio("Revenue_curr_sum", "Spend_curr_sum").alias("Parent_roas_curr"),
        safe_ratio("Revenue_prev_sum", "Spend_prev_sum").alias("Parent_roas_prev"),
        F.col("Spend_curr_sum").alias("__psc"), F.col("Spend_prev_sum").alias("__psp"),
    ).withColumn("Parent_roas_delta", F.col("Parent_roas_curr") - F.col("Parent_roas_prev"))
    x = div.join(parent, "SUBSIDIARY", "left")
    cc = safe_ratio("Revenue_curr_sum", "__psc")
    cp = safe_ratio("Revenue_prev_sum", "__psp")
    lc, lp = log_mean(cc, cp), log_mean("Parent_roas_curr", "Parent_roas_prev")
    lr = log_ratio("Parent_roas_curr", "Parent_roas_prev")
    valid = (cc > 0) & (cp > 0) & (F.col("Parent_roas_curr") > 0) & (F.col("Parent_roas_prev") > 0) \
        & lc.isNotNull() & lp.isNotNull() & lr.isNotNull()
    x = x.withColumns({
        "Impact_raw": F.when(valid, (lc / lp) * lr * F.col("Parent_roas_delta")).otherwise(cc - cp),
        "Impact_raw_method": F.when(valid, F.lit("LMDI_ROAS")).otherwise(F.lit("ROAS_COMPONENT_DELTA_FALLBACK")),
    })
    res = x.groupBy("SUBSIDIARY").agg(
        F.sum("Impact_raw").alias("__sraw"),
        F.coalesce(F.sum(F.abs("Impact_raw")), F.lit(0.0)).alias("__sabs"),
        F.count(F.lit(1)).alias("__n"),
    )
    x = x.join(res, "SUBSIDIARY", "left").withColumn(
        "Residual_parent", F.col("Parent_roas_delta") - F.coalesce(F.col("__sraw"), F.lit(0.0))
    )
    alloc = (
        F.when(F.col("__n") <= 0, F.lit(0.0))
        .when(F.col("__sabs") > 0, (F.abs("Impact_raw") / F.col("__sabs")) * F.col("Residual_parent"))
        .otherwise(F.col("Residual_parent") / F.col("__n"))
    )
    x = x.withColumn("__alloc", alloc).withColumns({
        "Impact_adj": F.col("Impact_raw") + F.col("__alloc"),
        "Residual_applied_flag": F.abs("__alloc") > F.lit(1e-12),
        "Revenue_delta": F.col("Revenue_curr_sum") - F.col("Revenue_prev_sum"),
        "Revenue_yoy_pct": pct_change("Revenue_curr_sum", "Revenue_prev_sum"),
        "Spend_yoy_pct": pct_change("Spend_curr_sum", "Spend_prev_sum"),
        "ROAS_curr": safe_ratio("Revenue_curr_sum", "Spend_curr_sum"),
        "ROAS_prev": safe_ratio("Revenue_prev_sum", "Spend_prev_sum"),
    })
    pd_, adj = F.col("Parent_roas_delta"), F.col("Impact_adj")
    pabs = F.abs(pd_)
    x = x.withColumns({
        "ROAS_delta": F.col("ROAS_curr") - F.col("ROAS_prev"),
        "ROAS_yoy_pct": pct_change("ROAS_curr", "ROAS_prev"),
        "Contribution_to_total_delta_pct": F.when(pabs > 0, F.abs(adj) / pabs).otherwise(F.lit(0.0)),
        "Contribution_to_decline_pct": F.when((pd_ < 0) & (pabs > 0), F.when(adj < 0, -adj).otherwise(F.lit(0.0)) / pabs).otherwise(F.lit(0.0)),
        "Contribution_to_growth_pct": F.when((pd_ > 0) & (pabs > 0), F.when(adj > 0, adj).otherwise(F.lit(0.0)) / pabs).otherwise(F.lit(0.0)),
        "Contribution_label": (
            F.when(pd_ < 0, F.when(adj < 0, F.lit("DECLINE_DRIVER")).otherwise(F.lit("DECLINE_OFFSET")))
            .when(pd_ > 0, F.when(adj > 0, F.lit("GROWTH_DRIVER")).otherwise(F.lit("GROWTH_OFFSET")))
            .otherwise(F.lit("NEUTRAL"))
        ),
    })
    # X17 summary line (own wording)
    base_txt = F.concat(F.col("DIVISION"), F.lit(" ROAS "), fmt_roas("ROAS_curr"), F.lit(" ("), fmt_pct("ROAS_yoy_pct"), F.lit(")"))
    pdz = F.coalesce(pd_, F.lit(0.0))
    x = x.withColumn("summary_text", (
        F.when(pdz < 0, F.concat(base_txt, F.lit(", share of the ROAS decline "), fmt_pct("Contribution_to_decline_pct", signed=False)))
        .when(pdz > 0, F.concat(base_txt, F.lit(", share of the ROAS growth "), fmt_pct("Contribution_to_growth_pct", signed=False)))
        .otherwise(base_txt)
    ))
    # D16 order within a subsidiary (ranked on at most #divisions rows per subsidiary)
    key = (
        F.when(pdz < 0, -F.col("Contribution_to_decline_pct"))
        .when(pdz > 0, -F.col("Contribution_to_growth_pct"))
        .otherwise(F.lit(0.0))
    )
    w = Window.partitionBy("SUBSIDIARY").orderBy(key.asc(), (-F.abs(F.coalesce(adj, F.lit(0.0)))).asc(), F.col("DIVISION").asc())
    return x.withColumn("division_rank", F.row_number().over(w).cast("long")).select(*DIVISION_COLUMNS, "summary_text", "division_rank")


def division_blocks(divisions: DataFrame, levels: DataFrame) -> DataFrame:
    """Nested view: one row per subsidiary with parent ROAS fields and ordered division rows."""
    parent = level_rows(levels, 1).select(
        "SUBSIDIARY",
        safe_ratio("Revenue_curr_sum", "Spend_curr_sum").alias("Parent_roas_curr"),
        safe_ratio("Revenue_prev_sum", "Spend_prev_sum").alias("Parent_roas_prev"),
    ).withColumns({
        "Parent_roas_delta": F.coalesce(F.col("Parent_roas_curr") - F.col("Parent_roas_prev"), F.lit(0.0)),
        "Parent_roas_yoy_pct": pct_change("Parent_roas_curr", "Parent_roas_prev"),
    })
    rows = divisions.groupBy("SUBSIDIARY").agg(
        F.array_sort(F.collect_list(F.struct("division_rank", *[c for c in divisions.columns if c != "division_rank"]))).alias("rows")
    )
    return parent.join(rows, "SUBSIDIARY", "left")


def division_headline(divisions: DataFrame) -> DataFrame:
    """Per subsidiary the division labelled *_DRIVER with the largest positive pct (first wins)."""
    pct = F.when(F.col("Contribution_label") == "DECLINE_DRIVER", F.col("Contribution_to_decline_pct")) \
        .when(F.col("Contribution_label") == "GROWTH_DRIVER", F.col("Contribution_to_growth_pct"))
    cand = divisions.withColumn("__pct", pct).filter(F.col("__pct") > 0)
    best = cand.groupBy("SUBSIDIARY").agg(
        F.min(F.struct((-F.col("__pct")).alias("k"), F.col("division_rank").alias("r"), "DIVISION", "Contribution_label", "__pct")).alias("b")
    )
    return best.select(
        "SUBSIDIARY", F.col("b.DIVISION").alias("headline_division"), F.col("b.Contribution_label").alias("headline_label"),
        F.col("b.__pct").alias("headline_pct"),
    )
