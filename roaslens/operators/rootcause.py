"""Root cause of a leaf's ROAS change.

ROAS = AOV * CVR / CPC, so ln(ROAS_c/ROAS_p) = dlog CVR + dlog AOV - dlog CPC.
All of it is a projection of the leaf aggregate: no join to the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roaslens.functions.exprs import log_ratio, safe_ratio
from roaslens.schema import DIMENSIONS, SUM_COLUMNS

RCA_FIELDS = [
    "primary_driver", "tag", "dlog_CVR", "dlog_AOV", "dlog_CPC", "total_dlog_roas",
    "CPC_curr", "CPC_prev", "CVR_curr", "CVR_prev", "AOV_curr", "AOV_prev", "ROAS_curr", "ROAS_prev",
]
TAGS_WITHOUT_DRIVER = ["LOW_VOL", "NEW", "GONE", "UNDEFINED"]
# LOW_VOL volume limits (clicks, orders of the current year).
LOW_VOL_MIN_CLICKS = 100
LOW_VOL_MIN_ORDERS = 5


def kpi_ratios(df: DataFrame) -> DataFrame:
    """R1 + R2 + R3: ratios, dlogs, total and tag."""
    s = {c: F.col(c) for c in SUM_COLUMNS}
    df = df.withColumns({
        "CPC_curr": safe_ratio(s["Spend_curr_sum"], s["Clicks_curr_sum"]),
        "CPC_prev": safe_ratio(s["Spend_prev_sum"], s["Clicks_prev_sum"]),
        "CVR_curr": safe_ratio(s["Orders_curr_sum"], s["Clicks_curr_sum"]),
        "CVR_prev": safe_ratio(s["Orders_prev_sum"], s["Clicks_prev_sum"]),
        "AOV_curr": safe_ratio(s["Revenue_curr_sum"], s["Orders_curr_sum"]),
        "AOV_prev": safe_ratio(s["Revenue_prev_sum"], s["Orders_prev_sum"]),
        "ROAS_curr": safe_ratio(s["Revenue_curr_sum"], s["Spend_curr_sum"]),
        "ROAS_prev": safe_ratio(s["Revenue_prev_sum"], s["Spend_prev_sum"]),
    })
    df = df.withColumns({
        "dlog_CVR": log_ratio("CVR_curr", "CVR_prev"),
        "dlog_AOV": log_ratio("AOV_curr", "AOV_prev"),
        "dlog_CPC": log_ratio("CPC_curr", "CPC_prev"),
    })
    df = df.withColumn("total_dlog_roas", F.col("dlog_CVR") + F.col("dlog_AOV") - F.col("dlog_CPC"))
    tag = (
        F.when((s["Clicks_curr_sum"] < LOW_VOL_MIN_CLICKS) | (s["Orders_curr_sum"] < LOW_VOL_MIN_ORDERS), F.lit("LOW_VOL"))
        .when((s["Revenue_prev_sum"] == 0) & (s["Revenue_curr_sum"] > 0), F.lit("NEW"))
        .when((s["Revenue_prev_sum"] > 0) & (s["Revenue_curr_sum"] == 0), F.lit("GONE"))
        .when(F.col("total_dlog_roas").isNull(), F.lit("UNDEFINED"))
        .otherwise(F.lit("NORMAL"))
    )
    return df.withColumn("tag", tag)


def _mode_scores(mode: str) -> tuple[Column, Column, Column, Column]:
    """Mode-aligned scores (|dlog| when it moves ROAS the mode's way)."""
    cvr, aov, cpc, tot = (F.col(c) for c in ("dlog_CVR", "dlog_AOV", "dlog_CPC", "total_dlog_roas"))
    if mode == "ISSUE":
        valid = tot < 0
        sc = F.when(valid & (cvr < 0), F.abs(cvr)).otherwise(0.0)
        sa = F.when(valid & (aov < 0), F.abs(aov)).otherwise(0.0)
        sp = F.when(valid & (cpc > 0), F.abs(cpc)).otherwise(0.0)
    else:
        valid = tot > 0
        sc = F.when(valid & (cvr > 0), F.abs(cvr)).otherwise(0.0)
        sa = F.when(valid & (aov > 0), F.abs(aov)).otherwise(0.0)
        sp = F.when(valid & (cpc < 0), F.abs(cpc)).otherwise(0.0)
    return valid, sc, sa, sp


def engine_driver(mode: str) -> Column:
    """Driver of the engine; ties CVR >= AOV >= CPC; NONE when tagged or total has the wrong sign."""
    valid, sc, sa, sp = _mode_scores(mode)
    return (
        F.when(F.col("tag").isin(TAGS_WITHOUT_DRIVER) | ~F.coalesce(valid, F.lit(False)), F.lit("NONE"))
        .when((sc >= sa) & (sc >= sp) & (sc > 0), F.lit("CVR"))
        .when((sa >= sp) & (sa > 0), F.lit("AOV"))
        .when(sp > 0, F.lit("CPC"))
        .otherwise(F.lit("NONE"))
    )


def rca_table(leaf: DataFrame, mode: str) -> DataFrame:
    """R6 for one mode: dims + 8 sums + the 14 RCA fields."""
    mode = mode.upper()
    if mode not in ("ISSUE", "IMPROVE"):
        raise ValueError("mode must be 'ISSUE' or 'IMPROVE'")
    x = kpi_ratios(leaf)
    return x.withColumn("primary_driver", engine_driver(mode)).select(*DIMENSIONS, *SUM_COLUMNS, *RCA_FIELDS)


def attach_rca_by_list(selected: DataFrame, leaf: DataFrame) -> DataFrame:
    """R7 / J6 for issues and improvements together.

    ``selected`` has a ``list`` column (``issues`` / ``improvements``); the
    engine driver (R5) is scored in ISSUE mode for issues and IMPROVE mode for
    improvements (DEFENSE rows included), as the reference does.
    """
    keys = selected.select(*DIMENSIONS).distinct()
    rca = kpi_ratios(leaf.join(keys, DIMENSIONS, "left_semi")).withColumns({
        "__drv_issue": engine_driver("ISSUE"), "__drv_improve": engine_driver("IMPROVE"),
    })
    rca_lower = {c.lower() for c in RCA_FIELDS}
    base = selected.drop(*[c for c in selected.columns if c.lower() in rca_lower])
    rca = rca.select(*DIMENSIONS, *[F.col(c).alias(f"__r_{c}") for c in SUM_COLUMNS],
                     *[c for c in RCA_FIELDS if c != "primary_driver"], "__drv_issue", "__drv_improve")
    joined = base.join(rca, DIMENSIONS, "left")
    drv = F.when(F.col("list") == "issues", F.col("__drv_issue")).otherwise(F.col("__drv_improve"))
    return joined.withColumns({
        **{c: F.coalesce(F.col(f"__r_{c}"), F.col(c)) for c in SUM_COLUMNS},
        "primary_driver": F.coalesce(drv, F.lit("NONE")),
        "tag": F.coalesce(F.col("tag"), F.lit("UNDEFINED")),
    }).drop(*[f"__r_{c}" for c in SUM_COLUMNS], "__drv_issue", "__drv_improve")


def _argmax_driver(cvr: Column, aov: Column, cpc: Column) -> Column:
    """Largest score; equal scores go to the larger name (CVR > CPC > AOV)."""
    return (
        F.when((cvr >= cpc) & (cvr >= aov), F.lit("CVR"))
        .when(cpc >= aov, F.lit("CPC"))
        .otherwise(F.lit("AOV"))
    )


def confirmed_driver(mode_col: str = "mode_tag") -> Column:
    """One driver among CPC/CVR/AOV for every row.

    Mode-aligned scores without any tag/total gate; if all are 0 the largest
    |dlog| wins; if everything is 0 or null, CPC.
    """
    cvr, aov, cpc = (F.col(c) for c in ("dlog_CVR", "dlog_AOV", "dlog_CPC"))
    is_issue = F.upper(F.coalesce(F.col(mode_col), F.lit(""))) == "ISSUE"
    sc = F.when(is_issue, F.when(cvr < 0, F.abs(cvr))).otherwise(F.when(cvr > 0, F.abs(cvr)))
    sa = F.when(is_issue, F.when(aov < 0, F.abs(aov))).otherwise(F.when(aov > 0, F.abs(aov)))
    sp = F.when(is_issue, F.when(cpc > 0, F.abs(cpc))).otherwise(F.when(cpc < 0, F.abs(cpc)))
    sc, sa, sp = (F.coalesce(v, F.lit(0.0)) for v in (sc, sa, sp))
    fc, fa, fp = (F.coalesce(F.abs(v), F.lit(0.0)) for v in (cvr, aov, cpc))
    return (
        F.when(F.greatest(sc, sa, sp) > 0, _argmax_driver(sc, sa, sp))
        .when(F.greatest(fc, fa, fp) > 0, _argmax_driver(fc, fa, fp))
        .otherwise(F.lit("CPC"))
    )


def choose_subsidiary_mode(delta: Column, n_issues: Column, n_improves: Column) -> Column:
    """ISSUE or IMPROVE for a subsidiary report."""
    d = F.coalesce(delta, F.lit(0.0))
    return (
        F.when(d < 0, F.when(n_issues > 0, F.lit("ISSUE")).otherwise(F.lit("IMPROVE")))
        .when(n_improves > 0, F.lit("IMPROVE"))
        .when(n_issues > 0, F.lit("ISSUE"))
        .otherwise(F.lit("IMPROVE"))
    )
