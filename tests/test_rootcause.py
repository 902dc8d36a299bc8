"""Root cause tags, drivers and policy (FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from conftest import engine_rows
from roaslens.operators.levels import level_rollup, level_rows
from roaslens.operators.policy import ACTION_RULES, CHECK_RULES, enrich_actions, rules_sql
from roaslens.operators.rootcause import confirmed_driver, rca_table


def leaf(spark, rows):
    return level_rows(level_rollup(engine_rows(spark, rows)), 4)


@pytest.mark.parametrize("clk,orders,rev_p,rev_c,clk_prev,tag", [
    (99, 10, 100, 80, 500, "LOW_VOL"),
    (500, 4, 100, 80, 500, "LOW_VOL"),
    (500, 20, 0, 50, 500, "NEW"),
    (500, 20, 50, 0, 500, "GONE"),
    (500, 20, 50, 60, 0, "UNDEFINED"),
    (500, 20, 100, 80, 500, "NORMAL"),
])
def test_tags(spark, clk, orders, rev_p, rev_c, clk_prev, tag):
    rows = [("S", "C", "MX", "P", 10, 10, rev_c, rev_p, clk, clk_prev, orders, 20)]
    r = rca_table(leaf(spark, rows), "ISSUE").first()
    assert r["tag"] == tag


def test_dlog_identity_and_engine_driver(spark):
    # ROAS falls: CPC up strongly, CVR flat, AOV slightly down
    rows = [("S", "C", "MX", "P", 20, 10, 90, 100, 500, 500, 20, 20)]
    r = rca_table(leaf(spark, rows), "ISSUE").first()
    assert r["total_dlog_roas"] == pytest.approx(__import__("math").log((90 / 20) / (100 / 10)))
    assert r["primary_driver"] == "CPC"
    r2 = rca_table(leaf(spark, rows), "IMPROVE").first()
    assert r2["primary_driver"] == "NONE"  # total has the wrong sign for IMPROVE


def drivers(spark, cvr, aov, cpc, mode):
    df = spark.createDataFrame([(cvr, aov, cpc, mode)], "dlog_CVR double, dlog_AOV double, dlog_CPC double, mode_tag string")
    return df.select(confirmed_driver().alias("d")).first()["d"]


def test_confirmed_driver_ties(spark):
    # equal CVR and AOV scores -> CVR; equal AOV and CPC -> CPC (name order CVR > CPC > AOV)
    assert drivers(spark, -0.1, -0.1, 0.0, "ISSUE") == "CVR"
    assert drivers(spark, 0.0, -0.1, 0.1, "ISSUE") == "CPC"
    # nothing aligned with the mode -> largest |dlog|
    assert drivers(spark, 0.3, 0.1, -0.2, "ISSUE") == "CVR"
    # everything zero or null -> CPC
    assert drivers(spark, 0.0, None, 0.0, "IMPROVE") == "CPC"
    assert drivers(spark, None, None, None, "DEFENSE") == "CPC"


def test_policy_rules_cover_all_paths(spark):
    rows = []
    for tag in ("LOW_VOL", "NEW", "GONE", "UNDEFINED", "NORMAL"):
        for mode in ("ISSUE", "IMPROVE", "DEFENSE"):
            for drv in ("CPC", "CVR", "AOV"):
                for ch in ("Brand Search", "PMAX retail", "Display"):
                    rows.append((tag, mode, drv, ch))
    df = spark.createDataFrame(rows, "tag string, mode_tag string, primary_driver string, CHANNEL string")
    df = df.withColumns({"dlog_CVR": F.lit(None).cast("double"), "dlog_AOV": F.lit(None).cast("double"),
                         "dlog_CPC": F.lit(None).cast("double"), "drill_trace": F.array().cast(
                             "array<struct<level:string,rule:string,selected_path:struct<SUBSIDIARY:string,CHANNEL:string,DIVISION:string,PRODUCT:string>,impact_adj:double,share_childsum:double>>"),
                         **{d: F.lit("x") for d in ("SUBSIDIARY", "DIVISION", "PRODUCT")}})
    out = enrich_actions(df).collect()
    codes = {r["action_code"] for r in out}
    # tags win over modes; every driver/channel combination is reachable (driver CPC after confirmation)
    assert {"TAG_LOW_VOL", "TAG_NEW", "TAG_GONE", "TAG_UNDEFINED"} <= codes
    assert "ISSUE_CPC_SEARCH" in codes and "IMPROVE_CPC_PMAX" in codes and "IMPROVE_CPC_OTHER" in codes
    assert all(r["recommended_actions"] for r in out) and all(r["action_checklist"] for r in out)
    assert len(ACTION_RULES) == 4 + 9 + 1 + 9 + 2 and len(CHECK_RULES) == 4 + 18
    assert rules_sql("action", "code", "t", "m", "d", "c").startswith("CASE WHEN t = 'LOW_VOL'")


def test_code_expressions_equal_rule_chains(spark):
    from roaslens.operators.policy import (action_checklist, action_code_expr, checklist_code_expr, recommended_action,
                                           with_signals)
    rows = [(t, m, d, c) for t in ("LOW_VOL", "NEW", "GONE", "UNDEFINED", "NORMAL", None)
            for m in ("ISSUE", "IMPROVE", "DEFENSE", "", None) for d in ("CPC", "CVR", "AOV", "NONE", None)
            for c in ("Search", "pmax", "other", None)]
    df = with_signals(spark.createDataFrame(rows, "tag string, mode_tag string, primary_driver string, CHANNEL string"))
    got = df.select(action_code_expr().alias("a"), recommended_action(code=True).alias("a2"),
                    checklist_code_expr().alias("c"), action_checklist(code=True).alias("c2")).collect()
    assert all(r["a"] == r["a2"] and r["c"] == r["c2"] for r in got)
