"""End to end on the smallest test scale, properties and plan shape."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from roaslens.config import EngineConfig
from roaslens.operators.drill import run_impact, validate_focus
from roaslens.operators.impact import all_child_impacts, select_children
from roaslens.operators.levels import level_rollup
from roaslens.plans.pipeline import build_report
from roaslens.session import cut
from roaslens.sources.ingest import engine_frame
from roaslens.sources.mapped import mapped_long_table

CFG = EngineConfig(2000, 1999)


@pytest.fixture(scope="module")
def engine(spark):
    return cut(engine_frame(mapped_long_table(spark, SF_SMALL, (2000, 1999)), CFG))


@pytest.fixture(scope="module")
def report(engine):
    return build_report(engine, CFG)


def test_report_tables(report):
    t = report.tables
    n_sub = report.analysis.subsidiaries.count()
    assert n_sub == 5
    assert 0 < t["issues"].count() <= 3 * n_sub
    assert 0 < t["improvements"].count() <= 3 * n_sub
    assert len(t["issues"].columns) == 38
    assert t["division_parallel"].count() > 0
    steps = [r["step"] for r in t["trace"].orderBy("step").collect()]
    assert steps == list(range(1, len(steps) + 1))
    reps = report.sections["subsidiary_reports"].collect()
    assert len(reps) == n_sub and all(r["mode"] in ("ISSUE", "IMPROVE") for r in reps)


def test_impacts_sum_to_parent_delta(report):
    imp = all_child_impacts(report.analysis.levels)
    per_parent = imp.groupBy("plevel", "p_SUBSIDIARY", "p_CHANNEL", "p_DIVISION").agg(
        F.sum("Impact_adj").alias("s"), F.first("parent_delta").alias("d"),
        F.count_if(F.col("Impact_adj").isNull()).alias("nulls"), F.sum("Share_childsum").alias("sh"))
    for r in per_parent.collect():
        if r["nulls"] == 0:
            assert r["s"] == pytest.approx(r["d"], abs=1e-9)
        if r["sh"] and r["sh"] > 0:
            assert r["sh"] == pytest.approx(1.0)


def test_selection_limits(report):
    sel = report.analysis.selected
    per = sel.groupBy("diagnosis_subsidiary", "list").count().collect()
    assert all(r["count"] <= 3 for r in per)
    iss = report.analysis.issues.collect()
    assert all(r["Impact_adj"] < 0 and r["mode_tag"] == "ISSUE" for r in iss)
    assert all(r["primary_driver"] in ("CPC", "CVR", "AOV") for r in sel.collect())


def test_partitioning_does_not_change_results(spark, engine):
    a = run_impact(engine, CFG).issues.select("SUBSIDIARY", "CHANNEL", "DIVISION", "PRODUCT", "Impact_adj").collect()
    b = run_impact(engine.repartition(3, "PRODUCT").sortWithinPartitions(F.rand(1)), CFG).issues.select(
        "SUBSIDIARY", "CHANNEL", "DIVISION", "PRODUCT", "Impact_adj").collect()
    key = lambda r: (r[0], r[1], r[2], r[3])
    assert [key(r) for r in sorted(a, key=key)] == [key(r) for r in sorted(b, key=key)]
    for x, y in zip(sorted(a, key=key), sorted(b, key=key)):
        assert x["Impact_adj"] == pytest.approx(y["Impact_adj"], abs=1e-12)


def test_all_subsidiaries_equals_each_focused(spark, engine):
    """Running every subsidiary at once equals focusing on each one (property h)."""
    together = {tuple(r[:4]) for r in run_impact(engine, CFG).issues.select("SUBSIDIARY", "CHANNEL", "DIVISION", "PRODUCT").collect()}
    subs = [r[0] for r in engine.select("SUBSIDIARY").distinct().collect()]
    focused = set()
    for s in subs[:2]:
        r = run_impact(engine, CFG, focus={"SUBSIDIARY": s}).issues.select("SUBSIDIARY", "CHANNEL", "DIVISION", "PRODUCT")
        focused |= {tuple(x) for x in r.collect()}
    assert focused == {t for t in together if t[0] in subs[:2]}


def test_focus_validation():
    assert validate_focus(None) == {}
    with pytest.raises(ValueError, match="Invalid"):
        validate_focus({"REGION": "x"})
    with pytest.raises(ValueError, match="prefix"):
        validate_focus({"CHANNEL": "x"})


def test_terminal_focus(spark, engine):
    both_years = (F.col("Spend_prev") > 0) & (F.col("Revenue_prev") > 0) & (F.col("Revenue_curr") > 0)
    leaf = engine.filter(both_years).select("SUBSIDIARY", "CHANNEL", "DIVISION", "PRODUCT").first().asDict()
    run = run_impact(engine, CFG, focus=leaf)
    rows = run.drill.leaves.collect()
    assert len(rows) == 1 and rows[0]["drill_trace"][0]["rule"] == "FOCUS_TERMINAL"
    assert rows[0]["Share_childsum"] == 1.0


def test_plan_shape(spark, engine):
    """No Python in the plan, top-k as WindowGroupLimit, filters and pruning at the scan."""
    lv = level_rollup(engine)
    plan = select_children(all_child_impacts(lv), CFG)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "Python" not in plan and "ArrowEval" not in plan
    raw_plan = engine_frame(mapped_long_table(spark, SF_SMALL, (2000, 1999)), CFG)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in raw_plan
    assert "l_tax" not in raw_plan  # column pruning: unused lineitem columns are not read
