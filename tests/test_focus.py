"""Many focuses in one plan against one run a focus; merging of runs; global positions."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from conftest import engine_rows
from roaslens.config import EngineConfig
from roaslens.functions.exprs import trace_text
from roaslens.operators.drill import dedupe_campaigns, run_impact
from roaslens.operators.focus import FOCUS, RANKS, focus_table, run_focuses
from roaslens.operators.levels import level_rollup
from roaslens.scale import join_split, numbered
from roaslens.schema import DIMENSIONS, SUM_COLUMNS
from roaslens.session import cut

CFG = EngineConfig(2026, 2025)


@pytest.fixture(scope="module")
def engine(spark):
    rng = random.Random(11)
    rows = []
    for s, c, d, p in itertools.product(("S1", "S2"), ("Search", "PMax"), ("MX", "VD"), ("P1", "P2", "P3")):
        if rng.random() < 0.85:
            rows.append((s, c, d, p, *[rng.choice([0, rng.randint(1, 400), rng.randint(1, 400)]) if k else rng.randint(1, 300) for k in range(8)]))
    return engine_rows(spark, rows).cache()


@pytest.fixture(scope="module")
def levels(engine):
    return cut(level_rollup(engine))


def _rows(df, cols):
    r = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(r(x) for x in row) for row in df.select(*cols).collect()), key=str)


LEAF = [*DIMENSIONS, *SUM_COLUMNS, "Impact_raw", "Impact_adj", "Share_childsum", "Residual_parent", "trace"]


def test_equal_to_single_runs(engine, levels):
    run = run_focuses(levels, CFG, focus_table(levels))
    leaves = run.leaves.withColumn("trace", trace_text("drill_trace")).cache()
    ev = run.events.withColumn("paths", F.to_json("selected_paths")).withColumn("above", F.to_json("parent_path")).cache()
    ev_cols = ["lvl", "rule", "above", "paths", "parent_delta", "top1_share_childsum", "impact_floor"]
    mine, my_events = {}, {}
    for row in leaves.select(*FOCUS, *LEAF).collect():
        mine.setdefault(tuple(row[f] for f in FOCUS[1:]), []).append(tuple(round(x, 9) if isinstance(x, float) else x for x in row[5:]))
    for row in ev.select(*FOCUS, *ev_cols).collect():
        my_events.setdefault(tuple(row[f] for f in FOCUS[1:]), []).append(tuple(round(x, 9) if isinstance(x, float) else x for x in row[5:]))
    picked = {}
    for part in (run.issues, run.improvements):
        for row in part.collect():
            picked.setdefault(tuple(row[f] for f in FOCUS[1:]), []).append((row["mode_tag"], row["mode_rank"], *[row[d] for d in DIMENSIONS]))
    nodes = [tuple(r) for r in levels.select(*DIMENSIONS).distinct().collect()]
    rng = random.Random(2)
    some = [rng.choice([n for n in nodes if sum(v is not None for v in n) == k]) for k in range(5)]
    for node in some:
        focus = {d: v for d, v in zip(DIMENSIONS, node) if v is not None}
        one = run_impact(engine, CFG, focus, per_subsidiary=False)
        want = one.drill.leaves.withColumn("trace", trace_text("drill_trace"))
        assert sorted(mine.get(node, []), key=str) == _rows(want, LEAF), node
        events = one.drill.events.withColumn("paths", F.to_json("selected_paths")).withColumn("above", F.to_json("parent_path"))
        assert sorted(my_events.get(node, []), key=str) == _rows(events, ev_cols), node
        sel = [tuple(r) for part in (one.issues, one.improvements) for r in part.select("mode_tag", "mode_rank", *DIMENSIONS).collect()]
        assert sorted(picked.get(node, [])) == sorted(sel), node


def test_gap_in_a_focus(spark):
    with pytest.raises(Exception, match="focus is no prefix"):
        focus_table(spark.createDataFrame([("S1", None, "MX", None)], ", ".join(f"{d} string" for d in DIMENSIONS))).collect()


def test_merge_of_runs_in_any_partitioning(levels):
    rows = run_focuses(levels, CFG, focus_table(levels)).leaves.withColumn("note", F.concat_ws("/", *[c for c in FOCUS]))
    plain = rows.collect()
    by = {}
    for r in plain:
        by.setdefault(tuple(r[d] for d in DIMENSIONS), []).append(r)
    key = lambda r: tuple((r[c] is not None, r[c] if r[c] is not None else 0) for c in [*FOCUS, *RANKS])
    results = []
    for n in (1, 7):
        merged = dedupe_campaigns(rows.repartition(n, F.rand(n)), [*FOCUS, *RANKS])
        got = {tuple(r[d] for d in DIMENSIONS): r for r in merged.collect()}
        assert got.keys() == by.keys()
        for k, runs in by.items():
            runs = sorted(runs, key=key)
            assert got[k]["note"] == runs[0]["note"] and got[k]["rank4"] == runs[0]["rank4"]
            assert got[k]["drill_traces"] == [r["drill_trace"] for r in runs]
            assert got[k]["Revenue_curr_sum"] == pytest.approx(sum(r["Revenue_curr_sum"] for r in runs))
        results.append(sorted((k, r["note"], str(r["drill_traces"])) for k, r in got.items()))
    assert results[0] == results[1]


def test_numbered_over_partitions(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.randint(0, 5), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, v int, i int").repartition(6)
    got = numbered(df, [F.col("k").asc_nulls_first(), F.col("v").desc(), F.col("i").asc()], parts=5)
    assert "RangePartitioning" not in got._jdf.queryExecution().executedPlan().toString()  # positions come from written facts
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", -r[1], r[2]))
    assert [(r.k, r.v, r.i) for r in sorted(got.collect(), key=lambda r: r.position)] == order
    assert sorted(r.position for r in got.collect()) == list(range(1, 501))
    assert numbered(df.limit(0), [F.col("i").asc()]).count() == 0


def test_join_split_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id").repartition(8)
        right = left.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("x", F.col("k") * 2)
        for how in ("inner", "left"):
            got = join_split(left, right.filter("k != 7"), ["k"], "n", 40_000, how, keys=100)
            rows = got.select("k", "id", "x").collect()
            assert len(rows) == (39_999 if how == "inner" else 40_000) and all(r.x == 2 * r.k or r.k == 7 for r in rows)
            sizes = [n for n in got.filter("k != 0").rdd.glom().map(len).collect() if n]
            assert max(sizes) < 10_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
