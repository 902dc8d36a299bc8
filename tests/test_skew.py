"""A hot parent: one division with 3,000 products spread over many input partitions.

The selection uses partial per-parent top-k before the shuffle and per-parent
sums by aggregate + join; the result must equal a brute-force computation.
"""

import math
import random

import pytest

from conftest import engine_rows
from roaslens.config import EngineConfig
from roaslens.operators.impact import all_child_impacts, select_children, selected_children
from roaslens.operators.levels import level_rollup


def L(x, y):
    return x if x == y else (x - y) / (math.log(x) - math.log(y))


def test_hot_parent_matches_brute_force(spark):
    rng = random.Random(3)
    prods = {f"p{i:04d}": (rng.randint(10, 99), rng.randint(10, 99), rng.randint(100, 999), rng.randint(100, 999))
             for i in range(3000)}
    rows = [("S", "C", "MX", p, sc, sp, rc, rp, 500, 500, 20, 20) for p, (sc, sp, rc, rp) in prods.items()]
    eng = engine_rows(spark, rows).repartition(16)
    lv = level_rollup(eng)
    imp = all_child_impacts(lv).filter("level = 4")
    sel = [r["PRODUCT"] for r in selected_children(select_children(imp, EngineConfig())).orderBy("sel_rank").collect()]

    spc, spp = sum(v[0] for v in prods.values()), sum(v[1] for v in prods.values())
    pc, pp = sum(v[2] for v in prods.values()) / spc, sum(v[3] for v in prods.values()) / spp
    lm = {k: L(v[2] / spc, v[3] / spp) for k, v in prods.items()}
    tot = sum(lm.values())
    adj = {k: (pc - pp) * lm[k] / tot for k in prods}
    if pc > pp:
        expected = sorted(adj, key=lambda k: (-adj[k], k))[:3]
    else:
        expected = sorted(adj, key=lambda k: (adj[k], k))[:3]
    assert sel == expected
    got = {r["PRODUCT"]: r["Impact_adj"] for r in imp.filter("PRODUCT IN ('p0000', 'p1234', 'p2999')").collect()}
    for k, v in got.items():
        assert v == pytest.approx(adj[k], rel=1e-9)


def test_hot_parent_stays_spread(spark, monkeypatch):
    """One division owns nearly all children; no broadcast by size, no adaptive plan: its children are not dealt to one task."""
    from roaslens.operators import impact
    from roaslens.session import cut

    monkeypatch.setattr(impact, "HOT_CHILDREN", 2000)
    from pyspark.sql import functions as F
    n = 60_000
    number = F.col("id")
    eng = spark.range(n, numPartitions=12).select(
        F.lit("S").alias("SUBSIDIARY"), F.when(number < 300, F.concat(F.lit("C"), (number % 30).cast("string"))).otherwise("HOT").alias("CHANNEL"), F.lit("MX").alias("DIVISION"),
        F.concat(F.lit("p"), number.cast("string")).alias("PRODUCT"), *[((number * (k + 3)) % 97 + 3).cast("double").alias(m) for k, m in enumerate(impact_metrics())])
    lv = cut(level_rollup(eng).repartition(16))
    plain = {r["PRODUCT"]: r for r in all_child_impacts(lv, 4).collect()}
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        imp = all_child_impacts(lv, 4)
        sizes = [k for k in imp.filter("CHANNEL = 'HOT'").select("PRODUCT").rdd.glom().map(len).collect() if k]
        got = {r["PRODUCT"]: r for r in imp.collect()}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert len(sizes) >= 4 and max(sizes) < 3 * sorted(sizes)[len(sizes) // 2]
    assert got.keys() == plain.keys() and len(got) == n
    for k in ("p5", "p299", "p300", "p59999"):
        assert got[k]["Impact_adj"] == pytest.approx(plain[k]["Impact_adj"], rel=1e-9)
    monkeypatch.setattr(impact, "HOT_CHILDREN", 10**9)
    whole = {r["PRODUCT"]: r["Impact_adj"] for r in all_child_impacts(lv, 4).collect()}
    assert all(whole[k] == pytest.approx(got[k]["Impact_adj"], rel=1e-9, abs=1e-15) for k in list(whole)[::501])


def impact_metrics():
    from roaslens.schema import ENGINE_METRICS
    return ENGINE_METRICS
