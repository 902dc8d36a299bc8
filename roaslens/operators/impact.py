"""LMDI impact of children on their parent's ROAS change.

Every parent of every level is decomposed in the same pass: a child row of
level k (1..4) carries the key of its parent, ``(plevel, p_SUBSIDIARY,
p_CHANNEL, p_DIVISION)`` with the dims below the parent level null.  Joins and
groupings use that key, so the four levels share one set of shuffles.

Per-parent quantities (parent totals, sum of raw impacts, ...) are computed
with ``groupBy`` on the parent key and joined back: the aggregation is partial
on the map side.  A parent that owns more than ``HOT_CHILDREN`` children and a
``HOT_SHARE``-th of all is joined apart, by broadcast of its one row (there are
fewer than ``HOT_SHARE`` such parents), so its children stay spread as they
were, whatever the adaptive plan does; the others meet in a shuffle.

Selection (D9) needs only the top two children by share and the top k by
signed impact per parent; ``row_number() <= k`` is planned as a partial
``WindowGroupLimit`` before the shuffle, so each map task ships at most k rows
per parent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roaslens.config import EngineConfig
from roaslens.functions.exprs import log_mean, log_ratio, safe_ratio
from roaslens.schema import DIMENSIONS, LEVEL_NAMES, SUM_COLUMNS

IMPACT_COLUMNS = [
    "Impact_raw", "Impact_adj", "Share_childsum", "Share_parentdelta", "Residual_parent", "Residual_applied_flag",
]
PKEY = ["plevel", "p_SUBSIDIARY", "p_CHANNEL", "p_DIVISION"]
PARENT_FIELDS = ["parent_delta", "parent_roas_prev", "parent_roas_curr"]
HOT_CHILDREN, HOT_SHARE = 10_000, 1024


def _child_key(df: DataFrame) -> DataFrame:
    lv = F.col("level")
    return df.withColumns({
        "plevel": lv - 1,
        "p_SUBSIDIARY": F.when(lv >= 2, F.col("SUBSIDIARY")),
        "p_CHANNEL": F.when(lv >= 3, F.col("CHANNEL")),
        "p_DIVISION": F.when(lv >= 4, F.col("DIVISION")),
        # the child's own (deepest non-null) dimension: orders siblings
        "child_name": F.coalesce(F.col("PRODUCT"), F.col("DIVISION"), F.col("CHANNEL"), F.col("SUBSIDIARY")),
    })


def _join_on_pkey(left: DataFrame, right: DataFrame, hot: bool = False, how: str = "left") -> DataFrame:
    """Equi-join on the parent key; dims below the parent level are null on both sides."""
    r = right.withColumnsRenamed({k: f"__r_{k}" for k in PKEY})
    cond = [left["plevel"] == r["__r_plevel"]] + [left[k].eqNullSafe(r[f"__r_{k}"]) for k in PKEY[1:]]
    return left.join(F.broadcast(r) if hot else r, cond, how).drop(*[f"__r_{k}" for k in PKEY])


def hot_parents(children: DataFrame) -> DataFrame | None:
    """The keys of parents with very many children (fewer than ``HOT_SHARE``), or None without any."""
    counts = children.groupBy(*PKEY).agg(F.count(F.lit(1)).alias("__n"))
    hot = counts.filter(F.col("__n") > HOT_CHILDREN).orderBy(F.desc("__n")).limit(HOT_SHARE).collect()
    if not hot:
        return None
    total = children.count()
    rows = [tuple(r[k] for k in PKEY) for r in hot if r["__n"] * HOT_SHARE > total]
    return children.sparkSession.createDataFrame(rows, "plevel int, p_SUBSIDIARY string, p_CHANNEL string, p_DIVISION string") if rows else None


def all_child_impacts(levels: DataFrame, child_level: int | None = None) -> DataFrame:
    """D1-D7 for every child row of levels 1..4 (``level`` = child level), or of ``child_level`` alone.

    Output: ``level``, 4 dims (null below the level), parent key, child_name,
    8 sums, the impact columns and the parent fields.
    """
    of = (F.col("level") >= 1) if child_level is None else (F.col("level") == child_level)
    children = _child_key(levels.filter(of))
    above = (F.col("level") <= 3) if child_level is None else (F.col("level") == child_level - 1)
    ptot = levels.filter(above).select(
        F.col("level").alias("plevel"),
        F.col("SUBSIDIARY").alias("p_SUBSIDIARY"), F.col("CHANNEL").alias("p_CHANNEL"), F.col("DIVISION").alias("p_DIVISION"),
        F.col("Revenue_curr_sum").alias("__p_rev_c"), F.col("Revenue_prev_sum").alias("__p_rev_p"),
        F.col("Spend_curr_sum").alias("__p_sp_c"), F.col("Spend_prev_sum").alias("__p_sp_p"),
    )
    hot = hot_parents(children)
    if hot is None:
        return _impacts(children, ptot, False)
    apart = _impacts(_join_on_pkey(children, hot, True, "left_semi"), _join_on_pkey(ptot, hot, True, "left_semi"), True)
    return apart.unionByName(_impacts(_join_on_pkey(children, hot, True, "left_anti"), ptot, False))


def _impacts(children: DataFrame, ptot: DataFrame, hot: bool) -> DataFrame:
    x = _join_on_pkey(children, ptot, hot)
    pc = safe_ratio("__p_rev_c", "__p_sp_c")
    pp = safe_ratio("__p_rev_p", "__p_sp_p")
    x = x.withColumns({
        "parent_roas_curr": pc,
        "parent_roas_prev": pp,
        "parent_delta": F.coalesce(pc, F.lit(0.0)) - F.coalesce(pp, F.lit(0.0)),
        "__cc": safe_ratio("Revenue_curr_sum", "__p_sp_c"),
        "__cp": safe_ratio("Revenue_prev_sum", "__p_sp_p"),
    })
    lc = log_mean("__cc", "__cp")
    lp = log_mean("parent_roas_curr", "parent_roas_prev")
    lr = log_ratio("parent_roas_curr", "parent_roas_prev")
    valid = (
        (F.col("__cc") > 0) & (F.col("__cp") > 0)
        & (F.col("parent_roas_curr") > 0) & (F.col("parent_roas_prev") > 0)
        & lc.isNotNull() & lp.isNotNull() & lr.isNotNull()
    )
    x = x.withColumn(
        "Impact_raw",
        F.when(valid, (lc / lp) * lr * F.col("parent_delta")).otherwise(F.col("__cc") - F.col("__cp")),
    )

    # Residual per parent, allocated by |raw| (or evenly when all raw are 0 / null)
    s1 = x.groupBy(*PKEY).agg(
        F.coalesce(F.sum("Impact_raw"), F.lit(0.0)).alias("__sraw"),
        F.coalesce(F.sum(F.abs("Impact_raw")), F.lit(0.0)).alias("__sabs"),
        F.count(F.lit(1)).alias("__n"),
    )
    x = _join_on_pkey(x, s1, hot)
    x = x.withColumn("Residual_parent", F.col("parent_delta") - F.col("__sraw"))
    alloc = (
        F.when(F.col("__sabs") > 0, (F.abs("Impact_raw") / F.col("__sabs")) * F.col("Residual_parent"))
        .otherwise(F.col("Residual_parent") / F.col("__n"))
    )
    x = x.withColumn("__alloc", alloc).withColumns({
        "Residual_applied_flag": F.abs("__alloc") > F.lit(1e-12),
        "Impact_adj": F.col("Impact_raw") + F.col("__alloc"),
    })

    # shares
    s2 = x.groupBy(*PKEY).agg(F.coalesce(F.sum(F.abs("Impact_adj")), F.lit(0.0)).alias("__sadj"))
    x = _join_on_pkey(x, s2, hot)
    x = x.withColumns({
        "Share_childsum": F.when(F.col("__sadj") > 0, F.abs("Impact_adj") / F.col("__sadj")).otherwise(F.lit(0.0)),
        "Share_parentdelta": F.when(F.abs("parent_delta") > 0, F.abs("Impact_adj") / F.abs("parent_delta")).otherwise(F.lit(0.0)),
    })
    return x.select("level", *DIMENSIONS, *PKEY, "child_name", *SUM_COLUMNS, *IMPACT_COLUMNS, *PARENT_FIELDS)


def child_impacts(levels: DataFrame, child_level: int) -> DataFrame:
    """Impacts of the children of ``child_level`` only."""
    return all_child_impacts(levels, child_level)


def _topk(df: DataFrame, order: list[Column], k: int, src: str) -> DataFrame:
    w = Window.partitionBy(*PKEY).orderBy(*order)
    return df.withColumn("sel_rank", F.row_number().over(w)).filter(F.col("sel_rank") <= k).withColumn("__src", F.lit(src))


def select_children(impacts: DataFrame, cfg: EngineConfig) -> DataFrame:
    """D9 for every parent: candidate rows with the parent's rule and a ``selected`` flag.

    Candidates are the top 2 by share and the top k negative / positive by
    ``Impact_adj``; ``sel_rank`` orders the selected children of a parent.
    """
    name = F.col("child_name").asc()
    share = _topk(impacts, [F.col("Share_childsum").desc(), name], 2, "S")
    neg = _topk(impacts.filter(F.col("Impact_adj") < 0), [F.col("Impact_adj").asc(), name], cfg.wide_top_k, "N")
    pos = _topk(impacts.filter(F.col("Impact_adj") > 0), [F.col("Impact_adj").desc(), name], cfg.wide_top_k, "P")
    cand = reduce(DataFrame.unionByName, [share, neg, pos])

    # at most 2 + 2k rows per parent here: a per-parent window is cheap
    wp = Window.partitionBy(*PKEY)
    is_top = lambda r: (F.col("__src") == "S") & (F.col("sel_rank") == r)
    cand = cand.withColumns({
        "top1_share": F.coalesce(F.max(F.when(is_top(1), F.col("Share_childsum"))).over(wp), F.lit(0.0)),
        "top2_share": F.coalesce(F.max(F.when(is_top(2), F.col("Share_childsum"))).over(wp), F.lit(0.0)),
        "__top1_abs": F.coalesce(F.max(F.when(is_top(1), F.abs("Impact_adj"))).over(wp), F.lit(0.0)),
        "impact_floor": F.greatest(F.lit(float(cfg.abs_floor)), F.abs(F.coalesce("parent_roas_prev", F.lit(0.0))) * F.lit(cfg.rel_floor)),
    })
    single = (
        (F.col("top1_share") >= cfg.single_share_min)
        & ((F.col("top1_share") - F.col("top2_share")) >= cfg.single_gap_min)
        & (F.col("__top1_abs") >= F.col("impact_floor"))
    )
    rule = (
        F.when(single, F.lit("SINGLE"))
        .when(F.col("parent_delta") < 0, F.lit("WIDE_NEG"))
        .when(F.col("parent_delta") > 0, F.lit("WIDE_POS"))
        .otherwise(F.lit("STOP_ZERO_DELTA"))
    )
    cand = cand.withColumn("rule", rule)
    selected = (
        ((F.col("rule") == "SINGLE") & (F.col("__src") == "S") & (F.col("sel_rank") == 1))
        | ((F.col("rule") == "WIDE_NEG") & (F.col("__src") == "N"))
        | ((F.col("rule") == "WIDE_POS") & (F.col("__src") == "P"))
    )
    return cand.withColumn("selected", selected).drop("__top1_abs")


def selected_children(cand: DataFrame) -> DataFrame:
    return cand.filter("selected").drop("__src", "selected")


def parent_events(cand: DataFrame) -> DataFrame:
    """One row per parent: rule, shares, floor, parent delta (trace event fields)."""
    return (
        cand.filter((F.col("__src") == "S") & (F.col("sel_rank") == 1))
        .select(
            *PKEY, F.col("level").alias("lvl"), "rule", "parent_delta",
            F.col("top1_share").alias("top1_share_childsum"), F.col("top2_share").alias("top2_share_childsum"),
            "impact_floor",
        )
    )


def node_struct() -> Column:
    """Drill-trace node of a selected child (its own level and path)."""
    path = F.struct(*[F.col(d).alias(d) for d in DIMENSIONS])
    level = F.concat(F.lit("LEVEL"), F.col("level").cast("string"))
    return F.struct(
        level.alias("level"), F.col("rule").alias("rule"), path.alias("selected_path"),
        F.col("Impact_adj").alias("impact_adj"), F.col("Share_childsum").alias("share_childsum"),
    )


__all__ = [
    "IMPACT_COLUMNS", "PKEY", "all_child_impacts", "child_impacts", "select_children", "selected_children",
    "parent_events", "node_struct", "LEVEL_NAMES",
]
