"""Drill-down (D10-D14) and candidate selection.

The reference walks parents one at a time in Python.  Here each level is one
set-based step over *all* reached parents: the selected children of level k
become the parent key set of level k+1 (an inner join on the parent dims), so
the whole drill is a fixed chain of at most four steps, independent of the
number of subsidiaries, and the plan never loops over data on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roaslens.config import EngineConfig
from roaslens.functions.exprs import dsum, pct_change, safe_ratio
from roaslens.operators.impact import (
    IMPACT_COLUMNS, PKEY, all_child_impacts, child_impacts, node_struct, parent_events, select_children,
    selected_children,
)
from roaslens.operators.levels import level_rollup, level_rows
from roaslens.schema import DIMENSIONS, LEVEL_NAMES, SUM_COLUMNS, dims_of
from roaslens.session import cut

CANDIDATE_METRICS = ["rev_yoy_pct", "spend_yoy_pct", "roas_curr", "roas_prev", "roas_yoy_pct", "defense_score_pct"]


@dataclass
class DrillResult:
    leaves: DataFrame   # selected leaves: dims, sums, impact columns, drill_trace, rank keys
    events: DataFrame   # one row per visited parent, ordered by (focus, lvl, rank path)
    start_depth: int


def _path_struct(dims: list[str]):
    return F.struct(*[(F.col(d) if d in dims else F.lit(None).cast("string")).alias(d) for d in DIMENSIONS])


def _as_parent_key(df: DataFrame, level: int) -> DataFrame:
    """Key columns of rows of ``level`` seen as parents of the next level."""
    dims = dims_of(level)
    return df.withColumns({
        "plevel": F.lit(level),
        **{f"p_{d}": (F.col(d) if d in dims else F.lit(None).cast("string")) for d in DIMENSIONS[:3]},
    })


def _join_pkey(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    r = right.withColumnsRenamed({k: f"__r_{k}" for k in PKEY})
    cond = [left["plevel"] == r["__r_plevel"]] + [left[k].eqNullSafe(r[f"__r_{k}"]) for k in PKEY[1:]]
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in PKEY])


def drill_candidates(levels: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Selection candidates of every parent at every level (small: <= 2 + 2k rows per parent), cut."""
    # the impacts are one row per hierarchy node (level-sized, far below the input);
    # cutting them keeps the three top-k branches from re-planning the aggregates
    return cut(select_children(cut(all_child_impacts(levels)), cfg))


def drill(levels: DataFrame, cfg: EngineConfig, start_depth: int = 1, cand: DataFrame | None = None) -> DrillResult:
    """Walk levels ``start_depth+1 .. 4`` from every row of level ``start_depth``.

    ``start_depth=1`` is the per-subsidiary analysis for all subsidiaries at
    once; ``start_depth=0`` is the unfocused run from the grand total.  The
    decomposition and selection of every parent is computed once
    (``drill_candidates``); the walk itself is reachability: the selected
    children of the reached parents become the reached parents of the next
    level (one small join per level).
    """
    if not 0 <= start_depth <= 3:
        raise ValueError("start_depth must be 0..3 (use terminal_focus for a full path)")
    if cand is None:
        cand = drill_candidates(levels, cfg)
    sel = selected_children(cand).withColumn("node", node_struct())
    ev_all = parent_events(cand)
    reached = _as_parent_key(levels.filter(F.col("level") == start_depth), start_depth).select(
        *PKEY, F.array().cast("array<struct<level:string,rule:string,selected_path:struct<SUBSIDIARY:string,CHANNEL:string,DIVISION:string,PRODUCT:string>,impact_adj:double,share_childsum:double>>").alias("drill_trace")
    )
    all_ranks = [f"rank{k}" for k in range(start_depth + 1, 5)]
    rank_cols: list[str] = []
    events = []
    leaves = None
    for child_level in range(start_depth + 1, 5):
        cdims = dims_of(child_level)
        rank = f"rank{child_level}"
        got = _join_pkey(sel.filter(F.col("level") == child_level), reached)
        got = got.withColumns({
            rank: F.col("sel_rank").cast("long"),
            "drill_trace": F.concat(F.col("drill_trace"), F.array(F.col("node"))),
        })
        paths = sel.filter(F.col("level") == child_level).groupBy(*PKEY).agg(
            F.array_sort(F.collect_list(F.struct(F.col("sel_rank").alias("r"), _path_struct(cdims).alias("p")))).alias("__paths")
        )
        ev = _join_pkey(ev_all.filter(F.col("lvl") == child_level), reached.select(*PKEY, *rank_cols))
        ev = _join_pkey(ev, paths, "left")
        ev = ev.withColumns({
            "level": F.lit(LEVEL_NAMES[child_level]),
            "selected_paths": F.coalesce(F.transform("__paths", lambda s: s.getField("p")), F.array()),
            "parent_path": F.struct(*[F.col(f"p_{d}").alias(d) for d in DIMENSIONS[:3]], F.lit(None).cast("string").alias("PRODUCT")),
        }).drop("__paths")
        for r in all_ranks:
            if r not in ev.columns:
                ev = ev.withColumn(r, F.lit(None).cast("long"))
        events.append(ev.select(
            (F.col("p_SUBSIDIARY") if start_depth >= 1 else F.lit(None).cast("string")).alias("focus_SUBSIDIARY"),
            "lvl", "level", "rule", "parent_path", "parent_delta", "top1_share_childsum", "top2_share_childsum",
            "impact_floor", "selected_paths", *all_ranks,
        ))
        rank_cols = rank_cols + [rank]
        if child_level < 4:
            reached = _as_parent_key(got, child_level).select(*PKEY, *rank_cols, "drill_trace")
        else:
            leaves = got
    leaves = leaves.select(*DIMENSIONS, *SUM_COLUMNS, *IMPACT_COLUMNS, "drill_trace", *rank_cols)
    return DrillResult(leaves=leaves, events=reduce(DataFrame.unionByName, events), start_depth=start_depth)


def terminal_focus(levels: DataFrame, focus: dict[str, str]) -> DrillResult:
    """Focus on a full 4-dim path; the leaf is the only child of its parent."""
    imp = child_impacts(levels, 4).filter(reduce(lambda a, b: a & b, [F.col(d) == F.lit(focus[d]) for d in DIMENSIONS]))
    path = F.struct(*[F.lit(focus[d]).alias(d) for d in DIMENSIONS])
    node = F.struct(
        F.lit(LEVEL_NAMES[4]).alias("level"), F.lit("FOCUS_TERMINAL").alias("rule"), path.alias("selected_path"),
        F.col("Impact_adj").alias("impact_adj"), F.col("Share_childsum").alias("share_childsum"),
    )
    imp = imp.drop("level")
    leaves = imp.limit(1).withColumn("drill_trace", F.array(node)).select(
        *DIMENSIONS, *SUM_COLUMNS, *IMPACT_COLUMNS, "drill_trace", F.lit(1).cast("long").alias("rank4"),
    )
    events = imp.limit(1).select(
        F.lit(focus["SUBSIDIARY"]).alias("focus_SUBSIDIARY"), F.lit(4).alias("lvl"), F.lit(LEVEL_NAMES[4]).alias("level"),
        F.lit("FOCUS_TERMINAL").alias("rule"), _path_struct(dims_of(3)).alias("parent_path"), "parent_delta",
        F.lit(None).cast("double").alias("top1_share_childsum"), F.lit(None).cast("double").alias("top2_share_childsum"),
        F.lit(None).cast("double").alias("impact_floor"), F.array(path).alias("selected_paths"),
        F.lit(1).cast("long").alias("rank4"),
    )
    return DrillResult(leaves=leaves, events=events, start_depth=4)


def validate_focus(focus: dict[str, str] | None) -> dict[str, str]:
    """a focus names the top of the hierarchy without a gap; returned in hierarchy order."""
    focus = dict(focus or {})
    path = {d: focus[d] for d in DIMENSIONS[: len(focus)] if d in focus}
    if len(path) < len(focus):
        raise ValueError(f"Invalid focus {sorted(focus)}: no prefix of the levels from {DIMENSIONS[0]} down")
    return path


def apply_focus(engine: DataFrame, focus: dict[str, str]) -> DataFrame:
    """The engine rows under a focus."""
    wanted = [F.col(d) == v for d, v in focus.items()]
    return engine.filter(reduce(lambda a, b: a & b, wanted)) if wanted else engine


# ------------------------------------------------------------------ W4, W6-W8

def candidate_metrics(df: DataFrame) -> DataFrame:
    """YoY, ROAS and defense score of each candidate leaf."""
    rc, rp, sc, sp = (F.col(c) for c in ("Revenue_curr_sum", "Revenue_prev_sum", "Spend_curr_sum", "Spend_prev_sum"))
    df = df.withColumns({
        "rev_yoy_pct": pct_change(rc, rp),
        "spend_yoy_pct": pct_change(sc, sp),
        "roas_curr": safe_ratio(rc, sc),
        "roas_prev": safe_ratio(rp, sp),
    })
    return df.withColumns({
        "roas_yoy_pct": pct_change("roas_curr", "roas_prev"),
        "defense_score_pct": F.col("rev_yoy_pct") - F.col("spend_yoy_pct"),
    })


def _defense_ok(cfg: EngineConfig, prefix: str = "") -> F.Column:
    d, r, v = (F.col(prefix + c) for c in ("defense_score_pct", "roas_yoy_pct", "rev_yoy_pct"))
    return F.coalesce((d > 0) & (r > 0) & (v > F.lit(-cfg.phantom_drop_threshold)), F.lit(False))


def scope_eligibility(levels: DataFrame, cfg: EngineConfig, scope_level: int = 1) -> DataFrame:
    """Defense eligibility of each scope (a subsidiary by default)."""
    dims = dims_of(scope_level)
    return candidate_metrics(level_rows(levels, scope_level)).select(
        *dims, _defense_ok(cfg).alias("scope_defense_eligible")
    )


def _scope_dims(start_depth: int) -> list[str]:
    return dims_of(max(1, min(start_depth, 4)))


def _rank_within(df: DataFrame, keys: list[str], order: list) -> F.Column:
    w = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
    return F.row_number().over(w)


def select_issues(cands: DataFrame, start_depth: int, cfg: EngineConfig) -> DataFrame:
    """Three most negative ``Impact_adj`` per scope."""
    keys = _scope_dims(start_depth) if start_depth >= 1 else []
    rn = _rank_within(cands, keys, [F.col("Impact_adj").asc(), *[F.col(d).asc() for d in DIMENSIONS]])
    return (
        cands.filter(F.col("Impact_adj") < 0).withColumn("mode_rank", rn)
        .filter(F.col("mode_rank") <= cfg.wide_top_k)
        .withColumns({"mode_tag": F.lit("ISSUE"), "mode_rank": F.col("mode_rank").cast("long")})
    )


def select_improvements(cands: DataFrame, levels: DataFrame, start_depth: int, cfg: EngineConfig) -> DataFrame:
    """Three most positive ``Impact_adj``; free slots go to DEFENSE candidates.

    One ranking ordered by (class, key) fills the slots exactly like "take
    growth first, then the best defenders".
    """
    keys = _scope_dims(start_depth) if start_depth >= 1 else []
    scope = scope_eligibility(levels, cfg, 1 if start_depth <= 1 else start_depth)
    scope_keys = dims_of(1 if start_depth <= 1 else start_depth)
    x = cands.join(scope, scope_keys, "left")
    adj = F.coalesce(F.col("Impact_adj"), F.lit(0.0))
    defense = F.coalesce(F.col("scope_defense_eligible"), F.lit(False)) & _defense_ok(cfg)
    cls = F.when(adj > 0, F.lit(0)).when(defense, F.lit(1))
    x = x.withColumn("__cls", cls).filter(F.col("__cls").isNotNull())
    key = F.when(F.col("__cls") == 0, -adj).otherwise(-F.coalesce(F.col("defense_score_pct"), F.lit(-1e9)))
    rn = _rank_within(x, keys, [F.col("__cls").asc(), key.asc(), (-adj).asc(), *[F.col(d).asc() for d in DIMENSIONS]])
    return (
        x.withColumn("mode_rank", rn).filter(F.col("mode_rank") <= cfg.wide_top_k)
        .withColumns({
            "mode_tag": F.when(F.col("__cls") == 0, F.lit("IMPROVE")).otherwise(F.lit("DEFENSE")),
            "mode_rank": F.col("mode_rank").cast("long"),
        })
        .drop("__cls", "scope_defense_eligible")
    )


@dataclass
class ImpactRun:
    levels: DataFrame
    drill: DrillResult
    candidates: DataFrame
    issues: DataFrame
    improvements: DataFrame


def run_impact(engine: DataFrame, cfg: EngineConfig, focus: dict[str, str] | None = None,
               per_subsidiary: bool = True, levels: DataFrame | None = None,
               cand: DataFrame | None = None) -> ImpactRun:
    """Decomposition, drill, candidates and selections.

    ``per_subsidiary=True`` reproduces the pipeline (every subsidiary is its own
    focus, all in one plan); otherwise the run starts at ``len(focus)``.
    """
    focus = validate_focus(focus)
    if focus:
        engine = apply_focus(engine, focus)
    if focus and (levels is not None or cand is not None):
        raise ValueError("levels and candidates of all subsidiaries can't be used with a focus")
    if levels is None:
        levels = cut(level_rollup(engine))
    start = max(len(focus), 1) if per_subsidiary else len(focus)
    if start >= 4:
        d = terminal_focus(levels, focus)
    else:
        d = drill(levels, cfg, start, cand)
    cands = candidate_metrics(d.leaves)
    return ImpactRun(
        levels=levels, drill=d, candidates=cands,
        issues=select_issues(cands, d.start_depth, cfg),
        improvements=select_improvements(cands, levels, d.start_depth, cfg),
    )


def dedupe_campaigns(rows: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Merge rows with the same 4-dim key (union helper for several drill runs).

    ``order`` names the columns that put the rows of a key in order (run, then rank): sums and impacts add up, the
    residual flag is OR-ed, traces are kept as a list in that order (a key is reached once per run, so
    the list is bounded by the number of runs), other columns are those of the first row.  All columns break
    ties, so the result does not depend on partitioning; the list of traces is then sorted too.
    """
    add = [*SUM_COLUMNS, "Impact_raw", "Impact_adj", "Residual_parent"]
    other = [c for c in rows.columns if c not in DIMENSIONS + add + ["Residual_applied_flag", "drill_trace"]]
    # nulls first, as in an ascending sort: a struct compares its fields in turn
    place = F.struct(*[F.col(c) for c in [*order, *[c for c in rows.columns if c not in order]]])
    aggs = [dsum(F.coalesce(F.col(c), F.lit(0.0))).alias(c) for c in add]
    aggs.append(F.bool_or(F.coalesce(F.col("Residual_applied_flag"), F.lit(False))).alias("Residual_applied_flag"))
    if "drill_trace" in rows.columns:
        traced = F.array_sort(F.collect_list(F.struct(place.alias("place"), F.col("drill_trace").alias("trace"))))
        aggs.append(F.transform(traced, lambda t: t.getField("trace")).alias("drill_traces"))
    if other:
        aggs.append(F.min(place).alias("__first"))
    out = rows.groupBy(*DIMENSIONS).agg(*aggs)
    return out.select(*[c for c in out.columns if c != "__first"], *[F.col("__first").getField(c).alias(c) for c in other])
