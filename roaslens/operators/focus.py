"""Many focused drills in one plan.

A focus is a prefix of the hierarchy: none (the grand total), a subsidiary, down to one product.  The reference runs
one focus at a time; here a table of focuses of mixed depth is the start set of one reachability walk: at each
level the focuses that end there join the parents already reached.  Decomposition and selection of a parent do not
depend on the focus above it, so they are computed once for all.  A focus on a product is its own only child.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roaslens.config import EngineConfig
from roaslens.operators.drill import _as_parent_key, _defense_ok, _join_pkey, _path_struct, candidate_metrics, drill_candidates
from roaslens.operators.impact import IMPACT_COLUMNS, PKEY, all_child_impacts, node_struct, parent_events, selected_children
from roaslens.schema import DIMENSIONS, LEVEL_NAMES, SUM_COLUMNS, dims_of

FOCUS = ["focus_depth", *[f"focus_{d}" for d in DIMENSIONS]]
RANKS = [f"rank{k}" for k in range(1, 5)]
_TRACE = "array<struct<level:string,rule:string,selected_path:struct<SUBSIDIARY:string,CHANNEL:string,DIVISION:string,PRODUCT:string>,impact_adj:double,share_childsum:double>>"
_MARK = "\x1f"


def focus_table(paths: DataFrame) -> DataFrame:
    """focuses from the four dims of ``paths`` (null below the focus); a path with a gap raises an error."""
    given = [F.col(d).isNotNull() for d in DIMENSIONS]
    gap = reduce(lambda a, b: a | b, [below & ~above for above, below in zip(given, given[1:])])
    text = F.concat(F.lit("focus is no prefix of the levels: "), F.to_json(F.struct(*DIMENSIONS)))
    depth = F.when(gap, F.raise_error(text).cast("int")).otherwise(sum((g.cast("int") for g in given[1:]), given[0].cast("int")))
    return paths.select(depth.alias("focus_depth"), *[F.col(d).alias(f"focus_{d}") for d in DIMENSIONS]).distinct()


@dataclass
class FocusRuns:
    """One row set for all focuses, told apart by the columns ``FOCUS``."""

    leaves: DataFrame
    events: DataFrame
    issues: DataFrame
    improvements: DataFrame


def _starts(focuses: DataFrame, depth: int) -> DataFrame:
    return focuses.filter(F.col("focus_depth") == depth).select(
        *FOCUS, F.lit(depth).alias("plevel"), *[F.col(f"focus_{d}").alias(f"p_{d}") for d in DIMENSIONS[:3]],
        *[F.lit(None).cast("long").alias(r) for r in RANKS], F.array().cast(_TRACE).alias("drill_trace"),
    )


def _terminal(levels: DataFrame, focuses: DataFrame) -> DataFrame:
    """The leaves under a full focus with the impact of an only child, and their focus columns.

    Each such leaf hangs under a parent of its own with its own sums: the division gets the product's name appended for the
    decomposition, and loses it after."""
    on = [F.col(d) == F.col(f"focus_{d}") for d in DIMENSIONS]
    leaf = levels.filter(F.col("level") == 4).join(focuses.filter(F.col("focus_depth") == 4), on)
    leaf = leaf.withColumn("DIVISION", F.concat_ws(_MARK, "DIVISION", "PRODUCT"))
    parent = leaf.withColumns({"level": F.lit(3), "PRODUCT": F.lit(None).cast("string")})
    cols = ["level", *DIMENSIONS, *SUM_COLUMNS]
    own = all_child_impacts(leaf.select(*cols).unionByName(parent.select(*cols))).filter(F.col("level") == 4)
    division = F.expr("left(DIVISION, length(DIVISION) - length(PRODUCT) - 1)")
    own = own.withColumns({"DIVISION": division, "p_DIVISION": division})
    node = F.struct(F.lit(LEVEL_NAMES[4]).alias("level"), F.lit("FOCUS_TERMINAL").alias("rule"), _path_struct(DIMENSIONS).alias("selected_path"),
                    F.col("Impact_adj").alias("impact_adj"), F.col("Share_childsum").alias("share_childsum"))
    return own.withColumns({
        "focus_depth": F.lit(4), **{f"focus_{d}": F.col(d) for d in DIMENSIONS}, "drill_trace": F.array(node),
        **{r: F.lit(1 if r == "rank4" else None).cast("long") for r in RANKS},
    })


def drill_focuses(levels: DataFrame, cfg: EngineConfig, focuses: DataFrame, cand: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Leaves and events of all ``focuses`` (of ``focus_table``); one small join a level, whatever their number."""
    cand = cand if cand is not None else drill_candidates(levels, cfg)
    sel = selected_children(cand).withColumn("node", node_struct())
    ev_all = parent_events(cand)
    reached, events, leaves = None, [], None
    event_cols = [*FOCUS, "lvl", "level", "rule", "parent_path", "parent_delta", "top1_share_childsum", "top2_share_childsum", "impact_floor", "selected_paths", *RANKS]
    for child in range(1, 5):
        starts = _starts(focuses, child - 1)
        reached = starts if reached is None else reached.unionByName(starts)
        here = sel.filter(F.col("level") == child)
        got = _join_pkey(here, reached).withColumns({f"rank{child}": F.col("sel_rank").cast("long"), "drill_trace": F.concat("drill_trace", F.array("node"))})
        paths = here.groupBy(*PKEY).agg(F.array_sort(F.collect_list(F.struct(F.col("sel_rank").alias("r"), _path_struct(dims_of(child)).alias("p")))).alias("__paths"))
        ev = _join_pkey(_join_pkey(ev_all.filter(F.col("lvl") == child), reached.drop("drill_trace")), paths, "left")
        parent = F.struct(*[F.col(f"p_{d}").alias(d) for d in DIMENSIONS[:3]], F.lit(None).cast("string").alias("PRODUCT"))
        ev = ev.withColumns({"level": F.lit(LEVEL_NAMES[child]), "parent_path": parent, "selected_paths": F.coalesce(F.transform("__paths", lambda s: s.getField("p")), F.array())})
        events.append(ev.select(*event_cols))
        if child < 4:
            reached = _as_parent_key(got, child).select(*FOCUS, *PKEY, *RANKS, "drill_trace")
        else:
            leaves = got
    full = _terminal(levels, focuses)
    cols = [*FOCUS, *DIMENSIONS, *SUM_COLUMNS, *IMPACT_COLUMNS, "drill_trace", *RANKS]
    none = F.lit(None).cast("double")
    ev = full.withColumns({
        "lvl": F.lit(4), "level": F.lit(LEVEL_NAMES[4]), "rule": F.lit("FOCUS_TERMINAL"), "selected_paths": F.array(_path_struct(DIMENSIONS)),
        "parent_path": _path_struct(dims_of(3)), "top1_share_childsum": none, "top2_share_childsum": none, "impact_floor": none,
    })
    return leaves.select(*cols).unionByName(full.select(*cols)), reduce(DataFrame.unionByName, [*events, ev.select(*event_cols)])


def _first(rows: DataFrame, order: list[Column], k: int) -> DataFrame:
    w = Window.partitionBy(*FOCUS).orderBy(*order, *[F.col(d).asc() for d in DIMENSIONS])
    return rows.withColumn("mode_rank", F.row_number().over(w).cast("long")).filter(F.col("mode_rank") <= k)


def run_focuses(levels: DataFrame, cfg: EngineConfig, focuses: DataFrame, cand: DataFrame | None = None) -> FocusRuns:
    """D14 for all ``focuses`` at once: drill, candidates (W4), issues (W6), improvements with defenders."""
    leaves, events = drill_focuses(levels, cfg, focuses, cand)
    cands = candidate_metrics(leaves)
    issues = _first(cands.filter(F.col("Impact_adj") < 0), [F.col("Impact_adj").asc()], cfg.wide_top_k).withColumn("mode_tag", F.lit("ISSUE"))
    # The scope is the focus, at least a subsidiary; its dims are the first ones of the candidate's own path
    depth = F.greatest(F.col("focus_depth"), F.lit(1))
    keys = {f"__s{i}": F.when(depth > i, F.col(d)) for i, d in enumerate(DIMENSIONS)}
    scope = candidate_metrics(levels.filter(F.col("level") >= 1)).select(*[F.col(d).alias(f"__t{i}") for i, d in enumerate(DIMENSIONS)], _defense_ok(cfg).alias("__eligible"))
    x = cands.withColumns(keys)
    same = reduce(lambda a, b: a & b, [F.col(f"__s{i}").eqNullSafe(F.col(f"__t{i}")) for i in range(4)])
    x = x.join(scope, same, "left").drop(*[f"__{k}{i}" for k in "st" for i in range(4)])
    adj = F.coalesce(F.col("Impact_adj"), F.lit(0.0))
    kind = F.when(adj > 0, 0).when(F.coalesce("__eligible", F.lit(False)) & _defense_ok(cfg), 1)
    x = x.withColumn("__kind", kind).filter(F.col("__kind").isNotNull())
    key = F.when(F.col("__kind") == 0, -adj).otherwise(-F.coalesce("defense_score_pct", F.lit(-1e9)))
    improvements = _first(x, [F.col("__kind").asc(), key.asc(), (-adj).asc()], cfg.wide_top_k)
    improvements = improvements.withColumn("mode_tag", F.when(F.col("__kind") == 0, "IMPROVE").otherwise("DEFENSE")).drop("__kind", "__eligible")
    return FocusRuns(leaves, events, issues, improvements)
