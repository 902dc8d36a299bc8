"""Registered queries: name -> (Spark builder, DuckDB oracle SQL).

Every query reads the test tables through the mapped raw table, over whole
tables.  Spark builders share one analysis per (session, data dir, window) so
that the cut points run once per session, not once per query.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roaslens.config import EngineConfig
from roaslens.operators.display import fallback_topics
from roaslens.operators.division import division_headline, division_parallel
from roaslens.functions.canonical import canonical, document
from roaslens.functions.exprs import fmt_driver_metric, fmt_pp, path_key, paths_text, pct_change, safe_ratio, to_float, trace_text, trend, yoy_polarity
from roaslens.operators.drill import dedupe_campaigns, scope_eligibility
from roaslens.operators.focus import FOCUS, RANKS, focus_table, run_focuses
from roaslens.operators.impact import child_impacts, select_children, selected_children
from roaslens.operators.levels import kpi_table, level_rows
from roaslens.operators.policy import action_code_expr, checklist_code_expr, with_signals
from roaslens.operators.rootcause import confirmed_driver, rca_table
from roaslens.plans import oracle as O
from roaslens.operators.levels import level_rollup
from roaslens.plans.pipeline import Analysis, Report, analyze, build_report
from roaslens.scale import numbered
from roaslens.schema import DIMENSIONS, ENGINE_COLUMNS, SUM_COLUMNS
from roaslens.session import apply_engine_conf, cut, ensure_checkpoint_dir, scratch_path
from roaslens.sinks.report import CAMPAIGN_COLUMNS, DECOMPOSITION_METHOD, campaign_view, comparison_window_text, output_order, trace_table
from roaslens.sources.ingest import build_engine_frame, engine_frame, filter_counts, mtd_cutoff, normalize_long, parse_error_counts, run_facts, _scoped_input
from roaslens.sources.mapped import mapped_long_table, mapped_mtd_frame, text_long_table, write_text_table
from roaslens.sources.parts import engine_from_parts, refresh
from roaslens.sources.raw import read_candidates

FULL = EngineConfig(curr_year=O.CURR, prev_year=O.PREV, mtd_only=False)
MTD = EngineConfig(curr_year=O.CURR, prev_year=O.PREV, mtd_only=True)

def _prepare(spark: SparkSession) -> None:
    apply_engine_conf(spark)
    ensure_checkpoint_dir(spark)


class Run:
    """One comparison over one data directory; each stage is built on first use only."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: EngineConfig) -> None:
        _prepare(spark)
        self.cfg = cfg
        self.engine = mapped_mtd_frame(spark, sf_dir, cfg) if cfg.mtd_only else engine_frame(mapped_long_table(spark, sf_dir, (cfg.curr_year, cfg.prev_year)), cfg)
        self._levels = self._analysis = self._report = None

    @property
    def levels(self) -> DataFrame:
        if self._levels is None:
            self._levels = cut(level_rollup(self.engine))
        return self._levels

    @property
    def analysis(self) -> Analysis:
        if self._analysis is None:
            self._analysis = analyze(self.engine, self.cfg, self.levels)
        return self._analysis

    @property
    def report(self) -> Report:
        if self._report is None:
            self._report = build_report(self.engine, self.cfg, analysis=self.analysis)
        return self._report

    # Report-like accessors
    @property
    def sections(self):
        return self.report.sections

    @property
    def tables(self):
        return self.report.tables


_CACHE: dict[tuple, Run] = {}


def report_for(spark: SparkSession, sf_dir: str, cfg: EngineConfig = FULL) -> Run:
    key = (spark.sparkContext.applicationId, sf_dir, cfg)
    run = _CACHE.get(key)
    if run is None:
        run = _CACHE[key] = Run(spark, sf_dir, cfg)
    return run


# Columns computed with logarithms or floating-point sums (order-dependent); they
# are rounded to 9 decimals on both sides.  Every other double is a chain of
# correctly rounded IEEE operations on exact decimal sums and is compared as is.
INEXACT = {
    "Impact_raw", "Impact_adj", "Share_childsum", "Share_parentdelta", "Residual_parent",
    "dlog_CVR", "dlog_AOV", "dlog_CPC", "total_dlog_roas", "impact_contribution_pct", "channel_direct_pct",
    "division_direct_pct", "product_direct_pct", "signal_max_abs", "Contribution_to_total_delta_pct",
    "Contribution_to_decline_pct", "Contribution_to_growth_pct", "headline_pct", "top1_share", "top2_share",
    "top1_share_childsum", "top2_share_childsum",
}


def out(df: DataFrame, digits: int = O.R) -> DataFrame:
    """Round the inexact doubles; drop nested columns (compared through their text forms)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name in INEXACT:
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            continue
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _sql_round(select_cols: list[str], double_cols: set[str]) -> str:
    return ", ".join(O.rnd(c) + f" AS {c}" if c in double_cols and c in INEXACT else c for c in select_cols)


IMPACT_OUT = [*DIMENSIONS, *SUM_COLUMNS, "Impact_raw", "Impact_adj", "Share_childsum", "Share_parentdelta",
              "Residual_parent", "Residual_applied_flag", "parent_delta", "parent_roas_prev", "parent_roas_curr"]
IMPACT_DOUBLES = set(SUM_COLUMNS) | {"Impact_raw", "Impact_adj", "Share_childsum", "Share_parentdelta", "Residual_parent",
                                    "parent_delta", "parent_roas_prev", "parent_roas_curr"}
KPI = ["rev_curr", "rev_prev", "rev_delta", "rev_yoy", "spend_curr", "spend_prev", "spend_yoy", "cpc_curr", "cpc_prev",
       "cpc_yoy", "cvr_curr", "cvr_prev", "cvr_yoy", "aov_curr", "aov_prev", "aov_yoy", "roas_curr", "roas_prev",
       "roas_delta", "roas_yoy"]


def _kpi_cols_sql() -> str:
    r, p = O.ratio, O.pct
    e = {
        "rev_curr": "Revenue_curr_sum", "rev_prev": "Revenue_prev_sum", "rev_delta": "Revenue_curr_sum - Revenue_prev_sum",
        "rev_yoy": p("Revenue_curr_sum", "Revenue_prev_sum"),
        "spend_curr": "Spend_curr_sum", "spend_prev": "Spend_prev_sum", "spend_yoy": p("Spend_curr_sum", "Spend_prev_sum"),
        "cpc_curr": r("Spend_curr_sum", "Clicks_curr_sum"), "cpc_prev": r("Spend_prev_sum", "Clicks_prev_sum"),
        "cvr_curr": r("Orders_curr_sum", "Clicks_curr_sum"), "cvr_prev": r("Orders_prev_sum", "Clicks_prev_sum"),
        "aov_curr": r("Revenue_curr_sum", "Orders_curr_sum"), "aov_prev": r("Revenue_prev_sum", "Orders_prev_sum"),
        "roas_curr": r("Revenue_curr_sum", "Spend_curr_sum"), "roas_prev": r("Revenue_prev_sum", "Spend_prev_sum"),
    }
    e["cpc_yoy"] = p(e["cpc_curr"], e["cpc_prev"])
    e["cvr_yoy"] = p(e["cvr_curr"], e["cvr_prev"])
    e["aov_yoy"] = p(e["aov_curr"], e["aov_prev"])
    e["roas_delta"] = f"{e['roas_curr']} - {e['roas_prev']}"
    e["roas_yoy"] = p(e["roas_curr"], e["roas_prev"])
    return ", ".join(f"{e[k]} AS {k}" for k in KPI)


def _kpi_sql(level: int) -> str:
    return O.engine_ctes() + f" SELECT {', '.join(DIMENSIONS[:level])}, {_kpi_cols_sql()} FROM levels WHERE level = {level}"


# ------------------------------------------------------------------ Spark builders

def q_engine_frame(spark, sf_dir):
    return out(report_for(spark, sf_dir).engine.select(*ENGINE_COLUMNS))  # lazy: recomputed from the raw tables


def q_engine_frame_mtd(spark, sf_dir):
    _prepare(spark)
    return out(mapped_mtd_frame(spark, sf_dir, MTD))


def q_objective_filter_counts(spark, sf_dir):
    return filter_counts(mapped_long_table(spark, sf_dir))


def q_dq_parse_errors(spark, sf_dir):
    raw = mapped_long_table(spark, sf_dir)
    as_text = raw.withColumns({c: F.col(c).cast("string") for c in ("PLATFORM_SPEND_USD", "GROSS_REVENUE", "PLATFORM_CLICKS", "GROSS_ORDERS")})
    return parse_error_counts(as_text)


def q_mtd_cutoff(spark, sf_dir):
    raw = mapped_long_table(spark, sf_dir)
    return mtd_cutoff(normalize_long(_scoped_input(raw)), MTD.curr_year, MTD.prev_year)


_TEXT_TITLES = ("Ad performance export", "Subsidiary,Channel", "")


def _text_source(spark, sf_dir):
    """The given tables as a folder of CSV files with titles, read as the second of two candidates; the first has no header."""
    _prepare(spark)
    folder = scratch_path(spark, "text")
    made = text_long_table(spark, sf_dir)
    write_text_table(made, f"{folder}/data", _TEXT_TITLES)
    write_text_table(made.groupBy("Subsidiary").count(), f"{folder}/overview", ("Overview",), files=1)
    return read_candidates(spark, [f"{folder}/missing", f"{folder}/overview", f"{folder}/data"], "csv")


def q_text_source_frame(spark, sf_dir):
    return out(build_engine_frame(_text_source(spark, sf_dir), FULL)[0])


def q_text_source_frame_mtd(spark, sf_dir):
    return out(build_engine_frame(_text_source(spark, sf_dir), MTD)[0])


def q_text_source_facts(spark, sf_dir):
    return run_facts(_text_source(spark, sf_dir), MTD.curr_year)


def q_parts_frame_mtd(spark, sf_dir):
    """The exported table read year by year into a store of partial sums; the frame comes from the sums."""
    _prepare(spark)
    folder = scratch_path(spark, "parts")
    for y in (MTD.prev_year, MTD.curr_year):
        mapped_long_table(spark, sf_dir, (y,)).write.mode("append").parquet(f"{folder}/data")
        refresh(spark, f"{folder}/data", f"{folder}/store", "parquet")
    return out(engine_from_parts(spark, f"{folder}/store", MTD)[0])


def q_wide_frame(spark, sf_dir):
    """P5: the engine frame of the given tables as a wide text table, with commas and a blank, read back."""
    made = report_for(spark, sf_dir).engine
    text = lambda c: F.format_number(F.floor(F.col(c)), 0)
    wide = made.select(*[F.col(d).alias(d.lower()) for d in DIMENSIONS], *[F.when((F.col("Spend_curr") % 7 < 1) & F.lit(c == "Clicks_prev"), F.lit(" ")).otherwise(text(c)).alias(c) for c in ENGINE_COLUMNS[4:]])
    frame, meta = build_engine_frame(wide, FULL)
    return frame.withColumn("source_format", F.lit(meta["source_format"]))


def q_issues_ordered(spark, sf_dir):
    return _ordered(spark, sf_dir, "issues")


def q_improvements_ordered(spark, sf_dir):
    return _ordered(spark, sf_dir, "improvements")


def q_subsidiary_documents(spark, sf_dir):
    """Each subsidiary's report as one canonical text, with its top topics, comments and the method."""
    s = report_for(spark, sf_dir).sections["subsidiary_reports"]
    topic = s.schema["top3"].dataType
    s = s.withColumns({"decomposition_method": F.struct(*[F.lit(v).alias(k) for k, v in DECOMPOSITION_METHOD.items()]), "top3": F.coalesce("top3", F.array().cast(topic))})
    return s.select("SUBSIDIARY", document(s, [c for c in s.columns if c not in ("n_issues", "n_improvements")]).alias("document"))


def q_division_documents(spark, sf_dir):
    s = report_for(spark, sf_dir).sections["division_parallel_contribution"]
    return s.select("SUBSIDIARY", document(s, s.columns).alias("document"))


def q_leaf_documents(spark, sf_dir):
    """Drilled leaves with their nested trace."""
    s = report_for(spark, sf_dir).analysis.run.drill.leaves.select(*DIMENSIONS, "Impact_adj", "drill_trace")
    return s.select(*DIMENSIONS, document(s, s.columns).alias("document"))


def q_card_documents(spark, sf_dir):
    """K6: cards with their nested topics, their figures and texts."""
    s = report_for(spark, sf_dir).sections["report_cards"]
    keep = ["pick_no", "CHANNEL", "DIVISION", "PRODUCT", "source", "driver", "yoy_leader", "contribution_label", "impact_contribution_text", "reason_text", "so_what_text", "what_text"]
    topics = F.transform("topics", lambda t: F.struct(*[t.getField(c).alias(c) for c in keep]))
    s = s.withColumn("topics", topics)
    return s.select("SUBSIDIARY", document(s, ["SUBSIDIARY", "display_mode", "topics", "revenue_curr", "revenue_yoy", "roas_curr", "roas_yoy", "headline_division", "headline_pct"]).alias("document"))


def q_topic_texts(spark, sf_dir):
    """Texts of every topic, its KPIs in order of their effect, where its drill ended."""
    s = report_for(spark, sf_dir).sections
    rows = s["issues_top_products"].unionByName(s["improvements_top_products"])
    ranking = canonical(F.col("kpi_ranking"), rows.schema["kpi_ranking"].dataType)
    end = F.concat_ws(":", "final_drill_result.level", "final_drill_result.rule")
    return rows.select("diagnosis_subsidiary", *DIMENSIONS[1:], "mode_tag", "summary_text", "detail_text", "why_selected_text", "weak_signal", ranking.alias("kpi_ranking"), end.alias("drill_end"))


def q_fallback_texts(spark, sf_dir):
    """Short actions and checklists of every fallback topic, with its summary."""
    return fallback_topics(report_for(spark, sf_dir).levels).select(
        "diagnosis_subsidiary", *DIMENSIONS[1:], "mode_tag", "recommended_actions", "action_checklist", "summary_text", "why_selected_text")


def q_run_summary(spark, sf_dir):
    """One line for each subsidiary, and the comparison that it belongs to."""
    raw = mapped_long_table(spark, sf_dir, (FULL.curr_year, FULL.prev_year))
    window = comparison_window_text(build_engine_frame(raw, FULL)[1])
    rep = report_for(spark, sf_dir)
    lines = rep.sections["report_cards"].select("SUBSIDIARY", "summary_line")
    return rep.sections["subsidiaries_analyzed"].join(lines, "SUBSIDIARY", "left").withColumn("comparison", F.lit(window))


def q_scalar_texts(spark, sf_dir):
    """X5, X8-X10, X19 on every row of every level."""
    lv = report_for(spark, sf_dir).levels
    yoy = {"CPC": pct_change(safe_ratio("Spend_curr_sum", "Clicks_curr_sum"), safe_ratio("Spend_prev_sum", "Clicks_prev_sum")),
           "CVR": pct_change(safe_ratio("Orders_curr_sum", "Clicks_curr_sum"), safe_ratio("Orders_prev_sum", "Clicks_prev_sum"))}
    now = {"CPC": safe_ratio("Spend_curr_sum", "Clicks_curr_sum"), "CVR": safe_ratio("Orders_curr_sum", "Clicks_curr_sum"), "AOV": safe_ratio("Revenue_curr_sum", "Orders_curr_sum")}
    return lv.select(
        "level", path_key(DIMENSIONS).alias("path"), trend(yoy["CPC"]).alias("cpc_trend"), *[yoy_polarity(F.lit(k), v).alias(f"{k.lower()}_polarity") for k, v in yoy.items()],
        fmt_pp(yoy["CVR"]).alias("cvr_pp"), *[fmt_driver_metric(F.lit(k), v).alias(f"{k.lower()}_text") for k, v in now.items()], (to_float(yoy["CPC"], -1.0) >= 0).alias("cpc_up"),
    )


def _ordered(spark, sf_dir, name):
    rows = getattr(report_for(spark, sf_dir).analysis, name)
    return out(numbered(rows.select("diagnosis_subsidiary", *DIMENSIONS, "Impact_adj", "mode_tag"), output_order(name)))


class FocusRun:
    """All focuses of the data at once: the whole, every subsidiary, channel, division and product."""

    def __init__(self, spark, sf_dir):
        levels = report_for(spark, sf_dir).levels
        self.run = run_focuses(levels, FULL, focus_table(levels))


_FOCUSED: dict[tuple, FocusRun] = {}


def _focused(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FOCUSED:
        _FOCUSED[key] = FocusRun(spark, sf_dir)
    return _FOCUSED[key].run


def q_drill_focuses(spark, sf_dir):
    return out(_focused(spark, sf_dir).leaves.withColumn("drill_trace_text", trace_text("drill_trace")).drop("drill_trace"))


def q_focus_events(spark, sf_dir):
    ev = _focused(spark, sf_dir).events
    return out(ev.select(
        *FOCUS, F.col("lvl").cast("long").alias("lvl"), "level", "rule", *[F.col("parent_path").getField(d).alias(f"parent_{d}") for d in DIMENSIONS],
        "parent_delta", "top1_share_childsum", "top2_share_childsum", "impact_floor", paths_text("selected_paths").alias("selected_paths"), *RANKS[:3],
    ))


def q_focus_selections(spark, sf_dir):
    run = _focused(spark, sf_dir)
    cols = [*FOCUS, *DIMENSIONS, "Impact_adj", "mode_tag", "mode_rank"]
    return out(run.issues.select(*cols).unionByName(run.improvements.select(*cols)))


def q_merged_runs(spark, sf_dir):
    """The leaves of all runs, one row a leaf, the run with the widest focus first."""
    rows = _focused(spark, sf_dir).leaves
    merged = dedupe_campaigns(rows, [*FOCUS, *RANKS])
    traces = F.array_join(F.transform("drill_traces", lambda t: trace_text(t)), " | ")
    return out(merged.withColumns({"traces": traces, "n_runs": F.size("drill_traces").cast("long")}).drop("drill_traces"))


def q_level_rollup(spark, sf_dir):
    return out(report_for(spark, sf_dir).levels)


def q_kpi_subsidiary(spark, sf_dir):
    return out(kpi_table(report_for(spark, sf_dir).levels, 1))


def q_kpi_channel(spark, sf_dir):
    return out(kpi_table(report_for(spark, sf_dir).levels, 2))


def _impact(level):
    def q(spark, sf_dir):
        return out(child_impacts(report_for(spark, sf_dir).levels, level).select(*IMPACT_OUT))
    return q


def q_select_children(spark, sf_dir):
    lv = report_for(spark, sf_dir).levels
    sel = selected_children(select_children(child_impacts(lv, 3), FULL))
    return out(sel.select("SUBSIDIARY", "CHANNEL", "DIVISION", "rule", F.col("sel_rank").cast("long").alias("sel_rank"),
                          "Impact_adj", "top1_share", "top2_share", "impact_floor"))


def q_drill_leaves(spark, sf_dir):
    d = report_for(spark, sf_dir).analysis.run.drill.leaves
    from roaslens.functions.exprs import trace_text
    return out(d.withColumn("drill_trace_text", trace_text("drill_trace")).drop("drill_trace"))


def q_drill_trace_events(spark, sf_dir):
    ev = report_for(spark, sf_dir).analysis.run.drill.events
    from roaslens.functions.exprs import paths_text
    return out(ev.select(
        "focus_SUBSIDIARY", F.col("lvl").cast("long").alias("lvl"), "level", "rule",
        *[F.col("parent_path").getField(d).alias(f"parent_{d}") for d in DIMENSIONS],
        "parent_delta", "top1_share_childsum", "top2_share_childsum", "impact_floor",
        paths_text("selected_paths").alias("selected_paths"), "rank2", "rank3",
    ))


def q_trace_table(spark, sf_dir):
    return out(trace_table(report_for(spark, sf_dir).analysis.run.drill.events))


CAND_OUT = [*DIMENSIONS, "Impact_adj", "rev_yoy_pct", "spend_yoy_pct", "roas_curr", "roas_prev", "roas_yoy_pct", "defense_score_pct"]


def q_candidate_metrics(spark, sf_dir):
    return out(report_for(spark, sf_dir).analysis.run.candidates.select(*CAND_OUT))


def q_scope_eligibility(spark, sf_dir):
    return scope_eligibility(report_for(spark, sf_dir).levels, FULL)


SEL_OUT = [*DIMENSIONS, "Impact_adj", "mode_tag", "mode_rank"]


def q_issues_top3(spark, sf_dir):
    return out(report_for(spark, sf_dir).analysis.run.issues.select(*SEL_OUT))


def q_improvements_top3(spark, sf_dir):
    return out(report_for(spark, sf_dir).analysis.run.improvements.select(*SEL_OUT))


RCA_OUT = [*DIMENSIONS, *SUM_COLUMNS, "primary_driver", "tag", "dlog_CVR", "dlog_AOV", "dlog_CPC", "total_dlog_roas",
           "CPC_curr", "CPC_prev", "CVR_curr", "CVR_prev", "AOV_curr", "AOV_prev", "ROAS_curr", "ROAS_prev"]


def _rca(mode):
    def q(spark, sf_dir):
        return out(rca_table(level_rows(report_for(spark, sf_dir).levels, 4), mode).select(*RCA_OUT))
    return q


def q_rca_join(spark, sf_dir):
    return out(report_for(spark, sf_dir).analysis.issues.select(*CAMPAIGN_COLUMNS))


def q_rca_join_improvements(spark, sf_dir):
    return out(report_for(spark, sf_dir).analysis.improvements.select(*CAMPAIGN_COLUMNS))


def q_confirmed_driver(spark, sf_dir):
    a = report_for(spark, sf_dir).analysis
    cols = [*DIMENSIONS, "mode_tag", "tag", "rca_primary_driver", "primary_driver"]
    return a.issues.select(*cols).unionByName(a.improvements.select(*cols))


def q_policy_actions(spark, sf_dir):
    a = report_for(spark, sf_dir).analysis
    cols = [*DIMENSIONS, "mode_tag", "tag", "primary_driver", "action_code", "checklist_code", "recommended_actions", "action_checklist"]
    return a.issues.select(*cols).unionByName(a.improvements.select(*cols))


# Channel names by order priority, so that every channel type occurs.
CHANNEL_NAMES = {"1-URGENT": "Paid search brand", "2-HIGH": " pmax shopping", "3-MEDIUM": "Performance Max EU"}


def q_policy_codes(spark, sf_dir):
    """R9-R12 for every product in all three modes: tag, confirmed driver, channel type and the two codes."""
    leaf = level_rows(report_for(spark, sf_dir).levels, 4)
    rows = None
    for mode in ("ISSUE", "IMPROVE", "DEFENSE"):
        x = rca_table(leaf, "ISSUE" if mode == "ISSUE" else "IMPROVE").withColumn("mode_tag", F.lit(mode))
        rows = x if rows is None else rows.unionByName(x)
    names = F.coalesce(*[F.when(F.col("CHANNEL") == k, F.lit(v)) for k, v in CHANNEL_NAMES.items()], F.col("CHANNEL"))
    rows = with_signals(rows.withColumns({"CHANNEL": names, "primary_driver": confirmed_driver()}))
    return rows.select(*DIMENSIONS, "mode_tag", "tag", "primary_driver", F.col("__sig_ctype").alias("channel_type"), action_code_expr().alias("action_code"), checklist_code_expr().alias("checklist_code"))


def q_division_parallel(spark, sf_dir):
    return out(division_parallel(report_for(spark, sf_dir).levels))


def q_division_headline(spark, sf_dir):
    return out(division_headline(division_parallel(report_for(spark, sf_dir).levels)))


TOPIC_NUM = ["diagnosis_subsidiary", *DIMENSIONS, "mode_tag", "topic_roas_curr", "topic_roas_prev", "topic_roas_delta",
             "division_roas_delta", "impact_contribution_pct", "channel_direct_pct", "division_direct_pct", "product_direct_pct"]
RANK_OUT = ["diagnosis_subsidiary", *DIMENSIONS, "mode_tag", "selection_rank", "selection_pool_size"]
EVID_OUT = ["diagnosis_subsidiary", *DIMENSIONS, "mode_tag", "evidence_driver", "driver_curr", "driver_prev", "driver_yoy",
            "division_driver_yoy", "driver_gap_pp", "signal_max_abs"]


def _topics(spark, sf_dir, cols):
    s = report_for(spark, sf_dir).sections
    return out(s["issues_top_products"].select(*cols).unionByName(s["improvements_top_products"].select(*cols)))


def q_topic_contribution(spark, sf_dir):
    return _topics(spark, sf_dir, TOPIC_NUM)


def q_topic_rank(spark, sf_dir):
    return _topics(spark, sf_dir, RANK_OUT)


def q_driver_evidence(spark, sf_dir):
    return _topics(spark, sf_dir, EVID_OUT)


PICK_OUT = ["diagnosis_subsidiary", *DIMENSIONS, "mode_tag", "pick_no", "metric_rank"]


def q_top3_diverse(spark, sf_dir):
    s = report_for(spark, sf_dir).sections
    pick = lambda df: df.select(*PICK_OUT[:-1], F.col("metric_rank").cast("long").alias("metric_rank"))
    return pick(s["issues_top3_products_by_subsidiary"]).unionByName(pick(s["improvements_top3_products_by_subsidiary"]))


def q_subsidiary_report(spark, sf_dir):
    s = report_for(spark, sf_dir).sections["subsidiary_reports"]
    paths = F.array_join(F.transform("top3", lambda t: F.concat_ws("/", t.getField("CHANNEL"), t.getField("DIVISION"), t.getField("PRODUCT"))), " | ")
    return out(s.select(
        "SUBSIDIARY", "mode", *KPI,
        F.coalesce(F.col("n_issues"), F.lit(0)).cast("long").alias("n_issues"),
        F.coalesce(F.col("n_improvements"), F.lit(0)).cast("long").alias("n_improvements"),
        paths.alias("top3_paths"),
    ))


FALLBACK_OUT = ["diagnosis_subsidiary", *DIMENSIONS, "mode_tag", "revenue_delta", "is_primary", "impact_contribution_pct",
                "contribution_label", "primary_driver"]
MERGED_OUT = ["diagnosis_subsidiary", "card_mode", "pick_no", *DIMENSIONS[1:], "source", "impact_contribution_pct", "primary_driver"]


def q_fallback_topics(spark, sf_dir):
    return out(fallback_topics(report_for(spark, sf_dir).levels).select(*FALLBACK_OUT))


def q_merged_topics(spark, sf_dir):
    return out(report_for(spark, sf_dir).sections["merged_topics"].select(*MERGED_OUT))


CARD_OUT = ["diagnosis_subsidiary", "card_mode", "pick_no", "CHANNEL", "DIVISION", "PRODUCT", "source", "contribution_label", "driver", "yoy_leader"]
CARD_KPI = ["revenue_curr", "revenue_delta", "revenue_yoy", "cost_curr", "cost_yoy", "roas_curr", "roas_yoy", "cvr_yoy", "aov_yoy", "cpc_yoy"]


def q_card_topics(spark, sf_dir):
    rows = report_for(spark, sf_dir).sections["card_topics"]
    return out(rows.select(*CARD_OUT, *[F.col(f"{s}_kpi.{c}").alias(f"{s}_{c}") for s in ("channel", "division", "product") for c in CARD_KPI]))


def q_card_summary(spark, sf_dir):
    cards = report_for(spark, sf_dir).sections["report_cards"]
    return out(cards.select("SUBSIDIARY", "display_mode", "headline_division", "headline_pct", "top_channel", "top_driver"))


def q_report_cards(spark, sf_dir):
    c = report_for(spark, sf_dir).sections["report_cards"]
    paths = F.array_join(F.transform("topics", lambda t: F.concat_ws("/", t.getField("CHANNEL"), t.getField("DIVISION"), t.getField("PRODUCT"))), " | ")
    return c.select("SUBSIDIARY", "display_mode", F.size("topics").cast("long").alias("n_topics"), paths.alias("topic_paths"))


def _mtd(spark, sf_dir):
    return report_for(spark, sf_dir, MTD)


def _impact_mtd(level):
    def q(spark, sf_dir):
        return out(child_impacts(_mtd(spark, sf_dir).levels, level).select(*IMPACT_OUT))
    return q


def q_drill_leaves_mtd(spark, sf_dir):
    from roaslens.functions.exprs import trace_text
    d = _mtd(spark, sf_dir).analysis.run.drill.leaves
    return out(d.withColumn("drill_trace_text", trace_text("drill_trace")).drop("drill_trace"))


def q_drill_trace_events_mtd(spark, sf_dir):
    from roaslens.functions.exprs import paths_text
    ev = _mtd(spark, sf_dir).analysis.run.drill.events
    return out(ev.select(
        "focus_SUBSIDIARY", F.col("lvl").cast("long").alias("lvl"), "level", "rule",
        *[F.col("parent_path").getField(d).alias(f"parent_{d}") for d in DIMENSIONS],
        "parent_delta", "top1_share_childsum", "top2_share_childsum", "impact_floor",
        paths_text("selected_paths").alias("selected_paths"), "rank2", "rank3",
    ))


def q_issues_top3_mtd(spark, sf_dir):
    return out(_mtd(spark, sf_dir).analysis.run.issues.select(*SEL_OUT))


def q_improvements_top3_mtd(spark, sf_dir):
    return out(_mtd(spark, sf_dir).analysis.run.improvements.select(*SEL_OUT))


def q_rca_join_mtd(spark, sf_dir):
    return out(_mtd(spark, sf_dir).analysis.selected.select(*CAMPAIGN_COLUMNS))


def q_issues_view(spark, sf_dir):
    a = report_for(spark, sf_dir).analysis
    return campaign_view(a.issues, FULL.curr_year, FULL.prev_year)


def q_improvements_view(spark, sf_dir):
    a = report_for(spark, sf_dir).analysis
    return campaign_view(a.improvements, FULL.curr_year, FULL.prev_year)


# ------------------------------------------------------------------ oracle SQL

def _campaign_union_sql(mtd: bool) -> str:
    dbl = set(SUM_COLUMNS) | {"Impact_raw", "Impact_adj", "Share_childsum", "Share_parentdelta", "Residual_parent", "dlog_CVR",
                              "dlog_AOV", "dlog_CPC", "total_dlog_roas", "CPC_curr", "CPC_prev", "CVR_curr", "CVR_prev",
                              "AOV_curr", "AOV_prev", "ROAS_curr", "ROAS_prev"}
    cols = _sql_round(CAMPAIGN_COLUMNS, dbl)
    return O.enriched_ctes(mtd) + f" SELECT {cols} FROM issues UNION ALL SELECT {cols} FROM impr"


def _campaign_sql(src: str, mtd: bool = False) -> str:
    dbl = set(SUM_COLUMNS) | {"Impact_raw", "Impact_adj", "Share_childsum", "Share_parentdelta", "Residual_parent", "dlog_CVR",
                              "dlog_AOV", "dlog_CPC", "total_dlog_roas", "CPC_curr", "CPC_prev", "CVR_curr", "CVR_prev",
                              "AOV_curr", "AOV_prev", "ROAS_curr", "ROAS_prev"}
    cols = [c if c != "tag" else "tag" for c in CAMPAIGN_COLUMNS]
    return O.enriched_ctes(mtd) + f" SELECT {_sql_round(cols, dbl)} FROM {src}"


def _view_sql(src: str = "issues") -> str:
    def money(x):
        a = f"abs({x})"
        return (f"CASE WHEN {a} IS NULL THEN '$0' WHEN {a} >= 1000000 THEN '$' || printf('%.1f', round({a} / 1000000, 1)) || 'M' "
                f"WHEN {a} >= 1000 THEN '$' || printf('%.0f', round({a} / 1000, 0)) || 'K' ELSE '$' || printf('%.0f', round({a}, 0)) END")

    def pct(x):
        return f"CASE WHEN {x} IS NULL THEN 'N/A' ELSE printf('%.0f', round({x} * 100, 0) + 0.0) || '%' END"

    def roas(x):
        return f"CASE WHEN {x} IS NULL THEN 'N/A' ELSE printf('%.1f', round({x}, 1) + 0.0) END"
    rc = f"coalesce(ROAS_curr, {O.ratio('Revenue_curr_sum', 'Spend_curr_sum')})"
    rp = f"coalesce(ROAS_prev, {O.ratio('Revenue_prev_sum', 'Spend_prev_sum')})"
    c, p = FULL.curr_year, FULL.prev_year
    return O.enriched_ctes() + f"""
SELECT diagnosis_subsidiary AS subsidiary, CHANNEL AS media, DIVISION AS bu, PRODUCT AS product, mode_tag AS mode,
       primary_driver AS driver,
       CASE WHEN Impact_adj IS NULL THEN 'N/A' ELSE (CASE WHEN round(Impact_adj, 3) >= 0 THEN '+' ELSE '' END) || printf('%.3f', round(Impact_adj, 3) + 0.0) END AS impact_roas,
       {money('Revenue_curr_sum')} AS revenue_{c}, {money('Revenue_prev_sum')} AS revenue_{p},
       {pct(O.pct('Revenue_curr_sum', 'Revenue_prev_sum'))} AS revenue_yoy,
       {money('Spend_curr_sum')} AS spend_{c}, {money('Spend_prev_sum')} AS spend_{p},
       {pct(O.pct('Spend_curr_sum', 'Spend_prev_sum'))} AS spend_yoy,
       {roas(rc)} AS roas_{c}, {roas(rp)} AS roas_{p}, {pct(O.pct(rc, rp))} AS roas_yoy,
       tag, recommended_actions AS action_one, action_checklist AS checklist,
       drill_trace_text AS trace
FROM {src}"""


def _division_sql() -> str:
    pr = O.ratio
    dl = ("Revenue_curr_sum", "Revenue_prev_sum", "Spend_curr_sum", "Spend_prev_sum", "Clicks_curr_sum", "Clicks_prev_sum", "Orders_curr_sum", "Orders_prev_sum")
    aggs = ", ".join(f"{O.dsum(s[:-4])} AS {s}" for s in dl)
    valid = (f"(cc > 0 AND cp > 0 AND Parent_roas_curr > 0 AND Parent_roas_prev > 0 AND {O.logmean('cc', 'cp')} IS NOT NULL "
             f"AND {O.logmean('Parent_roas_curr', 'Parent_roas_prev')} IS NOT NULL AND {O.lnr('Parent_roas_curr', 'Parent_roas_prev')} IS NOT NULL)")
    return O.engine_ctes() + f""",
dv AS (SELECT SUBSIDIARY, DIVISION, {aggs} FROM engine GROUP BY SUBSIDIARY, DIVISION),
pa AS (
  SELECT SUBSIDIARY, {pr('Revenue_curr_sum', 'Spend_curr_sum')} AS Parent_roas_curr, {pr('Revenue_prev_sum', 'Spend_prev_sum')} AS Parent_roas_prev,
         Spend_curr_sum AS psc, Spend_prev_sum AS psp
  FROM levels WHERE level = 1
),
j AS (
  SELECT d.*, p.Parent_roas_curr, p.Parent_roas_prev, p.Parent_roas_curr - p.Parent_roas_prev AS Parent_roas_delta,
         {pr('d.Revenue_curr_sum', 'p.psc')} AS cc, {pr('d.Revenue_prev_sum', 'p.psp')} AS cp
  FROM dv d LEFT JOIN pa p ON d.SUBSIDIARY = p.SUBSIDIARY
),
k AS (
  SELECT *, CASE WHEN {valid} THEN ({O.logmean('cc', 'cp')} / {O.logmean('Parent_roas_curr', 'Parent_roas_prev')}) * {O.lnr('Parent_roas_curr', 'Parent_roas_prev')} * Parent_roas_delta ELSE cc - cp END AS Impact_raw,
         CASE WHEN {valid} THEN 'LMDI_ROAS' ELSE 'ROAS_COMPONENT_DELTA_FALLBACK' END AS Impact_raw_method
  FROM j
),
m AS (
  SELECT *, Parent_roas_delta - coalesce(sum(Impact_raw) OVER (PARTITION BY SUBSIDIARY), 0.0) AS Residual_parent,
         coalesce(sum(abs(Impact_raw)) OVER (PARTITION BY SUBSIDIARY), 0.0) AS sabs, count(*) OVER (PARTITION BY SUBSIDIARY) AS n
  FROM k
),
a AS (
  SELECT *, CASE WHEN n <= 0 THEN 0.0 WHEN sabs > 0 THEN (abs(Impact_raw) / sabs) * Residual_parent ELSE Residual_parent / n END AS alloc FROM m
),
b AS (
  SELECT *, Impact_raw + alloc AS Impact_adj, abs(alloc) > 1e-12 AS Residual_applied_flag,
         Revenue_curr_sum - Revenue_prev_sum AS Revenue_delta, {O.pct('Revenue_curr_sum', 'Revenue_prev_sum')} AS Revenue_yoy_pct,
         {O.pct('Spend_curr_sum', 'Spend_prev_sum')} AS Spend_yoy_pct, {pr('Revenue_curr_sum', 'Spend_curr_sum')} AS ROAS_curr,
         {pr('Revenue_prev_sum', 'Spend_prev_sum')} AS ROAS_prev
  FROM a
),
c AS (
  SELECT *, ROAS_curr - ROAS_prev AS ROAS_delta, {O.pct('ROAS_curr', 'ROAS_prev')} AS ROAS_yoy_pct,
         CASE WHEN abs(Parent_roas_delta) > 0 THEN abs(Impact_adj) / abs(Parent_roas_delta) ELSE 0.0 END AS Contribution_to_total_delta_pct,
         CASE WHEN Parent_roas_delta < 0 AND abs(Parent_roas_delta) > 0 THEN (CASE WHEN Impact_adj < 0 THEN -Impact_adj ELSE 0.0 END) / abs(Parent_roas_delta) ELSE 0.0 END AS Contribution_to_decline_pct,
         CASE WHEN Parent_roas_delta > 0 AND abs(Parent_roas_delta) > 0 THEN (CASE WHEN Impact_adj > 0 THEN Impact_adj ELSE 0.0 END) / abs(Parent_roas_delta) ELSE 0.0 END AS Contribution_to_growth_pct,
         CASE WHEN Parent_roas_delta < 0 THEN CASE WHEN Impact_adj < 0 THEN 'DECLINE_DRIVER' ELSE 'DECLINE_OFFSET' END
              WHEN Parent_roas_delta > 0 THEN CASE WHEN Impact_adj > 0 THEN 'GROWTH_DRIVER' ELSE 'GROWTH_OFFSET' END ELSE 'NEUTRAL' END AS Contribution_label
  FROM b
),
d AS (
  SELECT *, row_number() OVER (PARTITION BY SUBSIDIARY ORDER BY
              CASE WHEN coalesce(Parent_roas_delta, 0.0) < 0 THEN -Contribution_to_decline_pct WHEN coalesce(Parent_roas_delta, 0.0) > 0 THEN -Contribution_to_growth_pct ELSE 0.0 END,
              -abs(coalesce(Impact_adj, 0.0)), DIVISION) AS division_rank
  FROM c
)"""


DIV_DOUBLES = {"Revenue_curr_sum", "Revenue_prev_sum", "Spend_curr_sum", "Spend_prev_sum", "Revenue_delta", "Revenue_yoy_pct",
               "Spend_yoy_pct", "ROAS_curr", "ROAS_prev", "ROAS_delta", "ROAS_yoy_pct", "Impact_raw", "Impact_adj",
               "Residual_parent", "Parent_roas_delta", "Contribution_to_total_delta_pct", "Contribution_to_decline_pct",
               "Contribution_to_growth_pct"}
DIV_OUT = ["SUBSIDIARY", "DIVISION", "Revenue_curr_sum", "Revenue_prev_sum", "Spend_curr_sum", "Spend_prev_sum",
           "Revenue_delta", "Revenue_yoy_pct", "Spend_yoy_pct", "ROAS_curr", "ROAS_prev", "ROAS_delta", "ROAS_yoy_pct",
           "Impact_raw", "Impact_adj", "Impact_raw_method", "Residual_parent", "Residual_applied_flag", "Parent_roas_delta",
           "Contribution_to_total_delta_pct", "Contribution_to_decline_pct", "Contribution_to_growth_pct", "Contribution_label",
           "division_rank"]


def _division_text_sql() -> str:
    def pct(x):
        return f"CASE WHEN {x} IS NULL THEN 'N/A' ELSE printf('%.0f', round({x} * 100, 0) + 0.0) || '%' END"

    def roas(x):
        return f"CASE WHEN {x} IS NULL THEN 'N/A' ELSE printf('%.1f', round({x}, 1) + 0.0) END"
    base = f"DIVISION || ' ROAS ' || {roas('ROAS_curr')} || ' (' || {pct('ROAS_yoy_pct')} || ')'"
    return (f"CASE WHEN coalesce(Parent_roas_delta, 0.0) < 0 THEN {base} || ', share of the ROAS decline ' || {pct('Contribution_to_decline_pct')} "
            f"WHEN coalesce(Parent_roas_delta, 0.0) > 0 THEN {base} || ', share of the ROAS growth ' || {pct('Contribution_to_growth_pct')} ELSE {base} END")


def _events_sql(mtd: bool) -> str:
    return O.drill_ctes(mtd) + """,
ev AS (
  SELECT SUBSIDIARY AS focus_SUBSIDIARY, 2 AS lvl, 'LEVEL2' AS level, rule, SUBSIDIARY AS parent_SUBSIDIARY, NULL AS parent_CHANNEL,
         NULL AS parent_DIVISION, parent_delta, top1_share AS top1_share_childsum, top2_share AS top2_share_childsum, impact_floor,
         CAST(NULL AS BIGINT) AS rank2, CAST(NULL AS BIGINT) AS rank3,
         (SELECT string_agg(s.SUBSIDIARY || '/' || s.CHANNEL, ' ; ' ORDER BY s.sel_rank) FROM sel2 s WHERE s.SUBSIDIARY = r.SUBSIDIARY) AS selected_paths
  FROM sel2_rule r
  UNION ALL
  SELECT r.SUBSIDIARY, 3, 'LEVEL3', r.rule, r.SUBSIDIARY, r.CHANNEL, NULL, r.parent_delta, r.top1_share, r.top2_share, r.impact_floor,
         p.sel_rank, NULL,
         (SELECT string_agg(s.SUBSIDIARY || '/' || s.CHANNEL || '/' || s.DIVISION, ' ; ' ORDER BY s.sel_rank) FROM sel3 s WHERE s.SUBSIDIARY = r.SUBSIDIARY AND s.CHANNEL = r.CHANNEL)
  FROM sel3_rule r JOIN sel2 p ON p.SUBSIDIARY = r.SUBSIDIARY AND p.CHANNEL = r.CHANNEL
  UNION ALL
  SELECT r.SUBSIDIARY, 4, 'LEVEL4', r.rule, r.SUBSIDIARY, r.CHANNEL, r.DIVISION, r.parent_delta, r.top1_share, r.top2_share, r.impact_floor,
         p2.sel_rank, p3.sel_rank,
         (SELECT string_agg(s.SUBSIDIARY || '/' || s.CHANNEL || '/' || s.DIVISION || '/' || s.PRODUCT, ' ; ' ORDER BY s.sel_rank) FROM sel4 s WHERE s.SUBSIDIARY = r.SUBSIDIARY AND s.CHANNEL = r.CHANNEL AND s.DIVISION = r.DIVISION)
  FROM sel4_rule r JOIN sel3 p3 ON p3.SUBSIDIARY = r.SUBSIDIARY AND p3.CHANNEL = r.CHANNEL AND p3.DIVISION = r.DIVISION
  JOIN sel2 p2 ON p2.SUBSIDIARY = r.SUBSIDIARY AND p2.CHANNEL = r.CHANNEL
)"""


def _money_sql(x: str) -> str:
    a = f"abs({x})"
    return (f"CASE WHEN {a} IS NULL THEN '$0' WHEN {a} >= 1000000 THEN '$' || printf('%.1f', round({a} / 1000000, 1)) || 'M' "
            f"WHEN {a} >= 1000 THEN '$' || printf('%.0f', round({a} / 1000, 0)) || 'K' ELSE '$' || printf('%.0f', round({a}, 0)) END")


def _pct_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'N/A' ELSE printf('%.0f', round({x} * 100, 0) + 0.0) || '%' END"


def _yoy_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'N/A' ELSE printf('%.0f', round({x} * 100, 0) + 0.0) || '% YoY' END"


def _roas_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'N/A' ELSE printf('%.1f', round({x}, 1) + 0.0) END"


def _num(x: str) -> str:
    return f"coalesce(printf('%.6f', round({x}, 6) + 0.0), 'null')"


def _txt(x: str) -> str:
    return f"""coalesce('"' || replace(replace({x}, '\\', '\\\\'), '"', '\\"') || '"', 'null')"""


def _int(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), 'null')"


def _obj(items: dict[str, str]) -> str:
    return "'{' || " + " || ',' || ".join(f"""'"{k}":' || {v}""" for k, v in sorted(items.items())) + " || '}'"


def _list(item: str, order: str) -> str:
    return f"'[' || coalesce(string_agg({item}, ',' ORDER BY {order}), '') || ']'"


def _document_sql(kpi_cols: str, packs: str) -> dict[str, str]:
    """Canonical texts composed in SQL, field by field."""
    q: dict[str, str] = {}
    topic = _obj({"pick_no": _int("pick_no"), "CHANNEL": _txt("CHANNEL"), "DIVISION": _txt("DIVISION"), "PRODUCT": _txt("PRODUCT"), "mode_tag": _txt("mode_tag"),
                  "impact_contribution_pct": _num("impact_contribution_pct"), "impact_contribution_text": _txt(_pct_sql("impact_contribution_pct")), "primary_driver": _txt("primary_driver"),
                  "topic_roas_delta": _num("topic_roas_delta")})
    line = ("pick_no || ') ' || CHANNEL || '/' || DIVISION || '/' || PRODUCT || ': share of ROAS {0} ' || " + _pct_sql("impact_contribution_pct") + " || ', lever ' || coalesce(primary_driver, 'NONE')")
    d0 = "coalesce(r.roas_delta, 0.0)"
    overall = (f"r.SUBSIDIARY || ' ROAS ' || {_roas_sql('r.roas_curr')} || ' (' || {_yoy_sql('r.roas_yoy')} || '), ' || CASE WHEN {d0} < 0 THEN 'down' WHEN {d0} > 0 THEN 'up' ELSE 'flat' END "
               f"|| '. Revenue ' || {_money_sql('r.rev_curr')} || ' (' || {_yoy_sql('r.rev_yoy')} || '), spend ' || {_money_sql('r.spend_curr')} || ' (' || {_yoy_sql('r.spend_yoy')} || '). Top 3 ' "
               "|| CASE WHEN r.mode = 'ISSUE' THEN 'issues' ELSE 'improvements' END || ' by ROAS.'")
    method = _obj({k: "'\"" + v.replace("'", "''") + "\"'" for k, v in DECOMPOSITION_METHOD.items()})
    fields = {"SUBSIDIARY": _txt("r.SUBSIDIARY"), "mode": _txt("r.mode"), "top3": "coalesce(r.top3, '[]')", "overall_comment": _txt(overall),
              "detailed_comment": _txt("CASE WHEN r.top3 IS NULL THEN 'No top 3 selected.' ELSE r.lines END"), "decomposition_method": method, **{k: _num(f"r.{k}") for k in KPI}}
    q["subsidiary_documents"] = O.topics_ctes() + f""",
perf AS (SELECT SUBSIDIARY, {kpi_cols} FROM levels WHERE level = 1),
ni AS (SELECT diagnosis_subsidiary AS SUBSIDIARY, count(*) AS n, {_list(topic, 'pick_no')} AS top3, string_agg({line.format('decline')}, ' | ' ORDER BY pick_no) AS lines FROM ipick GROUP BY 1),
nm AS (SELECT diagnosis_subsidiary AS SUBSIDIARY, count(*) AS n, {_list(topic, 'pick_no')} AS top3, string_agg({line.format('improvement')}, ' | ' ORDER BY pick_no) AS lines FROM mpick GROUP BY 1),
md AS (
  SELECT p.*, ni.top3 AS it, ni.lines AS il, nm.top3 AS mt, nm.lines AS ml,
         CASE WHEN coalesce(coalesce(p.roas_delta, p.rev_delta), 0.0) < 0 THEN CASE WHEN coalesce(ni.n, 0) > 0 THEN 'ISSUE' ELSE 'IMPROVE' END
              WHEN coalesce(nm.n, 0) > 0 THEN 'IMPROVE' WHEN coalesce(ni.n, 0) > 0 THEN 'ISSUE' ELSE 'IMPROVE' END AS mode
  FROM perf p LEFT JOIN ni ON p.SUBSIDIARY = ni.SUBSIDIARY LEFT JOIN nm ON p.SUBSIDIARY = nm.SUBSIDIARY
),
r AS (SELECT *, CASE WHEN mode = 'ISSUE' THEN it ELSE mt END AS top3, CASE WHEN mode = 'ISSUE' THEN il ELSE ml END AS lines FROM md)
SELECT r.SUBSIDIARY, {_obj(fields)} AS document FROM r"""

    row = {c: _num(c) for c in DIV_OUT if c in DIV_DOUBLES} | {c: _txt(c) for c in ("SUBSIDIARY", "DIVISION", "Impact_raw_method", "Contribution_label")}
    row |= {"Residual_applied_flag": _int("Residual_applied_flag"), "division_rank": _int("division_rank"), "summary_text": _txt(_division_text_sql())}
    pr = [O.ratio(f"p.Revenue_{y}_sum", f"p.Spend_{y}_sum") for y in ("curr", "prev")]
    block = {"SUBSIDIARY": _txt("p.SUBSIDIARY"), "Parent_roas_curr": _num(pr[0]), "Parent_roas_prev": _num(pr[1]), "Parent_roas_delta": _num(f"coalesce({pr[0]} - {pr[1]}, 0.0)"),
             "Parent_roas_yoy_pct": _num(O.pct(*pr)), "rows": "x.held"}
    q["division_documents"] = _division_sql() + f""",
x AS (SELECT SUBSIDIARY, {_list(_obj(row), 'division_rank')} AS held FROM d GROUP BY SUBSIDIARY)
SELECT p.SUBSIDIARY, {_obj(block)} AS document FROM levels p JOIN x ON x.SUBSIDIARY = p.SUBSIDIARY WHERE p.level = 1"""

    def node(a: str, n: int) -> str:
        path = _obj({d: _txt(f"{a}.{d}") if i < n else "'null'" for i, d in enumerate(DIMENSIONS)})
        return _obj({"level": f"""'"LEVEL{n}"'""", "rule": _txt(f"{a}.rule"), "selected_path": path, "impact_adj": _num(f"{a}.Impact_adj"), "share_childsum": _num(f"{a}.Share_childsum")})
    trace = "'[' || " + " || ',' || ".join(node(f"s{k}", k) for k in (2, 3, 4)) + " || ']'"
    leaf = {**{d: _txt(f"s4.{d}") for d in DIMENSIONS}, "Impact_adj": _num("s4.Impact_adj"), "drill_trace": trace}
    q["leaf_documents"] = O.drill_ctes() + f"""
SELECT {', '.join(f's4.{d}' for d in DIMENSIONS)}, {_obj(leaf)} AS document
FROM sel4 s4 JOIN sel3 s3 ON s3.SUBSIDIARY = s4.SUBSIDIARY AND s3.CHANNEL = s4.CHANNEL AND s3.DIVISION = s4.DIVISION JOIN sel2 s2 ON s2.SUBSIDIARY = s4.SUBSIDIARY AND s2.CHANNEL = s4.CHANNEL"""

    figures = lambda a: (f"'Revenue ' || {_money_sql(a + '.revenue_curr')} || ' (' || {_yoy_sql(a + '.revenue_yoy')} || ') | Cost ' || {_money_sql(a + '.cost_curr')} || ' (' || {_yoy_sql(a + '.cost_yoy')} "  # noqa: E731
                         f"|| ') | ROAS ' || {_roas_sql(a + '.roas_curr')} || ' (' || {_yoy_sql(a + '.roas_yoy')} || ')'")
    up = {k: f"coalesce(pr.{k}_yoy, 0.0) * CASE WHEN (m.card_mode = 'ISSUE') = {'TRUE' if k == 'cpc' else 'FALSE'} THEN 1 ELSE -1 END" for k in ("cvr", "aov", "cpc")}
    yoy = lambda kpi: f"CASE {kpi} WHEN 'CVR' THEN cvr_yoy WHEN 'AOV' THEN aov_yoy WHEN 'CPC' THEN cpc_yoy END"
    reason = (f"CASE WHEN {yoy('driver')} IS NULL THEN driver || ': last year unknown' WHEN driver = yoy_leader THEN driver || ' ' || {_pct_sql(yoy('driver'))} || ', more than any other lever' "
              f"WHEN yoy_leader IS NOT NULL THEN driver || ' ' || {_pct_sql(yoy('driver'))} || '; ' || yoy_leader || ' leads with ' || {_pct_sql(yoy('yoy_leader'))} ELSE driver || ' ' || {_pct_sql(yoy('driver'))} END")
    item = _obj({"pick_no": _int("pick_no"), **{c: _txt(c) for c in ("CHANNEL", "DIVISION", "PRODUCT", "source", "driver", "yoy_leader", "contribution_label", "what_text")},
                 "impact_contribution_text": _txt("share"), "reason_text": _txt(reason), "so_what_text": _txt("PRODUCT || ': ' || contribution_label || ' ' || share || ', lever ' || driver")})
    card = {"SUBSIDIARY": _txt("s.SUBSIDIARY"), "display_mode": _txt("s.display_mode"), "topics": "coalesce(x.held, '[]')", "headline_division": _txt("s.headline_division"), "headline_pct": _num("s.hp"),
            **{c: _num(f"k.{c}") for c in ("revenue_curr", "revenue_yoy", "roas_curr", "roas_yoy")}}
    q["card_documents"] = (packs, figures, up, item, card)  # put together with the card summary below
    return q


def _card_documents_sql(parts: tuple, summary: str) -> str:
    packs, figures, up, item, card = parts
    return packs + f""",
ct AS (
  SELECT m.diagnosis_subsidiary, m.card_mode, CAST(m.pick_no AS BIGINT) AS pick_no, m.CHANNEL, m.DIVISION, m.PRODUCT, m.source, m.primary_driver AS driver, {_pct_sql('m.impact_contribution_pct')} AS share,
         pr.cvr_yoy, pr.aov_yoy, pr.cpc_yoy,
         CASE WHEN m.card_mode = 'ISSUE' THEN CASE WHEN m.source = 'selected' OR pr.revenue_delta < 0 THEN 'part of the fall' ELSE 'counterweight' END
              WHEN m.source = 'selected' OR pr.revenue_delta > 0 THEN 'part of the rise' ELSE 'drag' END AS contribution_label,
         CASE WHEN {up['cvr']} > 0 AND {up['cvr']} >= {up['cpc']} AND {up['cvr']} >= {up['aov']} THEN 'CVR'
              WHEN {up['cpc']} > 0 AND {up['cpc']} >= {up['aov']} THEN 'CPC' WHEN {up['aov']} > 0 THEN 'AOV' END AS yoy_leader,
         m.CHANNEL || ': ' || {figures('ch')} || '; ' || m.DIVISION || ': ' || {figures('dn')} AS what_text
  FROM merged m
  LEFT JOIN packs ch ON ch.level = 2 AND ch.SUBSIDIARY = m.diagnosis_subsidiary AND ch.CHANNEL = m.CHANNEL
  LEFT JOIN packs dn ON dn.level = 3 AND dn.SUBSIDIARY = m.diagnosis_subsidiary AND dn.CHANNEL = m.CHANNEL AND dn.DIVISION = m.DIVISION
  LEFT JOIN packs pr ON pr.level = 4 AND pr.SUBSIDIARY = m.diagnosis_subsidiary AND pr.CHANNEL = m.CHANNEL AND pr.DIVISION = m.DIVISION AND pr.PRODUCT = m.PRODUCT
),
x AS (SELECT diagnosis_subsidiary, card_mode, {_list(item, 'pick_no')} AS held FROM ct GROUP BY ALL)""" + summary + f"""
SELECT s.SUBSIDIARY, {_obj(card)} AS document
FROM s JOIN packs k ON k.level = 1 AND k.SUBSIDIARY = s.SUBSIDIARY LEFT JOIN x ON x.diagnosis_subsidiary = s.SUBSIDIARY AND x.card_mode = s.display_mode"""


def _figures_sql(revenue: str, revenue_yoy: str, cost: str, cost_yoy: str, roas: str, roas_yoy: str) -> str:
    return (f"'Revenue ' || {_money_sql(revenue)} || ' (' || {_yoy_sql(revenue_yoy)} || ') | Cost ' || {_money_sql(cost)} || ' (' || {_yoy_sql(cost_yoy)} || ') | ROAS ' "
            f"|| {_roas_sql(roas)} || ' (' || {_yoy_sql(roas_yoy)} || ')'")


def _run_summary_sql(packs: str, summary: str) -> str:
    so_what = ("CASE WHEN s.headline_division IS NULL THEN 'no division stands out' ELSE CASE WHEN s.display_mode = 'ISSUE' THEN 'falls with ' ELSE 'rises with ' END "
               f"|| concat_ws('/', s.top_channel, s.headline_division) || ' (' || {_pct_sql('s.hp')} || ')' END")
    step = ("CASE WHEN s.display_mode = 'ISSUE' THEN 'examine the ' ELSE 'extend the ' END || CASE s.top_driver WHEN 'CPC' THEN 'cost per click' WHEN 'CVR' THEN 'conversion rate' "
            "WHEN 'AOV' THEN 'order value' ELSE 'largest lever' END")
    years = f"Year IN ({FULL.curr_year}, {FULL.prev_year})"
    return packs + summary + f""",
w AS (SELECT count(*) AS n, count(*) FILTER (WHERE OBJECTIVE = 'CONVERSION') AS o, count(*) FILTER (WHERE OBJECTIVE = 'CONVERSION' AND DIVISION IN ('MX', 'VD', 'DA')) AS d FROM raw WHERE {years})
SELECT s.SUBSIDIARY, s.SUBSIDIARY || ' | Revenue ' || {_money_sql('k.revenue_curr')} || ' (' || {_yoy_sql('k.revenue_yoy')} || '), ROAS ' || {_roas_sql('k.roas_curr')} || ' (' || {_yoy_sql('k.roas_yoy')} || ') | '
       || {so_what} || ' | ' || {step} AS summary_line,
       (SELECT '{FULL.curr_year} vs {FULL.prev_year} (full years); objective = CONVERSION (' || o || '/' || n || ' rows); division in MX, VD, DA (' || d || '/' || o || ' rows)' FROM w) AS comparison
FROM s JOIN packs k ON k.level = 1 AND k.SUBSIDIARY = s.SUBSIDIARY"""


def _text_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    ra, pc = O.ratio, O.pct
    lever = {"CPC": "cost per click", "CVR": "conversion rate", "AOV": "order value"}
    named = lambda texts, col, other: f"CASE {col} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in texts.items()) + f" ELSE '{other}' END"

    # scalar functions
    cpc, cvr, aov = (ra(f"{a}_curr_sum", f"{b}_curr_sum") for a, b in (("Spend", "Clicks"), ("Orders", "Clicks"), ("Revenue", "Orders")))
    cpc_yoy, cvr_yoy = pc(cpc, ra("Spend_prev_sum", "Clicks_prev_sum")), pc(cvr, ra("Orders_prev_sum", "Clicks_prev_sum"))
    polarity = lambda x, sign: f"CASE WHEN {x} IS NULL THEN 'na' WHEN abs({x}) < 1e-12 THEN 'neutral' WHEN {sign}{x} > 0 THEN 'positive' ELSE 'negative' END"
    q["scalar_texts"] = O.engine_ctes() + f"""
SELECT level, concat_ws('|', {', '.join(DIMENSIONS)}) AS path,
       CASE WHEN {cpc_yoy} IS NULL THEN 'unknown' WHEN {cpc_yoy} > 1e-9 THEN 'up' WHEN {cpc_yoy} < -1e-9 THEN 'down' ELSE 'flat' END AS cpc_trend,
       {polarity(cpc_yoy, '-')} AS cpc_polarity, {polarity(cvr_yoy, '')} AS cvr_polarity,
       CASE WHEN {cvr_yoy} IS NULL THEN 'N/A' ELSE CASE WHEN round({cvr_yoy} * 100, 0) >= 0 THEN '+' ELSE '' END || printf('%.0f', round({cvr_yoy} * 100, 0) + 0.0) || '%p' END AS cvr_pp,
       CASE WHEN {cpc} IS NULL THEN 'N/A' ELSE '$' || printf('%.2f', round({cpc}, 2)) END AS cpc_text, CASE WHEN {cvr} IS NULL THEN 'N/A' ELSE printf('%.2f', round({cvr} * 100, 2)) || '%' END AS cvr_text,
       CASE WHEN {aov} IS NULL THEN 'N/A' ELSE {_money_sql(aov)} END AS aov_text, coalesce({cpc_yoy}, -1.0) >= 0 AS cpc_up
FROM levels"""

    # short texts of the fallback topics
    roas = [ra(f"l.Revenue_{y}_sum", f"l.Spend_{y}_sum") for y in ("curr", "prev")]
    figures = _figures_sql("l.Revenue_curr_sum", pc("l.Revenue_curr_sum", "l.Revenue_prev_sum"), "l.Spend_curr_sum", pc("l.Spend_curr_sum", "l.Spend_prev_sum"), roas[0], pc(*roas))
    q["fallback_texts"] = O.display_ctes() + f"""
SELECT f.diagnosis_subsidiary, f.CHANNEL, f.DIVISION, f.PRODUCT, f.mode_tag,
       CASE f.mode_tag WHEN 'ISSUE' THEN 'Win back the ' ELSE 'Build on the ' END || {named(lever, 'f.primary_driver', '?')} || '.' AS recommended_actions,
       'a) see where the ' || {named(lever, 'f.primary_driver', '?')} || CASE f.mode_tag WHEN 'ISSUE' THEN ' got worse' ELSE ' got better' END || '; b) follow it weekly' AS action_checklist,
       f.PRODUCT || ' | ' || {figures} AS summary_text, f.contribution_label || ' ' || {_pct_sql('f.impact_contribution_pct')} || ' (filled in)' AS why_selected_text
FROM fallback f JOIN levels l ON l.level = 4 AND l.SUBSIDIARY = f.SUBSIDIARY AND l.CHANNEL = f.CHANNEL AND l.DIVISION = f.DIVISION AND l.PRODUCT = f.PRODUCT"""

    # texts of the selected topics
    mode = "CASE WHEN t.mode_tag = 'ISSUE' THEN 'decline' ELSE 'improvement' END"
    rev_yoy, sp_yoy = pc("t.Revenue_curr_sum", "t.Revenue_prev_sum"), pc("t.Spend_curr_sum", "t.Spend_prev_sum")
    head = (f"t.PRODUCT || ' | revenue ' || {_money_sql('t.Revenue_curr_sum')} || ' (' || {_yoy_sql(rev_yoy)} || ') | spend ' || {_money_sql('t.Spend_curr_sum')} || ' (' || {_yoy_sql(sp_yoy)} "
            f"|| ') | ROAS ' || {_roas_sql('t.topic_roas_curr')} || ' (' || {_yoy_sql(pc('t.topic_roas_curr', 't.topic_roas_prev'))} || ')' "
            f"|| CASE WHEN t.mode_tag = 'ISSUE' THEN ' [decline driver]' WHEN {pc('ch.Revenue_curr_sum', 'ch.Revenue_prev_sum')} < 0 THEN ' [holds up in a shrinking channel]' ELSE '' END")
    detail = " || chr(10) || ".join([
        f"'1) channel ' || t.CHANNEL || ': ROAS ' || {_roas_sql(ra('ch.Revenue_curr_sum', 'ch.Spend_curr_sum'))} || ', share of subsidiary ' || {mode} || ' ' || {_pct_sql('t.channel_direct_pct')}",
        f"'2) division ' || t.DIVISION || ': ROAS ' || {_roas_sql(ra('dv.Revenue_curr_sum', 'dv.Spend_curr_sum'))} || ', share of channel ' || {mode} || ' ' || {_pct_sql('t.division_direct_pct')}",
        f"'3) product ' || t.PRODUCT || ': share of division ' || {mode} || ' ' || {_pct_sql('t.product_direct_pct')}",
        f"'4) driver ' || t.evidence_driver || ' YoY ' || {_pct_sql('t.driver_yoy')} || ' vs division ' || {_pct_sql('t.division_driver_yoy')}",
        "'5) ' || CASE WHEN t.tag = 'NEW' THEN 'no figures last year' WHEN t.tag = 'LOW_VOL' THEN 'few clicks or orders' WHEN t.signal_max_abs < 0.05 THEN 'no lever stands out' ELSE 'main lever: ' || t.evidence_driver END"])
    why = (f"'explains ' || {_pct_sql('t.impact_contribution_pct')} || ' of the ' || {mode} || ' through ' || coalesce(t.primary_driver, 'NONE') || ' (place ' || t.selection_rank || ' of ' || t.selection_pool_size "
           "|| ' in ' || t.CHANNEL || '/' || t.DIVISION || CASE t.tag WHEN 'NEW' THEN '; new this year' WHEN 'LOW_VOL' THEN '; small sample' ELSE '' END || ')'")

    def effect(k: str) -> str:
        harm = f"t.dlog_{k} > 0" if k == "CPC" else f"t.dlog_{k} < 0"
        d = f"coalesce(t.dlog_{k}, 0.0)"
        says = (f"CASE WHEN abs({d}) < 1e-12 THEN 'neutral' WHEN t.mode_tag = 'ISSUE' THEN CASE WHEN {harm} THEN 'pulls ROAS down' ELSE 'works against the fall' END "
                f"WHEN {harm} THEN 'works against the rise' ELSE 'lifts ROAS' END")
        text = _obj({"approx_pct": f"CAST(CAST(round(abs({d}) * 100) AS INT) AS VARCHAR)", "direction": _txt(says), "metric": f"""'"{k}"'"""})
        return f"{{'size': -abs({d}), 'name': '{k}', 'text': {text}}}"
    ranking = (f"CASE WHEN t.signal_max_abs > 0 THEN '[' || array_to_string(list_transform(list_sort([{', '.join(effect(k) for k in ('CVR', 'AOV', 'CPC'))}]), lambda x: x['text']), ',') || ']' ELSE 'null' END")
    rows = "SELECT * FROM itop UNION ALL BY NAME SELECT * FROM mtop"
    q["topic_texts"] = O.topics_ctes() + f"""
SELECT t.diagnosis_subsidiary, t.CHANNEL, t.DIVISION, t.PRODUCT, t.mode_tag, {head} AS summary_text, {detail} AS detail_text, {why} AS why_selected_text, t.signal_max_abs < 0.05 AS weak_signal,
       {ranking} AS kpi_ranking, 'LEVEL4:' || s4.rule AS drill_end
FROM ({rows}) t
JOIN sel4 s4 ON s4.SUBSIDIARY = t.SUBSIDIARY AND s4.CHANNEL = t.CHANNEL AND s4.DIVISION = t.DIVISION AND s4.PRODUCT = t.PRODUCT
LEFT JOIN levels ch ON ch.level = 2 AND ch.SUBSIDIARY = t.SUBSIDIARY AND ch.CHANNEL = t.CHANNEL
LEFT JOIN levels dv ON dv.level = 3 AND dv.SUBSIDIARY = t.SUBSIDIARY AND dv.CHANNEL = t.CHANNEL AND dv.DIVISION = t.DIVISION"""
    return q


def _oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    eng_d = set(ENGINE_COLUMNS[4:])
    q["engine_frame"] = O.engine_ctes() + f" SELECT {_sql_round(ENGINE_COLUMNS, eng_d)} FROM engine"
    q["engine_frame_mtd"] = O.engine_ctes(mtd=True) + f" SELECT {_sql_round(ENGINE_COLUMNS, eng_d)} FROM engine"
    q["parts_frame_mtd"] = q["engine_frame_mtd"]
    q["objective_filter_counts"] = "WITH " + O.raw_cte() + """
SELECT count(*) AS objective_rows_before,
       count(*) FILTER (WHERE upper(trim(OBJECTIVE)) = 'CONVERSION') AS objective_rows_after,
       count(*) FILTER (WHERE upper(trim(OBJECTIVE)) = 'CONVERSION') AS division_rows_before,
       count(*) FILTER (WHERE upper(trim(OBJECTIVE)) = 'CONVERSION' AND upper(trim(DIVISION)) IN ('MX', 'VD', 'DA')) AS division_rows_after
FROM raw"""
    err = lambda c: (f"count(*) FILTER (WHERE trim(CAST({c} AS VARCHAR)) <> '' AND NOT regexp_matches(replace(trim(CAST({c} AS VARCHAR)), ',', ''), "  # noqa: E731
                     f"'^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$')) AS {c}_errors")
    q["dq_parse_errors"] = "WITH " + O.raw_cte() + f"""
SELECT count(*) AS rows, {', '.join(err(c) for c in ('PLATFORM_SPEND_USD', 'GROSS_REVENUE', 'PLATFORM_CLICKS', 'GROSS_ORDERS'))}
FROM scoped"""
    q["mtd_cutoff"] = "WITH " + O.raw_cte() + f""",
c AS (SELECT max(Month) AS m FROM long WHERE Year = {MTD.curr_year})
SELECT (SELECT m FROM c) AS mtd_month,
       (SELECT max(Day) FROM long WHERE Year = {MTD.curr_year} AND Month = (SELECT m FROM c)) AS mtd_day"""
    q["level_rollup"] = O.engine_ctes() + f" SELECT {_sql_round(['level', *DIMENSIONS, *SUM_COLUMNS], set(SUM_COLUMNS))} FROM levels"
    q["kpi_subsidiary"] = _kpi_sql(1)
    q["kpi_channel"] = _kpi_sql(2)
    for name, lv in (("impact_root", 1), ("impact_channel", 2), ("impact_division", 3), ("impact_product", 4)):
        q[name] = O.engine_ctes() + "," + O.impact_cte("imp", lv) + f" SELECT {_sql_round(IMPACT_OUT, IMPACT_DOUBLES)} FROM imp"
    q["select_children"] = (O.engine_ctes() + "," + O.impact_cte("imp", 3) + "," + O.select_cte("sel", "imp", 3)
                            + " SELECT SUBSIDIARY, CHANNEL, DIVISION, rule, sel_rank, " + _sql_round(["Impact_adj", "top1_share", "top2_share", "impact_floor"], {"Impact_adj", "top1_share", "top2_share", "impact_floor"}) + " FROM sel")
    leaf_cols = [*DIMENSIONS, *SUM_COLUMNS, "Impact_raw", "Impact_adj", "Share_childsum", "Share_parentdelta", "Residual_parent",
                 "Residual_applied_flag", "rank2", "rank3", "rank4", "drill_trace_text"]
    q["drill_leaves"] = O.drill_ctes() + f" SELECT {_sql_round(leaf_cols, IMPACT_DOUBLES)} FROM leaves"
    ev = _events_sql(False)
    evd = {"parent_delta", "top1_share_childsum", "top2_share_childsum", "impact_floor"}
    q["drill_trace_events"] = ev + " SELECT focus_SUBSIDIARY, CAST(lvl AS BIGINT) AS lvl, level, rule, parent_SUBSIDIARY, parent_CHANNEL, parent_DIVISION, CAST(NULL AS VARCHAR) AS parent_PRODUCT, " + \
        _sql_round(["parent_delta", "top1_share_childsum", "top2_share_childsum", "impact_floor"], evd) + ", coalesce(selected_paths, '') AS selected_paths, rank2, rank3 FROM ev"
    q["trace_table"] = ev + " SELECT row_number() OVER (ORDER BY focus_SUBSIDIARY, lvl, rank2 NULLS FIRST, rank3 NULLS FIRST) AS step, focus_SUBSIDIARY, level, rule, parent_SUBSIDIARY, parent_CHANNEL, parent_DIVISION, CAST(NULL AS VARCHAR) AS parent_PRODUCT, " + \
        _sql_round(["parent_delta", "top1_share_childsum", "top2_share_childsum", "impact_floor"], evd) + ", coalesce(selected_paths, '') AS selected_paths FROM ev"
    q["candidate_metrics"] = O.drill_ctes() + f" SELECT {_sql_round(CAND_OUT, set(CAND_OUT[4:]))} FROM cands"
    q["scope_eligibility"] = O.drill_ctes() + " SELECT SUBSIDIARY, scope_defense_eligible FROM scope"
    q["issues_top3"] = O.drill_ctes() + f" SELECT {_sql_round(SEL_OUT, {'Impact_adj'})} FROM issues_sel"
    q["improvements_top3"] = O.drill_ctes() + f" SELECT {_sql_round(SEL_OUT, {'Impact_adj'})} FROM impr_sel"
    rca_d = set(RCA_OUT[4:]) - {"primary_driver", "tag"}
    for name, mode in (("rca_issue", "ISSUE"), ("rca_improve", "IMPROVE")):
        q[name] = O.engine_ctes() + f", r AS (SELECT * EXCLUDE (sc, sa, sp, rca_primary_driver), rca_primary_driver AS primary_driver FROM {O.rca_select('(SELECT * FROM levels WHERE level = 4)', mode)})" + \
            f" SELECT {_sql_round(RCA_OUT, rca_d)} FROM r"
    q["rca_join"] = _campaign_sql("issues")
    q["rca_join_improvements"] = _campaign_sql("impr")
    cd_cols = f"{', '.join(DIMENSIONS)}, mode_tag, tag, rca_primary_driver, primary_driver"
    q["confirmed_driver"] = O.enriched_ctes() + f" SELECT {cd_cols} FROM issues UNION ALL SELECT {cd_cols} FROM impr"
    pa_cols = f"{', '.join(DIMENSIONS)}, mode_tag, tag, primary_driver, action_code, checklist_code, recommended_actions, action_checklist"
    q["policy_actions"] = O.enriched_ctes() + f" SELECT {pa_cols} FROM issues UNION ALL SELECT {pa_cols} FROM impr"
    kind = "CASE CHANNEL WHEN '1-URGENT' THEN 'SEARCH' WHEN '2-HIGH' THEN 'PMAX' WHEN '3-MEDIUM' THEN 'PMAX' ELSE 'OTHER' END"
    named = "CASE CHANNEL " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CHANNEL_NAMES.items()) + " ELSE CHANNEL END"
    leaf_rows = "(SELECT * FROM levels WHERE level = 4)"
    modes = " UNION ALL ".join(f"SELECT *, '{m}' AS mode_tag FROM {O.rca_select(leaf_rows, 'ISSUE' if m == 'ISSUE' else 'IMPROVE')}" for m in ("ISSUE", "IMPROVE", "DEFENSE"))
    q["policy_codes"] = O.engine_ctes() + f""",
pm AS ({modes}),
pc AS (SELECT *, {O.confirmed_sql()} AS driver, {kind} AS kind FROM pm)
SELECT SUBSIDIARY, {named} AS CHANNEL, DIVISION, PRODUCT, mode_tag, tag, driver AS primary_driver, kind AS channel_type,
       CASE WHEN tag <> 'NORMAL' THEN 'TAG_' || tag WHEN mode_tag = 'ISSUE' THEN 'ISSUE_' || driver || '_' || kind ELSE 'IMPROVE_' || driver || '_' || kind END AS action_code,
       CASE WHEN tag <> 'NORMAL' THEN 'TAG_' || tag WHEN mode_tag = 'ISSUE' THEN 'ISSUE_' || driver || '_' || kind ELSE 'SCALE_' || driver || '_' || kind END AS checklist_code
FROM pc"""
    q["division_parallel"] = _division_sql() + f" SELECT {_sql_round(DIV_OUT, DIV_DOUBLES)}, {_division_text_sql()} AS summary_text FROM d"
    q["division_headline"] = _division_sql() + """,
h AS (
  SELECT *, CASE WHEN Contribution_label = 'DECLINE_DRIVER' THEN Contribution_to_decline_pct WHEN Contribution_label = 'GROWTH_DRIVER' THEN Contribution_to_growth_pct END AS hp
  FROM d
)
SELECT SUBSIDIARY, DIVISION AS headline_division, Contribution_label AS headline_label, """ + O.rnd("hp") + """ AS headline_pct
FROM h WHERE hp > 0 QUALIFY row_number() OVER (PARTITION BY SUBSIDIARY ORDER BY hp DESC, division_rank) = 1"""
    tn_d = set(TOPIC_NUM[6:])
    q["topic_contribution"] = O.topics_ctes() + f" SELECT {_sql_round(TOPIC_NUM, tn_d)} FROM itop UNION ALL SELECT {_sql_round(TOPIC_NUM, tn_d)} FROM mtop"
    q["topic_rank"] = O.topics_ctes() + f" SELECT {', '.join(RANK_OUT)} FROM itop UNION ALL SELECT {', '.join(RANK_OUT)} FROM mtop"
    ev_d = set(EVID_OUT[7:])
    q["driver_evidence"] = O.topics_ctes() + f" SELECT {_sql_round(EVID_OUT, ev_d)} FROM itop UNION ALL SELECT {_sql_round(EVID_OUT, ev_d)} FROM mtop"
    q["top3_diverse"] = O.topics_ctes() + f" SELECT {', '.join(PICK_OUT)} FROM ipick UNION ALL SELECT {', '.join(PICK_OUT)} FROM mpick"
    kpi_cols = _kpi_cols_sql()
    q["subsidiary_report"] = O.topics_ctes() + f""",
perf AS (SELECT SUBSIDIARY, {kpi_cols} FROM levels WHERE level = 1),
ni AS (SELECT diagnosis_subsidiary AS SUBSIDIARY, count(*) AS n, string_agg(CHANNEL || '/' || DIVISION || '/' || PRODUCT, ' | ' ORDER BY pick_no) AS paths FROM ipick GROUP BY 1),
nm AS (SELECT diagnosis_subsidiary AS SUBSIDIARY, count(*) AS n, string_agg(CHANNEL || '/' || DIVISION || '/' || PRODUCT, ' | ' ORDER BY pick_no) AS paths FROM mpick GROUP BY 1),
rep AS (
  SELECT p.*, coalesce(ni.n, 0) AS n_issues, coalesce(nm.n, 0) AS n_improvements, ni.paths AS ip, nm.paths AS mp,
         CASE WHEN coalesce(coalesce(p.roas_delta, p.rev_delta), 0.0) < 0 THEN CASE WHEN coalesce(ni.n, 0) > 0 THEN 'ISSUE' ELSE 'IMPROVE' END
              WHEN coalesce(nm.n, 0) > 0 THEN 'IMPROVE' WHEN coalesce(ni.n, 0) > 0 THEN 'ISSUE' ELSE 'IMPROVE' END AS mode
  FROM perf p LEFT JOIN ni ON p.SUBSIDIARY = ni.SUBSIDIARY LEFT JOIN nm ON p.SUBSIDIARY = nm.SUBSIDIARY
)
SELECT SUBSIDIARY, mode, {', '.join(KPI)}, n_issues, n_improvements,
       coalesce(CASE WHEN mode = 'ISSUE' THEN ip ELSE mp END, '') AS top3_paths
FROM rep"""
    q["issues_view"] = _view_sql()
    q["improvements_view"] = _view_sql("impr")
    # month-to-date twins: leaves without previous spend exercise the null-impact paths
    for name, lv in (("impact_channel_mtd", 2), ("impact_product_mtd", 4)):
        q[name] = O.engine_ctes(mtd=True) + "," + O.impact_cte("imp", lv) + f" SELECT {_sql_round(IMPACT_OUT, IMPACT_DOUBLES)} FROM imp"
    q["drill_leaves_mtd"] = O.drill_ctes(True) + f" SELECT {_sql_round(leaf_cols, IMPACT_DOUBLES)} FROM leaves"
    q["drill_trace_events_mtd"] = _events_sql(True) + " SELECT focus_SUBSIDIARY, CAST(lvl AS BIGINT) AS lvl, level, rule, parent_SUBSIDIARY, parent_CHANNEL, parent_DIVISION, CAST(NULL AS VARCHAR) AS parent_PRODUCT, " + \
        _sql_round(["parent_delta", "top1_share_childsum", "top2_share_childsum", "impact_floor"], evd) + ", coalesce(selected_paths, '') AS selected_paths, rank2, rank3 FROM ev"
    q["issues_top3_mtd"] = O.drill_ctes(True) + f" SELECT {_sql_round(SEL_OUT, {'Impact_adj'})} FROM issues_sel"
    q["improvements_top3_mtd"] = O.drill_ctes(True) + f" SELECT {_sql_round(SEL_OUT, {'Impact_adj'})} FROM impr_sel"
    q["rca_join_mtd"] = _campaign_union_sql(True)
    fo = ", ".join(O.rnd(c) + f" AS {c}" if c == "impact_contribution_pct" else c for c in FALLBACK_OUT)
    q["fallback_topics"] = O.display_ctes() + f" SELECT {fo} FROM fallback"
    mo = ", ".join(O.rnd(c) + f" AS {c}" if c == "impact_contribution_pct" else (f"CAST({c} AS BIGINT) AS {c}" if c == "pick_no" else c) for c in MERGED_OUT)
    q["merged_topics"] = O.display_ctes() + f" SELECT {mo} FROM merged"
    ratios = {"roas": ("Revenue", "Spend"), "cvr": ("Orders", "Clicks"), "aov": ("Revenue", "Orders"), "cpc": ("Spend", "Clicks")}
    rr = {k: [O.ratio(f"{n}_{y}_sum", f"{d}_{y}_sum") for y in ("curr", "prev")] for k, (n, d) in ratios.items()}
    packs = O.display_ctes() + f""",
packs AS (
  SELECT level, SUBSIDIARY, CHANNEL, DIVISION, PRODUCT, Revenue_curr_sum AS revenue_curr, Revenue_curr_sum - Revenue_prev_sum AS revenue_delta,
         {O.pct('Revenue_curr_sum', 'Revenue_prev_sum')} AS revenue_yoy, Spend_curr_sum AS cost_curr, {O.pct('Spend_curr_sum', 'Spend_prev_sum')} AS cost_yoy,
         {rr['roas'][0]} AS roas_curr, {', '.join(f"{O.pct(*v)} AS {k}_yoy" for k, v in rr.items())}
  FROM levels
)"""
    card = ", ".join(f"{O.rnd(f'{a}.{c}')} AS {s}_{c}" for s, a in (("channel", "ch"), ("division", "dn"), ("product", "pr")) for c in CARD_KPI)
    up = {k: f"coalesce(pr.{k}_yoy, 0.0) * CASE WHEN (m.card_mode = 'ISSUE') = {'TRUE' if k == 'cpc' else 'FALSE'} THEN 1 ELSE -1 END" for k in ("cvr", "aov", "cpc")}
    q["card_topics"] = packs + f"""
SELECT m.diagnosis_subsidiary, m.card_mode, CAST(m.pick_no AS BIGINT) AS pick_no, m.CHANNEL, m.DIVISION, m.PRODUCT, m.source,
       CASE WHEN m.card_mode = 'ISSUE' THEN CASE WHEN m.source = 'selected' OR pr.revenue_delta < 0 THEN 'part of the fall' ELSE 'counterweight' END
            WHEN m.source = 'selected' OR pr.revenue_delta > 0 THEN 'part of the rise' ELSE 'drag' END AS contribution_label,
       m.primary_driver AS driver,
       CASE WHEN {up['cvr']} > 0 AND {up['cvr']} >= {up['cpc']} AND {up['cvr']} >= {up['aov']} THEN 'CVR'
            WHEN {up['cpc']} > 0 AND {up['cpc']} >= {up['aov']} THEN 'CPC' WHEN {up['aov']} > 0 THEN 'AOV' END AS yoy_leader,
       {card}
FROM merged m
LEFT JOIN packs ch ON ch.level = 2 AND ch.SUBSIDIARY = m.diagnosis_subsidiary AND ch.CHANNEL = m.CHANNEL
LEFT JOIN packs dn ON dn.level = 3 AND dn.SUBSIDIARY = m.diagnosis_subsidiary AND dn.CHANNEL = m.CHANNEL AND dn.DIVISION = m.DIVISION
LEFT JOIN packs pr ON pr.level = 4 AND pr.SUBSIDIARY = m.diagnosis_subsidiary AND pr.CHANNEL = m.CHANNEL AND pr.DIVISION = m.DIVISION AND pr.PRODUCT = m.PRODUCT"""
    q["report_cards"] = O.display_ctes() + """,
rep_mode AS (
  SELECT l.SUBSIDIARY,
         CASE WHEN coalesce(coalesce(""" + O.ratio("l.Revenue_curr_sum", "l.Spend_curr_sum") + " - " + O.ratio("l.Revenue_prev_sum", "l.Spend_prev_sum") + """, l.Revenue_curr_sum - l.Revenue_prev_sum), 0.0) < 0
              THEN CASE WHEN (SELECT count(*) FROM ipick i WHERE i.diagnosis_subsidiary = l.SUBSIDIARY) > 0 THEN 'ISSUE' ELSE 'IMPROVE' END
              WHEN (SELECT count(*) FROM mpick i WHERE i.diagnosis_subsidiary = l.SUBSIDIARY) > 0 THEN 'IMPROVE'
              WHEN (SELECT count(*) FROM ipick i WHERE i.diagnosis_subsidiary = l.SUBSIDIARY) > 0 THEN 'ISSUE' ELSE 'IMPROVE' END AS display_mode
  FROM levels l WHERE l.level = 1
)
SELECT r.SUBSIDIARY, r.display_mode, CAST(count(m.PRODUCT) AS BIGINT) AS n_topics,
       coalesce(string_agg(m.CHANNEL || '/' || m.DIVISION || '/' || m.PRODUCT, ' | ' ORDER BY m.pick_no), '') AS topic_paths
FROM rep_mode r LEFT JOIN merged m ON m.diagnosis_subsidiary = r.SUBSIDIARY AND m.card_mode = r.display_mode
GROUP BY r.SUBSIDIARY, r.display_mode"""
    q.update(O.text_queries(FULL, MTD))
    q.update(O.focus_queries(_sql_round, IMPACT_DOUBLES))
    q.update(_document_sql(kpi_cols, packs))
    for name, src, way in (("issues_ordered", "issues", "ASC"), ("improvements_ordered", "impr", "DESC")):
        q[name] = O.enriched_ctes() + f""" SELECT diagnosis_subsidiary, {', '.join(DIMENSIONS)}, {O.rnd('Impact_adj')} AS Impact_adj, mode_tag,
       row_number() OVER (ORDER BY diagnosis_subsidiary, Impact_adj {way}, CHANNEL, DIVISION, PRODUCT) AS position FROM {src}"""
    cards = q["report_cards"]
    division_part = _division_sql()[len(O.engine_ctes()):]
    q["card_summary"] = cards[: cards.index("\nSELECT r.SUBSIDIARY, r.display_mode, CAST(")] + division_part + f"""
SELECT r.SUBSIDIARY, r.display_mode, h.DIVISION AS headline_division, {O.rnd('h.pct')} AS headline_pct, t.CHANNEL AS top_channel, t.primary_driver AS top_driver
FROM rep_mode r
LEFT JOIN merged t ON t.diagnosis_subsidiary = r.SUBSIDIARY AND t.card_mode = r.display_mode AND t.pick_no = 1
LEFT JOIN (
  SELECT SUBSIDIARY, DIVISION, division_rank, 'ISSUE' AS mode, Contribution_to_decline_pct AS pct FROM d WHERE Contribution_label = 'DECLINE_DRIVER' AND Contribution_to_decline_pct > 0
  UNION ALL
  SELECT SUBSIDIARY, DIVISION, division_rank, 'IMPROVE', Contribution_to_growth_pct FROM d WHERE Contribution_label = 'GROWTH_DRIVER' AND Contribution_to_growth_pct > 0
) h ON h.SUBSIDIARY = r.SUBSIDIARY AND h.mode = r.display_mode
QUALIFY row_number() OVER (PARTITION BY r.SUBSIDIARY ORDER BY h.pct DESC, h.division_rank) = 1"""
    base = O.display_ctes()
    whole = q["card_summary"][len(base):]  # its own steps, then the rows, which become the step ``s``
    steps, rows = whole.rsplit("\nSELECT r.SUBSIDIARY, r.display_mode, h.DIVISION", 1)
    summary = steps + ",\ns AS (SELECT r.SUBSIDIARY, r.display_mode, h.DIVISION" + rows.replace("AS headline_pct,", "AS headline_pct, h.pct AS hp,") + ")"
    q["card_documents"] = _card_documents_sql(q["card_documents"], summary)
    q["run_summary"] = _run_summary_sql(packs, summary)
    q.update(_text_sql())
    return q


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "engine_frame": q_engine_frame,
    "engine_frame_mtd": q_engine_frame_mtd,
    "objective_filter_counts": q_objective_filter_counts,
    "dq_parse_errors": q_dq_parse_errors,
    "mtd_cutoff": q_mtd_cutoff,
    "level_rollup": q_level_rollup,
    "kpi_subsidiary": q_kpi_subsidiary,
    "kpi_channel": q_kpi_channel,
    "impact_root": _impact(1),
    "impact_channel": _impact(2),
    "impact_division": _impact(3),
    "impact_product": _impact(4),
    "select_children": q_select_children,
    "drill_leaves": q_drill_leaves,
    "drill_trace_events": q_drill_trace_events,
    "trace_table": q_trace_table,
    "candidate_metrics": q_candidate_metrics,
    "scope_eligibility": q_scope_eligibility,
    "issues_top3": q_issues_top3,
    "improvements_top3": q_improvements_top3,
    "rca_issue": _rca("ISSUE"),
    "rca_improve": _rca("IMPROVE"),
    "rca_join": q_rca_join,
    "rca_join_improvements": q_rca_join_improvements,
    "confirmed_driver": q_confirmed_driver,
    "policy_actions": q_policy_actions,
    "policy_codes": q_policy_codes,
    "division_parallel": q_division_parallel,
    "division_headline": q_division_headline,
    "topic_contribution": q_topic_contribution,
    "topic_rank": q_topic_rank,
    "driver_evidence": q_driver_evidence,
    "top3_diverse": q_top3_diverse,
    "subsidiary_report": q_subsidiary_report,
    "issues_view": q_issues_view,
    "improvements_view": q_improvements_view,
    "fallback_topics": q_fallback_topics,
    "merged_topics": q_merged_topics,
    "report_cards": q_report_cards,
    "card_topics": q_card_topics,
    "card_summary": q_card_summary,
    "impact_channel_mtd": _impact_mtd(2),
    "impact_product_mtd": _impact_mtd(4),
    "drill_leaves_mtd": q_drill_leaves_mtd,
    "drill_trace_events_mtd": q_drill_trace_events_mtd,
    "issues_top3_mtd": q_issues_top3_mtd,
    "improvements_top3_mtd": q_improvements_top3_mtd,
    "rca_join_mtd": q_rca_join_mtd,
    "text_source_frame": q_text_source_frame,
    "text_source_frame_mtd": q_text_source_frame_mtd,
    "text_source_facts": q_text_source_facts,
    "wide_frame": q_wide_frame,
    "parts_frame_mtd": q_parts_frame_mtd,
    "issues_ordered": q_issues_ordered,
    "improvements_ordered": q_improvements_ordered,
    "drill_focuses": q_drill_focuses,
    "focus_events": q_focus_events,
    "focus_selections": q_focus_selections,
    "merged_runs": q_merged_runs,
    "subsidiary_documents": q_subsidiary_documents,
    "division_documents": q_division_documents,
    "leaf_documents": q_leaf_documents,
    "card_documents": q_card_documents,
    "topic_texts": q_topic_texts,
    "fallback_texts": q_fallback_texts,
    "run_summary": q_run_summary,
    "scalar_texts": q_scalar_texts,
}

ORACLE: dict[str, str] = _oracle()
