"""End-to-end plans: engine frame -> analysis -> report tables (section 3 of the design).

One plan covers every subsidiary; the reference's per-subsidiary loop becomes
the partition key of the windows and joins.  Jobs run only at the few cut
points (level rollup, per-level drill candidates) and at the sinks.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roaslens.config import EngineConfig
from roaslens.operators.display import card_topics, existing_topics, fallback_topics, merged_topics, report_cards
from roaslens.operators.division import division_blocks, division_headline, division_parallel
from roaslens.operators.drill import ImpactRun, run_impact
from roaslens.operators.levels import level_rollup, level_rows
from roaslens.operators.policy import enrich_actions
from roaslens.operators.rootcause import attach_rca_by_list
from roaslens.operators.topics import TOPIC_COLUMNS, report_rows, subsidiary_reports, top3_by_subsidiary
from roaslens.session import cut, in_parallel
from roaslens.sinks.report import campaign_table, campaign_view, output_order, trace_table, write_report, write_summary
from roaslens.sources.ingest import build_engine_frame


@dataclass
class Analysis:
    levels: DataFrame
    run: ImpactRun
    selected: DataFrame        # issues + improvements (column ``list``) with RCA and actions, cut
    subsidiaries: DataFrame    # distinct subsidiaries (A11)

    @property
    def issues(self) -> DataFrame:
        return self.selected.filter(F.col("list") == "issues")

    @property
    def improvements(self) -> DataFrame:
        return self.selected.filter(F.col("list") == "improvements")


def analyze(engine: DataFrame, cfg: EngineConfig, levels: DataFrame | None = None) -> Analysis:
    """``run_subsidiary_analysis`` for all subsidiaries in one plan.

    Cut points: the level rollup, the selection candidates of every parent,
    and the (at most 6 per subsidiary) selected leaves with RCA and actions.
    """
    if levels is None:
        levels = cut(level_rollup(engine))
    run = run_impact(engine, cfg, per_subsidiary=True, levels=levels)
    leaf = level_rows(levels, 4)
    both = run.issues.withColumn("list", F.lit("issues")).unionByName(
        run.improvements.withColumn("list", F.lit("improvements")), allowMissingColumns=True)
    sel = enrich_actions(attach_rca_by_list(both, leaf)).withColumn("diagnosis_subsidiary", F.col("SUBSIDIARY"))
    subs = level_rows(levels, 1).select("SUBSIDIARY").filter(F.col("SUBSIDIARY").isNotNull())
    return Analysis(levels, run, cut(sel), subs)


@dataclass
class Report:
    cfg: EngineConfig
    engine: DataFrame
    analysis: Analysis
    tables: dict[str, DataFrame]
    sections: dict[str, DataFrame]
    meta: dict[str, Any] = field(default_factory=dict)


def build_report(engine: DataFrame, cfg: EngineConfig, meta: dict[str, Any] | None = None,
                 analysis: Analysis | None = None) -> Report:
    """All report tables as lazy DataFrames (section 3.1 of the design)."""
    a = analysis if analysis is not None else analyze(engine, cfg)
    levels = a.levels
    topics = cut(report_rows(a.selected, levels))
    # shared by several outputs: a few rows per subsidiary each
    top3, divisions = in_parallel([lambda: cut(top3_by_subsidiary(topics, cfg)), lambda: cut(division_parallel(levels))])
    issue_topics = topics.filter(F.col("list") == "issues")
    improve_topics = topics.filter(F.col("list") == "improvements")
    issues_top3 = top3.filter(F.col("list") == "issues")
    improvements_top3 = top3.filter(F.col("list") == "improvements")
    headline = division_headline(divisions)
    reports, merged = in_parallel([
        lambda: cut(subsidiary_reports(levels, issues_top3, improvements_top3)),
        lambda: cut(merged_topics(existing_topics(top3, topics, cfg), fallback_topics(levels), cfg)),
    ])
    card_rows = cut(card_topics(levels, top3, merged))
    cards = report_cards(levels, reports, card_rows, headline)
    # The tables hold at most 6 rows per subsidiary
    iss = a.issues.orderBy(*output_order("issues"))
    imp = a.improvements.orderBy(*output_order("improvements"))
    tables = {
        "issues": campaign_table(iss),
        "improvements": campaign_table(imp),
        "issues_view": campaign_view(iss, cfg.curr_year, cfg.prev_year),
        "improvements_view": campaign_view(imp, cfg.curr_year, cfg.prev_year),
        "division_parallel": divisions.orderBy("SUBSIDIARY", "division_rank").drop("division_rank"),
        "trace": trace_table(a.run.drill.events).orderBy("step"),
    }
    sections = {
        "subsidiaries_analyzed": a.subsidiaries,
        "division_parallel_contribution": division_blocks(divisions, levels),
        "division_headline": headline,
        "subsidiary_reports": reports,
        "issues_top3_products_by_subsidiary": issues_top3,
        "improvements_top3_products_by_subsidiary": improvements_top3,
        "merged_topics": merged,
        "card_topics": card_rows,
        "report_cards": cards,
        "issues_top_products": issue_topics.select(*TOPIC_COLUMNS),
        "improvements_top_products": improve_topics.select(*TOPIC_COLUMNS),
    }
    return Report(cfg, engine, a, tables, sections, dict(meta or {}))


def run_report(spark: SparkSession, raw: DataFrame, cfg: EngineConfig, out_dir: str | None = None,
               fmt: str = "parquet", check_quality: bool = True) -> Report:
    """``run_reporting_pipeline``: raw table -> engine frame (+ meta) -> report -> sinks."""
    engine, meta = build_engine_frame(raw, cfg, check_quality=check_quality)
    rep = build_report(engine, cfg, meta)
    if out_dir:
        write_report(rep.tables, out_dir, fmt)
        write_summary(spark, rep.sections, meta, out_dir)
    return rep
