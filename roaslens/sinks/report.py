"""Output tables and writers (K1-K7).

Tables are written one directory per table (Parquet by default, zstd), the
distributed replacement of the single workbook.  Nothing is collected to the
driver: the summary document is written as JSON per section.
"""

from __future__ import annotations

import json
import uuid
from functools import partial
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roaslens.functions.exprs import clean_number, fmt_money, fmt_pct, fmt_roas, paths_text, pct_change, safe_ratio
from roaslens.scale import numbered
from roaslens.schema import DIMENSIONS, ENGINE_COLUMNS, SUM_COLUMNS
from roaslens.session import in_parallel

CAMPAIGN_COLUMNS = [
    "diagnosis_subsidiary", *DIMENSIONS, *SUM_COLUMNS,
    "Impact_raw", "Impact_adj", "Share_childsum", "Share_parentdelta", "Residual_parent", "Residual_applied_flag",
    "mode_tag", "primary_driver", "tag", "dlog_CVR", "dlog_AOV", "dlog_CPC", "total_dlog_roas",
    "CPC_curr", "CPC_prev", "CVR_curr", "CVR_prev", "AOV_curr", "AOV_prev", "ROAS_curr", "ROAS_prev",
    "campaign_diagnosis_mode", "recommended_actions", "action_checklist", "drill_trace_text",
]


def campaign_table(rows: DataFrame) -> DataFrame:
    """K2: issues / improvements table (38 columns in fixed order)."""
    return rows.select(*CAMPAIGN_COLUMNS)


def campaign_view(rows: DataFrame, curr_year: int, prev_year: int) -> DataFrame:
    """K3: formatted view with the run's years in the column names."""
    rc, rp, sc, sp = (F.col(c) for c in ("Revenue_curr_sum", "Revenue_prev_sum", "Spend_curr_sum", "Spend_prev_sum"))
    roas_c = F.coalesce(F.col("ROAS_curr"), safe_ratio(rc, sc))
    roas_p = F.coalesce(F.col("ROAS_prev"), safe_ratio(rp, sp))
    adj = F.col("Impact_adj")
    impact = F.when(adj.isNull(), F.lit("N/A")).otherwise(
        F.concat(F.when(F.round(adj, 3) >= 0, F.lit("+")).otherwise(F.lit("")), F.format_string("%.3f", F.round(adj, 3) + F.lit(0.0)))
    )
    return rows.select(
        F.col("diagnosis_subsidiary").alias("subsidiary"), F.col("CHANNEL").alias("media"), F.col("DIVISION").alias("bu"),
        F.col("PRODUCT").alias("product"), F.col("mode_tag").alias("mode"), F.col("primary_driver").alias("driver"),
        impact.alias("impact_roas"),
        fmt_money(rc).alias(f"revenue_{curr_year}"), fmt_money(rp).alias(f"revenue_{prev_year}"),
        fmt_pct(pct_change(rc, rp)).alias("revenue_yoy"),
        fmt_money(sc).alias(f"spend_{curr_year}"), fmt_money(sp).alias(f"spend_{prev_year}"),
        fmt_pct(pct_change(sc, sp)).alias("spend_yoy"),
        fmt_roas(roas_c).alias(f"roas_{curr_year}"), fmt_roas(roas_p).alias(f"roas_{prev_year}"),
        fmt_pct(pct_change(roas_c, roas_p)).alias("roas_yoy"),
        "tag", F.col("recommended_actions").alias("action_one"), F.col("action_checklist").alias("checklist"),
        F.col("drill_trace_text").alias("trace"),
    )


def trace_table(events: DataFrame) -> DataFrame:
    """K4 trace: one row per visited parent, ``step`` numbered in event order.

    Order: subsidiary, level, then the selection ranks of the parent's path; no window spans all events."""
    ranks = [F.col(c).asc_nulls_first() for c in events.columns if c.startswith("rank")]
    e = numbered(events, [F.col("focus_SUBSIDIARY").asc_nulls_first(), F.col("lvl").asc(), *ranks], "step")
    return e.select(
        "step", "focus_SUBSIDIARY", "level", "rule",
        *[F.col("parent_path").getField(d).alias(f"parent_{d}") for d in DIMENSIONS],
        "parent_delta", "top1_share_childsum", "top2_share_childsum", "impact_floor",
        paths_text("selected_paths").alias("selected_paths"),
    )


def output_order(name: str) -> list[Column]:
    """Order of the issues (most negative impact first) and the improvements (most positive first) over all
    subsidiaries, ties by the dims."""
    adj = F.col("Impact_adj")
    return [F.col("diagnosis_subsidiary").asc(), adj.asc() if name == "issues" else adj.desc(), *[F.col(d).asc() for d in ("CHANNEL", "DIVISION", "PRODUCT")]]


def clean_for_export(df: DataFrame) -> DataFrame:
    """NaN / inf -> null in double columns; structs and arrays -> JSON text."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t in ("double", "float"):
            out.append(clean_number(F.col(f.name)).alias(f.name))
        elif t in ("struct", "array", "map"):
            out.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def write_report(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """K7: every table to ``out_dir/<name>`` (Parquet/zstd, or csv/json); the tables are small and written side by side."""
    if fmt not in ("parquet", "csv", "json"):
        raise ValueError(f"unknown format {fmt}")

    def write(name: str) -> None:
        df = clean_for_export(tables[name]) if fmt == "csv" else tables[name]
        w, path = df.write.mode(mode), f"{out_dir.rstrip('/')}/{name}"
        if fmt == "parquet":
            w.option("compression", "zstd").parquet(path)
        elif fmt == "csv":
            w.option("header", True).csv(path)
        else:
            w.json(path)

    in_parallel([partial(write, name) for name in tables])


def comparison_window_text(meta: dict[str, Any]) -> str:
    """The compared windows and the filters applied, from the run metadata."""
    c, p = meta.get("curr_year"), meta.get("prev_year")
    if meta.get("mtd_applied"):
        m = int(meta.get("mtd_month_cutoff", 0))
        if meta.get("mtd_day_cutoff") is not None:
            d = int(meta["mtd_day_cutoff"])
            window = f"{c}-{m:02d}-01..{c}-{m:02d}-{d:02d} vs {p}-{m:02d}-01..{p}-{m:02d}-{d:02d}"
        else:
            window = f"{c}-{m:02d} vs {p}-{m:02d} (whole month)"
    else:
        window = f"{c} vs {p} (full years)"
    filters = []
    if meta.get("objective_filter_applied"):
        filters.append(f"objective = {meta.get('objective_value')} ({meta.get('objective_rows_after')}/{meta.get('objective_rows_before')} rows)")
    if meta.get("division_filter_applied"):
        filters.append(f"division in {', '.join(meta.get('division_filter_values', []))} "
                       f"({meta.get('division_rows_after')}/{meta.get('division_rows_before')} rows)")
    return window + ("; " + "; ".join(filters) if filters else "")


#: K1: how the figures of the summary came about, in this project's words.
DECOMPOSITION_METHOD = {
    "division_contribution_pct": "share of the subsidiary's ROAS change in its own direction, from Impact_adj",
    "impact_adj": "Impact_raw plus the residual, dealt to the children by |Impact_raw|",
    "impact_raw": "log-mean (LMDI) part of the parent's ROAS change; the plain difference where a logarithm is undefined",
}


def write_summary(spark: SparkSession, sections: dict[str, DataFrame], meta: dict[str, Any], out_dir: str) -> None:
    """K1: the summary document as one JSON directory per section plus a meta row."""
    in_parallel([partial(df.write.mode("overwrite").json, f"{out_dir.rstrip('/')}/summary/{name}") for name, df in sections.items()])
    for name, value in (("comparison_meta", meta), ("decomposition_method", DECOMPOSITION_METHOD)):
        spark.range(1).select(F.lit(json.dumps(value, default=str, sort_keys=True)).alias("value")).write.mode("overwrite").text(f"{out_dir.rstrip('/')}/summary/{name}")


def write_snapshot(engine: DataFrame, path: str, run_key: str, meta: dict[str, Any]) -> None:
    """K5: engine frame as Parquet/zstd in a folder of its own, then a one-row table with its run key.

    The row comes last and names the folder, so a key never meets the frame of another run; write
    errors are ignored.  Frames of former runs stay until the caller removes them."""
    folder = f"engine-{uuid.uuid4().hex}"
    try:
        engine.select(*ENGINE_COLUMNS).write.option("compression", "zstd").parquet(f"{path}/{folder}")
        engine.sparkSession.createDataFrame([(run_key, folder, json.dumps(meta, default=str))], "run_key string, folder string, meta string") \
            .write.mode("overwrite").parquet(f"{path}/run")
    except Exception:  # noqa: BLE001 - a failed cache write must not fail the run
        pass


def read_snapshot(spark: SparkSession, path: str, run_key: str) -> tuple[DataFrame, dict[str, Any]] | None:
    """The stored engine frame when its run key matches, else None."""
    try:
        row = spark.read.parquet(f"{path}/run").first()
    except Exception:  # noqa: BLE001
        return None
    if row is None or row["run_key"] != run_key:
        return None
    meta = json.loads(row["meta"])
    meta["cache_hit"] = True
    return spark.read.parquet(f"{path}/{row['folder']}"), meta
