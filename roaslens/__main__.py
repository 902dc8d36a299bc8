"""Command line: ``python -m roaslens --input PATH [--input PATH ...] --out DIR [--curr-year Y] [--prev-year Y] [--mtd] [--focus A/B ...]``.

Several inputs are candidates in order of preference.  Years: argument, else ``ROASLENS_CURR_YEAR`` /
``ROASLENS_PREV_YEAR``, else the current year and the one before (a missing side is derived as +/- 1).  The share of
unreadable metric values that a run bears: ``ROASLENS_PARSE_ERROR_THRESHOLD``, from 0 (no check) to 1.  Each ``--focus``
is a path from the subsidiary down; the selections and the trace of all of them come from one drill.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os

from pyspark.sql import SparkSession

from roaslens.config import EngineConfig
from roaslens.operators.focus import focus_table, run_focuses
from roaslens.plans.pipeline import build_report
from roaslens.schema import DIMENSIONS
from roaslens.session import apply_engine_conf, ensure_checkpoint_dir
from roaslens.sinks.report import comparison_window_text, write_report, write_summary
from roaslens.sources.raw import read_input


def _env_int(name: str) -> int | None:
    v = os.environ.get(name)
    return int(v) if v else None


def _threshold() -> dict[str, float]:
    v = os.environ.get("ROASLENS_PARSE_ERROR_THRESHOLD")
    return {"parse_error_threshold": float(v)} if v else {}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="roaslens")
    ap.add_argument("--input", required=True, action="append", help="input; may be repeated: the first that qualifies is taken")
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default=None, help="input format (csv, tsv, parquet, json, orc); default from extension")
    ap.add_argument("--curr-year", type=int, default=None)
    ap.add_argument("--prev-year", type=int, default=None)
    ap.add_argument("--mtd", action="store_true", help="compare the same part of the latest month")
    ap.add_argument("--focus", action="append", default=[], metavar="SUBSIDIARY[/CHANNEL[/DIVISION[/PRODUCT]]]", help="drill from here; may be repeated")
    ap.add_argument("--output-format", default="parquet", choices=["parquet", "csv", "json"])
    a = ap.parse_args(argv)
    curr = a.curr_year if a.curr_year is not None else _env_int("ROASLENS_CURR_YEAR")
    prev = a.prev_year if a.prev_year is not None else _env_int("ROASLENS_PREV_YEAR")
    curr, prev = EngineConfig.resolve_years(curr, prev, dt.date.today().year)
    cfg = EngineConfig(curr_year=curr, prev_year=prev, mtd_only=a.mtd, **_threshold())

    spark = SparkSession.builder.appName("roaslens").getOrCreate()
    apply_engine_conf(spark)
    ensure_checkpoint_dir(spark)
    engine, meta = read_input(spark, a.input, cfg, fmt=a.format)
    rep = build_report(engine, cfg, meta)
    write_report(rep.tables, a.out, a.output_format)
    write_summary(spark, rep.sections, meta, a.out)
    if a.focus:
        paths = [tuple((path.split("/") + [None] * 4)[:4]) if path.count("/") < 4 else ap.error(f"more than four levels: {path}") for path in a.focus]
        focuses = focus_table(spark.createDataFrame(paths, ", ".join(f"{d} string" for d in DIMENSIONS)))
        run = run_focuses(rep.analysis.levels, cfg, focuses)
        write_report({"focus_issues": run.issues, "focus_improvements": run.improvements, "focus_trace": run.events}, a.out, a.output_format)
    print(f"roaslens: {comparison_window_text(meta)} -> {a.out}")


if __name__ == "__main__":
    main()
