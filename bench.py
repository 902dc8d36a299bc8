"""Benchmark: headline plans at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Timed steps (each forced with a no-op write, so nothing is collected):
  engine_frame      raw star schema -> engine frame, full years 2000 vs 1999
  engine_frame_mtd  same, month-to-date window of 2000
  level_rollup      leaf + all levels (one rollup)
  drill             LMDI of every parent at every level + drill for all subsidiaries
  full_report       everything from the raw tables to all six output tables and summary sections
A warm-up pass on the smallest test scale runs first (JVM / code generation), untimed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roaslens.config import EngineConfig  # noqa: E402
from roaslens.operators.drill import drill  # noqa: E402
from roaslens.operators.levels import level_rollup  # noqa: E402
from roaslens.plans.pipeline import build_report  # noqa: E402
from roaslens.session import cut, in_parallel, local_session  # noqa: E402
from roaslens.sources.ingest import engine_frame  # noqa: E402
from roaslens.sources.mapped import mapped_long_table, mapped_mtd_frame  # noqa: E402

FULL = EngineConfig(2000, 1999)
MTD = EngineConfig(2000, 1999, mtd_only=True)


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def run(spark, sf_dir: str) -> dict[str, float]:
    t: dict[str, float] = {}
    s = time.perf_counter()
    raw = mapped_long_table(spark, sf_dir, (FULL.curr_year, FULL.prev_year))
    noop(engine_frame(raw, FULL))
    t["engine_frame"] = time.perf_counter() - s

    s = time.perf_counter()
    noop(mapped_mtd_frame(spark, sf_dir, MTD))
    t["engine_frame_mtd"] = time.perf_counter() - s

    engine = cut(engine_frame(raw, FULL))
    s = time.perf_counter()
    levels = cut(level_rollup(engine))
    t["level_rollup"] = time.perf_counter() - s

    s = time.perf_counter()
    d = drill(levels, FULL, 1)
    noop(d.leaves)
    noop(d.events)
    t["drill"] = time.perf_counter() - s

    s = time.perf_counter()
    spark.sparkContext.setJobGroup("full_report", "full report from the raw tables")
    raw2 = mapped_long_table(spark, sf_dir, (FULL.curr_year, FULL.prev_year))
    rep = build_report(engine_frame(raw2, FULL), FULL)
    in_parallel([partial(noop, df) for df in [*rep.tables.values(), *rep.sections.values()]])  # as write_report does
    t["full_report"] = time.perf_counter() - s
    spark.sparkContext.setJobGroup("other", "")
    return t


def event_log_stats(log_dir: str, group: str) -> dict[str, int]:
    """Stages and shuffle bytes of the jobs in ``group``, from Spark's event log (scratch folder)."""
    stages: set[int] = set()
    shuffle_write = shuffle_read = 0
    done: dict[int, dict] = {}
    files = sorted(os.path.join(r, n) for r, _, names in os.walk(log_dir) for n in names if n.startswith("events_"))
    for path in files:  # Spark 4 writes rolling logs: a directory of events_* files
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart" and (ev.get("Properties") or {}).get("spark.jobGroup.id") == group:
                    stages.update(ev.get("Stage IDs", []))
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    done[info["Stage ID"]] = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
    ran = [sid for sid in stages if sid in done]
    for sid in ran:
        acc = done[sid]
        shuffle_write += int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0)
        shuffle_read += int(acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0) or 0) + \
            int(acc.get("internal.metrics.shuffle.read.localBytesRead", 0) or 0)
    return {"stages": len(ran), "shuffle_write_bytes": shuffle_write, "shuffle_read_bytes": shuffle_read}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4)))
    log_dir = tempfile.mkdtemp(prefix="roaslens-eventlog-", dir="/tmp")
    if os.environ.get("BENCH_EVENT_LOG", "1") != "0":
        os.environ["ROASLENS_EVENT_LOG_DIR"] = log_dir
    spark = local_session(cpus, shuffle_partitions=max(4, 2 * cpus), app="roaslens-bench")
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        run(spark, warm)
    times = run(spark, sf_dir)
    sf = sf_dir.rsplit("sf", 1)[-1]
    try:
        sf_val: float | str = float(sf)
    except ValueError:
        sf_val = sf
    spark.stop()
    try:
        stats = event_log_stats(log_dir, "full_report")
    except Exception:  # noqa: BLE001 - statistics are optional
        stats = {}
    print(json.dumps({
        "metric": "full_report_sec",
        "value": round(times["full_report"], 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": sf_val,
        "cpus": cpus,
        "full_report_stages": stats.get("stages"),
        "full_report_shuffle_write_bytes": stats.get("shuffle_write_bytes"),
        "full_report_shuffle_read_bytes": stats.get("shuffle_read_bytes"),
    }))


if __name__ == "__main__":
    main()
