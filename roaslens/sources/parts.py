"""Engine frame from per-file partial sums (S6, K5): new files are read, old ones are not.

A store folder keeps, for every input file read so far, its in-scope rows summed by (dims, Year, Month, Day) and its
row counts.  A refresh lists the input, reads only files that are new or changed, adds their sums, and builds
the frame of any comparison (years, month-to-date) from the sums of the files that are there now.  Sums of sums equal
the sums of a full build: both keep 14 significant digits.

Each refresh writes a folder of its own and then the list of files as a whole, so a refresh that fails leaves the store as
it was.  A file counts as changed when its length or time does.  The wide format has no dates: its rows are kept as they are.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roaslens.config import EngineConfig
from roaslens.functions.exprs import dsum
from roaslens.schema import DIMENSIONS, ENGINE_METRICS, METRICS, TARGET_DIVISIONS, TARGET_OBJECTIVE
from roaslens.sources.ingest import (
    _scoped_input, apply_mtd, filter_years, gate_parse_errors, is_wide, metric_targets, normalize_long, normalize_wide, objective_column,
    pivot_to_engine, run_facts,
)
from roaslens.sources.raw import _TEXT_SEPARATORS, _kind, discover, known_columns, path_exists, read_text_table, standard_names

FILES = "file string, length long, modified timestamp, part string, objective boolean, division boolean"
_FILE = "__file"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, length, modified) of an input; contents are not read."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Input not found: {path}")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified")).filter("length > 0")


def _held(spark: SparkSession, store: str) -> tuple[DataFrame, str | None]:
    """The files of the newest list of the store, and its name."""
    if not path_exists(spark, f"{store}/current"):
        return spark.createDataFrame([], FILES), None
    name = spark.read.text(f"{store}/current").first()[0]
    return spark.read.schema(FILES).parquet(f"{store}/{name}"), name


def _read(spark: SparkSession, files: list[str], fmt: str | None) -> DataFrame:
    """The known columns of ``files``, and each row's file."""
    kind = _kind(files[0], fmt)
    if kind in _TEXT_SEPARATORS:
        return read_text_table(spark, discover(spark, [(tuple(files), _TEXT_SEPARATORS[kind])])[0], True, _FILE)
    raw = spark.read.format(kind).load(files)
    names = standard_names(raw.columns)
    held = raw.select("*", F.col("_metadata.file_path").alias(_FILE)).toDF(*[f"__c{i}" for i in range(len(names))], _FILE)
    return held.select(*[F.col(f"__c{names.index(c)}").alias(c) for c in known_columns(names)], _FILE)


def _sums(raw: DataFrame) -> DataFrame:
    """Partial sums of the in-scope rows by file, dims and date (long), or the rows themselves (wide)."""
    scoped = _scoped_input(raw)
    if is_wide(raw.columns):
        return normalize_wide(scoped, (_FILE,))
    rows = normalize_long(scoped, (_FILE,))
    for c in ("Month", "Day"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("bigint"))
    return rows.groupBy(_FILE, *DIMENSIONS, "Year", "Month", "Day").agg(*[dsum(m).alias(m) for m in METRICS])


def refresh(spark: SparkSession, path: str, store: str, fmt: str | None = None) -> dict[str, int]:
    """Bring the store up to date with the input; returns how many files were read, kept and forgotten."""
    now = list_files(spark, path)
    held, old = _held(spark, store)
    same = [now[c] == held[c] for c in ("file", "length", "modified")]
    kept = held.join(now, same, "left_semi")
    fresh = now.join(held, same, "left_anti").cache()
    files = [r.file for r in fresh.select("file").orderBy("file").collect()]  # paths, which the listing has already brought to the driver
    n_held = held.count()
    n_kept = kept.count() if n_held else 0
    if not files and n_kept == n_held and old:
        fresh.unpersist()
        return {"read": 0, "kept": n_kept, "forgotten": 0}
    listed = kept
    if files:
        part, raw = f"part-{uuid.uuid4().hex}", _read(spark, files, fmt)
        flags = (objective_column(raw.columns) is not None, "DIVISION" in raw.columns)
        _sums(raw).write.option("compression", "zstd").parquet(f"{store}/{part}/sums")
        run_facts(raw, by=(_FILE,)).write.parquet(f"{store}/{part}/facts")
        rows = fresh.select("file", "length", "modified", F.lit(part).alias("part"), F.lit(flags[0]).alias("objective"), F.lit(flags[1]).alias("division"))
        listed = kept.select(*rows.columns).unionByName(rows)
    name = f"files-{uuid.uuid4().hex}"
    listed.write.parquet(f"{store}/{name}")
    fresh.unpersist()
    spark.range(1, numPartitions=1).select(F.lit(name).alias("value")).write.mode("overwrite").text(f"{store}/current")
    return {"read": len(files), "kept": n_kept, "forgotten": n_held - n_kept}


def _stored(spark: SparkSession, store: str, kind: str) -> DataFrame | None:
    """Rows of ``kind`` (sums or facts) of the files that the newest list names."""
    files, _ = _held(spark, store)
    parts = sorted(r.part for r in files.select("part").distinct().collect())  # one a refresh
    if not parts:
        return None
    base = store.rstrip("/")
    rows = None
    for p in parts:
        x = spark.read.parquet(f"{base}/{p}/{kind}").withColumn("part", F.lit(p))
        rows = x if rows is None else rows.unionByName(x, allowMissingColumns=True)
    return rows.join(files.select(F.col("file").alias(_FILE), "part"), [_FILE, "part"], "left_semi")


def engine_from_parts(spark: SparkSession, store: str, cfg: EngineConfig, check_quality: bool = True) -> tuple[DataFrame, dict[str, Any]]:
    """S1 from the store: engine frame and run metadata of a comparison, without reading the input."""
    sums, facts = _stored(spark, store, "sums"), _stored(spark, store, "facts")
    if sums is None:
        raise ValueError(f"no files in {store}; refresh it first")
    wide = set(ENGINE_METRICS) <= set(sums.columns)
    errors = [c for c in facts.columns if c.endswith("_errors")]
    total = facts.agg(*[F.sum(c).alias(c) for c in ("objective_rows_before", "objective_rows_after", "division_rows_before", "division_rows_after", *errors)]).first()
    if check_quality:
        gate_parse_errors(total["division_rows_after"], {c[: -len("_errors")]: total[c] or 0 for c in errors}, cfg.parse_error_threshold)
    flags = _held(spark, store)[0].agg(F.bool_or("objective"), F.bool_or("division")).first()
    meta: dict[str, Any] = {
        "curr_year": cfg.curr_year, "prev_year": cfg.prev_year, "mtd_applied": False, "source_format": "wide" if wide else "long",
        "objective_filter_applied": flags[0], "objective_column": "OBJECTIVE" if flags[0] else None, "objective_value": TARGET_OBJECTIVE,
        "division_filter_applied": flags[1], "division_filter_values": list(TARGET_DIVISIONS),
    }
    for name, on in (("objective", flags[0]), ("division", flags[1])):
        if on:
            meta |= {f"{name}_rows_{x}": total[f"{name}_rows_{x}"] for x in ("before", "after")}
    if wide:
        return sums.select(*DIMENSIONS, *ENGINE_METRICS), meta
    rows = sums
    if cfg.mtd_only:
        cut = rows.filter(F.col("Year") == cfg.curr_year).agg(F.max(F.struct("Month", "Day")).alias("c")).first().c
        cutoff = (cut["Month"], cut["Day"]) if cut else (None, None)
        if cutoff[0] is not None:
            meta |= {"mtd_applied": True, "mtd_month_start": cutoff[0], "mtd_month_cutoff": cutoff[0]}
            if cutoff[1] is not None:
                meta |= {"mtd_day_start": 1, "mtd_day_cutoff": cutoff[1]}
        rows = apply_mtd(rows, cfg.curr_year, cfg.prev_year, cutoff)
    else:
        rows = filter_years(rows, cfg.curr_year, cfg.prev_year)
    return pivot_to_engine(rows, cfg.curr_year, cfg.prev_year), meta
