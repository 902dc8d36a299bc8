"""Raw sources: candidate tables, header discovery on headerless text files, column subsets.

The spreadsheet decoder of the reference is replaced by Spark readers; what
remains is its logic for finding the table inside the file: the first row
that looks like a header, data below it, blank rows dropped.
Only header rows reach the driver (column names are metadata).
"""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from roaslens.scale import join_split
from roaslens.schema import (
    DIMENSIONS, ENGINE_COLUMNS, OBJECTIVE_CANDIDATES, RAW_METRIC_MAP, REQUIRED_LONG_UPPER, REQUIRED_WIDE_UPPER,
)
from roaslens.session import cut
from roaslens.sources.ingest import looks_like_supported, normalize_headers, standard_names

# Columns that a long table must have; of each of the others, the first spelling present is used.
_NEEDED = [*DIMENSIONS, *RAW_METRIC_MAP]
_OPTIONAL = [OBJECTIVE_CANDIDATES, ("Year", "YEAR"), ("Month", "MONTH"), ("Day", "DAY")]
_TEXT_SEPARATORS = {"csv": ",", "txt": ",", "tsv": "\t"}


def choose_source(candidates: Sequence[DataFrame]) -> DataFrame:
    """First candidate (preference order) whose header qualifies; else the first one."""
    if not candidates:
        raise ValueError("no candidate tables")
    return next((df for df in candidates if looks_like_supported(df.columns)), candidates[0])


def known_columns(names: Sequence[str]) -> list[str]:
    """Of a table with these (standard) names, the columns that the engine reads; all, if it is no known table."""
    have = set(names)
    optional = [next((c for c in spellings if c in have), None) for spellings in _OPTIONAL]
    if have >= set(_NEEDED) and optional[1]:
        return [*_NEEDED, *[c for c in optional if c]]
    return list(ENGINE_COLUMNS) if have >= set(ENGINE_COLUMNS) else list(names)


def select_known_columns(df: DataFrame) -> DataFrame:
    """S5 after P2: standard names, and only the engine's columns, so that the read skips the rest.

    Columns are taken by position: names that differ in case alone are different columns."""
    names = standard_names(df.columns)
    held = df.toDF(*[f"__c{i}" for i in range(len(names))])
    return held.select(*[F.col(f"__c{names.index(c)}").alias(c) for c in known_columns(names)])


def _header_cells(line: F.Column, sep: str) -> F.Column:
    return F.transform(F.split(line, re.escape(sep), -1), lambda c: F.upper(F.trim(F.replace(c, F.lit('"'), F.lit("")))))


def _qualifies(cells: F.Column) -> F.Column:
    def has(names) -> F.Column:
        return F.size(F.array_except(F.array(*[F.lit(v) for v in sorted(names)]), cells)) == 0

    return has(REQUIRED_LONG_UPPER) | has(REQUIRED_WIDE_UPPER)


def _width(line: F.Column, sep: str) -> F.Column:
    """Fields of a line; a separator inside a quoted field is none."""
    s = re.escape(sep)
    bare = F.regexp_replace(line, rf'(^|{s})\s*"(?:[^"\\]|\\.|"")*"', "$1")
    return F.size(F.split(bare, s, -1))


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines of text files or a folder with their place: file, start of the split, number in this read."""
    return spark.read.text(path if isinstance(path, str) else list(path)).select(
        F.regexp_replace("value", "^\ufeff", "").alias("__line"), F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"),
    )


@dataclass(frozen=True)
class TextTable:
    """What one read of a text candidate has told: its names, and whether a row looked like a header."""

    path: str | tuple[str, ...]
    sep: str
    names: tuple[str, ...]
    found: bool


def discover(spark: SparkSession, candidates: Sequence[tuple[str, str]]) -> list[TextTable | None]:
    """Header and width of each text candidate (path, separator), all in one read; None for one without lines.

    The header is the first row, anywhere in a file, that looks like one; that of the first file (by path) that has one
    counts, and a file with another raises ``ValueError`` when the table is read.  Without any, it is the first row."""
    def of(i: int, path: str, sep: str) -> DataFrame:
        lines = _lines(spark, path)
        return lines.withColumns({"__of": F.lit(i), "__width": _width(F.col("__line"), sep), "__cells": _header_cells(F.col("__line"), sep)})

    rows = reduce(DataFrame.unionByName, [of(i, *c) for i, c in enumerate(candidates)])
    seen, at = Observation(), F.struct("__file", "__block", "__id")
    mine = [F.col("__of") == i for i in range(len(candidates))]
    rows = rows.observe(
        seen, *[F.max(F.when(m, F.col("__width"))).alias(f"width{i}") for i, m in enumerate(mine)],
        *[F.min(F.when(m, F.struct("__file", "__block", "__id", "__line")))["__line"].alias(f"top{i}") for i, m in enumerate(mine)],
    )
    hits = cut(rows.filter(_qualifies(F.col("__cells"))).drop("__width"))
    facts = seen.get
    first = hits.groupBy("__of", "__file").agg(F.min_by("__line", at).alias("__line"), F.min_by("__cells", at).alias("__cells"))
    heads = first.groupBy("__of").agg(F.min_by("__line", "__file").alias("line"), F.count_distinct("__cells").alias("n")).collect()  # a row a candidate
    tops = {r["__of"]: r for r in heads}
    out: list[TextTable | None] = []
    for i, (path, sep) in enumerate(candidates):
        width, top = facts.get(f"width{i}"), tops.get(i)
        if width is None:
            out.append(None)
            continue
        header = next(csv.reader([top.line if top else facts[f"top{i}"]], delimiter=sep), [])
        names = normalize_headers([*header, *[None] * (width - len(header))])
        out.append(TextTable(path, sep, tuple(names) if not top or top.n == 1 else (), bool(top)))
    return out


def read_text_table(spark: SparkSession, table: TextTable | None, known_only: bool = False, file_column: str | None = None) -> DataFrame:
    """S3: the data of a discovered table, all columns text; all-null rows are dropped, short rows null-padded.

    The lines are read once; what is no blank row is written with its place, and only then title rows go: each file is
    data below its own first header row, by places of this same read, so neither splits nor
    partitions of another read matter.  With ``known_only`` (S5) just the engine's columns are written; ``file_column``
    adds the path of each row's file."""
    if table is None:
        return spark.createDataFrame([], "c string" + (f", {file_column} string" if file_column else ""))
    if not table.names:
        raise ValueError(f"files of {table.path} have different headers")
    names = standard_names(table.names)
    kept = known_columns(names) if known_only else names
    places = [names.index(c) for c in kept] if known_only else range(len(names))
    schema = ", ".join(f"_c{i} string" for i in range(len(names)))
    lines = _lines(spark, table.path)
    rows = lines.select(F.from_csv("__line", schema, {"sep": table.sep}).alias("__row"), "__file", "__block", "__id", _qualifies(_header_cells(F.col("__line"), table.sep)).alias("__head"))
    rows = rows.filter(F.coalesce(*[F.col(f"__row._c{i}") for i in range(len(names))]).isNotNull())
    held = cut(rows.select("__file", "__block", "__id", "__head", *[F.col(f"__row._c{i}").alias(f"__c{i}") for i in places]))
    data = [f"__c{i}" for i in places] + (["__file"] if file_column else [])
    kept = [*kept, file_column] if file_column else kept
    at = F.struct("__block", "__id")
    if table.found:
        marks = cut(held.groupBy("__file").agg(F.count(F.lit(1)).alias("__rows"), F.min(F.when(F.col("__head"), at)).alias("__top")))
        total = marks.agg(F.sum("__rows")).first()[0] or 0
        rows = join_split(held, marks, ["__file"], "__rows", total).filter(F.col("__top").isNull() | (at > F.col("__top")))
    else:
        place = F.struct("__file", "__block", "__id")
        first = held.agg(F.min(place).alias("p")).first().p
        if first is None:
            return held.select(*data).toDF(*kept)
        rows = held.filter(~((F.col("__file") == first[0]) & (F.col("__block") == first[1]) & (F.col("__id") == first[2])))
    return rows.select(*data).toDF(*kept)


def read_with_header_discovery(spark: SparkSession, path: str, sep: str = ",", known_only: bool = False) -> DataFrame:
    """S3: headerless read of a file or folder in two reads: one finds the header and the widest line, one the data."""
    return read_text_table(spark, discover(spark, [(path, sep)])[0], known_only)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the cluster file system (works for local, HDFS and object-store paths)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p)) or bool(fs.globStatus(p))


def _kind(path: str, fmt: str | None) -> str:
    return (fmt or path.rstrip("/").rsplit(".", 1)[-1]).lower()


def read_candidates(spark: SparkSession, paths: Sequence[str], fmt: str | None = None) -> DataFrame:
    """The raw table (known columns) of the first path, in order of preference, whose header qualifies; of the first
    path that exists, if none does.  Paths that do not exist are passed over; if all are, ``FileNotFoundError``.

    Typed files tell their columns without being read; text candidates before the first of those that qualifies are
    searched in one job."""
    there = [p for p in paths if path_exists(spark, p)]
    if not there:
        raise FileNotFoundError(f"Input not found: {', '.join(paths)}")
    probed: list[tuple[str, DataFrame | None]] = []
    for path in there:
        kind = _kind(path, fmt)
        typed = None if kind in _TEXT_SEPARATORS else spark.read.format(kind).load(path)
        probed.append((path, typed))
        if typed is not None and looks_like_supported(standard_names(typed.columns)):
            break
    texts = [(p, _TEXT_SEPARATORS[_kind(p, fmt)]) for p, typed in probed if typed is None]
    tables = dict(zip([p for p, _ in texts], discover(spark, texts) if texts else []))
    good = [(p, d) for p, d in probed if (looks_like_supported(standard_names(d.columns)) if d is not None else tables[p] is not None and tables[p].found)]
    path, typed = (good or probed)[0]
    return select_known_columns(typed) if typed is not None else read_text_table(spark, tables[path], known_only=True)


def read_input(spark: SparkSession, path: str | Sequence[str], cfg, fmt: str | None = None, check_quality: bool = True):
    """Path, or several in order of preference (S2) -> (engine frame, run metadata).

    Text files (csv / tsv / txt) go through header discovery and are read twice in all; Parquet, ORC and
    JSON are read with their own schema.  A missing path raises ``FileNotFoundError``.
    """
    from roaslens.sources.ingest import build_engine_frame

    raw = read_candidates(spark, [path] if isinstance(path, str) else list(path), fmt)
    return build_engine_frame(raw, cfg, check_quality=check_quality)


def input_version(spark: SparkSession, path: str) -> str:
    """Number, size and a hash of names, sizes and times of the files of an input (contents are not read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    n, size, mark = files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
    return f"{n}:{size or 0}:{mark or 0}"


def load_input_frame(spark: SparkSession, path: str, cfg, snapshot_dir: str, run_key: str | None = None,
                     fmt: str | None = None):
    """Engine frame from the snapshot when its run key matches, else build it and store it.

    The default run key holds the path, the version of its files (``input_version``) and the
    comparison settings.  After a store the stored frame is returned, not computed again.
    """
    from roaslens.sinks.report import read_snapshot, write_snapshot

    if not path_exists(spark, path):
        raise FileNotFoundError(f"Input not found: {path}")
    key = run_key or f"{path}|{input_version(spark, path)}|{cfg.curr_year}|{cfg.prev_year}|{'mtd' if cfg.mtd_only else 'full'}"
    hit = read_snapshot(spark, snapshot_dir, key)
    if hit is not None:
        return hit
    engine, meta = read_input(spark, path, cfg, fmt=fmt)
    meta = dict(meta, cache_hit=False)
    write_snapshot(engine, snapshot_dir, key, meta)
    stored = read_snapshot(spark, snapshot_dir, key)
    return (stored[0] if stored else engine), meta
