"""Incremental engine frame (A1 as a stateful streaming aggregation).

``engine_frame_stream`` reads raw long rows from a file source, applies the
same row-level normalisation and filters as the batch path (F1, F2, P4, F3),
and keeps the eight conditional sums per leaf as streaming state
(``outputMode("complete")``: the state holds one row per leaf, not per input
row).  The month-to-date window needs the latest month of the whole input,
which is a batch notion: the stream supports full-year comparisons and refuses
the other; ``sources.parts`` serves it incrementally.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from roaslens.config import EngineConfig
from roaslens.sources.ingest import _scoped_input, filter_years, normalize_long, pivot_to_engine, standardize_known_columns


def engine_frame_stream(spark: SparkSession, path: str, schema: T.StructType, cfg: EngineConfig,
                        fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming engine frame: one row per leaf, updated as raw files arrive."""
    if cfg.mtd_only:
        raise ValueError("the month-to-date window needs the whole input; run the batch path")
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = standardize_known_columns(reader.load(path))
    long_df = filter_years(normalize_long(_scoped_input(raw)), cfg.curr_year, cfg.prev_year)
    # with F4, the spend filter, on the aggregate
    return pivot_to_engine(long_df, cfg.curr_year, cfg.prev_year)


def report_each_batch(build: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` adapter: the complete engine frame of each trigger -> batch report."""
    def run(batch: DataFrame, batch_id: int) -> None:
        build(batch, batch_id)
    return run
