"""Plan pieces that hold at any size: global positions without a global window, joins that split hot keys."""

from __future__ import annotations

from itertools import accumulate
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roaslens.session import cut


def numbered(df: DataFrame, order: Sequence[Column], name: str = "position", parts: int | None = None) -> DataFrame:
    """``df`` with the place of each row, from 1, in the order of ``order`` (of its columns) over all rows.

    Rows go to range partitions and are written, so that partition numbers are facts; rows are counted within their
    partition, and the driver adds up one count a partition.  Rows equal in all of ``order`` get
    some order among themselves, so it should tell all rows apart."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()))
    counts = dict(ranged.groupBy("__part").agg(F.count(F.lit(1))).collect())
    before = list(accumulate((counts.get(i, 0) for i in range(n)), initial=0))
    here = Window.partitionBy("__part").orderBy(*order)
    offset = F.element_at(F.lit(before).cast("array<bigint>"), F.col("__part") + 1)
    return ranged.withColumn(name, offset + F.row_number().over(here)).select(*df.columns, name)


def join_split(left: DataFrame, right: DataFrame, on: Sequence[str], weight: str, total: int, how: str = "inner", keys: int = 4096) -> DataFrame:
    """``left`` joined to ``right``, which holds a key once and in ``weight`` no less than its rows in ``left``; the weights
    sum to ``total``.  Keys with more than a ``keys``-th of it are fewer than ``keys`` and broadcast, so no
    task of the shuffle join gets more than that share for one key, whatever the adaptive plan does."""
    heavy = right.filter(F.col(weight) * keys > total)
    light = right.filter(F.col(weight) * keys <= total)
    hot = left.join(F.broadcast(heavy), list(on))
    cold = left.join(F.broadcast(heavy.select(*on)), list(on), "left_anti").join(light, list(on), how)
    return hot.unionByName(cold)
