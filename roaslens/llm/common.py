"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roaslens.session import cut, drop_cut  # noqa: F401  (re-exported for the operators)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` computed once a row, also where ``body`` uses it in a lambda (an inlined
    expression would be evaluated again for every element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def row_key() -> list[Column]:
    """Two 64-bit halves that name a row by its id and its text.  Rows equal in both are one
    and the same to every operator here, so sharing a key is right for them."""
    return [F.xxhash64("doc_id").alias("k1"), F.xxhash64(text_or_empty("text"), F.lit(7)).alias("k2")]


def ordered_prefix(df: DataFrame, order: Sequence[str], values: dict[str, str]) -> DataFrame:
    """``df`` with, for each ``out: column`` of ``values``, the sum of ``column`` over all rows before
    this one in the order of ``order``; ``column`` None counts rows.  Nulls come first.

    The rows are range-partitioned and written, so that partition numbers are facts; totals are one
    row a partition, and only those are summed in one task.  Rows equal in all of ``order`` may
    swap places, so ``order`` should hold everything that the caller can tell apart."""
    spark = df.sparkSession
    cols = {out: F.lit(1) if c is None else F.col(c) for out, c in values.items()}
    ranged = cut(df.repartitionByRange(shuffle_parts(spark), *order).withColumn("_part", F.spark_partition_id()))
    totals = ranged.groupBy("_part").agg(*[F.sum(c).alias(f"_t_{o}") for o, c in cols.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    base = totals.select("_part", *[F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0)).alias(f"_b_{o}") for o in cols])
    here = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(F.broadcast(base), "_part")  # as many rows as range partitions
    for o, c in cols.items():
        out = out.withColumn(o, (F.col(f"_b_{o}") + F.coalesce(F.sum(c).over(here), F.lit(0))).cast("long"))
    return out.drop("_part", *[f"_b_{o}" for o in cols])


def hot_keys(df: DataFrame, key: str, least: int = 10_000, share: int = 1000) -> list:
    """The values of ``key`` (null too) that more than ``least`` rows and more than one row in ``share`` have: at most
    ``share`` of them, found by one partial count."""
    counts = cut(df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")))
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    hot = [r[0] for r in counts.filter(F.col("_rows") > max(least, total // share)).select(key).collect()]
    drop_cut(counts)
    return hot


def dealt(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` in range partitions of ``order``, written with their numbers in ``_part``."""
    return cut(df.repartitionByRange(shuffle_parts(df.sparkSession), *order).withColumn("_part", F.spark_partition_id()))


def spanning(ranged: DataFrame, group: str) -> list:
    """The values of ``group``, the first column of the order in which ``ranged`` was dealt, that lie in more than one
    range partition: at most two for each partition."""
    ends = ranged.groupBy("_part").agg(F.min(group).alias("a"), F.max(group).alias("z"))
    ends = ends.select("_part", F.explode(F.array_distinct(F.array("a", "z"))).alias(group))
    return [r[0] for r in ends.groupBy(group).count().filter("count > 1").collect()]


def running(ranged: DataFrame, group: str, order: Sequence[str], values: dict[str, tuple[str, Column]], spans: list) -> DataFrame:
    """``ranged`` (of ``dealt``) with, for each ``out: (kind, value)``, the sum or xor of ``value`` over the rows of the
    group up to this one, and over all of them in ``out_total``.  A group of any size stays split over its range
    partitions: what comes before a partition is at most two rows a partition, and those are broadcast."""
    fold = {"sum": F.sum, "xor": F.bit_xor}
    add = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + b, "xor": lambda a, b: F.coalesce(a, F.lit(0).cast("long")).bitwiseXOR(b)}
    whole = Window.partitionBy("_part", group)
    here = whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ranged
    for name, (kind, value) in values.items():
        out = out.withColumns({name: fold[kind](value).over(here), f"{name}_total": fold[kind](value).over(whole)})
    if not spans:
        return out
    parts = ranged.filter(F.col(group).isin(spans)).groupBy(group, "_part").agg(*[fold[k](v).alias(n) for n, (k, v) in values.items()])
    all_parts = Window.partitionBy(group)
    before = all_parts.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select(group, "_part", *[fold[k](n).over(before).alias(f"_b_{n}") for n, (k, _) in values.items()], *[fold[k](n).over(all_parts).alias(f"_t_{n}") for n, (k, _) in values.items()])
    out = out.join(F.broadcast(carry), [group, "_part"], "left")
    for name, (kind, _) in values.items():
        out = out.withColumns({name: add[kind](F.col(f"_b_{name}"), F.col(name)), f"{name}_total": F.coalesce(f"_t_{name}", f"{name}_total")})
    return out.drop(*[f"_{x}_{n}" for x in "bt" for n in values])


def join_split(left: DataFrame, right: DataFrame, on: Sequence[str], weight: str, total: int, how: str = "inner", keys: int = 4096) -> DataFrame:
    """``left`` joined to ``right``, which holds a key once and in ``weight`` no less than its rows in ``left``; the weights
    sum to ``total``.  Keys with more than a ``keys``-th of it are fewer than ``keys`` and broadcast, so no
    task of the shuffle join gets more than that share for one key."""
    heavy = right.filter(F.col(weight) * keys > total)
    light = right.filter(F.col(weight) * keys <= total)
    hot = left.join(F.broadcast(heavy), list(on))
    cold = left.join(F.broadcast(heavy.select(*on)), list(on), "left_anti").join(light, list(on), how)
    return hot.unionByName(cold)
