"""Merkle fingerprints of documents: leaves, paragraphs, sections, root.

A paragraph is a line of the text (lines end at ``\\n``; blank ones count, so the tree covers every
character).  Its leaves are phrases: up to ``LEAF`` characters and the ASCII marks that follow.  A
paragraph's digest is the SHA-256 of its leaf digests, a section is a run of paragraphs that ends
where a paragraph digest starts with 0-3 (so an edit moves no far-off border), its digest is that of
its paragraph digests, and the root's that of the section digests.  Equal texts have equal roots and,
short of a SHA-256 collision, only they have.

Main path: DataFrame functions only.  Null texts count as empty; the empty text has one empty
paragraph.  Equal rows have equal trees; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roaslens.llm.common import let, shuffle_parts, text_or_empty

LEAF = 120
_MARK = r"!-/:-@\[-`{-~"
LEAF_PATTERN = f"[^{_MARK}]{{0,{LEAF}}}[{_MARK}]+|[^{_MARK}]{{1,{LEAF}}}"


def tree(text: Column) -> Column:
    """Struct of ``leaves`` (array<array<string>> by paragraph), all digests in lower-case hex."""
    paragraphs = F.split(text, "\n", -1)
    return F.transform(paragraphs, lambda p: F.transform(F.regexp_extract_all(p, F.lit(LEAF_PATTERN), 0), lambda x: F.sha2(x, 256)))


def paragraph_digests(leaves: Column) -> Column:
    return F.transform(leaves, lambda x: F.sha2(F.array_join(x, ","), 256))


def section_runs(paragraphs: Column) -> Column:
    """Sections as strings of comma-separated paragraph digests."""
    return F.split(F.array_join(F.transform(paragraphs, lambda d: F.when(d < "4", F.concat(d, F.lit(";"))).otherwise(F.concat(d, F.lit(",")))), ""), ";", -1)


def section_digests(paragraphs: Column) -> Column:
    return F.transform(F.filter(section_runs(paragraphs), lambda s: s != ""), lambda s: F.sha2(s, 256))


def root(sections: Column) -> Column:
    return F.sha2(F.array_join(sections, ","), 256)


def with_tree(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """``df`` with columns ``{name}_leaves``, ``_paragraphs``, ``_sections`` and ``_root``."""
    df = df.withColumn(f"{name}_leaves", tree(text_or_empty(text_col)))
    df = df.withColumn(f"{name}_paragraphs", paragraph_digests(F.col(f"{name}_leaves")))
    df = df.withColumn(f"{name}_sections", section_digests(F.col(f"{name}_paragraphs")))
    return df.withColumn(f"{name}_root", root(F.col(f"{name}_sections")))


def likeness(a: str, b: str) -> Column:
    """Share of distinct leaves in common (Dice), 1 for equal roots; of two trees of ``with_tree``."""
    def dice(both: Column) -> Column:
        total = F.size(both["x"]) + F.size(both["y"])
        return F.when(total == 0, F.lit(0.0)).otherwise(F.lit(2.0) * F.size(F.array_intersect(both["x"], both["y"])) / total)

    sets = F.struct(*[F.array_distinct(F.flatten(f"{t}_leaves")).alias(k) for k, t in (("x", a), ("y", b))])
    return F.when(F.col(f"{a}_root") == F.col(f"{b}_root"), F.lit(1.0)).otherwise(let(sets, dice))


def first_difference(a: str, b: str, level: str) -> Column:
    """Number (from 0) of the first branch of ``level`` (sections, paragraphs) that differs, -1 if none:
    compare the roots, then the sections, and look into the paragraphs of a differing one only."""
    same = F.zip_with(f"{a}_{level}", f"{b}_{level}", lambda p, q: p.eqNullSafe(q))
    return (F.array_position(same, F.lit(False)) - 1).cast("long")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``next_text``, the text of the next row in ascending id (nulls first, equal ids by
    text hash); the last row gets the first row's.

    Ids are cut at quantiles into buckets, the first rows of a bucket are also sent, as sentinels, to
    the bucket before, and each bucket looks one row ahead: texts move once and no task sees all rows.
    Only the quantiles and one id a bucket come to the driver; their number is set by the shuffle
    partitions.  The id is taken as nearly unique: rows of one id are one bucket."""
    spark = docs.sparkSession
    low = F.lit(-(2**63)).cast("long")
    keyed = docs.withColumn("_key", F.coalesce(F.col(id_col).cast("long"), low)).withColumn(text_col, text_or_empty(text_col))
    steps = max(1, 4 * shuffle_parts(spark) - 1).bit_length()
    size = 1 << steps
    ids = keyed.select("_key")
    bounds = ids.agg(F.percentile_approx("_key", [i / size for i in range(1, size)], 10 * size)).first()[0]
    if bounds is None:
        return docs.withColumn("next_text", F.lit(None).cast("string"))
    table = F.lit(sorted(bounds)).cast("array<bigint>")
    bucket = F.aggregate(  # halving search for the number of bounds below the key
        F.array(*[F.lit(1 << k) for k in reversed(range(steps))]),
        F.lit(0),
        lambda at, step: F.when(F.element_at(table, at + step) < F.col("_key"), at + step).otherwise(at),
    )
    keyed = keyed.withColumn("_bucket", bucket)
    heads = sorted((r["_bucket"], r["head"]) for r in keyed.select("_key", "_bucket").groupBy("_bucket").agg(F.min("_key").alias("head")).collect())
    first, before = [low] * size, [0] * size
    for (b, head), (prev, _) in zip(heads, heads[-1:] + heads[:-1], strict=True):
        first[b], before[b] = head, prev
    first = [x if isinstance(x, int) else -(2**63) for x in first]
    at = F.col("_bucket") + 1
    is_head = F.col("_key") == F.element_at(F.lit(first).cast("array<bigint>"), at)
    own = F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("ahead"))
    sentinel = F.struct(F.element_at(F.lit(before).cast("array<int>"), at).alias("b"), F.lit(True).alias("ahead"))
    spread = keyed.withColumn("_to", F.explode(F.when(is_head, F.array(own, sentinel)).otherwise(F.array(own))))
    order = Window.partitionBy("_to.b").orderBy("_to.ahead", "_key", F.xxhash64(text_col))
    return spread.withColumn("next_text", F.lead(text_col).over(order)).filter(~F.col("_to.ahead")).drop("_to", "_bucket", "_key")


def edited(text: Column, next_text: Column) -> Column:
    """``text`` with its last half (rounded down, code points) replaced by as many characters of ``next_text``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(next_text, F.lit(1), half))
