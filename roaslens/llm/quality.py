"""Quality rules as a bitmask ledger: every rule is evaluated once, its failure is one bit.

``ledger`` measures every text and stores the measurements and the bits of the failed rules.  A
policy is a version and the rules it enforces, so changing a policy, or asking what a document set
would look like without one rule, is bit arithmetic on the ledger and never reads a text again.

Main path: DataFrame functions only.  A null text counts as empty; an empty table gives an empty
ledger; equal rows give equal ledger rows; other columns pass through (``keep``), and a column
named like a measurement is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roaslens.llm.common import let, text_or_empty

WINDOW = 8
#: character classes of the measurements
SPACE, SYMBOLS, CAPITALS = r"\x20\x09-\x0D", "#*$%&|<>", "A-Z"
#: measurement columns in ledger order
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements in whole-number arithmetic; ``bit`` never changes once given."""

    bit: int
    name: str
    fails: str


#: The catalogue.  A rule keeps its bit for ever; policies pick from it.
RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "short_words", "2 * word_chars < 5 * n_words"),
    Rule(4, "long_words", "word_chars > 12 * n_words"),
    Rule(5, "repeated_lines", "10 * n_dup_lines > 4 * n_lines"),
    Rule(6, "capitals", "10 * n_upper > 4 * word_chars"),
)


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: r.bit for r in RULES}
        return sum(1 << bits[name] for name in self.rules)


#: The two rules that every policy shares, and the policies by version.
BASE = Policy("base", ("few_words", "repeated_windows"))
POLICIES = {
    "v1": Policy("v1", (*BASE.rules, "symbols", "repeated_lines")),
    "v2": Policy("v2", tuple(r.name for r in RULES)),
}


def _windows(words: Column) -> Column:
    """64-bit hashes of all windows (null for texts shorter than a window): each from the hashes of
    its two halves of four words."""
    halves = lambda c: F.transform(c, lambda x, i: F.xxhash64(x, F.get(c, i + 1), F.get(c, i + 2), F.get(c, i + 3)))
    whole = let(let(words, halves), lambda c: F.transform(F.slice(c, F.lit(1), F.size(c) - (WINDOW - 1)), lambda x, i: F.xxhash64(x, F.get(c, i + 4))))
    return F.when(F.size(words) >= WINDOW, whole)


def _covered(windows: Column) -> Column:
    """Words inside windows that occur twice or more.

    Only texts where two windows agree pay for the sort of (hash, place) pairs; the places of
    agreeing windows are then walked in order, each adding the words that the one before left."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    agreeing = let(pairs, lambda p: F.filter(p, lambda x, i: F.coalesce((F.get(p, i - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce(F.get(p, i + 1)["h"] == x["h"], F.lit(False))))
    walked = F.aggregate(
        F.sort_array(F.transform(agreeing, lambda x: x["i"])),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
    )
    return walked["n"]


def _repeat_words(words: Column) -> Column:
    n = let(_windows(words), lambda w: F.when(w.isNotNull() & (F.size(F.array_distinct(w)) < F.size(w)), _covered(w)).otherwise(F.lit(0)))
    return n.cast("long")


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns of ``MEASURES`` (long); see the module for the edge cases."""
    docs = docs.drop(*MEASURES)
    text = text_or_empty(text_col)
    words = F.filter(F.split(text, rf"[{SPACE}]"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(rf"[^{SPACE}]"))
    length = lambda c: F.length(c).cast("long")
    among = lambda chars: length(F.regexp_replace(text, f"[^{chars}]+", ""))  # noqa: E731  characters of a class
    of_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), F.aggregate(w, F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("chars"), _repeat_words(w).alias("repeat")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    staged = docs.withColumns({"_w": of_words, "_l": of_lines})
    found = {"n_words": "_w.n", "word_chars": "_w.chars", "n_dup_lines": "_l.dup", "n_repeat_words": "_w.repeat", "n_lines": "_l.n"}
    counted = {"n_symbols": among(SYMBOLS), "n_upper": among(CAPITALS)}
    return staged.select(*docs.columns, *[(counted[m] if m in counted else F.col(found[m])).alias(m) for m in MEASURES])


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Measurements and ``failures``: bit ``Rule.bit`` is set where the rule fails."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in RULES]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measure(docs.drop("failures"), text_col).withColumn("failures", total.cast("long"))


def passes(policy: Policy) -> Column:
    """True where none of the policy's rules failed."""
    return F.col("failures").bitwiseAND(F.lit(policy.mask)) == 0


def ablation(entries: DataFrame, policy: Policy) -> DataFrame:
    """One row per rule of the policy: rows failing it, and rows that only it rejects (which come
    back if it goes).  Rows are first summed by failure mask, at most ``2 ** len(RULES)`` of them."""
    masks = entries.groupBy(F.col("failures").bitwiseAND(F.lit(policy.mask)).alias("mask")).count()
    named = {r.name: r.bit for r in RULES}
    return masks.select(
        "mask", "count",
        F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << named[n]).cast("long").alias("bit")) for n in policy.rules])).alias("r"),
    ).groupBy(F.lit(policy.version).alias("version"), F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("mask").bitwiseAND(F.col("r.bit")) != 0, F.col("count")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("mask") == F.col("r.bit"), F.col("count")).otherwise(0)).alias("n_only"),
    )
