"""Column expressions (X1-X23): null-safe ratios, log mean, formatters, trace text.

Everything here returns a ``Column`` built from built-in functions, so it stays
inside whole-stage code generation; no Python UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roaslens.schema import DIMENSIONS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _pos(x) -> Column:
    """``x`` where it is > 0, else null."""
    x = _c(x)
    return F.when(x > 0, x)


SUM_DIGITS = 14


def significant(x, digits: int = SUM_DIGITS) -> Column:
    """``x`` rounded to significant digits: what is left does not depend on the order of additions."""
    x = _c(x).cast("double")
    shift = F.lit(digits - 1) - F.floor(F.log10(F.abs(x)))
    power = F.pow(F.lit(10.0), F.abs(shift))
    return F.when(x == 0, F.lit(0.0)).when(F.abs(shift) > 300, x).when(shift >= 0, F.rint(x * power) / power).otherwise(F.rint(x / power) * power)


def dsum(x) -> Column:
    """Sum of a double column, kept to ``SUM_DIGITS`` significant digits at any magnitude."""
    return significant(F.sum(_c(x).cast("double")))


def safe_ratio(num, den) -> Column:
    """Num / den, null unless den > 0."""
    return _c(num) / _pos(den)


def pct_change(curr, prev) -> Column:
    """(curr - prev) / prev, null unless prev > 0."""
    p = _pos(prev)
    return (_c(curr) - p) / p


def log_ratio(curr, prev) -> Column:
    """ln(curr / prev), null unless both > 0."""
    return F.log(_pos(curr) / _pos(prev))


def log_mean(curr, prev) -> Column:
    """Logarithmic mean L(x, y); null if a side is <= 0, x if equal."""
    c, p = _pos(curr), _pos(prev)
    den = F.when(c != p, F.log(c) - F.log(p))
    return (
        F.when(c.isNull() | p.isNull(), F.lit(None).cast("double"))
        .when(c == p, c)
        .otherwise(F.try_divide(c - p, den))
    )


def to_float(x, default: float = 0.0) -> Column:
    """Null -> default."""
    return F.coalesce(_c(x), F.lit(float(default)))


def direct_contribution_pct(child, parent_delta, mode) -> Column:
    """Share of |parent delta| carried by ``child`` in the direction of ``mode``."""
    child, parent_delta, mode = _c(child), _c(parent_delta), _c(mode)
    den = F.abs(parent_delta)
    m = F.upper(F.coalesce(mode, F.lit("")))
    return (
        F.when(den.isNull() | (den <= 0), F.lit(None).cast("double"))
        .when(m == "ISSUE", F.greatest(F.lit(0.0), -child) / den)
        .when(m.isin("IMPROVE", "DEFENSE"), F.greatest(F.lit(0.0), child) / den)
        .otherwise(F.abs(child) / den)
    )


# ---------------------------------------------------------------- formatters
# Display strings round numerically first (round = half-up on the decimal
# value), then format the rounded value, so that text does not depend on the
# platform's printf rounding.

def _fmt(fmt: str, x: Column) -> Column:
    return F.format_string(fmt, x)


def fmt_money(x) -> Column:
    """$x.xM / $xK / $x of |x|; null -> $0."""
    a = F.abs(_c(x))
    return (
        F.when(a.isNull(), F.lit("$0"))
        .when(a >= 1_000_000, F.concat(F.lit("$"), _fmt("%.1f", F.round(a / 1_000_000, 1)), F.lit("M")))
        .when(a >= 1_000, F.concat(F.lit("$"), _fmt("%.0f", F.round(a / 1_000, 0)), F.lit("K")))
        .otherwise(F.concat(F.lit("$"), _fmt("%.0f", F.round(a, 0))))
    )


def fmt_money_signed(x) -> Column:
    x = _c(x)
    return F.when(x.isNull(), F.lit("$0")).otherwise(
        F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("+")), fmt_money(x))
    )


def fmt_pct(x, signed: bool = True) -> Column:
    """Whole percent; null -> N/A (the signed form drops the '+')."""
    x = _c(x)
    return F.when(x.isNull(), F.lit("N/A")).otherwise(
        F.concat(_fmt("%.0f", F.round(x * 100, 0) + F.lit(0.0)), F.lit("%"))
    )


def fmt_pct_yoy(x) -> Column:
    x = _c(x)
    return F.when(x.isNull(), F.lit("N/A")).otherwise(F.concat(fmt_pct(x), F.lit(" YoY")))


def fmt_roas(x) -> Column:
    """One decimal; null -> N/A."""
    x = _c(x)
    return F.when(x.isNull(), F.lit("N/A")).otherwise(_fmt("%.1f", F.round(x, 1) + F.lit(0.0)))


def fmt_pp(x) -> Column:
    x = _c(x)
    v = F.round(x * 100, 0) + F.lit(0.0)
    return F.when(x.isNull(), F.lit("N/A")).otherwise(
        F.concat(F.when(v >= 0, F.lit("+")).otherwise(F.lit("")), _fmt("%.0f", v), F.lit("%p"))
    )


def fmt_driver_metric(metric, x) -> Column:
    """CPC as $0.00, CVR as 0.00%, AOV as money, else three decimals."""
    metric, x = _c(metric), _c(x)
    return (
        F.when(x.isNull(), F.lit("N/A"))
        .when(metric == "CPC", F.concat(F.lit("$"), _fmt("%.2f", F.round(x, 2))))
        .when(metric == "CVR", F.concat(_fmt("%.2f", F.round(x * 100, 2)), F.lit("%")))
        .when(metric == "AOV", fmt_money(x))
        .otherwise(_fmt("%.3f", F.round(x, 3)))
    )


def trend(x, eps: float = 1e-9) -> Column:
    """Up / down / flat / unknown."""
    x = _c(x)
    return (
        F.when(x.isNull(), F.lit("unknown"))
        .when(x > eps, F.lit("up"))
        .when(x < -eps, F.lit("down"))
        .otherwise(F.lit("flat"))
    )


def yoy_polarity(metric, x) -> Column:
    """Positive / negative / neutral / na; a CPC rise is negative."""
    metric, x = _c(metric), _c(x)
    signed = F.when(metric == "CPC", -x).otherwise(x)
    return (
        F.when(x.isNull(), F.lit("na"))
        .when(F.abs(x) < 1e-12, F.lit("neutral"))
        .when(signed > 0, F.lit("positive"))
        .otherwise(F.lit("negative"))
    )


def clean_number(x) -> Column:
    """NaN / +-inf -> null (export cleaning)."""
    x = _c(x)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(x)


# ---------------------------------------------------------------- paths, traces

def path_key(dims: list[str]) -> Column:
    """Dims joined by a pipe (null dims skipped)."""
    return F.concat_ws("|", *[F.col(d) for d in dims])


def _path_text(path: Column) -> Column:
    """a/b/c of the non-null dims of a path struct (dims are a prefix)."""
    return F.concat_ws("/", *[path.getField(d) for d in DIMENSIONS])


def trace_text(trace) -> Column:
    """X11: 'LEVELn:RULE:a/b/c' per node joined by ' -> '."""
    trace = _c(trace)
    return F.coalesce(
        F.array_join(
            F.transform(
                trace,
                lambda n: F.concat_ws(":", n.getField("level"), n.getField("rule"), _path_text(n.getField("selected_path"))),
            ),
            " -> ",
        ),
        F.lit(""),
    )


def paths_text(paths) -> Column:
    """Selected paths 'a/b/c' joined by ' ; '."""
    return F.coalesce(F.array_join(F.transform(_c(paths), _path_text), " ; "), F.lit(""))


def _depth(path: Column) -> Column:
    """Number of leading non-null dims of a path struct."""
    depth = F.lit(0)
    alive = F.lit(True)
    for d in DIMENSIONS:
        alive = alive & path.getField(d).isNotNull()
        depth = depth + F.when(alive, 1).otherwise(0)
    return depth


def trace_node_for_dim(trace, dim: str) -> Column:
    """Last node whose selected path ends exactly at ``dim``; null if none."""
    target = DIMENSIONS.index(dim) + 1
    hits = F.filter(_c(trace), lambda n: _depth(n.getField("selected_path")) == target)
    return F.try_element_at(hits, F.lit(-1))


def last_node(trace) -> Column:
    """Last node of a trace or null."""
    return F.try_element_at(_c(trace), F.lit(-1))


def channel_type(channel) -> Column:
    """PMAX / SEARCH / OTHER from the channel text."""
    t = F.upper(F.trim(F.coalesce(_c(channel), F.lit(""))))
    return (
        F.when(t.contains("PMAX") | t.contains("PERFORMANCE MAX"), F.lit("PMAX"))
        .when(t.contains("SEARCH"), F.lit("SEARCH"))
        .otherwise(F.lit("OTHER"))
    )
