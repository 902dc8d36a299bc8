"""Recommended action and checklist.

The rules are data: an ordered list of (condition, action code, text).  The
same list renders to a Spark ``when`` chain (JVM-side, no UDF) and to a SQL
CASE expression, so there is one source of truth for both engines.  The
wording is this project's own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roaslens.functions.exprs import channel_type, trace_text
from roaslens.schema import DIMENSIONS

DRIVERS = ("CPC", "CVR", "AOV")
CHANNEL_TYPES = ("SEARCH", "PMAX", "OTHER")
_KPI_WORD = {"CPC": "cost per click", "CVR": "conversion rate", "AOV": "order value"}
_CH_WORD = {"SEARCH": "search", "PMAX": "performance-max", "OTHER": "the channel"}

# A condition is a dict over the keys tag / mode (tuple of allowed modes) /
# driver / ctype; a missing key matches anything.
Rule = tuple[dict, str, str]

_TAG_ACTIONS: list[Rule] = [
    ({"tag": "LOW_VOL"}, "TAG_LOW_VOL", "Sample too small for a verdict; wait for more traffic."),
    ({"tag": "NEW"}, "TAG_NEW", "No last-year figures; track it weekly against its parent's ROAS."),
    ({"tag": "GONE"}, "TAG_GONE", "No spend this year; confirm that its demand is served elsewhere."),
    ({"tag": "UNDEFINED"}, "TAG_UNDEFINED", "A ratio cannot be computed; repair the missing inputs before acting."),
]

def _advice(driver: str, ctype: str, verb: str) -> str:
    return f"{verb} {_KPI_WORD[driver]} in {_CH_WORD[ctype]}."


_ISSUE_TEXT = {d: {c: _advice(d, c, "ROAS fell, led by the change of") for c in CHANNEL_TYPES} for d in DRIVERS}
_IMPROVE_TEXT = {d: {c: _advice(d, c, "ROAS rose or held thanks to the change of") for c in CHANNEL_TYPES} for d in DRIVERS}

ACTION_RULES: list[Rule] = list(_TAG_ACTIONS)
for _d in DRIVERS:
    for _c in CHANNEL_TYPES:
        ACTION_RULES.append(({"mode": ("ISSUE",), "driver": _d, "ctype": _c}, f"ISSUE_{_d}_{_c}", _ISSUE_TEXT[_d][_c]))
ACTION_RULES.append(({"mode": ("ISSUE",)}, "ISSUE_DEFAULT", "ROAS fell and no single lever explains it."))
for _d in DRIVERS:
    for _c in CHANNEL_TYPES:
        ACTION_RULES.append(({"mode": ("IMPROVE", "DEFENSE"), "driver": _d, "ctype": _c}, f"IMPROVE_{_d}_{_c}", _IMPROVE_TEXT[_d][_c]))
ACTION_RULES.append(({"mode": ("DEFENSE",)}, "DEFENSE_DEFAULT", "ROAS held up better than its peers and no single lever explains it."))
ACTION_RULES.append(({"mode": ("IMPROVE",)}, "IMPROVE_DEFAULT", "ROAS rose and no single lever explains it."))
ACTION_DEFAULT = ("NO_RULE", "No action rule matched.")

_TAG_CHECKS: list[Rule] = [
    ({"tag": "LOW_VOL"}, "TAG_LOW_VOL", "a) count clicks and orders; b) compare with the parent"),
    ({"tag": "NEW"}, "TAG_NEW", "a) note the first day of spend; b) compare with siblings; c) look again next month"),
    ({"tag": "GONE"}, "TAG_GONE", "a) find the last day of spend; b) see which siblings grew"),
    ({"tag": "UNDEFINED"}, "TAG_UNDEFINED", "a) list the null or zero inputs; b) trace them to their source; c) load again"),
]


def _check_text(driver: str, issue: bool, ctype: str) -> str:
    kpi, ch = _KPI_WORD[driver], _CH_WORD[ctype]
    side = "below" if issue else "above"
    return f"a) list the products of {ch} by {kpi}; b) mark those {side} last year; c) review their share of spend"


CHECK_RULES: list[Rule] = list(_TAG_CHECKS)
for _d in DRIVERS:
    for _issue in (True, False):
        for _c in CHANNEL_TYPES:
            cond = {"driver": _d, "ctype": _c}
            if _issue:
                cond["mode"] = ("ISSUE",)
            else:
                cond["not_mode"] = ("ISSUE",)
            CHECK_RULES.append((cond, f"{'ISSUE' if _issue else 'SCALE'}_{_d}_{_c}", _check_text(_d, _issue, _c)))
CHECK_DEFAULT = ("DEFAULT", "a) compare all three levers with last year; b) review the share of spend")


def _cond_col(cond: dict, tag: Column, mode: Column, driver: Column, ctype: Column) -> Column:
    parts = []
    if "tag" in cond:
        parts.append(tag == F.lit(cond["tag"]))
    if "mode" in cond:
        parts.append(mode.isin(*cond["mode"]))
    if "not_mode" in cond:
        parts.append(~mode.isin(*cond["not_mode"]))
    if "driver" in cond:
        parts.append(driver == F.lit(cond["driver"]))
    if "ctype" in cond:
        parts.append(ctype == F.lit(cond["ctype"]))
    out = F.lit(True)
    for p in parts:
        out = out & p
    return out


def _chain(rules: list[Rule], default: tuple[str, str], field: int, tag: Column, mode: Column, driver: Column, ctype: Column) -> Column:
    expr = None
    for cond, code, text in rules:
        val = F.lit(code if field == 1 else text)
        c = _cond_col(cond, tag, mode, driver, ctype)
        expr = F.when(c, val) if expr is None else expr.when(c, val)
    return expr.otherwise(F.lit(default[0] if field == 1 else default[1]))


SIGNAL_COLUMNS = {
    "__sig_tag": lambda: F.upper(F.coalesce(F.col("tag"), F.lit("NORMAL"))),
    "__sig_mode": lambda: F.upper(F.coalesce(F.col("mode_tag"), F.lit(""))),
    "__sig_driver": lambda: F.upper(F.coalesce(F.col("primary_driver"), F.lit("CPC"))),
    "__sig_ctype": lambda: channel_type(F.col("CHANNEL")),
}


def _signals() -> tuple[Column, Column, Column, Column]:
    """Policy inputs as column references (materialised once by ``with_signals``)."""
    return tuple(F.col(c) for c in SIGNAL_COLUMNS)  # type: ignore[return-value]


def with_signals(df):
    return df.withColumns({k: f() for k, f in SIGNAL_COLUMNS.items()})


def recommended_action(code: bool = False) -> Column:
    """R10 over columns tag / mode_tag / primary_driver (confirmed) / CHANNEL (after ``with_signals``)."""
    return _chain(ACTION_RULES, ACTION_DEFAULT, 1 if code else 2, *_signals())


def action_checklist(code: bool = False) -> Column:
    """R11."""
    return _chain(CHECK_RULES, CHECK_DEFAULT, 1 if code else 2, *_signals())


TAGS = ("LOW_VOL", "NEW", "GONE", "UNDEFINED")


def action_code_expr() -> Column:
    """R10 as a code: the rule list's first match, written as one short expression."""
    tag, mode, driver, ctype = _signals()
    known = driver.isin(*DRIVERS)
    return (
        F.when(tag.isin(*TAGS), F.concat(F.lit("TAG_"), tag))
        .when(mode == "ISSUE", F.when(known, F.concat_ws("_", F.lit("ISSUE"), driver, ctype)).otherwise(F.lit("ISSUE_DEFAULT")))
        .when(mode.isin("IMPROVE", "DEFENSE"), F.when(known, F.concat_ws("_", F.lit("IMPROVE"), driver, ctype))
              .when(mode == "DEFENSE", F.lit("DEFENSE_DEFAULT")).otherwise(F.lit("IMPROVE_DEFAULT")))
        .otherwise(F.lit(ACTION_DEFAULT[0]))
    )


def checklist_code_expr() -> Column:
    """R11 as a code."""
    tag, mode, driver, ctype = _signals()
    return (
        F.when(tag.isin(*TAGS), F.concat(F.lit("TAG_"), tag))
        .when(driver.isin(*DRIVERS), F.concat_ws("_", F.when(mode == "ISSUE", F.lit("ISSUE")).otherwise(F.lit("SCALE")), driver, ctype))
        .otherwise(F.lit(CHECK_DEFAULT[0]))
    )


def _texts(spark, rules, default, code_col: str, text_col: str):
    rows = [(code, text) for _, code, text in rules] + [default]
    return spark.createDataFrame(rows, f"{code_col} string, {text_col} string")


def enrich_actions(df):
    """Confirmed driver, action / checklist codes and texts, path, diagnosis mode, trace text.

    Codes are short expressions; texts come from the rule tables (48 fixed
    rows, so the broadcast is bounded) through an equi-join.
    """
    from roaslens.operators.rootcause import confirmed_driver

    df = df.withColumn("rca_primary_driver", F.col("primary_driver"))
    df = with_signals(df.withColumn("primary_driver", confirmed_driver()))
    df = df.withColumns({
        "diagnosis_path": F.struct(*[F.col(d) for d in DIMENSIONS]),
        "campaign_diagnosis_mode": F.lit("MANUAL"),
        "action_code": action_code_expr(),
        "checklist_code": checklist_code_expr(),
        "drill_trace_text": trace_text("drill_trace"),
    }).drop(*SIGNAL_COLUMNS)
    spark = df.sparkSession
    df = df.join(F.broadcast(_texts(spark, ACTION_RULES, ACTION_DEFAULT, "action_code", "recommended_actions")), "action_code", "left")
    return df.join(F.broadcast(_texts(spark, CHECK_RULES, CHECK_DEFAULT, "checklist_code", "action_checklist")), "checklist_code", "left")


# ------------------------------------------------------------------ SQL rendering (oracle)

def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _cond_sql(cond: dict, tag: str, mode: str, driver: str, ctype: str) -> str:
    parts = []
    if "tag" in cond:
        parts.append(f"{tag} = {_sql_lit(cond['tag'])}")
    if "mode" in cond:
        parts.append(f"{mode} IN ({', '.join(_sql_lit(m) for m in cond['mode'])})")
    if "not_mode" in cond:
        parts.append(f"{mode} NOT IN ({', '.join(_sql_lit(m) for m in cond['not_mode'])})")
    if "driver" in cond:
        parts.append(f"{driver} = {_sql_lit(cond['driver'])}")
    if "ctype" in cond:
        parts.append(f"{ctype} = {_sql_lit(cond['ctype'])}")
    return " AND ".join(parts) if parts else "TRUE"


def rules_sql(kind: str, field: str, tag: str, mode: str, driver: str, ctype: str) -> str:
    rules, default = (ACTION_RULES, ACTION_DEFAULT) if kind == "action" else (CHECK_RULES, CHECK_DEFAULT)
    idx = 1 if field == "code" else 2
    whens = " ".join(f"WHEN {_cond_sql(c, tag, mode, driver, ctype)} THEN {_sql_lit((None, code, text)[idx])}" for c, code, text in rules)
    return f"CASE {whens} ELSE {_sql_lit(default[idx - 1])} END"
