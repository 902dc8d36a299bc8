"""Display layer of the report cards.

Fallback topics rank every leaf of a subsidiary; they are never ranked with a
window over the subsidiary.  Instead each row carries a sortable ``order``
struct, the contribution denominator is a grouped sum, and the merge with the
selected topics is the grouped-min diverse pick, so a subsidiary that owns a
third of all leaves is reduced map-side like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roaslens.config import EngineConfig
from roaslens.functions.exprs import fmt_money, fmt_pct, fmt_pct_yoy, fmt_roas, pct_change, safe_ratio
from roaslens.operators.levels import level_rows
from roaslens.operators.topics import diverse_pick, yoy_basis
from roaslens.schema import dims_of

KPIS = ("CVR", "AOV", "CPC")

_LEVER = {"CPC": "cost per click", "CVR": "conversion rate", "AOV": "order value"}

# Display texts by mode and driver (R17), composed from the two.
SHORT_ACTION = {
    (mode, driver): f"{verb} the {_LEVER[driver]}." if driver else f"{verb} whichever lever moved most."
    for mode, verb in (("ISSUE", "Win back"), ("IMPROVE", "Build on"))
    for driver in ("CPC", "CVR", "AOV", None)
}
SHORT_CHECK = {
    **{(mode, driver): f"a) see where the {word} {moved}; b) follow it weekly" for driver, word in _LEVER.items() for mode, moved in (("ISSUE", "got worse"), ("IMPROVE", "got better"))},
    (None, None): "a) compare the three levers; b) follow the largest weekly",
}
# Next step of the summary line by mode and driver.
SHORT_NEXT = {
    (mode, driver): f"{verb} the {_LEVER[driver]}" if driver else f"{verb} the largest lever"
    for mode, verb in (("ISSUE", "examine"), ("IMPROVE", "extend"))
    for driver in ("CPC", "CVR", "AOV", None)
}


def _by_mode_and_driver(texts: dict, mode: Column, driver: Column) -> Column:
    m = F.when(F.upper(mode) == "ISSUE", F.lit("ISSUE")).otherwise(F.lit("IMPROVE"))
    d = F.upper(F.coalesce(driver, F.lit("NONE")))
    expr = None
    for (mm, dd), text in texts.items():
        cond = (m == mm) & (d == dd) if dd else (m == mm)
        expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))
    return expr


def short_action(mode: Column, driver: Column) -> Column:
    return _by_mode_and_driver(SHORT_ACTION, mode, driver)


def short_next(mode: Column, driver: Column) -> Column:
    return _by_mode_and_driver(SHORT_NEXT, mode, driver)


def short_checklist(mode: Column, driver: Column) -> Column:
    m = F.when(F.upper(mode) == "ISSUE", F.lit("ISSUE")).otherwise(F.lit("IMPROVE"))
    d = F.upper(F.coalesce(driver, F.lit("NONE")))
    expr = None
    for (mm, dd), text in SHORT_CHECK.items():
        if mm is None:
            continue
        cond = (m == mm) & (d == dd)
        expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))
    return expr.otherwise(F.lit(SHORT_CHECK[(None, None)]))


def _yoy_of(kpi: str) -> Column:
    return F.coalesce(F.col(f"{kpi.lower()}_yoy"), F.lit(0.0))


def _yoy_scores(mode: Column) -> dict[str, Column]:
    """How far each KPI's YoY moved in the direction of the mode (CPC is good when it falls)."""
    sign = F.when(F.upper(mode) == "ISSUE", F.lit(-1.0)).otherwise(F.lit(1.0))
    return {k: F.greatest(F.lit(0.0), _yoy_of(k) * (-sign if k == "CPC" else sign)) for k in KPIS}


def _largest(scores: dict[str, Column]) -> Column:
    """Name of the largest score; ties go to the larger name."""
    c, a, p = (scores[k] for k in KPIS)
    return F.when((c >= p) & (c >= a), F.lit("CVR")).when(p >= a, F.lit("CPC")).otherwise(F.lit("AOV"))


def yoy_leader(mode: Column) -> Column:
    """The KPI that moved most in the direction of the mode; null if none did."""
    scores = _yoy_scores(mode)
    return F.when(F.greatest(*scores.values()) > 0, _largest(scores))


def yoy_driver_cols(mode: Column) -> Column:
    """R14 on columns cvr_yoy / aov_yoy / cpc_yoy (null -> 0); without a leader the largest change."""
    return F.coalesce(yoy_leader(mode), _largest({k: F.abs(_yoy_of(k)) for k in KPIS}))


def effect_direction(metric: str, mode: Column, dlog: Column) -> Column:
    """Causes / offsets / neutral, by mode and the sign of the KPI's dlog."""
    v = F.coalesce(dlog, F.lit(0.0))
    iss = F.upper(mode) == "ISSUE"
    harmful = (v > 0) if metric == "CPC" else (v < 0)
    return (
        F.when(F.abs(v) < 1e-12, F.lit("neutral"))
        .when(iss, F.when(harmful, F.lit("pulls ROAS down")).otherwise(F.lit("works against the fall")))
        .otherwise(F.when(~harmful, F.lit("lifts ROAS")).otherwise(F.lit("works against the rise")))
    )


def kpi_ranking(mode: Column) -> Column:
    """KPIs ranked by |dlog| desc then name, with approx % and effect direction; null without any dlog."""
    items = F.array(*[
        F.struct(
            (-F.abs(F.coalesce(F.col(f"dlog_{k}"), F.lit(0.0)))).alias("neg_abs"), F.lit(k).alias("metric"),
            F.round(F.abs(F.coalesce(F.col(f"dlog_{k}"), F.lit(0.0))) * 100).cast("int").alias("approx_pct"),
            effect_direction(k, mode, F.col(f"dlog_{k}")).alias("direction"),
        ) for k in KPIS
    ])
    some = F.greatest(*[F.abs(F.coalesce(F.col(f"dlog_{k}"), F.lit(0.0))) for k in KPIS]) > 0
    return F.when(some, F.transform(F.array_sort(items), lambda s: s.dropFields("neg_abs")))


PACK = [
    "revenue_curr", "revenue_prev", "revenue_delta", "revenue_yoy", "cost_curr", "cost_prev", "cost_yoy", "roas_curr", "roas_prev",
    "roas_yoy", "CPC_curr", "CPC_prev", "cpc_yoy", "CVR_curr", "CVR_prev", "cvr_yoy", "AOV_curr", "AOV_prev", "aov_yoy",
]


def scope_metrics(levels: DataFrame, level: int) -> DataFrame:
    """Metric pack (``PACK``) of every row of a level."""
    scope = level_rows(levels, level)
    rc, rp, sc, sp = (F.col(c) for c in ("Revenue_curr_sum", "Revenue_prev_sum", "Spend_curr_sum", "Spend_prev_sum"))
    cc, cp, oc, op = (F.col(c) for c in ("Clicks_curr_sum", "Clicks_prev_sum", "Orders_curr_sum", "Orders_prev_sum"))
    x = scope.select(
        *dims_of(level),
        rc.alias("revenue_curr"), rp.alias("revenue_prev"), (rc - rp).alias("revenue_delta"), pct_change(rc, rp).alias("revenue_yoy"),
        sc.alias("cost_curr"), sp.alias("cost_prev"), pct_change(sc, sp).alias("cost_yoy"),
        safe_ratio(rc, sc).alias("roas_curr"), safe_ratio(rp, sp).alias("roas_prev"),
        safe_ratio(sc, cc).alias("CPC_curr"), safe_ratio(sp, cp).alias("CPC_prev"),
        safe_ratio(oc, cc).alias("CVR_curr"), safe_ratio(op, cp).alias("CVR_prev"),
        safe_ratio(rc, oc).alias("AOV_curr"), safe_ratio(rp, op).alias("AOV_prev"),
    )
    return x.withColumns({
        "roas_yoy": pct_change("roas_curr", "roas_prev"),
        "cpc_yoy": pct_change("CPC_curr", "CPC_prev"),
        "cvr_yoy": pct_change("CVR_curr", "CVR_prev"),
        "aov_yoy": pct_change("AOV_curr", "AOV_prev"),
    })


def contribution_label(mode: Column, delta: Column) -> Column:
    return F.when(mode == "ISSUE", F.when(delta < 0, F.lit("part of the fall")).otherwise(F.lit("counterweight"))).otherwise(
        F.when(delta > 0, F.lit("part of the rise")).otherwise(F.lit("drag")))


def _figures(prefix: str = "") -> Column:
    """Revenue, cost and ROAS of a metric pack with their YoY, as one text."""
    part = lambda word, fmt, curr, yoy: F.concat(F.lit(word + " "), fmt(prefix + curr), F.lit(" ("), fmt_pct_yoy(prefix + yoy), F.lit(")"))
    return F.concat_ws(" | ", part("Revenue", fmt_money, "revenue_curr", "revenue_yoy"), part("Cost", fmt_money, "cost_curr", "cost_yoy"),
                       part("ROAS", fmt_roas, "roas_curr", "roas_yoy"))


def fallback_topics(levels: DataFrame) -> DataFrame:
    """W12 for both modes: every leaf of a subsidiary as a candidate topic.

    ISSUE: revenue decliners first, then the rest, each by |revenue delta|
    desc; IMPROVE mirrored.  Contribution = |delta| / sum of |delta| of the
    primary part (null if 0).  Ties in the reference follow hash order; here
    they are broken by (channel, division, product).
    """
    m = scope_metrics(levels, 4)
    x = m.withColumn("mode_tag", F.explode(F.array(F.lit("ISSUE"), F.lit("IMPROVE"))))
    d = F.col("revenue_delta")
    primary = F.when(F.col("mode_tag") == "ISSUE", d < 0).otherwise(d > 0)
    x = x.withColumn("is_primary", primary)
    den = x.groupBy("SUBSIDIARY", "mode_tag").agg(F.sum(F.when(F.col("is_primary"), F.abs(d))).alias("__den"))
    x = x.join(den, ["SUBSIDIARY", "mode_tag"], "left")
    pct = F.when(F.col("__den") > 0, F.abs(d) / F.col("__den"))
    label = contribution_label(F.col("mode_tag"), d)
    x = x.withColumns({"impact_contribution_pct": pct, "contribution_label": label, "primary_driver": yoy_driver_cols(F.col("mode_tag"))})
    x = x.withColumns({
        "impact_contribution_text": fmt_pct("impact_contribution_pct", signed=False),
        "recommended_actions": short_action(F.col("mode_tag"), F.col("primary_driver")),
        "action_checklist": short_checklist(F.col("mode_tag"), F.col("primary_driver")),
        "summary_text": F.concat(F.col("PRODUCT"), F.lit(" | "), _figures()),
        "why_selected_text": F.concat(F.col("contribution_label"), F.lit(" "), fmt_pct("impact_contribution_pct", signed=False), F.lit(" (filled in)")),
        "order": F.struct((~F.col("is_primary")).alias("secondary"), (-F.abs(d)).alias("neg_abs_delta"),
                          F.col("CHANNEL").alias("c"), F.col("DIVISION").alias("d"), F.col("PRODUCT").alias("p")),
    })
    return x.withColumn("diagnosis_subsidiary", F.col("SUBSIDIARY")).drop("__den")


def display_gate(cfg: EngineConfig) -> Column:
    """YoY basis or contribution >= 0.03 (null contribution counts as low)."""
    p = F.col("impact_contribution_pct")
    return yoy_basis() | (p.isNotNull() & (p >= cfg.min_topic_roas_abs_delta))


def existing_topics(top3: DataFrame | None, topics: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The top-3 picks; of a summary without them (``None``) three topics by contribution, per list."""
    cols = ["diagnosis_subsidiary", "CHANNEL", "DIVISION", "PRODUCT", "mode_tag", "impact_contribution_pct", "primary_driver", "list"]
    if top3 is not None:
        return top3.filter(display_gate(cfg)).select(*cols, F.col("pick_no").cast("double").alias("k"))
    exact = F.when(F.col("list") == "issues", F.lit("ISSUE")).otherwise(F.lit("IMPROVE"))
    w = Window.partitionBy("diagnosis_subsidiary", "list").orderBy(
        F.coalesce("impact_contribution_pct", F.lit(0.0)).desc(), "CHANNEL", "DIVISION", "PRODUCT")
    ranked = topics.filter((F.col("mode_tag") == exact) & display_gate(cfg)).withColumn("__n", F.row_number().over(w))
    return ranked.filter(F.col("__n") <= 3).select(*cols, F.col("__n").cast("double").alias("k"))


def merged_topics(existing: DataFrame, fallback: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Existing topics, then fallback topics; gate; first of each triplet; diverse pick of 3."""
    cols = ["diagnosis_subsidiary", "CHANNEL", "DIVISION", "PRODUCT", "impact_contribution_pct", "primary_driver"]
    mode = F.when(F.col("list") == "issues", F.lit("ISSUE")).otherwise(F.lit("IMPROVE"))

    def order(src: int, sec: Column, k: Column, c: Column, d: Column, p: Column) -> Column:
        return F.struct(F.lit(src).alias("src"), sec.alias("sec"), k.cast("double").alias("k"),
                        c.alias("c"), d.alias("d"), p.alias("p"))
    blank = F.lit("")
    ex = existing.select(*cols, mode.alias("card_mode"), F.lit("selected").alias("source"),
                         order(0, F.lit(False), F.col("k"), blank, blank, blank).alias("order"))
    fb = fallback.filter(display_gate(cfg)).select(
        *cols, F.col("mode_tag").alias("card_mode"), F.lit("fallback").alias("source"),
        order(1, F.col("order.secondary"), F.col("order.neg_abs_delta"), F.col("CHANNEL"), F.col("DIVISION"), F.col("PRODUCT")).alias("order"),
    )
    return diverse_pick(ex.unionByName(fb), ["diagnosis_subsidiary", "card_mode"], F.col("order"), 3)


def card_topics(levels: DataFrame, top3: DataFrame, merged: DataFrame) -> DataFrame:
    """The merged topics with the figures of their channel, division and product, and their texts.

    A topic filled in from the fallback has no RCA of its own: its texts follow from the figures."""
    keys = ["diagnosis_subsidiary", "card_mode", "CHANNEL", "DIVISION", "PRODUCT"]
    texts = ["recommended_actions", "action_checklist", "why_selected_text", "summary_text", "kpi_ranking"]
    yoys = [f"{k.lower()}_yoy" for k in KPIS]
    own = top3.withColumns({
        "card_mode": F.when(F.col("list") == "issues", F.lit("ISSUE")).otherwise(F.lit("IMPROVE")), "source": F.lit("selected"),
    }).select(*keys, "source", *texts, *yoys)
    x = merged.select(*keys, "pick_no", "source", "impact_contribution_pct", "primary_driver").join(own, [*keys, "source"], "left")
    for level, name in ((2, "channel"), (3, "division"), (4, "product")):
        dims = dims_of(level)[1:]
        pack = scope_metrics(levels, level).select(F.col("SUBSIDIARY").alias("diagnosis_subsidiary"), *dims, F.struct(*PACK).alias(f"{name}_kpi"))
        x = x.join(pack, ["diagnosis_subsidiary", *dims], "left")
    mode = F.col("card_mode")
    x = x.withColumns({c: F.coalesce(c, f"product_kpi.{c}") for c in yoys})
    x = x.withColumns({
        "driver": F.coalesce(F.col("primary_driver"), yoy_driver_cols(mode)),
        "yoy_leader": yoy_leader(mode),
        "impact_contribution_text": fmt_pct("impact_contribution_pct", signed=False),
        "contribution_label": contribution_label(mode, F.when(F.col("source") == "fallback", F.col("product_kpi.revenue_delta"))
                                                 .otherwise(F.when(mode == "ISSUE", F.lit(-1.0)).otherwise(F.lit(1.0)))),
    })
    yoy = lambda kpi: F.when(kpi == "CVR", F.col("cvr_yoy")).when(kpi == "AOV", F.col("aov_yoy")).when(kpi == "CPC", F.col("cpc_yoy"))
    drv, lead = F.col("driver"), F.col("yoy_leader")
    x = x.withColumns({
        "recommended_actions": F.coalesce("recommended_actions", short_action(mode, drv)),
        "action_checklist": F.coalesce("action_checklist", short_checklist(mode, drv)),
        "why_selected_text": F.coalesce("why_selected_text", F.concat(F.col("contribution_label"), F.lit(" "), F.col("impact_contribution_text"), F.lit(" (filled in)"))),
        "summary_text": F.coalesce("summary_text", F.concat(F.col("PRODUCT"), F.lit(" | "), _figures("product_kpi."))),
        "reason_text": F.when(yoy(drv).isNull(), F.concat(drv, F.lit(": last year unknown")))
                        .when(drv == lead, F.concat(drv, F.lit(" "), fmt_pct(yoy(drv)), F.lit(", more than any other lever")))
                        .when(lead.isNotNull(), F.concat(drv, F.lit(" "), fmt_pct(yoy(drv)), F.lit("; "), lead, F.lit(" leads with "), fmt_pct(yoy(lead))))
                        .otherwise(F.concat(drv, F.lit(" "), fmt_pct(yoy(drv)))),
    })
    return x.withColumns({
        "what_text": F.concat(F.col("CHANNEL"), F.lit(": "), _figures("channel_kpi."), F.lit("; "), F.col("DIVISION"), F.lit(": "), _figures("division_kpi.")),
        "so_what_text": F.concat(F.col("PRODUCT"), F.lit(": "), F.col("contribution_label"), F.lit(" "), F.col("impact_contribution_text"), F.lit(", lever "), drv),
        "now_what_text": F.col("recommended_actions"),
    }).drop("primary_driver")


def report_cards(levels: DataFrame, reports: DataFrame, topics: DataFrame, headline: DataFrame) -> DataFrame:
    """One card per subsidiary: display mode, chosen topics with all they hold, KPI pack, summary line."""
    modes = reports.select("SUBSIDIARY", F.col("mode").alias("__rep_mode"))
    x = scope_metrics(levels, 1).join(modes, "SUBSIDIARY", "left").withColumn(
        "display_mode",
        F.when(F.col("__rep_mode").isin("ISSUE", "IMPROVE"), F.col("__rep_mode"))
        .when(F.col("revenue_delta") < 0, F.lit("ISSUE")).otherwise(F.lit("IMPROVE")),
    ).drop("__rep_mode")
    rest = [c for c in topics.columns if c not in ("pick_no", "diagnosis_subsidiary", "card_mode")]
    held = topics.groupBy(F.col("diagnosis_subsidiary").alias("SUBSIDIARY"), F.col("card_mode").alias("display_mode")).agg(
        F.collect_list(F.struct("pick_no", *rest)).alias("topics"))  # at most 3
    x = x.join(held, ["SUBSIDIARY", "display_mode"], "left").withColumn("topics", F.coalesce(F.array_sort("topics"), F.array()))
    # The division that drives the change in the card's own direction
    lead = headline.select(
        "SUBSIDIARY", F.when(F.col("headline_label") == "DECLINE_DRIVER", F.lit("ISSUE")).otherwise(F.lit("IMPROVE")).alias("display_mode"),
        "headline_division", "headline_pct")
    x = x.join(lead, ["SUBSIDIARY", "display_mode"], "left")
    first = F.try_element_at(F.col("topics"), F.lit(1))
    x = x.withColumns({"top_channel": first.getField("CHANNEL"), "top_driver": F.coalesce(first.getField("driver"), yoy_driver_cols(F.col("display_mode")))})
    what = F.concat(F.lit("Revenue "), fmt_money("revenue_curr"), F.lit(" ("), fmt_pct_yoy("revenue_yoy"), F.lit("), ROAS "),
                    fmt_roas("roas_curr"), F.lit(" ("), fmt_pct_yoy("roas_yoy"), F.lit(")"))
    so_what = F.when(F.col("headline_division").isNull(), F.lit("no division stands out")).otherwise(F.concat(
        F.when(F.col("display_mode") == "ISSUE", F.lit("falls with ")).otherwise(F.lit("rises with ")), F.concat_ws("/", "top_channel", "headline_division"),
        F.lit(" ("), fmt_pct("headline_pct", signed=False), F.lit(")")))
    return x.withColumn("summary_line", F.concat_ws(" | ", F.col("SUBSIDIARY"), what, so_what, short_next(F.col("display_mode"), F.col("top_driver"))))
