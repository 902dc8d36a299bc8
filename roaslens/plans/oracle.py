"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the DataFrame code, as plain SQL over the test
tables: windows where the Spark side aggregates and joins, CTE chains where
the Spark side cuts lineage.  Doubles are rounded to 9 decimals on both sides.
"""

from __future__ import annotations

from roaslens.operators.policy import rules_sql
from roaslens.schema import DIMENSIONS

CURR, PREV = 2000, 1999
R = 9  # rounding of doubles in outputs


def rnd(expr: str) -> str:
    # printf rounds the exact value; DuckDB's round() multiplies first and can be off by one ulp
    return f"CAST(printf('%.{R}f', {expr}) AS DOUBLE)"


def pos(x: str) -> str:
    return f"(CASE WHEN {x} > 0 THEN {x} END)"


def ratio(n: str, d: str) -> str:
    return f"({n} / {pos(d)})"


def pct(c: str, p: str) -> str:
    return f"(({c} - {pos(p)}) / {pos(p)})"


def lnr(c: str, p: str) -> str:
    return f"ln({pos(c)} / {pos(p)})"


def logmean(c: str, p: str) -> str:
    return (f"(CASE WHEN {pos(c)} IS NULL OR {pos(p)} IS NULL THEN NULL WHEN {c} = {p} THEN {c} "
            f"ELSE ({c} - {p}) / (CASE WHEN ln({pos(c)}) - ln({pos(p)}) <> 0 THEN ln({pos(c)}) - ln({pos(p)}) END) END)")


SUMS = ["Revenue_curr_sum", "Revenue_prev_sum", "Spend_curr_sum", "Spend_prev_sum",
        "Clicks_curr_sum", "Clicks_prev_sum", "Orders_curr_sum", "Orders_prev_sum"]
METRIC_OF = {s: s[:-4] for s in SUMS}


def dsum(x: str) -> str:
    # exact decimal sum; decimal -> text -> double gives the correctly rounded double
    return f"CAST(CAST(sum(CAST({x} AS DECIMAL(38,6))) AS VARCHAR) AS DOUBLE)"


def raw_cte() -> str:
    return """
raw AS (
  SELECT r.r_name AS SUBSIDIARY, o.o_orderpriority AS CHANNEL,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'MX' WHEN 'BUILDING' THEN 'VD' WHEN 'FURNITURE' THEN 'DA'
              ELSE c.c_mktsegment END AS DIVISION,
         p.p_type AS PRODUCT,
         l.l_extendedprice * l.l_discount AS PLATFORM_SPEND_USD,
         l.l_extendedprice * (1.0 - l.l_discount) AS GROSS_REVENUE,
         l.l_quantity AS PLATFORM_CLICKS, 1.0 AS GROSS_ORDERS,
         CASE WHEN l.l_returnflag <> 'R' THEN 'CONVERSION' ELSE 'AWARENESS' END AS OBJECTIVE,
         year(l.l_shipdate) AS Year, month(l.l_shipdate) AS Month, day(l.l_shipdate) AS Day
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
scoped AS (
  SELECT * FROM raw
  WHERE upper(trim(OBJECTIVE)) = 'CONVERSION' AND upper(trim(DIVISION)) IN ('MX', 'VD', 'DA')
),
long AS (
  SELECT coalesce(trim(SUBSIDIARY), 'UNKNOWN') AS SUBSIDIARY, coalesce(trim(CHANNEL), 'UNKNOWN') AS CHANNEL,
         coalesce(trim(DIVISION), 'UNKNOWN') AS DIVISION, coalesce(trim(PRODUCT), 'UNKNOWN') AS PRODUCT,
         CAST(Year AS BIGINT) AS Year, CAST(Month AS BIGINT) AS Month, CAST(Day AS BIGINT) AS Day,
         coalesce(CAST(PLATFORM_SPEND_USD AS DOUBLE), 0.0) AS Spend,
         coalesce(CAST(GROSS_REVENUE AS DOUBLE), 0.0) AS Revenue,
         coalesce(CAST(PLATFORM_CLICKS AS DOUBLE), 0.0) AS Clicks,
         coalesce(CAST(GROSS_ORDERS AS DOUBLE), 0.0) AS Orders
  FROM scoped
)"""


def engine_ctes(mtd: bool = False, curr: int = CURR, prev: int = PREV) -> str:
    if mtd:
        window = f"""
cut AS (
  SELECT max(Month) AS m FROM long WHERE Year = {curr}
),
cutd AS (
  SELECT (SELECT m FROM cut) AS m, (SELECT max(Day) FROM long WHERE Year = {curr} AND Month = (SELECT m FROM cut)) AS d
),
yr AS (
  SELECT l.* FROM long l, cutd
  WHERE l.Year IN ({curr}, {prev})
    AND (cutd.m IS NULL OR (l.Month = cutd.m AND (cutd.d IS NULL OR (l.Day >= 1 AND l.Day <= cutd.d))))
)"""
    else:
        window = f"""
yr AS (SELECT * FROM long WHERE Year IN ({curr}, {prev}))"""
    aggs = []
    for m in ("Spend", "Revenue", "Clicks", "Orders"):
        aggs.append(f"coalesce({dsum(f'CASE WHEN Year = {curr} THEN {m} END')}, 0.0) AS {m}_curr")
        aggs.append(f"coalesce({dsum(f'CASE WHEN Year = {prev} THEN {m} END')}, 0.0) AS {m}_prev")
    lvl_aggs = ", ".join(f"{dsum(METRIC_OF[s])} AS {s}" for s in SUMS)
    return f"""WITH {raw_cte()},{window},
engine AS MATERIALIZED (
  SELECT * FROM (
    SELECT SUBSIDIARY, CHANNEL, DIVISION, PRODUCT, {', '.join(aggs)}
    FROM yr GROUP BY SUBSIDIARY, CHANNEL, DIVISION, PRODUCT
  ) WHERE Spend_curr > 0
),
levels AS MATERIALIZED (
  SELECT CASE grouping(SUBSIDIARY, CHANNEL, DIVISION, PRODUCT) WHEN 0 THEN 4 WHEN 1 THEN 3 WHEN 3 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS level,
         SUBSIDIARY, CHANNEL, DIVISION, PRODUCT, {lvl_aggs}
  FROM engine GROUP BY ROLLUP (SUBSIDIARY, CHANNEL, DIVISION, PRODUCT)
)"""


def _cd(level: int) -> list[str]:
    return DIMENSIONS[:level]


def impact_cte(name: str, level: int, parent_filter: str | None = None) -> str:
    """Child impacts of every parent at ``level`` (windows over the parent key)."""
    cd, pd = _cd(level), _cd(level - 1)
    part = f"PARTITION BY {', '.join('x.' + d for d in pd)}" if pd else ""
    part2 = f"PARTITION BY {', '.join(pd)}" if pd else ""
    jcond = " AND ".join(f"c.{d} = p.{d}" for d in pd) or "TRUE"
    missing = ", ".join(f"CAST(NULL AS VARCHAR) AS {d}" for d in DIMENSIONS if d not in cd)
    missing = (", " + missing) if missing else ""
    pf = f" AND ({parent_filter})" if parent_filter else ""
    cc, cp = "x.cc", "x.cp"
    valid = (f"({cc} > 0 AND {cp} > 0 AND x.prc > 0 AND x.prp > 0 AND {logmean(cc, cp)} IS NOT NULL "
             f"AND {logmean('x.prc', 'x.prp')} IS NOT NULL AND {lnr('x.prc', 'x.prp')} IS NOT NULL)")
    raw = (f"CASE WHEN {valid} THEN ({logmean(cc, cp)} / {logmean('x.prc', 'x.prp')}) * {lnr('x.prc', 'x.prp')} * x.parent_delta "
           f"ELSE {cc} - {cp} END")
    return f"""
{name}_x AS (
  SELECT {', '.join('c.' + d for d in cd)}, {', '.join('c.' + s for s in SUMS)},
         {ratio('p.Revenue_curr_sum', 'p.Spend_curr_sum')} AS prc,
         {ratio('p.Revenue_prev_sum', 'p.Spend_prev_sum')} AS prp,
         coalesce({ratio('p.Revenue_curr_sum', 'p.Spend_curr_sum')}, 0.0) - coalesce({ratio('p.Revenue_prev_sum', 'p.Spend_prev_sum')}, 0.0) AS parent_delta,
         {ratio('c.Revenue_curr_sum', 'p.Spend_curr_sum')} AS cc,
         {ratio('c.Revenue_prev_sum', 'p.Spend_prev_sum')} AS cp
  FROM levels c JOIN levels p ON {jcond} AND p.level = {level - 1}
  WHERE c.level = {level}{pf}
),
{name}_r AS (
  SELECT x.*, {raw} AS Impact_raw FROM {name}_x x
),
{name}_a AS (
  SELECT r.*,
         r.parent_delta - coalesce(sum(r.Impact_raw) OVER ({part.replace('x.', 'r.')}), 0.0) AS Residual_parent,
         coalesce(sum(abs(r.Impact_raw)) OVER ({part.replace('x.', 'r.')}), 0.0) AS sabs,
         count(*) OVER ({part.replace('x.', 'r.')}) AS n
  FROM {name}_r r
),
{name}_b AS (
  SELECT a.*, CASE WHEN a.sabs > 0 THEN (abs(a.Impact_raw) / a.sabs) * a.Residual_parent ELSE a.Residual_parent / a.n END AS alloc
  FROM {name}_a a
),
{name}_c AS (
  SELECT b.*, b.Impact_raw + b.alloc AS Impact_adj, abs(b.alloc) > 1e-12 AS Residual_applied_flag FROM {name}_b b
),
{name} AS (
  SELECT {', '.join(cd)}{missing}, {', '.join(SUMS)}, Impact_raw, Impact_adj,
         CASE WHEN coalesce(sum(abs(Impact_adj)) OVER ({part2}), 0.0) > 0 THEN abs(Impact_adj) / sum(abs(Impact_adj)) OVER ({part2}) ELSE 0.0 END AS Share_childsum,
         CASE WHEN abs(parent_delta) > 0 THEN abs(Impact_adj) / abs(parent_delta) ELSE 0.0 END AS Share_parentdelta,
         Residual_parent, Residual_applied_flag, parent_delta, prp AS parent_roas_prev, prc AS parent_roas_curr
  FROM {name}_c
)"""


def select_cte(name: str, imp: str, level: int) -> str:
    """Rule per parent and selected children with their rank."""
    cd, pd = _cd(level), _cd(level - 1)
    new = cd[-1]
    part = f"PARTITION BY {', '.join(pd)}" if pd else ""
    pj = " AND ".join(f"t.{d} = u.{d}" for d in pd) or "TRUE"
    grp = f"GROUP BY {', '.join(pd)}" if pd else ""
    return f"""
{name}_w AS (
  SELECT i.*,
         row_number() OVER ({part} ORDER BY Share_childsum DESC, {new} ASC) AS rn_s,
         CASE WHEN Impact_adj < 0 THEN row_number() OVER ({part}{',' if pd else 'PARTITION BY'} (Impact_adj < 0) ORDER BY Impact_adj ASC, {new} ASC) END AS rn_n,
         CASE WHEN Impact_adj > 0 THEN row_number() OVER ({part}{',' if pd else 'PARTITION BY'} (Impact_adj > 0) ORDER BY Impact_adj DESC, {new} ASC) END AS rn_p
  FROM {imp} i
),
{name}_p AS (
  SELECT {', '.join(pd) + ',' if pd else ''}
         coalesce(max(CASE WHEN rn_s = 1 THEN Share_childsum END), 0.0) AS top1_share,
         coalesce(max(CASE WHEN rn_s = 2 THEN Share_childsum END), 0.0) AS top2_share,
         coalesce(max(CASE WHEN rn_s = 1 THEN abs(Impact_adj) END), 0.0) AS top1_abs,
         max(parent_delta) AS parent_delta,
         greatest(0.0, abs(coalesce(max(parent_roas_prev), 0.0)) * 0.01) AS impact_floor
  FROM {name}_w {grp}
),
{name}_rule AS MATERIALIZED (
  SELECT u.*, CASE WHEN top1_share >= 0.45 AND top1_share - top2_share >= 0.15 AND top1_abs >= impact_floor THEN 'SINGLE'
                   WHEN parent_delta < 0 THEN 'WIDE_NEG' WHEN parent_delta > 0 THEN 'WIDE_POS' ELSE 'STOP_ZERO_DELTA' END AS rule
  FROM {name}_p u
),
{name} AS MATERIALIZED (
  SELECT t.*, u.rule, u.top1_share, u.top2_share, u.impact_floor,
         CASE u.rule WHEN 'SINGLE' THEN t.rn_s WHEN 'WIDE_NEG' THEN t.rn_n ELSE t.rn_p END AS sel_rank
  FROM {name}_w t JOIN {name}_rule u ON {pj}
  WHERE (u.rule = 'SINGLE' AND t.rn_s = 1) OR (u.rule = 'WIDE_NEG' AND t.rn_n <= 3) OR (u.rule = 'WIDE_POS' AND t.rn_p <= 3)
)"""


def drill_ctes(mtd: bool = False) -> str:
    """Per-subsidiary drill LEVEL2 -> LEVEL4 over all subsidiaries."""
    return engine_ctes(mtd) + "," + ",".join([
        impact_cte("imp2", 2),
        select_cte("sel2", "imp2", 2),
        impact_cte("imp3", 3, "EXISTS (SELECT 1 FROM sel2 s WHERE s.SUBSIDIARY = c.SUBSIDIARY AND s.CHANNEL = c.CHANNEL)"),
        select_cte("sel3", "imp3", 3),
        impact_cte("imp4", 4, "EXISTS (SELECT 1 FROM sel3 s WHERE s.SUBSIDIARY = c.SUBSIDIARY AND s.CHANNEL = c.CHANNEL AND s.DIVISION = c.DIVISION)"),
        select_cte("sel4", "imp4", 4),
    ]) + f""",
leaves AS MATERIALIZED (
  SELECT l.SUBSIDIARY, l.CHANNEL, l.DIVISION, l.PRODUCT, {', '.join('l.' + s for s in SUMS)},
         l.Impact_raw, l.Impact_adj, l.Share_childsum, l.Share_parentdelta, l.Residual_parent, l.Residual_applied_flag,
         s2.sel_rank AS rank2, s3.sel_rank AS rank3, l.sel_rank AS rank4,
         'LEVEL2:' || s2.rule || ':' || s2.SUBSIDIARY || '/' || s2.CHANNEL || ' -> LEVEL3:' || s3.rule || ':' || s3.SUBSIDIARY || '/' || s3.CHANNEL || '/' || s3.DIVISION
           || ' -> LEVEL4:' || l.rule || ':' || l.SUBSIDIARY || '/' || l.CHANNEL || '/' || l.DIVISION || '/' || l.PRODUCT AS drill_trace_text,
         s2.Impact_adj AS ch_adj, s3.Impact_adj AS div_adj
  FROM sel4 l
  JOIN sel3 s3 ON l.SUBSIDIARY = s3.SUBSIDIARY AND l.CHANNEL = s3.CHANNEL AND l.DIVISION = s3.DIVISION
  JOIN sel2 s2 ON l.SUBSIDIARY = s2.SUBSIDIARY AND l.CHANNEL = s2.CHANNEL
),
cands AS MATERIALIZED (
  SELECT l.*, {pct('Revenue_curr_sum', 'Revenue_prev_sum')} AS rev_yoy_pct, {pct('Spend_curr_sum', 'Spend_prev_sum')} AS spend_yoy_pct,
         {ratio('Revenue_curr_sum', 'Spend_curr_sum')} AS roas_curr, {ratio('Revenue_prev_sum', 'Spend_prev_sum')} AS roas_prev,
         {pct(ratio('Revenue_curr_sum', 'Spend_curr_sum'), ratio('Revenue_prev_sum', 'Spend_prev_sum'))} AS roas_yoy_pct,
         {pct('Revenue_curr_sum', 'Revenue_prev_sum')} - {pct('Spend_curr_sum', 'Spend_prev_sum')} AS defense_score_pct
  FROM leaves l
),
scope AS (
  SELECT SUBSIDIARY,
         coalesce(({pct('Revenue_curr_sum', 'Revenue_prev_sum')} - {pct('Spend_curr_sum', 'Spend_prev_sum')}) > 0
                  AND {pct(ratio('Revenue_curr_sum', 'Spend_curr_sum'), ratio('Revenue_prev_sum', 'Spend_prev_sum'))} > 0
                  AND {pct('Revenue_curr_sum', 'Revenue_prev_sum')} > -0.3, FALSE) AS scope_defense_eligible
  FROM levels WHERE level = 1
),
issues_sel AS MATERIALIZED (
  SELECT * FROM (
    SELECT c.*, 'ISSUE' AS mode_tag,
           row_number() OVER (PARTITION BY SUBSIDIARY ORDER BY Impact_adj ASC, CHANNEL, DIVISION, PRODUCT) AS mode_rank
    FROM cands c WHERE Impact_adj < 0
  ) WHERE mode_rank <= 3
),
impr_c AS (
  SELECT c.*, CASE WHEN coalesce(c.Impact_adj, 0.0) > 0 THEN 0
                   WHEN coalesce(s.scope_defense_eligible, FALSE) AND coalesce(c.defense_score_pct > 0 AND c.roas_yoy_pct > 0 AND c.rev_yoy_pct > -0.3, FALSE) THEN 1 END AS cls
  FROM cands c LEFT JOIN scope s ON c.SUBSIDIARY = s.SUBSIDIARY
),
impr_sel AS MATERIALIZED (
  SELECT * EXCLUDE (cls) FROM (
    SELECT c.*, CASE cls WHEN 0 THEN 'IMPROVE' ELSE 'DEFENSE' END AS mode_tag,
           row_number() OVER (PARTITION BY SUBSIDIARY ORDER BY cls,
               CASE WHEN cls = 0 THEN -coalesce(Impact_adj, 0.0) ELSE -coalesce(defense_score_pct, -1e9) END,
               -coalesce(Impact_adj, 0.0), CHANNEL, DIVISION, PRODUCT) AS mode_rank
    FROM impr_c c WHERE cls IS NOT NULL
  ) WHERE mode_rank <= 3
)"""


def rca_select(src: str, mode: str) -> str:
    """R1-R5 columns over a relation with the 8 sums."""
    cvr, aov, cpc = "dlog_CVR", "dlog_AOV", "dlog_CPC"
    if mode == "ISSUE":
        v = "total_dlog_roas < 0"
        sc, sa, sp = f"CASE WHEN {v} AND {cvr} < 0 THEN abs({cvr}) ELSE 0.0 END", f"CASE WHEN {v} AND {aov} < 0 THEN abs({aov}) ELSE 0.0 END", f"CASE WHEN {v} AND {cpc} > 0 THEN abs({cpc}) ELSE 0.0 END"
    else:
        v = "total_dlog_roas > 0"
        sc, sa, sp = f"CASE WHEN {v} AND {cvr} > 0 THEN abs({cvr}) ELSE 0.0 END", f"CASE WHEN {v} AND {aov} > 0 THEN abs({aov}) ELSE 0.0 END", f"CASE WHEN {v} AND {cpc} < 0 THEN abs({cpc}) ELSE 0.0 END"
    return f"""(
  SELECT *, CASE WHEN tag IN ('LOW_VOL', 'NEW', 'GONE', 'UNDEFINED') OR NOT coalesce({v}, FALSE) THEN 'NONE'
                 WHEN sc >= sa AND sc >= sp AND sc > 0 THEN 'CVR' WHEN sa >= sp AND sa > 0 THEN 'AOV' WHEN sp > 0 THEN 'CPC' ELSE 'NONE' END AS rca_primary_driver
  FROM (
    SELECT *, {sc} AS sc, {sa} AS sa, {sp} AS sp,
           CASE WHEN Clicks_curr_sum < 100 OR Orders_curr_sum < 5 THEN 'LOW_VOL'
                WHEN Revenue_prev_sum = 0 AND Revenue_curr_sum > 0 THEN 'NEW'
                WHEN Revenue_prev_sum > 0 AND Revenue_curr_sum = 0 THEN 'GONE'
                WHEN total_dlog_roas IS NULL THEN 'UNDEFINED' ELSE 'NORMAL' END AS tag
    FROM (
      SELECT *, dlog_CVR + dlog_AOV - dlog_CPC AS total_dlog_roas FROM (
        SELECT *, {lnr('CVR_curr', 'CVR_prev')} AS dlog_CVR, {lnr('AOV_curr', 'AOV_prev')} AS dlog_AOV, {lnr('CPC_curr', 'CPC_prev')} AS dlog_CPC
        FROM (
          SELECT *, {ratio('Spend_curr_sum', 'Clicks_curr_sum')} AS CPC_curr, {ratio('Spend_prev_sum', 'Clicks_prev_sum')} AS CPC_prev,
                 {ratio('Orders_curr_sum', 'Clicks_curr_sum')} AS CVR_curr, {ratio('Orders_prev_sum', 'Clicks_prev_sum')} AS CVR_prev,
                 {ratio('Revenue_curr_sum', 'Orders_curr_sum')} AS AOV_curr, {ratio('Revenue_prev_sum', 'Orders_prev_sum')} AS AOV_prev,
                 {ratio('Revenue_curr_sum', 'Spend_curr_sum')} AS ROAS_curr, {ratio('Revenue_prev_sum', 'Spend_prev_sum')} AS ROAS_prev
          FROM {src}
        )
      )
    )
  )
)"""


def _argmax(c: str, a: str, p: str) -> str:
    return f"CASE WHEN {c} >= {p} AND {c} >= {a} THEN 'CVR' WHEN {p} >= {a} THEN 'CPC' ELSE 'AOV' END"


def confirmed_sql() -> str:
    iss = "upper(coalesce(mode_tag, '')) = 'ISSUE'"
    sc = f"coalesce(CASE WHEN {iss} THEN CASE WHEN dlog_CVR < 0 THEN abs(dlog_CVR) END ELSE CASE WHEN dlog_CVR > 0 THEN abs(dlog_CVR) END END, 0.0)"
    sa = f"coalesce(CASE WHEN {iss} THEN CASE WHEN dlog_AOV < 0 THEN abs(dlog_AOV) END ELSE CASE WHEN dlog_AOV > 0 THEN abs(dlog_AOV) END END, 0.0)"
    sp = f"coalesce(CASE WHEN {iss} THEN CASE WHEN dlog_CPC > 0 THEN abs(dlog_CPC) END ELSE CASE WHEN dlog_CPC < 0 THEN abs(dlog_CPC) END END, 0.0)"
    fc, fa, fp = "coalesce(abs(dlog_CVR), 0.0)", "coalesce(abs(dlog_AOV), 0.0)", "coalesce(abs(dlog_CPC), 0.0)"
    return (f"CASE WHEN greatest({sc}, {sa}, {sp}) > 0 THEN {_argmax(sc, sa, sp)} "
            f"WHEN greatest({fc}, {fa}, {fp}) > 0 THEN {_argmax(fc, fa, fp)} ELSE 'CPC' END")


def ctype_sql(col: str = "CHANNEL") -> str:
    t = f"upper(trim(coalesce({col}, '')))"
    return f"CASE WHEN {t} LIKE '%PMAX%' OR {t} LIKE '%PERFORMANCE MAX%' THEN 'PMAX' WHEN {t} LIKE '%SEARCH%' THEN 'SEARCH' ELSE 'OTHER' END"


def enriched_ctes(mtd: bool = False) -> str:
    """Issues / improvements with RCA (J6), confirmed driver (R8) and actions."""
    base = drill_ctes(mtd)

    def enrich(name: str, src: str, mode: str) -> str:
        rca = rca_select(f"(SELECT * EXCLUDE (roas_curr, roas_prev) FROM {src})", mode)
        act = lambda kind, field: rules_sql(kind, field, "upper(coalesce(tag, 'NORMAL'))", "upper(coalesce(mode_tag, ''))",
                                            "upper(coalesce(primary_driver, 'CPC'))", ctype_sql())
        return f"""
{name}_r AS (SELECT * EXCLUDE (sc, sa, sp) FROM {rca}),
{name}_d AS (SELECT *, {confirmed_sql()} AS primary_driver FROM {name}_r),
{name} AS MATERIALIZED (
  SELECT *, SUBSIDIARY AS diagnosis_subsidiary, 'MANUAL' AS campaign_diagnosis_mode,
         {act('action', 'code')} AS action_code, {act('action', 'text')} AS recommended_actions,
         {act('check', 'code')} AS checklist_code, {act('check', 'text')} AS action_checklist
  FROM {name}_d
)"""
    return base + "," + enrich("issues", "issues_sel", "ISSUE") + "," + enrich("impr", "impr_sel", "IMPROVE")


def topics_ctes(mtd: bool = False) -> str:
    """Report rows (D18, D19, R19, W5) for issues and improvements, then the diverse top 3."""
    base = enriched_ctes(mtd)

    def topics(name: str, src: str) -> str:
        mode = "upper(coalesce(t.mode_tag, ''))"

        def dcp(child: str, parent: str) -> str:
            return (f"(CASE WHEN abs({parent}) IS NULL OR abs({parent}) <= 0 THEN NULL WHEN {mode} = 'ISSUE' THEN greatest(0.0, -({child})) / abs({parent}) "
                    f"WHEN {mode} IN ('IMPROVE', 'DEFENSE') THEN greatest(0.0, {child}) / abs({parent}) ELSE abs({child}) / abs({parent}) END)")
        drv = "CASE WHEN upper(coalesce(t.primary_driver, 'CPC')) IN ('AOV', 'CVR') THEN upper(t.primary_driver) ELSE 'CPC' END"
        return f"""
{name}_j AS (
  SELECT t.*,
         coalesce(t.ROAS_curr, {ratio('t.Revenue_curr_sum', 't.Spend_curr_sum')}) AS topic_roas_curr,
         coalesce(t.ROAS_prev, {ratio('t.Revenue_prev_sum', 't.Spend_prev_sum')}) AS topic_roas_prev,
         {ratio('dv.Revenue_curr_sum', 'dv.Spend_curr_sum')} - {ratio('dv.Revenue_prev_sum', 'dv.Spend_prev_sum')} AS division_roas_delta,
         coalesce({ratio('ch.Revenue_curr_sum', 'ch.Spend_curr_sum')} - {ratio('ch.Revenue_prev_sum', 'ch.Spend_prev_sum')}, 0.0) AS channel_roas_delta,
         coalesce({ratio('sb.Revenue_curr_sum', 'sb.Spend_curr_sum')} - {ratio('sb.Revenue_prev_sum', 'sb.Spend_prev_sum')}, 0.0) AS subsidiary_roas_delta,
         {drv} AS evidence_driver,
         CASE {drv} WHEN 'AOV' THEN {ratio('dv.Revenue_curr_sum', 'dv.Orders_curr_sum')} WHEN 'CVR' THEN {ratio('dv.Orders_curr_sum', 'dv.Clicks_curr_sum')} ELSE {ratio('dv.Spend_curr_sum', 'dv.Clicks_curr_sum')} END AS division_driver_curr,
         CASE {drv} WHEN 'AOV' THEN {ratio('dv.Revenue_prev_sum', 'dv.Orders_prev_sum')} WHEN 'CVR' THEN {ratio('dv.Orders_prev_sum', 'dv.Clicks_prev_sum')} ELSE {ratio('dv.Spend_prev_sum', 'dv.Clicks_prev_sum')} END AS division_driver_prev,
         CASE {drv} WHEN 'AOV' THEN t.AOV_curr WHEN 'CVR' THEN t.CVR_curr ELSE t.CPC_curr END AS driver_curr,
         CASE {drv} WHEN 'AOV' THEN t.AOV_prev WHEN 'CVR' THEN t.CVR_prev ELSE t.CPC_prev END AS driver_prev
  FROM {src} t
  LEFT JOIN levels sb ON sb.level = 1 AND sb.SUBSIDIARY = t.SUBSIDIARY
  LEFT JOIN levels ch ON ch.level = 2 AND ch.SUBSIDIARY = t.SUBSIDIARY AND ch.CHANNEL = t.CHANNEL
  LEFT JOIN levels dv ON dv.level = 3 AND dv.SUBSIDIARY = t.SUBSIDIARY AND dv.CHANNEL = t.CHANNEL AND dv.DIVISION = t.DIVISION
),
{name}_k AS (
  SELECT t.*, t.topic_roas_curr - t.topic_roas_prev AS topic_roas_delta FROM {name}_j t
),
{name} AS MATERIALIZED (
  SELECT t.*,
         CASE WHEN t.topic_roas_delta IS NOT NULL AND t.division_roas_delta IS NOT NULL AND abs(t.division_roas_delta) > 0
              THEN {dcp('t.topic_roas_delta', 't.division_roas_delta')}
              ELSE coalesce({dcp('coalesce(t.Impact_adj, 0.0)', 'coalesce(t.division_roas_delta, 0.0)')},
                            {dcp('coalesce(t.Impact_adj, 0.0)', 't.channel_roas_delta')}) END AS impact_contribution_pct,
         {dcp('coalesce(t.ch_adj, 0.0)', 't.subsidiary_roas_delta')} AS channel_direct_pct,
         {dcp('coalesce(t.div_adj, 0.0)', 't.channel_roas_delta')} AS division_direct_pct,
         coalesce({dcp('coalesce(t.Impact_adj, 0.0)', 'coalesce(t.division_roas_delta, 0.0)')},
                  CASE WHEN t.topic_roas_delta IS NOT NULL AND t.division_roas_delta IS NOT NULL AND abs(t.division_roas_delta) > 0
                       THEN {dcp('t.topic_roas_delta', 't.division_roas_delta')}
                       ELSE {dcp('coalesce(t.Impact_adj, 0.0)', 'coalesce(t.division_roas_delta, 0.0)')} END) AS product_direct_pct,
         row_number() OVER (PARTITION BY t.diagnosis_subsidiary, t.CHANNEL, t.DIVISION, t.mode_tag
                            ORDER BY CASE WHEN {mode} = 'ISSUE' THEN coalesce(t.topic_roas_delta, 0.0) ELSE -coalesce(t.topic_roas_delta, 0.0) END, t.PRODUCT) AS selection_rank,
         count(*) OVER (PARTITION BY t.diagnosis_subsidiary, t.CHANNEL, t.DIVISION, t.mode_tag) AS selection_pool_size,
         {pct('t.driver_curr', 't.driver_prev')} AS driver_yoy,
         {pct('t.division_driver_curr', 't.division_driver_prev')} AS division_driver_yoy,
         {pct('t.driver_curr', 't.driver_prev')} - {pct('t.division_driver_curr', 't.division_driver_prev')} AS driver_gap_pp,
         greatest(abs(coalesce(t.dlog_CVR, 0.0)), abs(coalesce(t.dlog_AOV, 0.0)), abs(coalesce(t.dlog_CPC, 0.0))) AS signal_max_abs
  FROM {name}_k t
)"""

    def pick(name: str, src: str) -> str:
        basis = " OR ".join(f"({k}_curr IS NOT NULL AND {k}_prev IS NOT NULL AND {k}_prev > 0)" for k in ("CVR", "AOV", "CPC"))
        return diverse_pick_sql(name, f"""
  SELECT t.*, row_number() OVER (PARTITION BY diagnosis_subsidiary
           ORDER BY coalesce(abs(topic_roas_delta), impact_contribution_pct, 0.0) DESC, CHANNEL, DIVISION, PRODUCT) AS metric_rank
  FROM {src} t
  WHERE ({basis}) OR (topic_roas_delta IS NOT NULL AND abs(topic_roas_delta) >= 0.03)""", ["diagnosis_subsidiary"])

    return base + "," + topics("itop", "issues") + "," + topics("mtop", "impr") + "," + pick("ipick", "itop") + "," + pick("mpick", "mtop")


def diverse_pick_sql(name: str, base_sql: str, keys: list[str]) -> str:
    """W11 in SQL: three rounds of 'least (stage, metric_rank)' per key against the picks so far."""
    kj = " AND ".join(f"st.{k} = b.{k}" for k in keys)
    kp = ", ".join(keys)
    if True:
        out = [f"""
{name}_base AS MATERIALIZED ({base_sql}
)"""]
        prev = None
        for r in (1, 2, 3):
            if prev is None:
                src_sql = f"SELECT b.*, 0 AS stage FROM {name}_base b"
            else:
                st = (f"SELECT {kp}, list(CHANNEL) AS chs, list(DIVISION) AS dvs, list(CHANNEL || chr(1) || DIVISION) AS prs, "
                      f"list(CHANNEL || chr(1) || DIVISION || chr(1) || PRODUCT) AS trs, list(metric_rank) AS rks FROM {prev} GROUP BY {kp}")
                new_ch = "NOT coalesce(list_contains(st.chs, b.CHANNEL), FALSE)"
                new_dv = "NOT coalesce(list_contains(st.dvs, b.DIVISION), FALSE)"
                new_pr = "NOT coalesce(list_contains(st.prs, b.CHANNEL || chr(1) || b.DIVISION), FALSE)"
                dup = ("(coalesce(list_contains(st.trs, b.CHANNEL || chr(1) || b.DIVISION || chr(1) || b.PRODUCT), FALSE) "
                       "OR coalesce(list_contains(st.rks, b.metric_rank), FALSE))")
                stage = (f"CASE WHEN {new_pr} AND {new_ch} AND {new_dv} THEN 0 WHEN {new_pr} AND ({new_ch} OR {new_dv}) THEN 1 "
                         f"WHEN {new_pr} THEN 2 ELSE 3 END")
                src_sql = (f"SELECT b.*, {stage} AS stage FROM {name}_base b LEFT JOIN ({st}) st "
                           f"ON {kj} WHERE NOT {dup}")
            out.append(f"""
{name}_s{r} AS (
  SELECT * FROM ({src_sql}) QUALIFY row_number() OVER (PARTITION BY {kp} ORDER BY stage, metric_rank) = 1
),
{name}_p{r} AS MATERIALIZED (
  SELECT * EXCLUDE (stage), {r} AS pick_no FROM {name}_s{r} {'' if prev is None else f'UNION ALL SELECT * FROM {prev}'}
)""")
            prev = f"{name}_p{r}"
        out.append(f"""
{name} AS (SELECT * FROM {prev})""")
        return ",".join(out)


def _argmax_yoy(mode: str) -> str:
    iss = f"{mode} = 'ISSUE'"
    cv, av, cp = "coalesce(cvr_yoy, 0.0)", "coalesce(aov_yoy, 0.0)", "coalesce(cpc_yoy, 0.0)"
    sc = f"greatest(0.0, CASE WHEN {iss} THEN -{cv} ELSE {cv} END)"
    sa = f"greatest(0.0, CASE WHEN {iss} THEN -{av} ELSE {av} END)"
    sp = f"greatest(0.0, CASE WHEN {iss} THEN {cp} ELSE -{cp} END)"
    return (f"CASE WHEN greatest({sc}, {sa}, {sp}) > 0 THEN {_argmax(sc, sa, sp)} "
            f"ELSE {_argmax(f'abs({cv})', f'abs({av})', f'abs({cp})')} END")


def display_ctes() -> str:
    """W12-W16 and the report cards."""
    basis = " OR ".join(f"({k}_curr IS NOT NULL AND {k}_prev IS NOT NULL AND {k}_prev > 0)" for k in ("CVR", "AOV", "CPC"))
    gate = f"(({basis}) OR (impact_contribution_pct IS NOT NULL AND impact_contribution_pct >= 0.03))"
    fb = f"""
fbm AS (
  SELECT SUBSIDIARY, CHANNEL, DIVISION, PRODUCT, m.mode_tag,
         Revenue_curr_sum - Revenue_prev_sum AS revenue_delta,
         {ratio('Spend_curr_sum', 'Clicks_curr_sum')} AS CPC_curr, {ratio('Spend_prev_sum', 'Clicks_prev_sum')} AS CPC_prev,
         {ratio('Orders_curr_sum', 'Clicks_curr_sum')} AS CVR_curr, {ratio('Orders_prev_sum', 'Clicks_prev_sum')} AS CVR_prev,
         {ratio('Revenue_curr_sum', 'Orders_curr_sum')} AS AOV_curr, {ratio('Revenue_prev_sum', 'Orders_prev_sum')} AS AOV_prev
  FROM levels, (VALUES ('ISSUE'), ('IMPROVE')) m(mode_tag) WHERE level = 4
),
fbp AS (
  SELECT *, CASE WHEN mode_tag = 'ISSUE' THEN revenue_delta < 0 ELSE revenue_delta > 0 END AS is_primary,
         {pct('CVR_curr', 'CVR_prev')} AS cvr_yoy, {pct('AOV_curr', 'AOV_prev')} AS aov_yoy, {pct('CPC_curr', 'CPC_prev')} AS cpc_yoy
  FROM fbm
),
fallback AS MATERIALIZED (
  SELECT *, SUBSIDIARY AS diagnosis_subsidiary,
         CASE WHEN den > 0 THEN abs(revenue_delta) / den END AS impact_contribution_pct,
         CASE WHEN mode_tag = 'ISSUE' THEN CASE WHEN revenue_delta < 0 THEN 'part of the fall' ELSE 'counterweight' END
              ELSE CASE WHEN revenue_delta > 0 THEN 'part of the rise' ELSE 'drag' END END AS contribution_label,
         {_argmax_yoy('mode_tag')} AS primary_driver
  FROM (SELECT *, sum(CASE WHEN is_primary THEN abs(revenue_delta) END) OVER (PARTITION BY SUBSIDIARY, mode_tag) AS den FROM fbp)
),
exist AS (
  SELECT diagnosis_subsidiary, CHANNEL, DIVISION, PRODUCT, 'ISSUE' AS card_mode, impact_contribution_pct, primary_driver,
         'selected' AS source, 0 AS src, FALSE AS sec, CAST(pick_no AS DOUBLE) AS k, '' AS c, '' AS d, '' AS p
  FROM ipick WHERE {gate}
  UNION ALL
  SELECT diagnosis_subsidiary, CHANNEL, DIVISION, PRODUCT, 'IMPROVE', impact_contribution_pct, primary_driver,
         'selected', 0, FALSE, CAST(pick_no AS DOUBLE), '', '', ''
  FROM mpick WHERE {gate}
),
fbsel AS (
  SELECT diagnosis_subsidiary, CHANNEL, DIVISION, PRODUCT, mode_tag AS card_mode, impact_contribution_pct, primary_driver,
         'fallback' AS source, 1 AS src, NOT is_primary AS sec, -abs(revenue_delta) AS k, CHANNEL AS c, DIVISION AS d, PRODUCT AS p
  FROM fallback WHERE {gate}
),
mcand AS (
  SELECT * FROM (SELECT * FROM exist UNION ALL SELECT * FROM fbsel)
  QUALIFY row_number() OVER (PARTITION BY diagnosis_subsidiary, card_mode, CHANNEL, DIVISION, PRODUCT ORDER BY src, sec, k, c, d, p) = 1
)"""
    merged = diverse_pick_sql("merged", """
  SELECT t.*, row_number() OVER (PARTITION BY diagnosis_subsidiary, card_mode ORDER BY src, sec, k, c, d, p) AS metric_rank
  FROM mcand t""", ["diagnosis_subsidiary", "card_mode"])
    return topics_ctes() + "," + fb + "," + merged


# ------------------------------------------------------------------ text sources, focuses

def text_ctes() -> str:
    """The rows of the exported text table, from the test tables: what is no number is null, and counted."""
    cents = lambda x: f"floor({x} * 100) / 100"
    base = raw_cte().split("),\nscoped")[0].replace("l.l_extendedprice * l.l_discount AS", f"{cents('(l.l_extendedprice * l.l_discount)')} AS").replace(
        "l.l_extendedprice * (1.0 - l.l_discount) AS", f"{cents('(l.l_extendedprice * (1.0 - l.l_discount))')} AS").replace("SELECT r.r_name", "SELECT l.l_orderkey, r.r_name")
    return base + """),
scoped AS (SELECT * FROM raw WHERE OBJECTIVE = 'CONVERSION' AND DIVISION IN ('MX', 'VD', 'DA')),
long AS (
  SELECT SUBSIDIARY, CHANNEL, lower(DIVISION) AS DIVISION, CASE WHEN l_orderkey % 61 = 0 THEN 'UNKNOWN' ELSE PRODUCT END AS PRODUCT, Year, Month, Day,
         CASE WHEN l_orderkey % 257 = 0 OR l_orderkey % 61 = 0 THEN 0.0 ELSE PLATFORM_SPEND_USD END AS Spend, GROSS_REVENUE AS Revenue,
         CASE WHEN l_orderkey % 353 = 0 THEN 0.0 ELSE floor(PLATFORM_CLICKS) END AS Clicks, CASE WHEN l_orderkey % 419 = 0 THEN 0.0 ELSE 1.0 END AS Orders
  FROM scoped
)"""


def text_queries(full, mtd) -> dict[str, str]:
    frame = lambda m: engine_ctes(m).replace("WITH " + raw_cte(), "WITH " + text_ctes())
    cols = ", ".join([*DIMENSIONS, *[f"{m}_{y}" for m in ("Spend", "Revenue", "Clicks", "Orders") for y in ("curr", "prev")]])
    wide = ", ".join([*[f"floor({m}_{y}) AS {m}_{y}" for m, y in [(m, y) for m in ("Spend", "Revenue", "Clicks", "Orders") for y in ("curr", "prev")] if (m, y) != ("Clicks", "prev")],
                      "CASE WHEN Spend_curr % 7 < 1 THEN 0.0 ELSE floor(Clicks_prev) END AS Clicks_prev"])
    return {
        "text_source_frame": frame(False) + f" SELECT {cols} FROM engine",
        "text_source_frame_mtd": frame(True) + f" SELECT {cols} FROM engine",
        "text_source_facts": "WITH " + text_ctes() + f""",
c AS (SELECT max(Month) AS m FROM long WHERE Year = {mtd.curr_year})
SELECT (SELECT count(*) FROM raw) AS objective_rows_before, (SELECT count(*) FROM raw WHERE OBJECTIVE = 'CONVERSION') AS objective_rows_after,
       (SELECT count(*) FROM raw WHERE OBJECTIVE = 'CONVERSION') AS division_rows_before, count(*) AS division_rows_after,
       count(*) FILTER (WHERE l_orderkey % 257 = 0) AS PLATFORM_SPEND_USD_errors, 0::BIGINT AS GROSS_REVENUE_errors,
       count(*) FILTER (WHERE l_orderkey % 353 = 0) AS PLATFORM_CLICKS_errors, count(*) FILTER (WHERE l_orderkey % 419 = 0) AS GROSS_ORDERS_errors,
       (SELECT m FROM c) AS mtd_month, (SELECT max(Day) FROM long WHERE Year = {mtd.curr_year} AND Month = (SELECT m FROM c)) AS mtd_day
FROM scoped""",
        "wide_frame": engine_ctes() + f" SELECT {', '.join(DIMENSIONS)}, {wide}, 'wide' AS source_format FROM engine WHERE floor(Spend_curr) > 0",
    }


def focus_ctes() -> str:
    """Leaves of the drill from every prefix of the hierarchy, the full paths among them."""
    steps = [x for lv in range(1, 5) for x in (impact_cte(f"imp{lv}", lv), select_cte(f"sel{lv}", f"imp{lv}", lv))]
    path = lambda a, n: " || '/' || ".join(f"{a}.{d}" for d in DIMENSIONS[:n])
    impact = ["Impact_raw", "Impact_adj", "Share_childsum", "Share_parentdelta", "Residual_parent", "Residual_applied_flag"]
    cases = []
    for depth in range(4):
        joins = "".join(f" JOIN sel{k} s{k} ON " + " AND ".join(f"s{k}.{d} = s4.{d}" for d in DIMENSIONS[:k]) for k in range(depth + 1, 4))
        trace = " || ' -> ' || ".join(f"'LEVEL{k}:' || s{k}.rule || ':' || {path(f's{k}', k)}" for k in range(depth + 1, 5))
        ranks = ", ".join(f"s{k}.sel_rank AS rank{k}" if k > depth else f"CAST(NULL AS BIGINT) AS rank{k}" for k in range(1, 5))
        focus = ", ".join(f"s4.{d} AS focus_{d}" if i < depth else f"CAST(NULL AS VARCHAR) AS focus_{d}" for i, d in enumerate(DIMENSIONS))
        cases.append(f"SELECT {depth} AS focus_depth, {focus}, {', '.join(f's4.{c}' for c in [*DIMENSIONS, *SUMS, *impact])}, {ranks}, {trace} AS drill_trace_text FROM sel4 s4{joins}")
    valid = f"(prc > 0 AND prp > 0 AND {logmean('prc', 'prp')} IS NOT NULL AND {lnr('prc', 'prp')} IS NOT NULL)"
    terminal = f"""
t0 AS (SELECT *, {ratio('Revenue_curr_sum', 'Spend_curr_sum')} AS prc, {ratio('Revenue_prev_sum', 'Spend_prev_sum')} AS prp FROM levels WHERE level = 4),
t1 AS (SELECT *, coalesce(prc, 0.0) - coalesce(prp, 0.0) AS parent_delta FROM t0),
t2 AS (SELECT *, CASE WHEN {valid} THEN {lnr('prc', 'prp')} * parent_delta ELSE prc - prp END AS Impact_raw FROM t1),
t3 AS (SELECT *, parent_delta - coalesce(Impact_raw, 0.0) AS Residual_parent FROM t2),
t4 AS (SELECT *, CASE WHEN abs(Impact_raw) > 0 THEN (abs(Impact_raw) / abs(Impact_raw)) * Residual_parent ELSE Residual_parent / 1 END AS alloc FROM t3),
t5 AS (SELECT *, Impact_raw + alloc AS Impact_adj, abs(alloc) > 1e-12 AS Residual_applied_flag FROM t4),
t6 AS (SELECT *, CASE WHEN abs(Impact_adj) > 0 THEN 1.0 ELSE 0.0 END AS Share_childsum, CASE WHEN abs(parent_delta) > 0 THEN abs(Impact_adj) / abs(parent_delta) ELSE 0.0 END AS Share_parentdelta FROM t5)"""
    focus = ", ".join(f"{d} AS focus_{d}" for d in DIMENSIONS)
    cases.append(f"SELECT 4, {focus}, {', '.join([*DIMENSIONS, *SUMS, *impact])}, NULL, NULL, NULL, 1, 'LEVEL4:FOCUS_TERMINAL:' || {path('t6', 4)} FROM t6")
    both = " UNION ALL ".join(cases)
    eligible = (f"coalesce(({pct('Revenue_curr_sum', 'Revenue_prev_sum')} - {pct('Spend_curr_sum', 'Spend_prev_sum')}) > 0 AND "
                f"{pct(ratio('Revenue_curr_sum', 'Spend_curr_sum'), ratio('Revenue_prev_sum', 'Spend_prev_sum'))} > 0 AND {pct('Revenue_curr_sum', 'Revenue_prev_sum')} > -0.3, FALSE)")
    return engine_ctes() + "," + ",".join(steps) + "," + terminal + f""",
fl AS MATERIALIZED ({both}),
fs AS (SELECT level, {', '.join(DIMENSIONS)}, {eligible} AS eligible FROM levels WHERE level >= 1),
fc AS (SELECT *, {pct('Revenue_curr_sum', 'Revenue_prev_sum')} - {pct('Spend_curr_sum', 'Spend_prev_sum')} AS defense, {eligible} AS defender FROM fl),
fk AS (
  SELECT fc.*, CASE WHEN coalesce(fc.Impact_adj, 0.0) > 0 THEN 0 WHEN fs.eligible AND fc.defender THEN 1 END AS kind
  FROM fc JOIN fs ON fs.level = greatest(fc.focus_depth, 1) AND fs.SUBSIDIARY = fc.SUBSIDIARY AND (fc.focus_depth < 2 OR fs.CHANNEL = fc.CHANNEL)
    AND (fc.focus_depth < 3 OR fs.DIVISION = fc.DIVISION) AND (fc.focus_depth < 4 OR fs.PRODUCT = fc.PRODUCT)
)"""


def focus_queries(rounded, doubles: set[str]) -> dict[str, str]:
    focus = ["focus_depth", *[f"focus_{d}" for d in DIMENSIONS]]
    impact = ["Impact_raw", "Impact_adj", "Share_childsum", "Share_parentdelta", "Residual_parent", "Residual_applied_flag"]
    ranks = [f"rank{k}" for k in range(1, 5)]
    leaf = [*focus, *DIMENSIONS, *SUMS, *impact, *ranks, "drill_trace_text"]
    by = f"PARTITION BY {', '.join(focus)}"
    dims = ", ".join(DIMENSIONS)
    sel = ", ".join([*focus, *DIMENSIONS, "Impact_adj"])
    run = ", ".join(f"{c} NULLS FIRST" for c in [*focus, *ranks])
    first = lambda c: f"first({c} ORDER BY {run}) AS {c}"
    merged = ", ".join([f"{dsum(c)} AS {c}" for c in SUMS] + [f"{rnd(f'sum(coalesce({c}, 0.0))')} AS {c}" for c in ("Impact_raw", "Impact_adj", "Residual_parent")])
    shares = ", ".join(f"{rnd(f'first({c} ORDER BY {run})')} AS {c}" for c in ("Share_childsum", "Share_parentdelta"))
    ctes = focus_ctes()
    events = []
    for depth in range(4):
        for lv in range(depth + 1, 5):
            on = lambda a, b, k: " AND ".join(f"{a}.{d} = {b}.{d}" for d in DIMENSIONS[:k]) or "TRUE"
            above = "".join(f" JOIN sel{k} s{k} ON {on(f's{k}', 'r', k)}" for k in range(depth + 1, lv))
            f_ = ", ".join(f"r.{d} AS focus_{d}" if i < depth else f"NULL AS focus_{d}" for i, d in enumerate(DIMENSIONS))
            parent = ", ".join(f"r.{d} AS parent_{d}" if i < lv - 1 else f"NULL AS parent_{d}" for i, d in enumerate(DIMENSIONS))
            path = " || '/' || ".join(f"s.{d}" for d in DIMENSIONS[:lv])
            paths = f"(SELECT string_agg({path}, ' ; ' ORDER BY s.sel_rank) FROM sel{lv} s WHERE {on('s', 'r', lv - 1)})"
            rk = ", ".join(f"s{k}.sel_rank AS rank{k}" if depth < k < lv else f"CAST(NULL AS BIGINT) AS rank{k}" for k in range(1, 4))
            events.append(f"SELECT {depth} AS focus_depth, {f_}, {lv}::BIGINT AS lvl, 'LEVEL{lv}' AS level, r.rule, {parent}, {rnd('r.parent_delta')} AS parent_delta, "
                          f"{rnd('r.top1_share')} AS top1_share_childsum, {rnd('r.top2_share')} AS top2_share_childsum, {rnd('r.impact_floor')} AS impact_floor, coalesce({paths}, '') AS selected_paths, {rk} "
                          f"FROM sel{lv}_rule r{above}")
    f_ = ", ".join(f"{d} AS focus_{d}" for d in DIMENSIONS)
    events.append(f"SELECT 4, {f_}, 4, 'LEVEL4', 'FOCUS_TERMINAL', SUBSIDIARY, CHANNEL, DIVISION, NULL, {rnd('parent_delta')}, NULL, NULL, NULL, "
                  f"SUBSIDIARY || '/' || CHANNEL || '/' || DIVISION || '/' || PRODUCT, NULL, NULL, NULL FROM t6")
    return {
        "drill_focuses": ctes + f" SELECT {rounded(leaf, doubles)} FROM fl",
        "focus_events": ctes + " " + " UNION ALL ".join(events),
        "focus_selections": ctes + f""" SELECT {sel.replace('Impact_adj', rnd('Impact_adj') + ' AS Impact_adj')}, mode_tag, mode_rank FROM (
  SELECT {sel}, 'ISSUE' AS mode_tag, row_number() OVER ({by} ORDER BY Impact_adj, {dims}) AS mode_rank FROM fl WHERE Impact_adj < 0 QUALIFY mode_rank <= 3
  UNION ALL
  SELECT {sel}, CASE kind WHEN 0 THEN 'IMPROVE' ELSE 'DEFENSE' END, row_number() OVER ({by} ORDER BY kind,
         CASE WHEN kind = 0 THEN -coalesce(Impact_adj, 0.0) ELSE -coalesce(defense, -1e9) END, -coalesce(Impact_adj, 0.0), {dims}) AS mode_rank
  FROM fk WHERE kind IS NOT NULL QUALIFY mode_rank <= 3)""",
        "merged_runs": ctes + f""" SELECT {dims}, {merged}, bool_or(coalesce(Residual_applied_flag, FALSE)) AS Residual_applied_flag, {', '.join(first(c) for c in [*focus, *ranks])}, {shares},
       string_agg(drill_trace_text, ' | ' ORDER BY {run}) AS traces, count(*) AS n_runs
FROM fl GROUP BY {dims}""",
    }
