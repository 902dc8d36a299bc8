import math

from pyspark.sql import functions as F

from roaslens.functions import exprs as X


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_safe_ratio_pct_log(spark):
    assert one(spark, X.safe_ratio(F.lit(6.0), F.lit(3.0))) == 2.0
    assert one(spark, X.safe_ratio(F.lit(6.0), F.lit(0.0))) is None
    assert one(spark, X.safe_ratio(F.lit(6.0), F.lit(-1.0))) is None
    assert one(spark, X.pct_change(F.lit(3.0), F.lit(2.0))) == 0.5
    assert one(spark, X.pct_change(F.lit(3.0), F.lit(0.0))) is None
    assert math.isclose(one(spark, X.log_ratio(F.lit(2.0), F.lit(1.0))), math.log(2))
    assert one(spark, X.log_ratio(F.lit(0.0), F.lit(1.0))) is None


def test_log_mean(spark):
    assert one(spark, X.log_mean(F.lit(2.0), F.lit(2.0))) == 2.0
    assert math.isclose(one(spark, X.log_mean(F.lit(2.0), F.lit(1.0))), 1.0 / math.log(2.0))
    assert one(spark, X.log_mean(F.lit(0.0), F.lit(1.0))) is None
    assert one(spark, X.log_mean(F.lit(None).cast("double"), F.lit(1.0))) is None


def test_direct_contribution(spark):
    assert one(spark, X.direct_contribution_pct(F.lit(-0.5), F.lit(-2.0), F.lit("ISSUE"))) == 0.25
    assert one(spark, X.direct_contribution_pct(F.lit(0.5), F.lit(-2.0), F.lit("ISSUE"))) == 0.0
    assert one(spark, X.direct_contribution_pct(F.lit(0.5), F.lit(2.0), F.lit("DEFENSE"))) == 0.25
    assert one(spark, X.direct_contribution_pct(F.lit(-0.5), F.lit(2.0), F.lit("OTHER"))) == 0.25
    assert one(spark, X.direct_contribution_pct(F.lit(0.5), F.lit(0.0), F.lit("ISSUE"))) is None


def test_formatters(spark):
    assert one(spark, X.fmt_money(F.lit(2_500_000.0))) == "$2.5M"
    assert one(spark, X.fmt_money(F.lit(-12_345.0))) == "$12K"
    assert one(spark, X.fmt_money(F.lit(None).cast("double"))) == "$0"
    assert one(spark, X.fmt_pct(F.lit(-0.123))) == "-12%"
    assert one(spark, X.fmt_pct(F.lit(None).cast("double"))) == "N/A"
    assert one(spark, X.fmt_pct_yoy(F.lit(0.5))) == "50% YoY"
    assert one(spark, X.fmt_roas(F.lit(19.04))) == "19.0"
    assert one(spark, X.fmt_pp(F.lit(0.031))) == "+3%p"
    assert one(spark, X.fmt_driver_metric(F.lit("CPC"), F.lit(1.234))) == "$1.23"
    assert one(spark, X.fmt_driver_metric(F.lit("CVR"), F.lit(0.01234))) == "1.23%"
    assert one(spark, X.trend(F.lit(0.0))) == "flat"
    assert one(spark, X.trend(F.lit(-1.0))) == "down"
    assert one(spark, X.yoy_polarity(F.lit("CPC"), F.lit(0.2))) == "negative"
    assert one(spark, X.channel_type(F.lit(" google performance max "))) == "PMAX"
    assert one(spark, X.channel_type(F.lit("Paid Search"))) == "SEARCH"
    assert one(spark, X.channel_type(F.lit(None).cast("string"))) == "OTHER"


def test_trace_text(spark):
    node = lambda lv, rule, *dims: F.struct(
        F.lit(lv).alias("level"), F.lit(rule).alias("rule"),
        F.struct(*[(F.lit(d) if d else F.lit(None).cast("string")).alias(n) for d, n in zip(list(dims) + [None] * (4 - len(dims)), ["SUBSIDIARY", "CHANNEL", "DIVISION", "PRODUCT"])]).alias("selected_path"),
        F.lit(0.1).alias("impact_adj"), F.lit(0.2).alias("share_childsum"))
    tr = F.array(node("LEVEL2", "SINGLE", "A", "B"), node("LEVEL3", "WIDE_POS", "A", "B", "C"))
    assert one(spark, X.trace_text(tr)) == "LEVEL2:SINGLE:A/B -> LEVEL3:WIDE_POS:A/B/C"
    assert one(spark, X.trace_node_for_dim(tr, "CHANNEL").getField("rule")) == "SINGLE"
    assert one(spark, X.trace_node_for_dim(tr, "PRODUCT")) is None
    assert one(spark, X.last_node(tr).getField("level")) == "LEVEL3"
