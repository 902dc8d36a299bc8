"""Test adapter: the star-schema test tables seen as a raw long ad table.

Mapping (one raw row per line item):
SUBSIDIARY = supplier region name, CHANNEL = order priority,
DIVISION = customer segment (AUTOMOBILE->MX, BUILDING->VD, FURNITURE->DA,
others unchanged), PRODUCT = part type, OBJECTIVE = CONVERSION unless the
return flag is 'R', Year/Month/Day from the ship date, spend = price *
discount, revenue = price * (1 - discount), clicks = quantity, orders = 1.

Scale notes: the year window is applied as a ship-date range so that it is
pushed into the lineitem scan; only needed columns are read (column pruning);
region and nation are bounded by the schema (5 and 25 rows) and are broadcast
explicitly; the other joins are left to AQE (broadcast when the measured side
is small, sort-merge otherwise).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roaslens.config import EngineConfig
from roaslens.sources.ingest import engine_frame, run_facts

# Fixed values of the test mapping: customer segment -> division code.
SEGMENT_TO_DIVISION = {"AUTOMOBILE": "MX", "BUILDING": "VD", "FURNITURE": "DA"}


def load_tables(spark: SparkSession, sf_dir: str, names=("region", "nation", "customer", "supplier", "part", "orders", "lineitem")) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def mapped_long_table(spark: SparkSession, sf_dir: str, years: tuple[int, ...] | None = None,
                      dates: list[tuple[dt.date, dt.date]] | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Raw long table (raw header names) derived from the test tables.

    ``years`` and ``dates`` (ranges from the first day up to, not including, the last) restrict the ship
    date in the scan; ``keys`` are columns of lineitem to carry along."""
    t = load_tables(spark, sf_dir)
    li = t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_shipdate", *[k for k in keys if k not in ("l_orderkey", "l_partkey", "l_suppkey")],
    )
    if dates:
        within = [(F.col("l_shipdate") >= F.lit(lo)) & (F.col("l_shipdate") < F.lit(hi)) for lo, hi in dates]
        li = li.filter(reduce(lambda a, b: a | b, within))
    if years:
        lo, hi = min(years), max(years)
        li = li.filter(
            (F.col("l_shipdate") >= F.lit(dt.datetime(lo, 1, 1)))
            & (F.col("l_shipdate") < F.lit(dt.datetime(hi + 1, 1, 1)))
        )
    region = F.broadcast(t["region"].select("r_regionkey", "r_name"))
    nation = F.broadcast(t["nation"].select("n_nationkey", "n_regionkey"))
    supp_region = (
        t["supplier"].select("s_suppkey", "s_nationkey")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey"), F.col("r_name").alias("SUBSIDIARY"))
    )
    seg = F.col("c_mktsegment")
    division = F.coalesce(
        *[F.when(seg == k, F.lit(v)) for k, v in SEGMENT_TO_DIVISION.items()], seg
    )
    cust = t["customer"].select("c_custkey", division.alias("DIVISION"))
    orders = t["orders"].select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("CHANNEL"))
    part = t["part"].select("p_partkey", F.col("p_type").alias("PRODUCT"))

    price, disc = F.col("l_extendedprice"), F.col("l_discount")
    return (
        li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supp_region, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "SUBSIDIARY", "CHANNEL", "DIVISION", "PRODUCT",
            (price * disc).alias("PLATFORM_SPEND_USD"),
            (price * (F.lit(1.0) - disc)).alias("GROSS_REVENUE"),
            F.col("l_quantity").alias("PLATFORM_CLICKS"),
            F.lit(1.0).alias("GROSS_ORDERS"),
            F.when(F.col("l_returnflag") != "R", F.lit("CONVERSION")).otherwise(F.lit("AWARENESS")).alias("OBJECTIVE"),
            F.year("l_shipdate").alias("Year"),
            F.month("l_shipdate").alias("Month"),
            F.dayofmonth("l_shipdate").alias("Day"),
            *keys,
        )
    )


def month_to_date(years: tuple[int, ...], month: int, day: int | None) -> list[tuple[dt.datetime, dt.datetime]]:
    """F5 as date ranges: ``month`` of each year up to ``day`` (a day that the month lacks is its last)."""
    out = []
    for y in years:
        first = dt.datetime(y, month, 1)
        after = dt.datetime(y + month // 12, month % 12 + 1, 1)
        out.append((first, min(after, first + dt.timedelta(days=day)) if day else after))
    return out


def mapped_mtd_frame(spark: SparkSession, sf_dir: str, cfg: EngineConfig) -> DataFrame:
    """Month-to-date engine frame: the cutoff from the current year's rows alone, then a scan of the month's days in both years."""
    facts = run_facts(mapped_long_table(spark, sf_dir, (cfg.curr_year,)), cfg.curr_year, quality=False).first()
    years = (cfg.curr_year, cfg.prev_year)
    dates = month_to_date(years, facts.mtd_month, facts.mtd_day) if facts.mtd_month else None
    return engine_frame(mapped_long_table(spark, sf_dir, years, dates), cfg, (facts.mtd_month, facts.mtd_day))


# Fixed values of the text form: one in so many orders has junk, blanks, a unit or no value in a metric.
JUNK, BLANK, UNIT, NAN = 257, 61, 353, 419


def text_long_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapped table as an export would have it: all text, thousands with commas, years and months inside words, padded
    dims and objectives, and in some orders values that are no numbers (P6-P9, A9)."""
    raw = mapped_long_table(spark, sf_dir, keys=("l_orderkey",))
    order = F.col("l_orderkey")

    def money(c: str):
        cents = F.floor(F.col(c) * 100).cast("bigint")
        return F.concat(F.format_number(F.expr(f"floor({c} * 100) div 100"), 0), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))

    odd = lambda n, value, other: F.when(order % n == 0, F.lit(value)).otherwise(other)
    return raw.select(
        F.concat(F.lit(" "), "SUBSIDIARY").alias("Subsidiary"), F.col("CHANNEL").alias("channel"), F.concat(F.lower("DIVISION"), F.lit("  ")).alias("DIVISION"),
        F.when(order % BLANK == 0, F.lit(None)).otherwise(F.col("PRODUCT")).alias("Product"),
        odd(JUNK, "n/a", odd(BLANK, "  ", money("PLATFORM_SPEND_USD"))).alias("platform_spend_usd"), money("GROSS_REVENUE").alias("Gross_Revenue"),
        odd(UNIT, "5d", F.col("PLATFORM_CLICKS").cast("bigint").cast("string")).alias("PLATFORM_CLICKS"), odd(NAN, "NaN", F.lit("1")).alias("GROSS_ORDERS"),
        F.concat(F.lit(" "), F.initcap("OBJECTIVE")).alias("objective"), F.concat(F.lit("FY"), F.col("Year").cast("string")).alias("YEAR"),
        F.concat(F.lit("m"), F.lpad(F.col("Month").cast("string"), 2, "0")).alias("Month"), F.col("Day").cast("string").alias("day"), F.lit("x").alias("Extra"),
    )


def write_text_table(table: DataFrame, path: str, titles: tuple[str, ...], files: int | None = None) -> str:
    """``table`` as CSV lines, each file with title lines and a header of its own.

    A partition's rows are one file (at most ``files``, if given), written where they are, so that a larger table makes
    more files and not larger tasks.  One more file has the header alone: an empty table has it too."""
    cols = [F.col(f"`{c}`").cast("string") for c in table.columns]
    head = [F.lit(x) for x in [*titles, ",".join(table.columns)]]
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # row of its partition
    rows = (table.coalesce(files) if files else table).select(first.alias("first"), F.to_csv(F.struct(*cols)).alias("line"))
    lines = rows.select(F.explode(F.when(F.col("first"), F.array(*head, "line")).otherwise(F.array("line"))).alias("value"))
    alone = table.sparkSession.range(1, numPartitions=1).select(F.explode(F.array(*head)).alias("value"))
    lines.unionByName(alone).write.text(path)
    return path
