"""Header discovery, candidate choice, column subsets, snapshot round trip, dedupe."""

import os
import tempfile

from conftest import engine_rows
from roaslens.config import EngineConfig
from roaslens.sinks.report import read_snapshot, write_snapshot
from roaslens.sources.ingest import engine_frame
from roaslens.sources.raw import choose_source, read_with_header_discovery, select_known_columns

HEADER = "SUBSIDIARY,CHANNEL,DIVISION,PRODUCT,PLATFORM_SPEND_USD,GROSS_REVENUE,PLATFORM_CLICKS,GROSS_ORDERS,objective,year,Month,Day,,Extra,Extra"


def test_header_discovery(spark):
    d = tempfile.mkdtemp(prefix="roaslens-csv-", dir="/tmp")
    path = os.path.join(d, "in.csv")
    with open(path, "w") as f:
        f.write("Monthly ad export\n")
        f.write("generated,2026-03-10\n")
        f.write(HEADER + "\n")
        f.write('KR,Search,MX,P1,"1,234.5",100,200,10,CONVERSION,2026,3,5,,a,b\n')
        f.write(",,,,,,,,,,,,,,\n")
        f.write("KR,Search,MX,P1,10,50,100,5,CONVERSION,2025,3,5\n")
    df = read_with_header_discovery(spark, path)
    assert df.columns[:12] == ["SUBSIDIARY", "CHANNEL", "DIVISION", "PRODUCT", "PLATFORM_SPEND_USD", "GROSS_REVENUE",
                               "PLATFORM_CLICKS", "GROSS_ORDERS", "OBJECTIVE", "Year", "Month", "Day"]
    assert df.columns[12:] == ["column_13", "Extra", "Extra_2"]
    assert df.count() == 2
    eng = engine_frame(df, EngineConfig(2026, 2025)).first()
    assert eng["Spend_curr"] == 1234.5 and eng["Spend_prev"] == 10.0


def test_choose_source_and_subset(spark):
    bad = spark.createDataFrame([("x",)], "a string")
    good = spark.createDataFrame([], ", ".join(f"{c} string" for c in HEADER.split(",")[:12]) + ", junk string")
    assert choose_source([bad, good]) is good
    assert choose_source([bad]) is bad
    sub = select_known_columns(good.withColumnRenamed("objective", "OBJECTIVE").withColumnRenamed("year", "Year"))
    assert "junk" not in sub.columns and sub.columns[-4:] == ["OBJECTIVE", "Year", "Month", "Day"]


def test_snapshot_round_trip(spark):
    d = tempfile.mkdtemp(prefix="roaslens-snap-", dir="/tmp")
    eng = engine_rows(spark, [("S", "C", "MX", "P", 1, 2, 3, 4, 5, 6, 7, 8)])
    write_snapshot(eng, d, "key-1", {"curr_year": 2026})
    got = read_snapshot(spark, d, "key-1")
    assert got is not None and got[1]["cache_hit"] and got[0].count() == 1
    assert read_snapshot(spark, d, "key-2") is None
    assert read_snapshot(spark, d + "/missing", "key-1") is None


def test_dedupe_campaigns(spark):
    from pyspark.sql import functions as F
    from roaslens.operators.drill import dedupe_campaigns
    from roaslens.schema import SUM_COLUMNS
    base = engine_rows(spark, [("S", "C", "MX", "P", 1, 2, 3, 4, 5, 6, 7, 8)])
    row = base.select("SUBSIDIARY", "CHANNEL", "DIVISION", "PRODUCT", *[F.lit(1.0).alias(c) for c in SUM_COLUMNS],
                      F.lit(0.5).alias("Impact_raw"), F.lit(0.25).alias("Impact_adj"), F.lit(0.1).alias("Residual_parent"),
                      F.lit(False).alias("Residual_applied_flag"), F.lit("ISSUE").alias("mode_tag"))
    two = row.unionByName(row.withColumn("Residual_applied_flag", F.lit(True)))
    r = dedupe_campaigns(two).collect()
    assert len(r) == 1 and r[0]["Impact_adj"] == 0.5 and r[0]["Residual_applied_flag"] and r[0]["mode_tag"] == "ISSUE"


def test_read_input_and_window_text(spark):
    import pytest
    from roaslens.sinks.report import comparison_window_text
    from roaslens.sources.raw import read_input
    d = tempfile.mkdtemp(prefix="roaslens-in-", dir="/tmp")
    path = os.path.join(d, "in.csv")
    with open(path, "w") as f:
        f.write(HEADER.rsplit(",,", 1)[0] + "\n")
        f.write("KR,Search,MX,P1,10,100,200,10,CONVERSION,2026,3,5\n")
        f.write("KR,Search,MX,P1,5,60,200,10,conversion,2025,3,9\n")
    eng, meta = read_input(spark, path, EngineConfig(2026, 2025, mtd_only=True))
    r = eng.first()
    assert r["Spend_curr"] == 10.0 and r["Spend_prev"] == 0.0  # day 9 is after the cutoff (day 5)
    assert meta["mtd_day_cutoff"] == 5 and meta["objective_rows_after"] == 2
    assert comparison_window_text(meta).startswith("2026-03-01..2026-03-05 vs 2025-03-01..2025-03-05; objective = CONVERSION (2/2 rows)")
    with pytest.raises(FileNotFoundError):
        read_input(spark, os.path.join(d, "missing.csv"), EngineConfig(2026, 2025))


def test_load_input_frame_uses_snapshot(spark):
    from roaslens.sources.raw import load_input_frame
    d = tempfile.mkdtemp(prefix="roaslens-load-", dir="/tmp")
    path = os.path.join(d, "in.csv")
    with open(path, "w") as f:
        f.write(HEADER.rsplit(",,", 1)[0] + "\n")
        f.write("KR,Search,MX,P1,10,100,200,10,CONVERSION,2026,3,5\n")
    cfg = EngineConfig(2026, 2025)
    e1, m1 = load_input_frame(spark, path, cfg, f"{d}/snap")
    e2, m2 = load_input_frame(spark, path, cfg, f"{d}/snap")
    assert m1["cache_hit"] is False and m2["cache_hit"] is True
    assert e1.collect() == e2.collect()
    with open(path, "a") as f:
        f.write("KR,Search,MX,P2,10,100,200,10,CONVERSION,2026,3,5\n")
    e3, m3 = load_input_frame(spark, path, cfg, f"{d}/snap")  # changed input: not the old frame
    assert m3["cache_hit"] is False and e3.count() == 2


def _write(folder, name, *lines):
    with open(os.path.join(folder, name), "w") as f:
        f.write("".join(x + "\n" for x in lines))


LONG = HEADER.rsplit(",,", 1)[0]


def _row(product, year=2026):
    return f"KR,Search,MX,{product},10,100,200,10,CONVERSION,{year},3,5"


def test_header_far_down(spark):
    d = tempfile.mkdtemp(prefix="roaslens-csv-", dir="/tmp")
    _write(d, "in.csv", *[f"note {i}" for i in range(130)], LONG, _row("P1"), _row("P2"))
    df = read_with_header_discovery(spark, os.path.join(d, "in.csv"))
    assert df.columns[:4] == ["SUBSIDIARY", "CHANNEL", "DIVISION", "PRODUCT"] and sorted(r.PRODUCT for r in df.collect()) == ["P1", "P2"]


def test_header_of_every_file(spark):
    d = tempfile.mkdtemp(prefix="roaslens-csv-", dir="/tmp")
    _write(d, "a.csv", "small title", LONG, *[_row(f"A{i}") for i in range(3)])
    _write(d, "b.csv", "title, with a comma", "more", LONG, *[_row(f"B{i}") for i in range(500)])
    _write(d, "c.csv", *[_row(f"C{i}") for i in range(2000)])  # larger, without a header: all data
    got = [r.PRODUCT for r in read_with_header_discovery(spark, d).collect()]
    assert len(got) == 2503 and len(set(got)) == 2503 and {x[0] for x in got} == set("ABC")


def test_header_over_splits(spark):
    d = tempfile.mkdtemp(prefix="roaslens-csv-", dir="/tmp")
    _write(d, "in.csv", *[f"note {i}" for i in range(2000)], LONG, *[_row(f"P{i}") for i in range(2000)])
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        assert read_with_header_discovery(spark, d).count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_quoted_separators_and_other_headers(spark):
    import pytest
    d = tempfile.mkdtemp(prefix="roaslens-csv-", dir="/tmp")
    _write(d, "a.csv", LONG, _row('"P,1,2,3,4,5,6"'))
    df = read_with_header_discovery(spark, d)
    assert len(df.columns) == 12 and df.first().PRODUCT == "P,1,2,3,4,5,6"
    _write(d, "b.csv", LONG + ",More", _row("P2") + ",x")
    with pytest.raises(ValueError):
        read_with_header_discovery(spark, d)


def test_no_header_and_no_rows(spark):
    d = tempfile.mkdtemp(prefix="roaslens-csv-", dir="/tmp")
    _write(d, "a.csv", "x,y", "1,2", "", "3")
    df = read_with_header_discovery(spark, d)
    assert df.columns == ["x", "y"] and sorted(map(tuple, df.collect()), key=str) == [("1", "2"), ("3", None)]
    _write(d, "a.csv")
    assert read_with_header_discovery(spark, d).count() == 0


def test_layout_of_the_second_read_does_not_matter(spark):
    """Splits and partitions differ between the read that finds the header and the read of the data, and after it."""
    d = tempfile.mkdtemp(prefix="roaslens-csv-", dir="/tmp")
    _write(d, "a.csv", *[f"note {i}" for i in range(3000)], LONG, *[_row(f"A{i}") for i in range(3000)])
    _write(d, "b.csv", "title", LONG, *[_row(f"B{i}") for i in range(700)], LONG, _row("B-last"))
    from roaslens.sources.raw import discover, read_text_table
    sizes = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5k")
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", 31)
        table = discover(spark, [(d, ",")])[0]
        spark.conf.set("spark.sql.files.maxPartitionBytes", "60k")
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", 2)
        df = read_text_table(spark, table)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9k")
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", 13)
        got = sorted(r.PRODUCT for r in df.select("PRODUCT").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", sizes)
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    want = [f"A{i}" for i in range(3000)] + [f"B{i}" for i in range(700)] + ["PRODUCT", "B-last"]
    assert got == sorted(want)  # a later header row is data


def test_candidates_in_order_of_preference(spark):
    import pytest
    from roaslens.sources.raw import read_candidates, read_input
    d = tempfile.mkdtemp(prefix="roaslens-csv-", dir="/tmp")
    for name in ("wrong", "right", "also"):
        os.mkdir(os.path.join(d, name))
    _write(os.path.join(d, "wrong"), "a.csv", "x,y", "1,2")
    _write(os.path.join(d, "right"), "a.csv", "title", LONG + ",Extra", _row("P1") + ",e", _row("P2", 2025) + ",e")
    _write(os.path.join(d, "also"), "a.csv", LONG, _row("Q1"))
    paths = [os.path.join(d, n) for n in ("missing", "wrong", "right", "also")]
    got = read_candidates(spark, paths, "csv")
    assert sorted(r.PRODUCT for r in got.collect()) == ["P1", "P2"] and "Extra" not in got.columns
    assert read_input(spark, paths, EngineConfig(2026, 2025), "csv")[0].first().PRODUCT == "P1"
    assert read_candidates(spark, paths[:2], "csv").columns == ["x", "y"]
    typed = os.path.join(d, "t.parquet")
    read_candidates(spark, [paths[3]], "csv").withColumnRenamed("Year", "yEAR").withColumn("junk", F_lit("z")).write.parquet(typed)
    got = read_candidates(spark, [typed, paths[2]])
    assert got.columns[-3:] == ["Year", "Month", "Day"] and "junk" not in got.columns
    assert "junk" not in got._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(FileNotFoundError):
        read_candidates(spark, [paths[0]])


def F_lit(x):
    from pyspark.sql import functions as F
    return F.lit(x)


def test_names_that_differ_in_case(spark):
    both = spark.createDataFrame([("a", "b", "c")], "Year string, YEAR string, month string")
    from roaslens.sources.ingest import standard_names
    assert standard_names(both.columns) == ["Year", "YEAR", "Month"]
    rows = [tuple("x" for _ in range(13))]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(13))).toDF(*LONG.split(","), "YEAR")
    assert select_known_columns(df).columns.count("Year") + select_known_columns(df).columns.count("YEAR") == 1


def test_text_input_is_scanned_twice_in_all(spark):
    """One read finds the header, one the data; the facts and the frame come from what that second read wrote."""
    from roaslens.sources.raw import read_input
    d = tempfile.mkdtemp(prefix="roaslens-csv-", dir="/tmp")
    _write(d, "in.csv", "title", LONG, *[_row(f"P{i}") for i in range(50)])
    seen = []
    reader = type(spark.read)
    text = reader.text
    reader.text = lambda self, *a, **k: seen.append(a) or text(self, *a, **k)
    try:
        frame, meta = read_input(spark, d, EngineConfig(2026, 2025, mtd_only=True), "csv")
    finally:
        reader.text = text
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert len(seen) == 2 and "Format: Text" not in plan and "text" not in plan.split("FileScan ", 1)[1][:8]
    assert frame.count() == 50 and meta["mtd_day_cutoff"] == 5 and meta["objective_rows_before"] == 50


def test_text_table_is_written_where_its_rows_are(spark):
    """Files and the rows of a task follow the table's partitions; each file has titles and a header, an empty table too."""
    import glob
    from roaslens.sources.mapped import write_text_table
    from roaslens.sources.raw import read_candidates
    d = tempfile.mkdtemp(prefix="roaslens-csv-", dir="/tmp")
    names = LONG.split(",")
    row = spark.range(0, 3200, 1, 16).select(*[F_lit("x").alias(n) if n != "PRODUCT" else F_col("id").cast("string").alias(n) for n in names])
    titles = ("Ad export", "Subsidiary,Channel", "")
    write_text_table(row, f"{d}/data", titles)
    files = [open(f).read().split("\n")[:-1] for f in glob.glob(f"{d}/data/**/part-*", recursive=True)]
    assert all(f[:4] == [*titles, LONG] and LONG not in f[4:] for f in files)
    assert sum(len(f) - 4 for f in files) == 3200 and max(len(f) - 4 for f in files) == 200
    got = read_candidates(spark, [f"{d}/data"], "csv")
    assert sorted(int(r.PRODUCT) for r in got.collect()) == list(range(3200))
    write_text_table(row.limit(0), f"{d}/none", titles)
    none = read_candidates(spark, [f"{d}/none"], "csv")
    assert none.columns == got.columns and none.count() == 0
    write_text_table(row, f"{d}/few", titles, files=2)
    assert read_candidates(spark, [f"{d}/few"], "csv").count() == 3200


def F_col(x):
    from pyspark.sql import functions as F
    return F.col(x)
