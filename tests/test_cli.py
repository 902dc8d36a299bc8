"""Command line end to end: raw Parquet in, report tables and summary sections out (K1, K7)."""

import os
import tempfile

from conftest import SF_SMALL
from roaslens.__main__ import main
from roaslens.sources.mapped import mapped_long_table


def test_cli_writes_report(spark):
    d = tempfile.mkdtemp(prefix="roaslens-cli-", dir="/tmp")
    mapped_long_table(spark, SF_SMALL).write.parquet(f"{d}/raw.parquet")
    main(["--input", f"{d}/raw.parquet", "--out", f"{d}/out", "--curr-year", "2000", "--prev-year", "1999"])
    for t in ("issues", "improvements", "issues_view", "improvements_view", "division_parallel", "trace"):
        assert os.path.isdir(f"{d}/out/{t}")
    assert spark.read.parquet(f"{d}/out/issues").count() > 0
    assert spark.read.json(f"{d}/out/summary/report_cards").count() == 5
    assert "curr_year" in spark.read.text(f"{d}/out/summary/comparison_meta").first()[0]


def test_candidates_focus_and_threshold(spark, tmp_path, monkeypatch):
    import pytest
    from roaslens.__main__ import main

    header = "SUBSIDIARY,CHANNEL,DIVISION,PRODUCT,PLATFORM_SPEND_USD,GROSS_REVENUE,PLATFORM_CLICKS,GROSS_ORDERS,OBJECTIVE,Year,Month,Day\n"
    rows = [f"KR,{c},MX,P{i},1{i}0,{500 + 70 * i * (y == 2026)},200,1{i},CONVERSION,{y},3,5" for c in ("Search", "PMax") for i in range(4) for y in (2026, 2025)]
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    (tmp_path / "good.csv").write_text(header + "\n".join([*rows, "KR,Search,MX,P9,x,5,200,10,CONVERSION,2026,3,5"]) + "\n")
    args = ["--input", str(tmp_path / "bad.csv"), "--input", str(tmp_path / "good.csv"), "--out", str(tmp_path / "out"), "--curr-year", "2026", "--prev-year", "2025", "--focus", "KR", "--focus", "KR/Search/MX"]
    with pytest.raises(ValueError, match="can't be read as numbers"):
        main(args)
    monkeypatch.setenv("ROASLENS_PARSE_ERROR_THRESHOLD", "0.2")
    main(args)
    trace = spark.read.parquet(str(tmp_path / "out" / "focus_trace"))
    assert {r.focus_depth for r in trace.collect()} == {1, 3}
    assert spark.read.parquet(str(tmp_path / "out" / "focus_improvements")).filter("focus_depth = 3").count() == 3
    monkeypatch.setenv("ROASLENS_PARSE_ERROR_THRESHOLD", "2")
    with pytest.raises(ValueError, match="parse_error_threshold"):
        main(args)
