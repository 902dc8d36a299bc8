"""A slice of the correctness gate inside pytest: registered queries vs their DuckDB SQL (sf0.001)."""

import importlib.util
import math
import os

import duckdb
import pytest

from conftest import SF_SMALL

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(HERE, "__spark_entry__.py"))
E = importlib.util.module_from_spec(spec)
spec.loader.exec_module(E)

NAMES = ["engine_frame", "impact_channel", "select_children", "drill_leaves", "trace_table", "rca_join",
         "division_parallel", "top3_diverse", "merged_topics", "report_cards", "card_topics", "card_summary", "drill_leaves_mtd"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


def _norm(rows):
    f = lambda v: round(v, 9) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(f(x) for x in r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    idx = [res.columns.index(c) for c in df.columns]
    assert _norm(df.collect()) == _norm([tuple(r[i] for i in idx) for r in res.fetchall()])
