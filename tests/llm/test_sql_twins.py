"""Queries with a SQL twin against DuckDB, on the small table and on odd ones with nulls, ties and odd characters."""

import glob
import os

import duckdb
import pytest

from roaslens.llm.oracle import ORACLE
from roaslens.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = [
    (1, None), (2, ""), (3, " \n\t \x0b"), (4, "one two three four five six seven eight " * 9), (5, "X\n\nX\nX $$$ | <>  y"), (6, "𝄞  a b\r\n"),
    (7, "Ünï, çödé. " * 200), (8, "Ünï, çödé. " * 200), (9, "a" * 1000 + "!?[]`{~}\n" * 40), (10, "\n".join(f"line {i % 7}" for i in range(300))),
]
TRICKS = ["", None, "\\", "\\\\", "### ", "#### ### # ###", "</turn>", "\\</turn>\\", "a: b\n### user: c</turn>\n", "𝄞é</turn", "###", "x" * 70_000 + "</turn>\\### "]
CONVERSATIONS = [(c, t, r, x) for c in (0, 3, 50, 100, 205, None) for t, (r, x) in enumerate(zip(["user", "assistant", None, "sys:tem\\", "### ", "assistant"], TRICKS[c or 0 if (c or 0) < 4 else c % 7 :]))]
CONVERSATIONS += [(7, None, "user", "b"), (7, None, "user", "a"), (7, None, None, "a"), (7, 1, "assistant", "a"), (7, 1, "assistant", "a"), (8, 0, "assistant", None), (-7, 1, "user", "mine")]
VECTORS = [(i, [((i * 37 + k * k * 11) % 41 - 20) / 23 for k in range(6)], i % 3) for i in range(260)]
VECTORS += [(i, VECTORS[100][1], 1) for i in range(300, 420)] + [(i, VECTORS[100][1], 2) for i in range(90, 110)] + [(150, VECTORS[3][1], 0), (150, VECTORS[3][1], 0), (None, VECTORS[100][1], 1), (None, [0.5] * 6, 2)]
VECTORS += [(500, None, 1), (550, [0.1] * 6, None), (600, [0.1, None, 0.2], 1), (650, [float("nan")] * 6, 1), (700, [float("inf"), 0.0], 1), (750, [], 2), (800, [0.9, -0.9], 0), (850, [0.0] * 6, 1), (900, [3000.0, -2500.5, 1.0, 4.0, 9.0, 1.0, 2.0], 2)]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(DOCUMENTS, "doc_id long, text string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(CONVERSATIONS, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(f"{folder}/conversations.parquet")
    spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>, label int").repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.fixture(scope="module")
def empty(spark, odd, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for path in glob.glob(f"{odd}/*.parquet"):
        spark.read.parquet(path).limit(0).coalesce(1).write.parquet(f"{folder}/{os.path.basename(path)}")
    return folder


def matches(spark, name, folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(want.columns)
    at = [want.columns.index(c) for c in got.columns]
    by = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=by) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=by)


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("table", ["small", "odd", "empty"])
def test_matches_sql(spark, odd, empty, name, table):
    matches(spark, name, {"small": SMALL, "odd": odd, "empty": empty}[table])
