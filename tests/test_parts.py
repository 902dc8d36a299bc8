"""Partial sums by file: a refresh reads new files only, and the frame equals a full build."""

import os
import tempfile

import pytest

from roaslens.config import EngineConfig
from roaslens.sources import parts
from roaslens.sources.ingest import build_engine_frame
from roaslens.sources.raw import read_input

HEADER = "SUBSIDIARY,CHANNEL,DIVISION,PRODUCT,PLATFORM_SPEND_USD,GROSS_REVENUE,PLATFORM_CLICKS,GROSS_ORDERS,OBJECTIVE,Year,Month,Day"


def _file(folder, name, *rows, header=HEADER):
    with open(os.path.join(folder, name), "w") as f:
        f.write("title\n" + header + "\n" + "".join(r + "\n" for r in rows))


def _rows(product, n, month=3):
    return [f'KR,{"Search" if i % 2 else "PMax"},{"MX" if i % 5 else "XX"},{product}{i % 3},"1,{i % 10}00.25",{i * 7 % 90}.5,200,1{i},{"CONVERSION" if i % 7 else "REACH"},{2026 - i % 2},{month},{1 + i % 9}' for i in range(n)]


def _same(spark, data, store, cfg):
    frame, meta = parts.engine_from_parts(spark, store, cfg)
    want, want_meta = read_input(spark, data, cfg, "csv")
    key = lambda r: tuple(r[:4])
    assert sorted(map(tuple, frame.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    assert meta == want_meta


@pytest.mark.parametrize("mtd", [False, True])
def test_new_changed_and_gone_files(spark, monkeypatch, mtd):
    d = tempfile.mkdtemp(prefix="roaslens-parts-", dir="/tmp")
    data, store = os.path.join(d, "data"), os.path.join(d, "store")
    os.mkdir(data)
    cfg = EngineConfig(2026, 2025, mtd_only=mtd)
    read = []
    monkeypatch.setattr(parts, "_read", lambda spark, files, fmt, own=parts._read: read.append([os.path.basename(f) for f in files]) or own(spark, files, fmt))
    _file(data, "a.csv", *_rows("A", 40))
    _file(data, "b.csv", *_rows("B", 30))
    assert parts.refresh(spark, data, store, "csv") == {"read": 2, "kept": 0, "forgotten": 0}
    _same(spark, data, store, cfg)
    assert parts.refresh(spark, data, store, "csv") == {"read": 0, "kept": 2, "forgotten": 0}
    _file(data, "c.csv", *_rows("A", 25, month=4))
    assert parts.refresh(spark, data, store, "csv") == {"read": 1, "kept": 2, "forgotten": 0}
    _same(spark, data, store, cfg)
    _file(data, "b.csv", *_rows("Z", 31))
    assert parts.refresh(spark, data, store, "csv") == {"read": 1, "kept": 2, "forgotten": 1}
    _same(spark, data, store, cfg)
    os.remove(os.path.join(data, "a.csv"))
    assert parts.refresh(spark, data, store, "csv") == {"read": 0, "kept": 2, "forgotten": 1}
    _same(spark, data, store, cfg)
    assert read == [["a.csv", "b.csv"], ["c.csv"], ["b.csv"]]


def test_typed_and_wide_files(spark):
    from roaslens.schema import ENGINE_COLUMNS

    d = tempfile.mkdtemp(prefix="roaslens-parts-", dir="/tmp")
    schema = ", ".join(f"{c} {'string' if i < 4 else 'double'}" for i, c in enumerate(ENGINE_COLUMNS))
    rows = [("S", "C", "MX", f"P{i}", *[float(i + k) for k in range(8)]) for i in range(20)]
    wide = spark.createDataFrame(rows, schema)
    for part in (wide.filter("Spend_curr < 9"), wide.filter("Spend_curr >= 9")):
        part.write.mode("append").parquet(f"{d}/wide")
        parts.refresh(spark, f"{d}/wide", f"{d}/store", "parquet")
    frame, meta = parts.engine_from_parts(spark, f"{d}/store", EngineConfig(2026, 2025))
    assert meta["source_format"] == "wide"
    assert sorted(map(tuple, frame.collect())) == sorted(map(tuple, build_engine_frame(wide, EngineConfig(2026, 2025))[0].collect()))


def test_nothing_there(spark):
    d = tempfile.mkdtemp(prefix="roaslens-parts-", dir="/tmp")
    with pytest.raises(FileNotFoundError):
        parts.refresh(spark, f"{d}/missing", f"{d}/store")
    with pytest.raises(ValueError, match="refresh it first"):
        parts.engine_from_parts(spark, f"{d}/store", EngineConfig(2026, 2025))
