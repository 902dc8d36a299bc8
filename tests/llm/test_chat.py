"""Chat formatting: the bytes against a turn-by-turn formatter, the mask, hot conversations, foreign bytes."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roaslens.llm import chat


def escaped(text, colon=False):
    text = text.replace("\\", "\\\\").replace("### ", "\\### ").replace("</turn>", "\\</turn>")
    return text.replace(":", "\\:") if colon else text


def formatted(turns):
    return "".join(f"### {escaped(r or '', True)}: {escaped(t or '')}</turn>\n" for r, t in turns)


def rows(n=400, seed=3):
    rng = random.Random(seed)
    bits = ["\\", "#", "##", "### ", "</turn>", "</", "turn>", ": ", "\n", "é", "𝄞", "word ", " ", ""]
    return [(rng.randint(0, 20), i, rng.choice(["user", "assistant", "assistant", "a:b", "### ", None]), rng.choice([None, "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))])) for i in range(n)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(*r, 1, "x") for r in rows()], "conv_id long, turn long, role string, text string, deal int, seq string").repartition(5).cache()


def by_conversation():
    out = {}
    for c, _, r, t in sorted(rows(), key=lambda x: x[:2]):
        out.setdefault(c, []).append((r, t))
    return out


@pytest.mark.parametrize("by_range", [False, True])
@pytest.mark.parametrize("size", [1 << 22, 40])
def test_bytes_and_mask(table, by_range, size):
    want = by_conversation()

    def run(batches):
        chat.SLICE = size
        yield from chat._format(batches)

    parts = chat.format_turns(table, by_range) if size != 40 else table.select("conv_id", "turn", "role", "text").repartition(2, "conv_id").sortWithinPartitions("conv_id", "turn").select("conv_id", "role", "text").mapInArrow(run, chat.PARTS)
    got, loss = {}, {}
    for r in sorted(parts.collect(), key=lambda r: (r.conv_id, r.deal, r.seq)):
        got[r.conv_id] = got.get(r.conv_id, b"") + bytes(r.text)
        loss.setdefault(r.conv_id, []).extend(bytes(r.text[a:z]).decode() for a, z in zip(r.loss_start, r.loss_end))
    assert {c: t.decode() for c, t in got.items()} == {c: formatted(x) for c, x in want.items()}
    assert loss == {c: [escaped(t or "") for r, t in x if r == "assistant"] for c, x in want.items()}


def test_hot_conversations_read_the_same(table):
    big = table.unionByName(table.filter("conv_id < 3").withColumn("turn", F.col("turn") + 1000)).unionByName(table.filter("conv_id = 4").withColumn("conv_id", F.lit(None).cast("long")))
    plain = sorted(map(str, chat.round_trip(big).collect()))
    assert sorted(map(str, chat.round_trip(big, hot_rows=12).collect())) == plain
    assert len(plain) == len(by_conversation()) + 1


def test_foreign_bytes_are_refused(spark):
    for text in (b"### user: a", b"user: a</turn>\n", b"### user: a</turn>\nb", b"### user a</turn>\n", b"### user: \\</turn>\n"):
        df = spark.createDataFrame([(1, 0, 0, 1, bytearray(text), [], [])], chat.PARTS)
        with pytest.raises(Exception, match="not the output of format_turns"):
            chat.read_parts(df).collect()


def test_one_text_over_the_slice():
    text = "</turn>\\" * (chat.SLICE // 8 + 5)
    out, turn_at, start, end = chat.assemble(pa.array(["assistant"]), pa.array([text]))
    assert out.tobytes().decode() == formatted([("assistant", text)]) and turn_at[-1] == len(out)
    assert out[start[0] : end[0]].tobytes().decode() == escaped(text)
