"""Incremental engine frame: streaming state equals the batch engine frame."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from roaslens.config import EngineConfig
from roaslens.sources.ingest import engine_frame
from roaslens.sources.mapped import mapped_long_table
from roaslens.streaming import engine_frame_stream, report_each_batch

CFG = EngineConfig(2000, 1999)


def test_stream_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="roaslens-stream-", dir="/tmp")
    raw = mapped_long_table(spark, SF_SMALL, (2000, 1999))
    # two arrivals: previous year first, then the current year
    raw.filter(F.col("Year") == 1999).write.parquet(f"{base}/in/part=1")
    raw.filter(F.col("Year") == 2000).write.parquet(f"{base}/in/part=2")
    schema = raw.schema
    seen = {}

    def build(batch, batch_id):
        seen[batch_id] = {tuple(r[:4]): r for r in batch.collect()}

    q = (engine_frame_stream(spark, f"{base}/in/*", schema, CFG, max_files_per_trigger=1)
         .writeStream.outputMode("complete").foreachBatch(report_each_batch(build))
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination(600)
    last = seen[max(seen)]
    batch = {tuple(r[:4]): r for r in engine_frame(raw, CFG).collect()}
    assert set(last) == set(batch)
    for k, r in batch.items():
        assert last[k]["Spend_curr"] == r["Spend_curr"] and last[k]["Revenue_prev"] == r["Revenue_prev"]
