"""Structured Streaming entry points.

The reference is batch only.  The one incremental piece that makes sense is
the engine frame: new raw rows arrive (daily files), the per-leaf conditional
sums are kept as streaming state, and each micro-batch hands the updated engine
frame to the batch report.
"""

from roaslens.streaming.incremental import engine_frame_stream, report_each_batch  # noqa: F401
