from roaslens.sinks.report import (  # noqa: F401
    campaign_table, campaign_view, trace_table, write_report, write_snapshot, read_snapshot,
)
