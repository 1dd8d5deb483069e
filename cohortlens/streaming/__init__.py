"""Change rules on batch or streaming DataFrames."""

from cohortlens.streaming.guards import (
    alert_stream,
    alerts,
    constrained_ingest,
    delete_guard,
    ingest_stream,
    ingest_summary,
    tag_violations,
    lookup_or_report,
    publish_snapshot,
)

__all__ = [
    "alert_stream", "alerts", "constrained_ingest", "delete_guard", "ingest_stream", "ingest_summary",
    "lookup_or_report", "publish_snapshot", "tag_violations",
]
