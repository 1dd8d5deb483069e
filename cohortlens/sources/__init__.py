"""Table scans, inline rows, spines and snapshot sinks."""

from cohortlens.sources.tables import (
    DRIVER_TABLES,
    inline_rows,
    read_table,
    register_views,
    tables,
    write_snapshot,
)
from cohortlens.sources.layout import write_bucketed_table, write_clustered_snapshot
from cohortlens.sources.schemas import CLINICAL_SCHEMAS, DRIVER_SCHEMAS, clean_sentinels

__all__ = [
    "CLINICAL_SCHEMAS",
    "DRIVER_SCHEMAS",
    "DRIVER_TABLES",
    "clean_sentinels",
    "inline_rows",
    "read_table",
    "register_views",
    "tables",
    "write_bucketed_table",
    "write_clustered_snapshot",
    "write_snapshot",
]
