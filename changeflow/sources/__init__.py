from changeflow.sources.files import ingest_files, read_files, stream_files, with_lineage
from changeflow.sources.schema import (
    grow_schema,
    infer_schema,
    starting_schema,
    stored_schema,
    tracked_schema,
    widen,
)
from changeflow.sources.tables import publish_table, publish_view, refresh

__all__ = [
    "grow_schema",
    "infer_schema",
    "ingest_files",
    "publish_table",
    "publish_view",
    "refresh",
    "read_files",
    "starting_schema",
    "stored_schema",
    "stream_files",
    "tracked_schema",
    "widen",
    "with_lineage",
]
