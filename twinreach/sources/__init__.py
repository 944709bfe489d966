"""Scans, derived fixture tables and batch sinks."""

from twinreach.sources.tables import (  # noqa: F401
    materialize,
    publish_snapshot,
    read_snapshot,
    read_table,
    table,
    to_schema,
    write_json,
    write_table,
)
