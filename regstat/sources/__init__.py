"""Sources, sinks and schema guards."""

from regstat.sources.readers import (
    Sources,
    fixture_frames,
    fixture_sources,
    named_sources,
    read_sources,
    read_table,
)
from regstat.sources.schemas import (
    SCHEMAS,
    MissingColumnError,
    missing_columns,
    normalise,
    normalise_names,
    require_columns,
)
from regstat.sources.sinks import write_delivery, write_sources, write_table

__all__ = [
    "SCHEMAS",
    "MissingColumnError",
    "Sources",
    "fixture_frames",
    "fixture_sources",
    "missing_columns",
    "named_sources",
    "normalise",
    "normalise_names",
    "read_sources",
    "read_table",
    "require_columns",
    "write_delivery",
    "write_sources",
    "write_table",
]
