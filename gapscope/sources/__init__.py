"""Sources and sinks: labelled CSV landings, JSON-stat documents, tables."""

from gapscope.sources.csv import malformed_lines, read_header, read_ingest_stamp, read_labelled_csv, require_columns
from gapscope.sources.json_stat import read_json_stat_documents, read_json_stat_ranges
from gapscope.sources.layout import read_ordered, write_bucketed, write_lookup_table, write_ordered
from gapscope.sources.schemas import AUDIT_FLAGS, EFFECTIVE_VS_STATUTORY, FACTS_CLEAN, RATES_CLEAN
from gapscope.sources.tables import (
    export_csv,
    path_exists,
    read_csv_export,
    read_table,
    require_path,
    write_table,
)

__all__ = [
    "AUDIT_FLAGS",
    "EFFECTIVE_VS_STATUTORY",
    "FACTS_CLEAN",
    "RATES_CLEAN",
    "export_csv",
    "malformed_lines",
    "path_exists",
    "read_csv_export",
    "read_header",
    "read_ingest_stamp",
    "read_json_stat_documents",
    "read_json_stat_ranges",
    "read_labelled_csv",
    "read_ordered",
    "read_table",
    "require_columns",
    "require_path",
    "write_bucketed",
    "write_lookup_table",
    "write_ordered",
    "write_table",
]
