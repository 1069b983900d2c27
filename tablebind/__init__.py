"""Spark operators that clean and combine messy tables and report texts."""

from tablebind.operators.bind_columns import bind_columns
from tablebind.operators.bind_rows import bind_rows, detect_bind_modes
from tablebind.operators.bind_tables import (
    bind_files,
    bind_report,
    bind_tables,
    coerce_dates,
    drop_all_null,
    empty_to_null,
    normalize_names,
    stringify,
    table_dims,
    union_tables,
)
from tablebind.operators.headers import (
    find_header_row,
    header_profile,
    header_values,
)
from tablebind.operators.reports import blank_repeats, html_tables, split_footer
from tablebind.operators.summaries import simplify_summary
from tablebind.operators.texts import (
    document_heads,
    documents_to_table,
    extract_fields,
    line_heads,
    normalize_text,
    unknown_heads,
    unmatched_heads,
)
from tablebind.sources.convert import convert_files
from tablebind.sources.dictionaries import load_mapping, load_rules
from tablebind.sources.documents import read_documents, read_lines
from tablebind.sources.tables import read_tables, select_sheet, write_heads, write_table

__all__ = [
    "bind_columns",
    "bind_files",
    "bind_report",
    "bind_rows",
    "bind_tables",
    "blank_repeats",
    "coerce_dates",
    "convert_files",
    "detect_bind_modes",
    "document_heads",
    "documents_to_table",
    "drop_all_null",
    "empty_to_null",
    "extract_fields",
    "find_header_row",
    "header_profile",
    "header_values",
    "html_tables",
    "line_heads",
    "load_mapping",
    "load_rules",
    "normalize_names",
    "normalize_text",
    "read_documents",
    "read_lines",
    "read_tables",
    "select_sheet",
    "simplify_summary",
    "split_footer",
    "stringify",
    "table_dims",
    "union_tables",
    "unknown_heads",
    "unmatched_heads",
    "write_heads",
    "write_table",
]
