"""Sources: text scans and parsers for labelled pairs, documents and points."""

from pointtally.sources.text import (
    deal,
    document_lines,
    document_tokens,
    parse_pairs,
    parse_point_line,
    parse_points,
    points_from_table,
    read_documents,
    read_pairs,
    read_point_tokens,
    read_points,
    read_text_lines,
    scan_point_tokens,
    validate_points,
    with_row_index,
    write_lines,
)

__all__ = [
    "deal",
    "document_lines",
    "document_tokens",
    "parse_pairs",
    "parse_point_line",
    "parse_points",
    "points_from_table",
    "read_documents",
    "read_pairs",
    "read_point_tokens",
    "read_points",
    "read_text_lines",
    "scan_point_tokens",
    "validate_points",
    "with_row_index",
    "write_lines",
]
