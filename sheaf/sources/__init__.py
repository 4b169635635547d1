"""Sources: text lines, line parsers and table bindings."""

from sheaf.sources.parsers import parse_labeled_points, parse_points, parse_ratings
from sheaf.sources.text import lines_from_column, number_lines, read_text_lines, write_text_lines

__all__ = [
    "lines_from_column",
    "number_lines",
    "parse_labeled_points",
    "parse_points",
    "parse_ratings",
    "read_text_lines",
    "write_text_lines",
]
