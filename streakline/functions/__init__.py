"""Scalar and aggregate column expressions (built-ins only, no Python UDFs)."""

from .arrays import in_order, join_ints, sorted_distinct
from .parsing import (
    LEVEL_MARKER,
    LINE_SEPARATOR,
    TIMESTAMP_FORMAT,
    TYPE_MARKERS,
    first_segment,
    lenient_int,
    line_is_valid,
    marker_regex,
    parse_lines,
    parse_timestamp,
    segment_after,
    split_first,
)

__all__ = [
    "LEVEL_MARKER",
    "LINE_SEPARATOR",
    "TIMESTAMP_FORMAT",
    "TYPE_MARKERS",
    "first_segment",
    "in_order",
    "join_ints",
    "lenient_int",
    "line_is_valid",
    "marker_regex",
    "parse_lines",
    "parse_timestamp",
    "segment_after",
    "sorted_distinct",
    "split_first",
]
