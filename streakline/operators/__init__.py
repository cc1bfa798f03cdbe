"""DataFrame -> DataFrame operators: quarantine, run segmentation, run reports."""

from .levels import bitmap_levels, level_bitmaps, merge_bitmaps, type_levels_by_bitmaps
from .quality import GOOD_COLUMNS, except_distinct, is_valid, split_valid
from .reports import (
    span_table,
    timeline_run_pieces,
    timeline_runs,
    type_levels,
    type_levels_by_rows,
    type_levels_of_spans,
    type_ordered,
    type_spans,
    type_summary,
)
from .runstate import PartsOverlap, RunStates, merge_spans, merge_states, run_state
from .segments import cut_in_order, ordinal, run_pieces, segment_runs

__all__ = [
    "GOOD_COLUMNS",
    "PartsOverlap",
    "RunStates",
    "bitmap_levels",
    "cut_in_order",
    "except_distinct",
    "is_valid",
    "level_bitmaps",
    "merge_bitmaps",
    "merge_spans",
    "merge_states",
    "ordinal",
    "run_pieces",
    "run_state",
    "segment_runs",
    "span_table",
    "split_valid",
    "timeline_run_pieces",
    "timeline_runs",
    "type_levels",
    "type_levels_by_bitmaps",
    "type_levels_by_rows",
    "type_levels_of_spans",
    "type_ordered",
    "type_spans",
    "type_summary",
]
