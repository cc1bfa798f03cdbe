"""Column expressions that turn a raw log line into typed fields.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen and runs on executors; nothing is evaluated in
Python per row.  All functions are NULL-returning on bad input (never raise),
which keeps them valid under Spark 4's default ANSI mode.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values of the log format (must equal the source data's format) ---
# A line is  <timestamp><SEPARATOR><url>; only the first separator splits.
LINE_SEPARATOR = "@"
# Timestamp text, second precision, parsed in the session time zone.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Path markers whose next segment is the request type, in priority order.
TYPE_MARKERS = ("slab", "multi-descr")
# Path marker whose next segment is the zoom level.
LEVEL_MARKER = "256"
# --- end of fixed values ---

# Bytes a lenient number may be padded with: ASCII control characters,
# space and DEL (what Spark's legacy string-to-int cast trims).
PAD = r"[\x00-\x20\x7f]*"
_FRACTION_ONLY = rf"^{PAD}[+-]?\.[0-9]*{PAD}$"
_INT_WITH_FRACTION = rf"^{PAD}([+-]?[0-9]+)(\.[0-9]*)?{PAD}$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_int(c: str | Column) -> Column:
    """String -> int with the legacy (non-ANSI) cast rules, NULL on failure.

    Accepts surrounding control/space padding, a sign, and a fraction that is
    cut off (``' 5.7 '`` -> 5, ``'.5'`` -> 0); anything else, and values out of
    the int range, give NULL.  ``try_cast`` alone refuses the fraction.
    """
    s = _col(c)
    digits = F.regexp_extract(s, _INT_WITH_FRACTION, 1)
    return (
        F.when(s.rlike(_FRACTION_ONLY), F.lit(0))
        .otherwise(F.nullif(digits, F.lit("")).try_cast("int"))
    )


def split_first(c: str | Column, sep: str = LINE_SEPARATOR) -> tuple[Column, Column]:
    """(head, tail) of ``c`` split at the first ``sep``; tail is NULL when absent.

    ``get`` (not ``getItem``) keeps a missing element NULL under ANSI mode.
    """
    parts = F.split(_col(c), re.escape(sep), 2)
    return F.get(parts, 0), F.get(parts, 1)


def segment_after(url: str | Column, marker: str) -> Column:
    """Text of the path segment following ``/<marker>/``.

    First match anywhere in the string; the segment must be non-empty and be
    closed by a ``/``.  Returns ``''`` when there is no match, NULL for NULL.
    ``marker`` is literal text (regex metacharacters are escaped).
    """
    return F.regexp_extract(_col(url), f"/{re.escape(marker)}/([^/]+)/", 1)


def first_segment(url: str | Column, markers: Sequence[str]) -> Column:
    """``segment_after`` for each marker in priority order; first non-empty wins, else NULL."""
    return F.coalesce(*[F.nullif(segment_after(url, m), F.lit("")) for m in markers])


def parse_timestamp(c: str | Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Timestamp (session zone) or NULL when the text does not match ``fmt``."""
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def marker_regex(markers: Sequence[str]) -> str:
    """Regex matching ``/<marker>/<non-empty segment>/`` for any of ``markers``."""
    return "|".join(f"/{re.escape(m)}/[^/]+/" for m in markers)


def line_is_valid(
    *,
    type_markers: Sequence[str] = TYPE_MARKERS,
    level_marker: str = LEVEL_MARKER,
) -> Column:
    """Predicate over a parsed table: timestamp parsed, a type segment and a level segment present.

    Equal to "timestamp not NULL, type not NULL/empty, level not NULL/empty"
    for ``parse_lines`` output, but written so that each parse step appears
    once: when the optimizer pushes the filter below the parse projection it
    substitutes column definitions, and a filter (unlike a projection) does
    not share repeated sub-expressions.
    """
    # one regex, two look-aheads: "has a type segment" and "has a level segment"
    both = f"(?s)^(?=.*(?:{marker_regex(type_markers)}))(?=.*(?:{marker_regex([level_marker])}))"
    return F.col("timestamp").isNotNull() & F.col("url").rlike(both)


def parse_lines(
    lines: DataFrame,
    *,
    value_col: str = "value",
    sep: str = LINE_SEPARATOR,
    ts_format: str = TIMESTAMP_FORMAT,
    type_markers: Sequence[str] = TYPE_MARKERS,
    level_marker: str = LEVEL_MARKER,
) -> DataFrame:
    """Raw lines -> parsed table.

    Output columns: ``ts_str, url, value, timestamp, breakdown_type,
    breakdown_level, breakdown_level_int`` plus every other input column
    (e.g. the arrival key) unchanged.  One narrow projection: no shuffle.
    """
    head, tail = split_first(value_col, sep)
    raw = lines.select(
        F.trim(head).alias("ts_str"),
        F.trim(tail).alias("url"),
        *[F.col(c) for c in lines.columns],
    )
    return raw.withColumns(
        {
            "timestamp": parse_timestamp("ts_str", ts_format),
            "breakdown_type": first_segment("url", type_markers),
            "breakdown_level": segment_after("url", level_marker),
        }
    ).withColumn("breakdown_level_int", lenient_int("breakdown_level"))
