"""Quarantine: split parsed lines into good rows and distinct bad lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import LEVEL_MARKER, TYPE_MARKERS, line_is_valid

GOOD_COLUMNS = (
    "timestamp",
    "arrival_id",
    "breakdown_type",
    "breakdown_level",
    "breakdown_level_int",
    "url",
    "value",
)


def is_valid(*, type_markers: Sequence[str] = TYPE_MARKERS, level_marker: str = LEVEL_MARKER) -> Column:
    """Timestamp parsed, type present and non-empty, level text present and non-empty.

    The level only has to be non-empty text: a non-numeric level is a good line
    that contributes no number to level lists.  Markers must be those given
    to ``parse_lines``.
    """
    return line_is_valid(type_markers=type_markers, level_marker=level_marker)


def split_valid(
    parsed: DataFrame,
    *,
    type_markers: Sequence[str] = TYPE_MARKERS,
    level_marker: str = LEVEL_MARKER,
) -> tuple[DataFrame, DataFrame]:
    """(good, bad) from a parsed table.

    ``good`` keeps the columns of ``GOOD_COLUMNS``.  ``bad`` is the set of
    distinct line texts that are not good -- equal to "all lines EXCEPT DISTINCT
    good lines", because validity depends on the text alone.  Computing it as a
    filter + distinct needs one pass and one (partially pre-aggregated) shuffle
    of the bad lines only, instead of an anti-join that shuffles every line.
    ``coalesce(valid, false)`` sends rows whose validity is NULL to ``bad``.
    """
    ok = F.coalesce(is_valid(type_markers=type_markers, level_marker=level_marker), F.lit(False))
    good = parsed.filter(ok).select(*GOOD_COLUMNS)
    bad = parsed.filter(~ok).select("value").distinct()
    return good, bad


#: Largest stored size of the left side for which the right one is filtered by it before it is shuffled.
PREFILTER_BYTES = 24 << 20


def except_distinct(left: DataFrame, right: DataFrame, *, prefilter_bytes: int = PREFILTER_BYTES) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` does not have, by all columns in order; nulls are equal to nulls.

    Both sides are de-duplicated where they stand before anything is shuffled, so a value that
    makes up a third of a side is one row per task.  The distinct left rows are stored; while their stored size is
    under ``prefilter_bytes``, right rows that none of them can match (by a hash of the row) never reach the shuffle.
    """
    from .segments import stored_table

    if len(left.columns) != len(right.columns):
        raise ValueError("both sides need as many columns")
    names = left.columns
    right = right.toDF(*names)
    asked = stored_table(left.distinct(), "except")
    hashed = F.xxhash64(*names)
    size = asked._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(size)) <= prefilter_bytes:
        keys = asked.select(hashed.alias("_sl_hash")).distinct()
        right = right.withColumn("_sl_hash", hashed).join(F.broadcast(keys), "_sl_hash", "left_semi").drop("_sl_hash")
    sides = asked.withColumn("_sl_right", F.lit(0)).union(right.distinct().withColumn("_sl_right", F.lit(1)))
    return sides.groupBy(*names).agg(F.max("_sl_right").alias("_sl_right")).filter("_sl_right = 0").drop("_sl_right")
