"""Distinct levels as bitmaps: a state of bounded size per type and bucket, mergeable across tasks, stages and parts.

``collect_set`` holds every level of a type in one state.  Here a level sets a bit in
the 32,768-bit bitmap of its bucket, so a partial state is 4 KB for each (type, bucket) that occurs, and
states of parts merge by OR.  Levels may be negative.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import join_ints

#: Bits of one bitmap (Spark's).
BITS = 32_768


def level_bitmaps(rows: DataFrame, level_col: str = "breakdown_level_int", by: Sequence[str] = ("breakdown_type",)) -> DataFrame:
    """``by``, bucket, bitmap of the distinct non-null levels; groups without any level have one row with null bucket and bitmap."""
    level = F.col(level_col).cast("bigint")
    keyed = rows.select(*by, F.bitmap_bucket_number(level).alias("bucket"), F.bitmap_bit_position(level).alias("_sl_bit"))
    # bitmap_construct_agg skips nulls, and their bucket is null
    maps = keyed.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("_sl_bit").alias("bitmap"))
    return maps.withColumn("bitmap", F.when(F.col("bucket").isNotNull(), F.col("bitmap")))


def merge_bitmaps(*states: DataFrame) -> DataFrame:
    """The bitmaps of several parts together."""
    rows = states[0]
    for more in states[1:]:
        rows = rows.unionByName(more)
    by = [c for c in rows.columns if c not in ("bucket", "bitmap")]
    merged = rows.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.withColumn("bitmap", F.when(F.col("bucket").isNotNull(), F.col("bitmap")))


def _levels(bucket: Column, bitmap: Column) -> Column:
    """The levels of one bitmap: its set bits, byte by byte."""
    byte = lambda i: F.conv(F.hex(F.substring(bitmap, i + 1, F.lit(1))), 16, 10).cast("int")
    full = F.filter(F.sequence(F.lit(0), F.lit(BITS // 8 - 1)), lambda i: byte(i) != 0)
    bits = lambda i: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(7)), lambda k: F.call_function("shiftright", byte(i), k).bitwiseAND(F.lit(1)) == 1), lambda k: i * 8 + k)
    value = lambda p: F.when(bucket > 0, (bucket - 1) * BITS + p + 1).otherwise(bucket * BITS - p)
    return F.transform(F.flatten(F.transform(full, bits)), lambda p: value(p.cast("bigint")))


def bitmap_levels(state: DataFrame, out: str = "levels") -> DataFrame:
    """``by`` and the ascending distinct levels (bigint array, empty where there are none)."""
    by = [c for c in state.columns if c not in ("bucket", "bitmap")]
    found = state.select(*by, F.coalesce(_levels(F.col("bucket"), F.col("bitmap")), F.array().cast("array<bigint>")).alias("_sl_levels"))
    return found.groupBy(*by).agg(F.array_sort(F.flatten(F.collect_list("_sl_levels"))).alias(out))


def type_levels_by_bitmaps(rows: DataFrame, level_col: str = "breakdown_level_int") -> DataFrame:
    """``reports.type_levels_by_rows`` from bitmaps: breakdown_type, distinct_levels_str."""
    return bitmap_levels(level_bitmaps(rows, level_col)).select("breakdown_type", join_ints(F.col("levels")).alias("distinct_levels_str"))


__all__ = ["bitmap_levels", "level_bitmaps", "merge_bitmaps", "type_levels_by_bitmaps"]
