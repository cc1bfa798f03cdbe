"""Dense arrival numbers: one bigint per line, 0, 1, 2, ... by file name and line, however the files are split.

A scan knows a line's file, the start of its split and its row within the task.
Lines are stored with these once; the lines of each split are counted from that table, the
counts are added up in the order of files and splits, and a line's number is its split's
first number plus its place within the split.  Splits of any size give the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Splits whose counts are added up in one task; the sums of such groups follow from their own sums.
GROUP = 4096


def split_offsets(lines: DataFrame, arrival: str = "arrival_id") -> DataFrame:
    """file, block, first_row, lines, first_number for each split of stored ``lines``, whose ``arrival`` is ``arrival_key()``.

    The table has a row per split.  Splits are ranked in one sorted pass over it, and their counts
    are added up in groups of GROUP splits and then over the groups, so no window holds them all.
    """
    key = F.col(arrival)
    counts = lines.groupBy(key["file"].alias("file"), key["block"].alias("block")).agg(
        F.min(key["row"]).alias("first_row"), F.count(F.lit(1)).alias("lines"))
    from ..operators.segments import ordinal, stored_table

    ranked = stored_table(ordinal(counts, ("file", "block"), col="rank", rows_per_bucket=GROUP * GROUP), "splits")
    ranked = ranked.withColumn("part", F.expr(f"(rank - 1) div {GROUP}"))
    within = Window.partitionBy("part").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranked.groupBy("part").agg(F.sum("lines").alias("part_lines"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per GROUP splits
    parts = parts.select("part", F.coalesce(F.sum("part_lines").over(before), F.lit(0)).alias("part_first"))
    out = ranked.withColumn("inside", F.coalesce(F.sum("lines").over(within), F.lit(0))).join(parts, "part")
    return out.select("file", "block", "first_row", "lines", (F.col("part_first") + F.col("inside")).alias("first_number"))


def dense_numbers(lines: DataFrame, splits: DataFrame, arrival: str = "arrival_id") -> DataFrame:
    """``lines`` with ``arrival`` as a dense bigint; ``splits`` is the stored result of :func:`split_offsets`.

    The planner broadcasts the splits while their stored size allows it.
    """
    names = lines.columns
    key = F.col(arrival)
    known = splits.select(F.col("file").alias("_sl_file"), F.col("block").alias("_sl_block"), "first_row", "first_number")
    joined = lines.join(known, (key["file"] == F.col("_sl_file")) & (key["block"] == F.col("_sl_block")))
    number: Column = F.col("first_number") + key["row"] - F.col("first_row")
    return joined.withColumn(arrival, number).select(*names)


__all__ = ["dense_numbers", "split_offsets"]
