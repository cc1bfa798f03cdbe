"""Cuts of an ordered table into ranges from a sketch of its keys, made in the pass that counts the rows.

The first order column, as a number, goes into a KLL sketch: a mergeable summary
whose quantiles are the cuts.  So a table that has to be computed (parsed lines, say) is
read once for its count and its cuts, where Spark's range partitioner would count, then sample, then read it.
A value that fills several quantiles is a heavy tie; its rows are cut by the second order column, from a
sketch of those rows alone.  Keys that are no numbers, or ties that two columns do
not break, are left to the range partitioner (:func:`streakline.operators.segments.cut_in_order`).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Size of a sketch: ranks are good to about 0.1 % of the rows.
SKETCH_SIZE = 4096
#: Ranges cut from one sketch; more are cut from a sketch of each of them.
MOST_RANGES = 256
#: Ranks that a sketch is asked for.
GRID = 1024
#: What null counts as: no number is lower.
NULL_NUMBER = -(1 << 63)
#: Values compared one by one when a key looks for its range.
FAN = 32


def order_number(df: DataFrame, column: str) -> Column | None:
    """A bigint that orders like ``column`` (null first), or None where its type has no such number."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        number = c.cast("bigint")
    elif isinstance(kind, T.BooleanType):
        number = c.cast("int").cast("bigint")
    elif isinstance(kind, T.DateType):
        number = F.unix_date(c).cast("bigint")
    elif isinstance(kind, T.TimestampType):
        number = F.unix_micros(c)
    elif isinstance(kind, T.TimestampNTZType):
        number = F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{column}`)")
    elif isinstance(kind, T.DecimalType) and kind.precision <= 18:
        number = (c * F.lit(10**kind.scale)).cast("bigint")
    else:
        return None
    return F.coalesce(number, F.lit(NULL_NUMBER))


@dataclass(frozen=True)
class KeySketch:
    """Number of rows and the sketch of a number over them; sketches of parts merge to that of the whole."""

    rows: int
    sketch: bytes

    @staticmethod
    def columns(number: Column, size: int = SKETCH_SIZE) -> list[Column]:
        """The aggregates that make one: ``rows`` and ``sketch``."""
        return [F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_bigint(number, F.lit(size)).alias("sketch")]

    @classmethod
    def of(cls, df: DataFrame, column: str) -> KeySketch:
        return cls(*df.agg(*cls.columns(order_number(df, column))).first())

    def merge(self, other: KeySketch, spark) -> KeySketch:
        both = spark.createDataFrame([(bytearray(self.sketch), bytearray(other.sketch))], "a binary, b binary")
        return KeySketch(self.rows + other.rows, bytes(both.select(F.kll_sketch_merge_bigint("a", "b")).first()[0]))

    def quantiles(self, n: int, spark) -> list[int]:
        """The numbers that end the first 1 / n, 2 / n, ... of the rows."""
        one = spark.createDataFrame([(bytearray(self.sketch),)], "sketch binary")
        return one.select(quantiles(F.col("sketch"), F.lit(n))).first()[0] if n > 1 and self.rows else []


def quantiles(sketch: Column, n: Column) -> Column:
    """Array of the numbers that end the first 1 / n, 2 / n, ... (n - 1) / n of the rows, to 1 / GRID of them (empty for one range)."""
    ranks = F.expr("array(" + ", ".join(f"{j / GRID!r}D" for j in range(1, GRID)) + ")")
    grid = F.kll_sketch_get_quantile_bigint(sketch, ranks)
    picked = lambda all_: F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.element_at(all_, F.round(i * GRID / n).cast("int")))
    return F.when(n > 1, F.element_at(F.transform(F.array(grid), picked), 1)).otherwise(F.array().cast("array<bigint>"))


def _longs(values: Sequence[int]) -> Column:
    """A literal array, made in one call."""
    return F.expr("cast(array(" + ", ".join(f"{v}L" if v > NULL_NUMBER else f"bigint('{v}')" for v in values) + ") as array<bigint>)")


def count_below(values: Sequence[int], key: Column) -> Column:
    """How many of the ascending ``values`` are below ``key``, by a search in a tree of arrays."""
    all_ = _longs(values)
    if len(values) <= 2 * FAN:
        return F.size(F.filter(all_, lambda v: v < key))
    leaf = lambda j: j * FAN + F.size(F.filter(F.slice(all_, j * FAN + 1, FAN), lambda v: v < key))
    return F.element_at(F.transform(F.array(count_below(values[FAN - 1 :: FAN], key)), leaf), 1)


def _ranges_for(rows: Column, per_range: int) -> Column:
    return F.least(F.ceil(rows / F.lit(per_range)), F.lit(MOST_RANGES)).cast("int")


def _cut_whole(df: DataFrame, order_by: Sequence[str], rows_per_bucket: int, per_range: int) -> tuple[int, Column | None]:
    """Rows of ``df``, and the range of a row (None: nothing to cut, or this cannot cut it)."""
    first = order_number(df, order_by[0])
    one = df.agg(*KeySketch.columns(first)).select("rows", quantiles(F.col("sketch"), _ranges_for(F.col("rows"), per_range)).alias("cuts")).first()
    if one["rows"] <= rows_per_bucket:
        return one["rows"], None
    cuts = one["cuts"]
    if one["rows"] > per_range * MOST_RANGES:  # sketches of the first ranges
        inside = df.groupBy(count_below(sorted(set(cuts)), first).alias("range")).agg(*KeySketch.columns(first))
        more = inside.select(quantiles(F.col("sketch"), _ranges_for(F.col("rows"), per_range)).alias("cuts")).collect()
        cuts = sorted([*cuts, *(c for r in more for c in r["cuts"])])
    heavy = sorted({a for a, b in zip(cuts, cuts[1:]) if a == b})
    ends = sorted({*cuts, *(v - 1 for v in heavy if v > NULL_NUMBER)})
    place = count_below(ends, first)
    if not heavy:
        return one["rows"], place
    second = order_number(df, order_by[1]) if len(order_by) > 1 else None
    if second is None:
        return one["rows"], None
    rows = df.filter(first.isin(heavy)).groupBy(first.alias("value")).agg(*KeySketch.columns(second))
    inner = {r["value"]: r["cuts"] for r in rows.select("value", quantiles(F.col("sketch"), _ranges_for(F.col("rows"), per_range)).alias("cuts")).collect()}
    if any(len(set(c)) < len(c) for c in inner.values()):
        return one["rows"], None
    # a heavy value's own ranges come in between: their numbers move up all that follow
    moved, number = [], 0
    for k in range(len(ends) + 1):
        moved.append(k + number)
        number += len(inner.get(ends[k], ())) if k < len(ends) else 0
    known = F.create_map(*[x for v, c in inner.items() for x in (F.lit(v), _longs(c))])
    within = F.coalesce(F.size(F.filter(F.try_element_at(known, first), lambda c: c < second)), F.lit(0))
    return one["rows"], F.element_at(_longs(moved), place + 1) + F.greatest(within, F.lit(0))


def _cut_parts(df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str], rows_per_bucket: int, per_range: int, name: str) -> tuple[int, DataFrame | None]:
    """Rows of ``df`` if some partition is to be cut (else 0), and ``df`` with the range of each row within its partition, or None."""
    from .segments import stored_table

    rows, key = f"{name}_rows", [F.col(f"`{c}`") for c in partition_by]
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias(rows))
    largest, total = counts.agg(F.max(rows), F.sum(rows)).first()
    if (largest or 0) <= rows_per_bucket:
        return 0, None
    if largest > per_range * MOST_RANGES:
        return total, None
    first = order_number(df, order_by[0])
    names = [f"{name}_k{i}" for i in range(len(partition_by))]
    hot = counts.filter(F.col(rows) > rows_per_bucket).select(*[c.alias(n) for c, n in zip(key, names)])
    same = lambda left, right: [left[c].eqNullSafe(right[n]) for c, n in zip(partition_by, names)]
    sketched = df.join(hot, same(df, hot), "left_semi").groupBy(*key).agg(*KeySketch.columns(first))
    n = _ranges_for(F.col("rows"), per_range)
    cuts = stored_table(sketched.select(*[c.alias(k) for c, k in zip(key, names)], quantiles(F.col("sketch"), n).alias(f"{name}_cuts")), "cuts")
    if cuts.filter(F.size(F.array_distinct(f"{name}_cuts")) < F.size(f"{name}_cuts")).limit(1).count():
        return total, None
    out = df.join(cuts, same(df, cuts), "left")
    place = F.coalesce(F.size(F.filter(f"{name}_cuts", lambda c: c < first)), F.lit(0))
    return total, out.withColumn(name, F.greatest(place, F.lit(0))).drop(*names, f"{name}_cuts")


def cut_by_sketch(
    df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str], name: str, *, rows_per_bucket: int, per_range: int
) -> tuple[int, DataFrame | None]:
    """(rows, ``df`` with the number of each row's range as column ``name``) for partitions of more than ``rows_per_bucket`` rows.

    Rows are 0 when nothing needs to be cut; the table is None when it does but this way cannot do it (see the module
    docstring).  Ranges are aimed at ``per_range`` rows.  Numbers rise along ``order_by`` within a partition.
    """
    if order_number(df, order_by[0]) is None:
        counted = df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias(f"{name}_rows")).agg(F.max(f"{name}_rows"), F.sum(f"{name}_rows")).first() if partition_by else [df.count()] * 2
        return (counted[1] if (counted[0] or 0) > rows_per_bucket else 0), None
    if partition_by:
        return _cut_parts(df, order_by, partition_by, rows_per_bucket, per_range, name)
    rows, place = _cut_whole(df, order_by, rows_per_bucket, per_range)
    if rows <= rows_per_bucket:
        return 0, None
    return rows, None if place is None else df.withColumn(name, place)
