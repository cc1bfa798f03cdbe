"""Run segmentation ("gaps and islands") over an ordered table.

Inside each partition (``partition_by``; none = the whole table) rows are put
in ``order_by`` order.  A run starts on the first row of a partition and
wherever one of the ``change_on`` columns differs (NULL-safe) from the previous
row.  Added columns:

* ``is_new_run`` int 0/1 -- the run-start flag;
* ``run_id`` bigint -- running count of starts, so 1, 1, 2, 2, 2, 3 ...;
* one ``lag`` column per entry of ``lag_of`` -- the previous row's value;
* optionally the row's position in its run (``position``), from 1.

With ``change_on=()`` there is one run per partition ("span" semantics: the
flag is 1 only on the partition's first row).

Two physical forms, same result:

* **plain**: one window ``PARTITION BY partition_by ORDER BY order_by``, used
  when no partition has more than ``rows_per_bucket`` rows;
* **bucketed**: the rows are cut into contiguous ranges of
  ``order_by``, by a sketch of its keys that the counting pass makes (``cuts``) or
  else by Spark's range partitioner, whatever the keys'
  types, and the window runs per partition and range.  Runs are then joined up
  across the ranges by a table of one row per range of a cut partition: its
  first and last change values and lag values, its run count and the length of
  its last run.

The range partitioner's range of a row follows from its partition and its place there in order.  That
number is only good within one job, so the job that assigns it writes the rows
with their ranges (and whatever was computed per range) to the shared folder,
and everything else reads that table.  A stored table that already carries range
numbers along its order (``ranges``; see :func:`cut_in_order`) is used as it is.
Should a sketch leave a range above ``rows_per_bucket``, the rows are
cut by the range partitioner, which adds a row number to ``order_by``, so that equal keys are cut, too.  Helper columns begin with ``_sl_``; inputs must not use that prefix.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .cuts import cut_by_sketch

#: Largest range (rows) of a partition that one window task handles; partitions above are cut.
DEFAULT_ROWS_PER_BUCKET = 4_000_000
#: Ranges are aimed at this part of ``rows_per_bucket``, since the bounds of a sketch are only about even.
AIM = 0.5
#: Rows that a task of the range partitioner is aimed at when ranges are shorter than that.
TASK_ROWS = 500_000

_P = "_sl_"  # prefix of helper columns
RANGE = f"{_P}range"
ROW = f"{_P}row_number"


def _nullsafe_differs(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return reduce(lambda x, y: x | y, [~x.eqNullSafe(y) for x, y in zip(a, b)], F.lit(False))


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back with its schema."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_in_order(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    *,
    rows: int,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    then: Callable[[DataFrame], DataFrame] = lambda cut: cut,
    store: Callable[[DataFrame], DataFrame] = lambda out: stored_table(out, "ranges"),
) -> DataFrame:
    """``then(df with its range number)``, stored by ``store``; range numbers never decrease along ``(partition_by, order_by)``.

    A task of the range partitioner holds many small ranges: it sorts its rows and numbers them, and every ``AIM * rows_per_bucket``
    numbers are a range.  So tasks and the key samples that the driver gets follow TASK_ROWS, however short the ranges, and no range is too large.
    """
    keys, per_range = [*partition_by, *order_by, ROW], max(1, int(AIM * rows_per_bucket))
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(math.ceil(rows / max(TASK_ROWS, per_range)), min(math.ceil(rows / per_range), shuffles))
    numbered = df.withColumn(ROW, F.monotonically_increasing_id())  # rows of equal keys have no order of their own, and any one will do
    cut = numbered.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return store(then(cut.withColumn(RANGE, F.expr(f"monotonically_increasing_id() div {per_range}")).drop(ROW)))


def cut_and_store(
    df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str], rows_per_bucket: int,
    then: Callable[[DataFrame], DataFrame], in_range: Column | None = None,
) -> DataFrame | None:
    """``then(df with its range number)``, stored; None when no partition has more than ``rows_per_bucket`` rows."""
    rows, cut = cut_by_sketch(df, order_by, partition_by, RANGE, rows_per_bucket=rows_per_bucket, per_range=max(1, int(AIM * rows_per_bucket)))
    if not rows:
        return None
    if cut is not None:
        out = stored_table(then(cut), "ranges")
        counted = F.sum(F.lit(1) if in_range is None else in_range).alias(f"{_P}n")
        if (out.groupBy(*partition_by, RANGE).agg(counted).agg(F.max(f"{_P}n")).first()[0] or 0) <= rows_per_bucket:
            return out
    return cut_in_order(df, order_by, partition_by, rows=rows, rows_per_bucket=rows_per_bucket, then=then)


def _join_ranges(big: DataFrame, small: DataFrame, part: Sequence[str]) -> DataFrame:
    """Left join a table of one row per range of a cut partition; its stored size lets the planner choose the join."""
    keys = [*part, RANGE]
    renamed = small.select(*[F.col(k).alias(f"{_P}k{i}") for i, k in enumerate(keys)], *[c for c in small.columns if c not in keys])
    same = [big[k].eqNullSafe(renamed[f"{_P}k{i}"]) for i, k in enumerate(part)] + [big[RANGE] == renamed[f"{_P}k{len(part)}"]]
    return big.join(renamed, reduce(lambda a, b: a & b, same), "left").drop(*[f"{_P}k{i}" for i in range(len(keys))])


def _across_ranges(edges: DataFrame, part: Sequence[str], by_change: bool) -> DataFrame:
    """Range edges (n runs, tail = rows of the last one, first and last change values) to what each range takes over.

    Adds ``_sl_cont`` 0/1 (its first run goes on from the range before),
    ``_sl_off`` (runs that ended up before its own), ``_sl_carried`` (rows of the
    run it goes on with).  Only partitions of several ranges are kept.
    """
    along = Window.partitionBy(*part).orderBy(RANGE)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    later = F.lag(F.lit(1)).over(along).isNotNull()
    goes_on = later & F.lag(f"{_P}last").over(along).eqNullSafe(F.col(f"{_P}first_chg")) if by_change else later
    out = edges.withColumn(f"{_P}parts", F.count("*").over(Window.partitionBy(*part))).filter(F.col(f"{_P}parts") > 1)
    out = out.withColumn(f"{_P}cont", F.when(goes_on, 1).otherwise(0))
    out = out.withColumn(f"{_P}off", F.coalesce(F.sum(F.col(f"{_P}n") - F.col(f"{_P}cont")).over(before), F.lit(0)))
    # the last runs of ranges belong together while ranges are one run that goes on
    fresh = F.when((F.col(f"{_P}n") > 1) | (F.col(f"{_P}cont") == 0), 1).otherwise(0)
    out = out.withColumn(f"{_P}tails", F.sum(fresh).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    chain = Window.partitionBy(*part, f"{_P}tails").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumn(f"{_P}sofar", F.sum(f"{_P}tail").over(chain))
    carried = F.when(F.col(f"{_P}cont") == 1, F.lag(f"{_P}sofar").over(along)).otherwise(0)
    return out.withColumn(f"{_P}carried", carried).drop(f"{_P}tails", f"{_P}sofar", f"{_P}parts", f"{_P}tail", f"{_P}n")


def _windowed(df: DataFrame, keys: Sequence[str], order_by, change_on, lag_of, every_row: bool) -> DataFrame:
    """Flags, run numbers, positions and lags within each group of ``keys`` (one sort)."""
    w = Window.partitionBy(*keys).orderBy(*order_by)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = F.row_number().over(w)
    changed = F.lit(True) if every_row else _nullsafe_differs([F.lag(c).over(w) for c in change_on], [F.col(c) for c in change_on])
    out = df.withColumns({
        **{f"{_P}lag{i}": F.lag(v).over(w) for i, v in enumerate(lag_of.values())},
        f"{_P}row": row,
        f"{_P}flag": F.when((row == 1) | changed, 1).otherwise(0),
    })
    return out.withColumns({
        f"{_P}run": F.sum(f"{_P}flag").over(running),
        f"{_P}pos": F.col(f"{_P}row") - F.max(F.when(F.col(f"{_P}flag") == 1, F.col(f"{_P}row"))).over(running) + 1,
    })


def segment_runs(
    df: DataFrame,
    order_by: Sequence[str],
    change_on: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    lag_of: Mapping[str, str] | None = None,
    *,
    flag_col: str = "is_new_run",
    run_col: str = "run_id",
    position: str | None = None,
    bucketed: bool = True,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    ranges: str | None = None,
    every_row: bool = False,
) -> DataFrame:
    """Add run flag, run id and lag columns; see the module docstring.

    ``order_by`` must be a total order inside a partition (end it with a unique
    key), otherwise ties make the result depend on the shuffle.
    ``lag_of`` maps output column -> source column, e.g. ``{"prev_ts": "timestamp"}``.
    ``ranges`` names a column of range numbers that a stored ``df`` already has.
    ``every_row`` starts a run on every row.  ``bucketed=False`` forces the plain window.
    """
    lag_of, part = dict(lag_of or {}), list(partition_by)
    names = [*df.columns, *lag_of, flag_col, run_col, *([position] if position else [])]
    window = lambda frame, keys: _windowed(frame, keys, order_by, change_on, lag_of, every_row)

    if ranges is not None:
        local = window(df.withColumn(RANGE, F.col(ranges)), [*part, RANGE])
    else:
        local = cut_and_store(df, order_by, part, rows_per_bucket, lambda cut: window(cut, [*part, RANGE])) if bucketed else None
        if local is None:
            out = window(df, part).withColumns({
                **{k: F.col(f"{_P}lag{i}") for i, k in enumerate(lag_of)},
                flag_col: F.col(f"{_P}flag"), run_col: F.col(f"{_P}run"), **({position: F.col(f"{_P}pos")} if position else {}),
            })
            return out.select(*names)

    order = F.struct(*order_by)
    change = F.struct(*change_on) if change_on else F.struct(F.lit(0))
    edges = local.groupBy(*part, RANGE).agg(
        F.max(f"{_P}run").alias(f"{_P}n"),
        F.max_by(f"{_P}pos", f"{_P}row").alias(f"{_P}tail"),
        F.min_by(change, order).alias(f"{_P}first_chg"),
        F.max_by(change, order).alias(f"{_P}last"),
        F.max_by(F.struct(*[F.col(v).alias(f"_{i}") for i, v in enumerate(lag_of.values())], F.lit(0)), order).alias(f"{_P}lags"),
    )
    if every_row:
        edges = edges.withColumns({f"{_P}first_chg": F.lit(0), f"{_P}last": F.lit(1)})
    edges = _across_ranges(edges, part, by_change=bool(change_on) or every_row)
    edges = edges.withColumn(f"{_P}prev", F.lag(f"{_P}lags").over(Window.partitionBy(*part).orderBy(RANGE)))
    edges = stored_table(edges.drop(f"{_P}lags", f"{_P}first_chg", f"{_P}last"), "range-edges")

    out = _join_ranges(local, edges, part)
    known = lambda c: F.coalesce(F.col(f"{_P}{c}"), F.lit(0))
    at_edge = (F.col(f"{_P}row") == 1) & F.col(f"{_P}cont").isNotNull()
    in_first = F.col(f"{_P}run") == 1
    return out.withColumns({
        **{k: F.when(at_edge, F.col(f"{_P}prev")[f"_{i}"]).otherwise(F.col(f"{_P}lag{i}")) for i, k in enumerate(lag_of)},
        flag_col: F.when(at_edge, 1 - F.col(f"{_P}cont")).otherwise(F.col(f"{_P}flag")),
        run_col: (F.col(f"{_P}run") + known("off") - known("cont")).cast("long"),
        **({position: (F.col(f"{_P}pos") + F.when(in_first, known("carried")).otherwise(0)).cast("long")} if position else {}),
    }).select(*names)


def ordinal(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    *,
    col: str = "position",
    bucketed: bool = True,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
) -> DataFrame:
    """1-based position of each row in ``order_by`` order, 1..N also where the order has ties.

    A segmentation where every row starts a run, computed range by range for a large input.
    """
    flag = f"{_P}pos_flag"
    return segment_runs(df, order_by, partition_by=partition_by, flag_col=flag, run_col=col, every_row=True,
                        bucketed=bucketed, rows_per_bucket=rows_per_bucket).drop(flag)


def run_pieces(
    df: DataFrame,
    order_by: Sequence[str],
    change_on: str,
    aggs: Mapping[str, Column],
    partition_by: Sequence[str] = (),
    *,
    bucketed: bool = True,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    ranges: str | None = None,
) -> DataFrame:
    """One row per run and range: partition columns, ``_sl_range``, ``run_id``, ``change_on``, ``_sl_count`` and ``aggs`` of its rows.

    The aggregation sits right above the window and groups by the window's own
    keys, so the rows are not shuffled again.
    """
    part = list(partition_by)

    def local(cut: DataFrame) -> DataFrame:
        seg = _windowed(cut, [*part, RANGE], order_by, (change_on,), {}, False)
        return seg.groupBy(*part, RANGE, F.col(f"{_P}run").alias(f"{_P}run"), change_on).agg(
            F.count("*").alias(f"{_P}count"), *[c.alias(k) for k, c in aggs.items()]
        )

    if ranges is not None:
        pieces = stored_table(local(df.withColumn(RANGE, F.col(ranges))), "pieces")
    else:
        pieces = cut_and_store(df, order_by, part, rows_per_bucket, local, F.col(f"{_P}count")) if bucketed else None
        if pieces is None:
            return local(df.withColumn(RANGE, F.lit(0))).withColumnRenamed(f"{_P}run", "run_id")
    value = F.struct(change_on)
    edges = pieces.groupBy(*part, RANGE).agg(
        F.max(f"{_P}run").alias(f"{_P}n"), F.max_by(f"{_P}count", f"{_P}run").alias(f"{_P}tail"),
        F.min_by(value, f"{_P}run").alias(f"{_P}first_chg"), F.max_by(value, f"{_P}run").alias(f"{_P}last"),
    )
    edges = stored_table(_across_ranges(edges, part, by_change=True).drop(f"{_P}first_chg", f"{_P}last"), "range-edges")
    out = _join_ranges(pieces, edges, part)
    run = F.col(f"{_P}run") + F.coalesce(F.col(f"{_P}off"), F.lit(0)) - F.coalesce(F.col(f"{_P}cont"), F.lit(0))
    return out.withColumn("run_id", run.cast("long")).select(*part, RANGE, "run_id", change_on, f"{_P}count", *aggs)
