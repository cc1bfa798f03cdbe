"""Run states: what a part of a log (a day, say) contributes to the run reports, mergeable with other parts.

The state of a part has a row per run of the part: its number, value, length
and levels, and the order keys of its first and last row.  States of parts that follow one another merge into the
state of the whole: runs that meet at an edge become one, all others
only get another number.  Merging is associative, so parts can be merged in
any grouping -- days to months, months to years -- and a new part of a log
costs the work on its own rows and on the edges, never on the rows of the parts before it.

The per-type side has states of its own: counts, first and last times and level sets, which simply add up.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import in_order, join_ints
from ..sinks.versions import Files, Versions
from .reports import ORDER, span_table, type_summary
from .segments import DEFAULT_ROWS_PER_BUCKET, RANGE, _across_ranges, run_pieces, stored_table

_P = "_sl_"


class PartsOverlap(ValueError):
    """Two parts hold rows of the same stretch of the order, so their runs cannot be joined at edges."""


def run_state(
    rows: DataFrame,
    *,
    order_by: Sequence[str] = ORDER,
    type_col: str = "breakdown_type",
    level_col: str = "breakdown_level_int",
    partition_by: Sequence[str] = (),
    bucketed: bool = True,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    ranges: str | None = None,
) -> DataFrame:
    """The state of one part: partition columns, run_id (from 1), Breakdown_Type, Count_Successive, Breakdowns_Level, run_start, first_key, last_key.

    A large part is cut into ranges like any other timeline (see ``segments``).
    """
    part = list(partition_by)
    cols = list(dict.fromkeys([*part, *order_by, type_col, level_col, *([ranges] if ranges else [])]))
    key = F.struct(*order_by)
    aggs = {
        "run_start": F.min(order_by[0]), "first_key": F.min(key), "last_key": F.max(key),
        "levels": join_ints(in_order(F.col(level_col), *[F.col(c) for c in order_by])),
    }
    pieces = run_pieces(rows.select(*cols), order_by, type_col, aggs, part, bucketed=bucketed, rows_per_bucket=rows_per_bucket, ranges=ranges)
    return _joined(pieces.withColumnsRenamed({type_col: "Breakdown_Type", f"{_P}count": "Count_Successive", "levels": "Breakdowns_Level"}), part)


def _joined(pieces: DataFrame, part: Sequence[str]) -> DataFrame:
    """Pieces of runs, told apart by the range they stand in, put together to whole runs."""
    lists = F.array_sort(F.collect_list(F.struct(RANGE, "Breakdowns_Level")))
    return pieces.groupBy(*part, "run_id", "Breakdown_Type").agg(
        F.sum("Count_Successive").alias("Count_Successive"),
        F.array_join(F.filter(lists["Breakdowns_Level"], lambda x: x != ""), ",").alias("Breakdowns_Level"),
        F.min("run_start").alias("run_start"), F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"),
    )


def merge_states(states: Sequence[DataFrame], partition_by: Sequence[str] = ()) -> DataFrame:
    """The state of all parts together, in the order of their keys; the order they are given in does not matter.

    Edges are one row per part and partition.  Only runs that meet another part's run are grouped again; the rest pass
    through with a new number.  Parts that overlap in a partition raise PartsOverlap.
    """
    part = list(partition_by)
    if not states:
        raise ValueError("no state to merge")
    names = states[0].columns
    rows = reduce(lambda a, b: a.unionByName(b), [s.withColumn(f"{_P}part", F.lit(i)) for i, s in enumerate(states)])
    edges = rows.groupBy(*part, f"{_P}part").agg(
        F.max("run_id").alias(f"{_P}n"), F.max_by("Count_Successive", "run_id").alias(f"{_P}tail"),
        F.min_by(F.struct("Breakdown_Type"), "run_id").alias(f"{_P}first_chg"), F.max_by(F.struct("Breakdown_Type"), "run_id").alias(f"{_P}last"),
        F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"),
    )
    along = Window.partitionBy(*part).orderBy("first_key", "last_key")
    edges = stored_table(edges.withColumns({RANGE: F.row_number().over(along), f"{_P}reach": F.lag("last_key").over(along)}), "part-edges")
    clash = edges.filter(F.col("first_key") <= F.col(f"{_P}reach")).limit(1).collect()
    if clash:
        raise PartsOverlap(f"part {clash[0][f'{_P}part']} begins at {clash[0]['first_key']}, before the end of the part before it at {clash[0][f'{_P}reach']}")
    joined = _across_ranges(edges.drop("first_key", "last_key", f"{_P}reach"), part, by_change=True)
    follows = F.coalesce(F.lead(f"{_P}cont").over(Window.partitionBy(*part).orderBy(RANGE)), F.lit(0))
    known = joined.select(*part, f"{_P}part", RANGE, f"{_P}off", f"{_P}cont", follows.alias(f"{_P}next"))
    runs_of = edges.select(*part, f"{_P}part", F.col(f"{_P}n").alias(f"{_P}runs"), F.col(RANGE).alias(f"{_P}place"))
    # null keys of a partition match themselves
    same = lambda left, right: reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in part], left[f"{_P}part"] == right[f"{_P}part"])
    edge = stored_table(
        runs_of.join(known, same(runs_of, known), "left").select(
            *[runs_of[c] for c in part], runs_of[f"{_P}part"], f"{_P}runs", f"{_P}place", *(F.coalesce(f"{_P}{c}", F.lit(0)).alias(f"{_P}{c}") for c in ("off", "cont", "next"))),
        "edges")
    out = rows.join(edge, same(rows, edge)).select(
        *[rows[c] for c in part], F.col(f"{_P}place").alias(RANGE), (rows["run_id"] + F.col(f"{_P}off") - F.col(f"{_P}cont")).cast("bigint").alias("run_id"),
        "Breakdown_Type", "Count_Successive", "Breakdowns_Level", "run_start", "first_key", "last_key",
        ((rows["run_id"] == 1) & (F.col(f"{_P}cont") == 1) | (rows["run_id"] == F.col(f"{_P}runs")) & (F.col(f"{_P}next") == 1)).alias(f"{_P}meets"),
    )
    return out.filter(~F.col(f"{_P}meets")).select(*names).unionByName(_joined(out.filter(f"{_P}meets"), part).select(*names))


def merge_spans(states: Sequence[DataFrame]) -> DataFrame:
    """``span_table`` of all parts from the span tables of each."""
    rows = reduce(lambda a, b: a.unionByName(b), states)
    return rows.groupBy("breakdown_type", "run_id").agg(
        F.sum("run_length").alias("run_length"), F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("levels_in_run_int")))).alias("levels_in_run_int"),
    )


class RunStates:
    """Stored states of the parts of one log: add or replace a part, merge parts into larger ones, read the reports.

    Every part is a versioned folder (see ``sinks.versions``), so a part that is being replaced stays readable
    until its new state is whole.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._files = spark, path.rstrip("/"), Files(spark, path)

    def _part(self, name: str) -> Versions:
        return Versions(self.spark, f"{self.path}/part={name}")

    def parts(self) -> list[str]:
        """Parts that have a whole state and have not been merged into another."""
        found = {n.removeprefix("part="): self._part(n.removeprefix("part=")).current() for n in self._files.names() if n.startswith("part=")}
        merged = {old for now in found.values() if now for old in now["notes"].get("merges", ())}
        return sorted(n for n, now in found.items() if now and n not in merged)

    def add(self, name: str, good: DataFrame, **kw) -> None:
        """Compute and store the state of a part's good rows; a part of that name is replaced."""
        def save(folder: str) -> None:
            run_state(good, **kw).write.parquet(f"{folder}/runs")
            span_table(good).write.parquet(f"{folder}/spans")

        self._part(name).publish(save)

    def _read(self, name: str, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._part(name).folder()}/{table}")

    def compact(self, names: Sequence[str], into: str) -> None:
        """Merge parts into one; later reads take it in their place."""
        def save(folder: str) -> None:
            merge_states([self._read(n, "runs") for n in names]).write.parquet(f"{folder}/runs")
            merge_spans([self._read(n, "spans") for n in names]).write.parquet(f"{folder}/spans")

        self._part(into).publish(save, {"merges": sorted(names)})

    def timeline(self) -> DataFrame:
        """The timeline report of all parts (``reports.timeline_runs``)."""
        whole = merge_states([self._read(n, "runs") for n in self.parts()])
        return whole.orderBy("run_id").select("Breakdown_Type", "Count_Successive", "Breakdowns_Level")

    def summary(self) -> DataFrame:
        """The per-type summary of all parts (``reports.type_summary``)."""
        return type_summary(merge_spans([self._read(n, "spans") for n in self.parts()]))
