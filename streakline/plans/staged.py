"""Restartable stages over a shared stage folder, and the one-shot job built from them.

Stages (each reads only what the previous one wrote, so a failed stage is
simply re-run):

=========  ===========================  ============================================
stage      reads                        writes
=========  ===========================  ============================================
read       text logs                    ``lines/quality=good|bad`` Parquet; bad-line texts
sort       ``lines/quality=good``       ``sorted`` (range-sorted by time, arrival; range numbers)
compute    ``sorted`` (or good lines)   ``ordered``, ``runs``, ``summary`` Parquet
save       ``summary, runs, ordered``   final / exo_output / runs / exo_runs_output CSV
=========  ===========================  ============================================

The read stage parses every line once and writes good and bad rows in one
job, partitioned by a ``quality`` column; later reads prune to one partition.
With ``order="dense"`` it also counts the lines of each split, and arrival ids are
dense bigints (see ``sources.numbering``).

Every stage leaves a manifest when it is complete (see ``manifests``).  A stage
whose predecessor has none, or other files than it lists, is refused
(``StageIncomplete``); ``skip_done`` leaves out a stage that is complete for the same input and parameters.
"""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import join_ints, parse_lines
from ..operators import (
    GOOD_COLUMNS,
    cut_in_order,
    is_valid,
    span_table,
    timeline_run_pieces,
    timeline_runs,
    type_levels,
    type_ordered,
    type_summary,
)
from ..operators.segments import DEFAULT_ROWS_PER_BUCKET, RANGE
from ..schemas import GOOD
from ..sinks import write_bad_lines, write_csv, write_one_file, write_table
from ..sources import read_log_lines
from ..sources.numbering import dense_numbers, split_offsets
from .manifests import StageLog, input_state

# fixed values: stage names and report columns
STAGES = ("read", "sort", "compute", "save")
SPAN_COLUMNS = ("breakdown_type", "run_id", "run_length", "run_start", "run_end", "levels_in_run_str")


#: Column of the ``sorted`` table: number of the row's time range, for the operators' ``ranges``.
TIME_RANGE = "time_range"


def _lines(spark: SparkSession, stage_dir: str) -> DataFrame:
    """The parsed lines; a log without lines leaves no part file to take the schema from."""
    try:
        return spark.read.parquet(f"{stage_dir}/lines")
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.createDataFrame([], T.StructType([*GOOD.fields, T.StructField("quality", T.StringType())]))


def _log(spark: SparkSession, stage_dir: str) -> StageLog:
    return StageLog(spark, stage_dir, STAGES)


def good_rows(spark: SparkSession, stage_dir: str) -> DataFrame:
    good = _lines(spark, stage_dir).filter(F.col("quality") == "good").drop("quality")
    if (_log(spark, stage_dir).require("read")["parameters"]["order"]) == "dense":
        return dense_numbers(good, spark.read.parquet(f"{stage_dir}/splits"))
    return good


def bad_rows(spark: SparkSession, stage_dir: str) -> DataFrame:
    return _lines(spark, stage_dir).filter(F.col("quality") == "bad").select("value").distinct()


def stage_read(spark: SparkSession, input_path: str, stage_dir: str, bad_dir: str, *,
               keep_history: bool = True, lines: DataFrame | None = None, order: str = "files", skip_done: bool = False) -> str | None:
    """Parse + quarantine. ``lines`` (value, arrival_id) overrides the text scan;
    ``order`` is the arrival order of ``read_log_lines``, or "dense".
    Returns the folder of the bad lines (None when the stage was skipped)."""
    log = _log(spark, stage_dir)
    raw = read_log_lines(spark, input_path, order="files" if order == "dense" else order) if lines is None else lines
    inputs = input_state(spark, input_path) if lines is None else {"given": uuid.uuid4().hex}
    parameters = {"order": "given" if lines is not None else order, "bad_dir": bad_dir}
    if skip_done and log.is_done("read", inputs, parameters):
        return None
    log.begin("read")
    parsed = parse_lines(raw)
    quality = F.when(F.coalesce(is_valid(), F.lit(False)), F.lit("good")).otherwise(F.lit("bad"))
    write_table(parsed.select(*GOOD_COLUMNS, quality.alias("quality")), f"{stage_dir}/lines",
                partition_by=("quality",))
    tables = ["lines"]
    if parameters["order"] == "dense":
        write_table(split_offsets(_lines(spark, stage_dir)), f"{stage_dir}/splits")
        tables.append("splits")
    folder = write_bad_lines(bad_rows(spark, stage_dir), bad_dir, keep_history=keep_history)
    log.done("read", inputs, parameters, tables)
    return folder


def stage_sort(spark: SparkSession, stage_dir: str, *, rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET, skip_done: bool = False) -> None:
    """Global sort by (timestamp, arrival): a range-partitioned, parallel sort.

    Rows keep the number of their range (``time_range``), so that later stages
    cut nothing again; one range holds at most ``rows_per_bucket`` rows.
    """
    log, path, order = _log(spark, stage_dir), f"{stage_dir}/sorted", ("timestamp", "arrival_id")
    log.require("read")
    inputs, parameters = {"read": log.fingerprint("read")}, {"rows_per_bucket": rows_per_bucket}
    if skip_done and log.is_done("sort", inputs, parameters):
        return
    log.begin("sort")
    good = good_rows(spark, stage_dir)

    def store(cut: DataFrame) -> DataFrame:
        write_table(cut.withColumnRenamed(RANGE, TIME_RANGE).sortWithinPartitions(*order), path)
        return spark.read.parquet(path).withColumnRenamed(TIME_RANGE, RANGE)

    rows = good.count()
    if rows > rows_per_bucket:
        cut_in_order(good, order, rows=rows, rows_per_bucket=rows_per_bucket, store=store)
    else:
        write_table(good.orderBy(*order).withColumn(TIME_RANGE, F.lit(0)), path)
    log.done("sort", inputs, parameters, ["sorted"])


def _ranges(df: DataFrame, rows_per_bucket: int) -> str | None:
    """The range column of a stored table that is too large for plain windows (the count reads only file footers)."""
    return TIME_RANGE if TIME_RANGE in df.columns and df.count() > rows_per_bucket else None


def stage_compute(spark: SparkSession, stage_dir: str, *, source: str = "sorted", ordered_path: str | None = None,
                  rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET, skip_done: bool = False) -> None:
    """``ordered`` (at ``ordered_path`` if given), ``runs`` and ``summary`` tables from the sorted (or the good) rows."""
    log, before = _log(spark, stage_dir), "sort" if source == "sorted" else "read"
    log.require(before)
    inputs, parameters = {before: log.fingerprint(before)}, {"rows_per_bucket": rows_per_bucket, "ordered_path": ordered_path}
    if skip_done and log.is_done("compute", inputs, parameters):
        return
    log.begin("compute")
    good = spark.read.parquet(f"{stage_dir}/sorted") if source == "sorted" else good_rows(spark, stage_dir)
    path = ordered_path or f"{stage_dir}/ordered"
    write_table(type_ordered(good, rows_per_bucket=rows_per_bucket, ranges=_ranges(good, rows_per_bucket)), path)
    ordered = spark.read.parquet(path)
    # spans once (with the level array the summary needs); the summary aggregates that small table
    spans = span_table(ordered).withColumn("levels_in_run_str", join_ints(F.col("levels_in_run_int")))
    write_table(spans, f"{stage_dir}/runs")
    write_table(type_summary(spark.read.parquet(f"{stage_dir}/runs")), f"{stage_dir}/summary")
    log.done("compute", inputs, parameters, ["runs", "summary", *([] if ordered_path else ["ordered"])])


def spans_report(spark: SparkSession, stage_dir: str) -> DataFrame:
    """The span report columns of the ``runs`` stage table."""
    return spark.read.parquet(f"{stage_dir}/runs").select(*SPAN_COLUMNS)


#: Forms of the timeline report: runs with their levels, runs alone, or levels in pieces of bounded length.
TIMELINE_FORMS = ("levels", "lengths", "pieces")


def stage_save(spark: SparkSession, stage_dir: str, output_dir: str, *, final_csv: str | None = None,
               timeline: str = "levels", ordered_path: str | None = None,
               rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET, one_file: bool = False) -> None:
    """The four CSV reports (folders with headered part files); ``final_csv`` is the final report's own path.

    With ``one_file`` the three per-type reports are single files under exactly their names (see ``sinks.write_one_file``).
    """
    if timeline not in TIMELINE_FORMS:
        raise ValueError(f"timeline must be one of {TIMELINE_FORMS}")
    _log(spark, stage_dir).require("compute")
    write_report = write_one_file if one_file else partial(write_csv, single_part=True)
    summary = spark.read.parquet(f"{stage_dir}/summary")
    write_report(summary, final_csv or f"{output_dir}/final.csv")
    write_report(type_levels(summary), f"{output_dir}/exo_output.csv")
    write_report(spans_report(spark, stage_dir), f"{output_dir}/runs.csv")
    ordered = spark.read.parquet(ordered_path or f"{stage_dir}/ordered")
    kw = {"rows_per_bucket": rows_per_bucket, "ranges": _ranges(ordered, rows_per_bucket)}
    report = timeline_run_pieces(ordered, **kw) if timeline == "pieces" else timeline_runs(ordered, with_levels=timeline == "levels", **kw)
    write_csv(report, f"{output_dir}/exo_runs_output.csv")


def run_stage(spark: SparkSession, name: str, *, input_path: str | None = None, stage_dir: str,
              bad_dir: str | None = None, output_dir: str | None = None, order: str = "files",
              final_csv: str | None = None, timeline: str = "levels", skip_done: bool = False, one_file: bool = False) -> None:
    """Dispatch one named stage (``read``, ``sort``, ``compute`` or ``save``)."""
    if name == "read":
        stage_read(spark, input_path, stage_dir, bad_dir, order=order, skip_done=skip_done)
    elif name == "sort":
        stage_sort(spark, stage_dir, skip_done=skip_done)
    elif name == "compute":
        stage_compute(spark, stage_dir, skip_done=skip_done)
    elif name == "save":
        stage_save(spark, stage_dir, output_dir, final_csv=final_csv, timeline=timeline, one_file=one_file)
    else:
        raise ValueError(f"unknown stage {name!r}; expected one of {STAGES}")


def run_once(spark: SparkSession, input_path: str, output_dir: str, bad_dir: str, *,
             lines: DataFrame | None = None, order: str = "files", final_csv: str | None = None,
             timeline: str = "levels", rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET, one_file: bool = False) -> None:
    """One-shot job: all outputs from one parse of the input.

    Writes the per-row table ``output_dir/parsed`` and ``output_dir/stage/*``
    (Parquet), CSV folders ``runs`` and ``summary``, the four reports, and
    replaces earlier bad-line runs.  The sort stage only runs for logs of more
    than ``rows_per_bucket`` good lines, whose ranges both later stages use.
    """
    stage_dir, parsed = f"{output_dir}/stage", f"{output_dir}/parsed"
    stage_read(spark, input_path, stage_dir, bad_dir, keep_history=False, lines=lines, order=order)
    large = good_rows(spark, stage_dir).count() > rows_per_bucket
    if large:
        stage_sort(spark, stage_dir, rows_per_bucket=rows_per_bucket)
    stage_compute(spark, stage_dir, source="sorted" if large else "lines", ordered_path=parsed, rows_per_bucket=rows_per_bucket)
    write_csv(spans_report(spark, stage_dir), f"{output_dir}/runs", single_part=True)
    write_csv(spark.read.parquet(f"{stage_dir}/summary"), f"{output_dir}/summary", single_part=True)
    stage_save(spark, stage_dir, output_dir, final_csv=final_csv, timeline=timeline, ordered_path=parsed,
               rows_per_bucket=rows_per_bucket, one_file=one_file)
