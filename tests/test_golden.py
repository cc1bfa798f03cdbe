"""A small sample log: its reports must equal those worked out by hand."""

from __future__ import annotations

import glob
import gzip
import os

import pytest
from conftest import SAMPLE

from streakline import schemas
from streakline.functions import parse_lines
from streakline.operators import (
    span_table,
    split_valid,
    timeline_runs,
    type_levels,
    type_spans,
    type_summary,
)
from streakline.plans import run_once, stage_compute, stage_read, stage_save, stage_sort
from streakline.sinks import read_csv_report
from streakline.sources import read_log_lines

# worked out from the rules: the last line is out of order in time, 'hi' is no number
SUMMARY = [
    ("base", 5, 1, 5, 5.0, "7,8,9,12"),
    ("base_hd", 2, 1, 2, 2.0, "9,13"),
    ("roads", 6, 1, 6, 6.0, "9,10,11,12,14"),
    ("transit", 3, 1, 3, 3.0, "10"),
]
TIMELINE = [
    ("base", 2, "7,9"),
    ("roads", 3, "11,11,12"),
    ("base_hd", 1, "9"),
    ("base", 1, "7"),
    ("transit", 3, "10,10"),
    ("roads", 1, "10"),
    ("base", 2, "8,12"),
    ("base_hd", 1, "13"),
    ("roads", 2, "9,14"),
]
SPAN_TIMES = {
    "base": ("08:00:00", "08:00:03"),
    "base_hd": ("08:00:01", "08:00:04"),
    "roads": ("08:00:00", "08:00:05"),
    "transit": ("08:00:02", "08:00:02"),
}


def _good(spark):
    return split_valid(parse_lines(read_log_lines(spark, SAMPLE)))


def test_sample_reports(spark):
    good, bad = _good(spark)
    assert good.count() == 16 and bad.count() == 0
    assert sorted(tuple(r) for r in type_summary(span_table(good)).collect()) == SUMMARY
    assert [tuple(r) for r in timeline_runs(good).collect()] == TIMELINE
    assert [tuple(r) for r in timeline_runs(good, rows_per_bucket=3).collect()] == TIMELINE
    levels = sorted(tuple(r) for r in type_levels(type_summary(span_table(good))).collect())
    assert levels == [(t, m, lv) for t, _, _, m, _, lv in SUMMARY]
    spans = {r["breakdown_type"]: r for r in type_spans(good).collect()}
    for t, (a, b) in SPAN_TIMES.items():
        assert spans[t]["run_id"] == 1
        assert spans[t]["run_start"].strftime("%H:%M:%S") == a
        assert spans[t]["run_end"].strftime("%H:%M:%S") == b


def test_invariants(spark):
    """Sum of run lengths = good rows; adjacent timeline runs differ in type."""
    good, _ = _good(spark)
    tl = timeline_runs(good).collect()
    assert sum(r["Count_Successive"] for r in tl) == good.count()
    assert all(a["Breakdown_Type"] != b["Breakdown_Type"] for a, b in zip(tl, tl[1:]))


def _read_reports(spark, out):
    summary = sorted(tuple(r) for r in read_csv_report(spark, f"{out}/final.csv", schemas.SUMMARY).collect())
    timeline = [tuple(r) for r in read_csv_report(spark, f"{out}/exo_runs_output.csv", schemas.TIMELINE).collect()]
    return summary, timeline


def test_one_shot_and_staged_agree(spark, tmp_dir):
    run_once(spark, SAMPLE, f"{tmp_dir}/once", f"{tmp_dir}/bad1")
    stage = f"{tmp_dir}/stage"
    stage_read(spark, SAMPLE, stage, f"{tmp_dir}/bad2")
    stage_sort(spark, stage)
    stage_compute(spark, stage)
    stage_save(spark, stage, f"{tmp_dir}/staged")
    once = _read_reports(spark, f"{tmp_dir}/once")
    staged = _read_reports(spark, f"{tmp_dir}/staged")
    assert once == staged == (SUMMARY, TIMELINE)
    header = open(glob.glob(f"{tmp_dir}/once/final.csv/part-*.csv")[0]).readline().strip()
    assert header == "breakdown_type,total_events,runs_count,max_run_length,avg_run_length,distinct_levels_str"
    assert len(glob.glob(f"{tmp_dir}/once/final.csv/part-*.csv")) == 1
    # fixed values: report headers
    headers = {
        "runs.csv": "breakdown_type,run_id,run_length,run_start,run_end,levels_in_run_str",
        "exo_output.csv": "breakdown_type,max_run_length,levels",
        "exo_runs_output.csv": "Breakdown_Type,Count_Successive,Breakdowns_Level",
    }
    for name, header in headers.items():
        first = sorted(glob.glob(f"{tmp_dir}/once/{name}/part-*.csv"))[0]
        assert open(first).readline().strip() == header, name


def test_bad_line_history(spark, tmp_dir):
    log = os.path.join(tmp_dir, "log.txt")
    with open(log, "w") as f:
        f.write("2017-10-05 00:01:09@/m/slab/a/256/1/x\nnoat\nnoat\n\n")
    stage = f"{tmp_dir}/stage"
    from streakline.plans.staged import bad_rows

    stage_read(spark, log, stage, f"{tmp_dir}/bad")
    assert sorted(r["value"] for r in bad_rows(spark, stage).collect()) == ["", "noat"]
    from streakline.sinks import write_bad_lines

    write_bad_lines(bad_rows(spark, stage), f"{tmp_dir}/bad", keep_history=True, run_stamp=1)
    write_bad_lines(bad_rows(spark, stage), f"{tmp_dir}/bad", keep_history=True, run_stamp=2)
    runs = sorted(os.path.basename(p) for p in glob.glob(f"{tmp_dir}/bad/run=*"))
    assert len(runs) == 3
    write_bad_lines(bad_rows(spark, stage), f"{tmp_dir}/bad", keep_history=False, run_stamp=3)
    assert sorted(os.path.basename(p) for p in glob.glob(f"{tmp_dir}/bad/run=*")) == ["run=3"]


def test_multi_file_arrival_order(spark, tmp_dir):
    """Lines are ordered by file name, then line, whatever the file packing or splits."""
    d = os.path.join(tmp_dir, "logs")
    os.makedirs(d)
    ts = "2017-10-05 00:01:09"
    lines = {
        "a.txt": [f"{ts}@/m/slab/a{i}/256/1/x" for i in range(2)],
        "b.txt": [f"{ts}@/m/slab/b{i:03d}/256/1/x" for i in range(199)],
        "c.txt.gz": [f"{ts}@/m/slab/c{i}/256/1/x" for i in range(2)],
    }
    for name, ls in lines.items():
        data = ("\n".join(ls) + "\n").encode()
        if name.endswith(".gz"):
            data = gzip.compress(data)
        with open(os.path.join(d, name), "wb") as f:
            f.write(data)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        good, _ = split_valid(parse_lines(read_log_lines(spark, d)))
        order = [r["breakdown_type"] for r in good.orderBy("timestamp", "arrival_id").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expect = [line.split("/slab/")[1].split("/")[0] for name in sorted(lines) for line in lines[name]]
    assert order == expect


def test_one_shot_paths(spark, tmp_dir):
    """The per-row table, the final report's own path and the timeline forms."""
    run_once(spark, SAMPLE, f"{tmp_dir}/out", f"{tmp_dir}/bad", final_csv=f"{tmp_dir}/elsewhere.csv", timeline="lengths")
    assert spark.read.parquet(f"{tmp_dir}/out/parsed").count() == 16
    assert sorted(tuple(r) for r in read_csv_report(spark, f"{tmp_dir}/elsewhere.csv", schemas.SUMMARY).collect()) == SUMMARY
    rows = spark.read.option("header", True).csv(f"{tmp_dir}/out/exo_runs_output.csv").collect()
    assert [(r["Breakdown_Type"], int(r["Count_Successive"])) for r in rows] == [(t, n) for t, n, _ in TIMELINE]


def test_sort_stage_keeps_ranges(spark, tmp_dir):
    """Ranges that the sort stage cut are used by the later stages, which cut nothing themselves."""
    stage = f"{tmp_dir}/stage"
    stage_read(spark, SAMPLE, stage, f"{tmp_dir}/bad")
    stage_sort(spark, stage, rows_per_bucket=4)
    cut = spark.read.parquet(f"{stage}/sorted").groupBy("time_range").count().collect()
    assert len(cut) >= 4 and max(r["count"] for r in cut) <= 4
    stage_compute(spark, stage, rows_per_bucket=4)
    stage_save(spark, stage, f"{tmp_dir}/out", rows_per_bucket=4)
    assert _read_reports(spark, f"{tmp_dir}/out") == (SUMMARY, TIMELINE)


@pytest.mark.parametrize("text,bad", [("", 0), ("noat\n\nnoat\n", 2)])
def test_log_without_good_lines(spark, tmp_dir, text, bad):
    with open(os.path.join(tmp_dir, "log.txt"), "w") as f:
        f.write(text)
    run_once(spark, f"{tmp_dir}/log.txt", f"{tmp_dir}/out", f"{tmp_dir}/bad")
    assert _read_reports(spark, f"{tmp_dir}/out") == ([], [])
    assert (spark.read.text(f"{tmp_dir}/bad").count() if bad else 0) == bad
    stage_read(spark, f"{tmp_dir}/log.txt", f"{tmp_dir}/stage", f"{tmp_dir}/bad2")
    stage_sort(spark, f"{tmp_dir}/stage")
    stage_compute(spark, f"{tmp_dir}/stage")
    stage_save(spark, f"{tmp_dir}/stage", f"{tmp_dir}/staged")
    assert _read_reports(spark, f"{tmp_dir}/staged") == ([], [])


def test_dynamic_overwrite_mode_keeps_nothing_old(spark, tmp_dir):
    from streakline.plans.staged import bad_rows

    first, second = f"{tmp_dir}/a.txt", f"{tmp_dir}/b.txt"
    with open(first, "w") as f:
        f.write("noat\n")
    with open(second, "w") as f:
        f.write("2021-03-14 08:00:00@/m/slab/a/256/1/x\n")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for log in (first, second):
            stage_read(spark, log, f"{tmp_dir}/stage", f"{tmp_dir}/bad", keep_history=False)
        assert bad_rows(spark, f"{tmp_dir}/stage").collect() == []
        runs = [p for p in glob.glob(f"{tmp_dir}/bad/run=*") if glob.glob(f"{p}/part-*")]
        assert runs == []
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_any_type_text_survives_csv(spark, tmp_dir):
    from streakline.sinks import write_csv

    rows = [("\\N", 1, ""), ("", 2, "1"), ("null", 3, ",\"x\"")]
    write_csv(spark.createDataFrame(rows, schemas.TIMELINE), f"{tmp_dir}/r.csv")
    assert sorted(tuple(r) for r in read_csv_report(spark, f"{tmp_dir}/r.csv", schemas.TIMELINE).collect()) == sorted(rows)


def test_clear_scratch(spark):
    from streakline.session import clear_scratch, scratch_path

    path = scratch_path(spark, "table")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path.removeprefix("file:"))
    clear_scratch(spark)
    assert not os.path.exists(path.removeprefix("file:"))
