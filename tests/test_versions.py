"""Versions, single files and stage manifests: nothing half-written is ever read."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
import textwrap

import pytest
from conftest import ROOT, SAMPLE
from pyspark.sql import functions as F

from streakline.plans import stage_compute, stage_read, stage_save, stage_sort
from streakline.plans.manifests import StageIncomplete
from streakline.plans.staged import good_rows
from streakline.sinks import Versions, write_one_file


def test_latest_whole_version_is_read(spark, tmp_dir):
    versions = Versions(spark, f"{tmp_dir}/report")
    with pytest.raises(FileNotFoundError):
        versions.folder()
    for k in range(3):
        versions.publish(lambda folder, k=k: spark.range(k + 1).write.parquet(folder), {"k": k})
    assert spark.read.parquet(versions.folder()).count() == 3
    assert versions.current()["notes"] == {"k": 2} and versions.numbers() == [1, 2, 3]

    def fails(folder):
        spark.range(9).write.parquet(folder)
        raise InterruptedError

    with pytest.raises(InterruptedError):
        versions.publish(fails)
    assert spark.read.parquet(versions.folder()).count() == 3
    versions.prune(keep=2)
    assert versions.numbers() == [2, 3] and len([n for n in os.listdir(f"{tmp_dir}/report") if n.startswith("v")]) == 2


def test_writers_that_finish_at_once_get_numbers_of_their_own(spark, tmp_dir):
    versions = Versions(spark, f"{tmp_dir}/report")

    def meanwhile(folder):
        spark.range(1).write.parquet(folder)
        if not versions.numbers():
            versions.publish(lambda other: spark.range(2).write.parquet(other))

    versions.publish(meanwhile)
    assert versions.numbers() == [1, 2] and spark.read.parquet(versions.folder()).count() == 1


def test_killed_writer_leaves_the_version_before_it(spark, tmp_dir):
    versions = Versions(spark, f"{tmp_dir}/report")
    versions.publish(lambda folder: spark.range(5).write.parquet(folder))
    before = versions.folder()
    script = textwrap.dedent(f"""
        import os, sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession
        from streakline.sinks import Versions
        spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()

        def save(folder):
            spark.range(7).write.parquet(folder)
            os.kill(os.getpid(), 9)

        Versions(spark, {tmp_dir + "/report"!r}).publish(save)
    """)
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, timeout=300)
    assert done.returncode == -9
    assert versions.folder() == before and spark.read.parquet(before).count() == 5
    versions.publish(lambda folder: spark.range(6).write.parquet(folder))
    versions.prune()
    assert spark.read.parquet(versions.folder()).count() == 6
    assert len([n for n in os.listdir(f"{tmp_dir}/report") if n.startswith("v")]) == 1


def test_one_file_under_its_name(spark, tmp_dir):
    path = f"{tmp_dir}/final.csv"
    for n in (3, 5):
        write_one_file(spark.range(n), path)
        assert open(path).read().split() == ["id", *map(str, range(n))]
    bad = spark.range(2).select(F.raise_error(F.lit("no")).cast("string").alias("id"))
    with pytest.raises(Exception, match="no"):
        write_one_file(bad, path)
    assert sorted(n for n in os.listdir(tmp_dir) if not n.endswith(".crc")) == ["final.csv"]
    assert len(open(path).read().split()) == 6


def test_stages_know_what_is_whole(spark, tmp_dir):
    log, stage, bad, out = f"{tmp_dir}/log.txt", f"{tmp_dir}/stage", f"{tmp_dir}/bad", f"{tmp_dir}/out"
    shutil.copy(SAMPLE, log)
    with pytest.raises(StageIncomplete, match="read"):
        stage_sort(spark, stage)
    run = lambda **kw: (stage_read(spark, log, stage, bad, **kw), stage_sort(spark, stage, **kw), stage_compute(spark, stage, **kw))
    run()
    stamp = lambda: [os.stat(f"{stage}/{t}/_SUCCESS").st_mtime_ns for t in ("lines", "sorted", "summary")]
    before = stamp()
    assert run(skip_done=True) == (None, None, None) and stamp() == before
    # a half-written table is refused, and made again
    part = next(n for n in os.listdir(f"{stage}/sorted") if n.startswith("part-") and os.path.getsize(f"{stage}/sorted/{n}"))
    os.truncate(f"{stage}/sorted/{part}", 10)
    with pytest.raises(StageIncomplete, match="sorted"):
        stage_compute(spark, stage)
    with pytest.raises(StageIncomplete):
        stage_save(spark, f"{tmp_dir}/none", out)
    run(skip_done=True)
    after = stamp()
    assert after[0] == before[0] and after[1] > before[1] and after[2] > before[2]
    # other input: every stage runs again
    with open(log, "a") as more:
        more.write("noat\n")
    run(skip_done=True)
    assert all(a > b for a, b in zip(stamp(), after))
    # a stage that fails leaves no manifest, so the next is refused
    with pytest.raises(Exception):  # noqa: B017
        stage_sort(spark, stage, rows_per_bucket="many")
    with pytest.raises(StageIncomplete):
        stage_compute(spark, stage)
    stage_sort(spark, stage)
    stage_compute(spark, stage)
    stage_save(spark, stage, out, one_file=True)
    assert os.path.isfile(f"{out}/final.csv") and os.path.isfile(f"{out}/runs.csv")


@pytest.mark.parametrize("packed", [False, True])
def test_dense_numbers_do_not_depend_on_splits(spark, tmp_dir, packed):
    """Three files (one empty line, one without a last line break) read with three split sizes, and gzipped."""
    log, found = f"{tmp_dir}/log", []
    os.makedirs(log)
    texts = ["".join(f"2017-10-05 00:01:{k % 60:02d}@/m/slab/a/256/{k}/x\n" for k in range(300)), "\n", "2017-10-05 00:01:09@/m/slab/b/256/7/x\nnoat"]
    for k, text in enumerate(texts):
        with open(f"{log}/{k}.txt", "w") as file:
            file.write(text)
        if packed:
            subprocess.run(["gzip", f"{log}/{k}.txt"], check=True)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for n, size in enumerate(("700", "5000", "128m")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            stage_read(spark, log, f"{tmp_dir}/stage{n}", f"{tmp_dir}/bad{n}", order="dense")
            found.append([tuple(r) for r in good_rows(spark, f"{tmp_dir}/stage{n}").select("arrival_id", "value").orderBy("arrival_id").collect()])
            lines = spark.read.parquet(f"{tmp_dir}/stage{n}/splits").selectExpr("sum(lines)", "max(first_number)").first()
            assert lines[0] == 303 and lines[1] == 301
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found[0] == found[1] == found[2]
    assert [i for i, _ in found[0]] == [*range(300), 301] and found[0][-1][1].endswith("b/256/7/x")
