"""States of parts merge to the report of the whole."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from streakline.operators import PartsOverlap, RunStates, merge_states, run_state, span_table, timeline_runs, type_summary

BASE = dt.datetime(2024, 1, 1)
SCHEMA = "timestamp timestamp, arrival_id long, breakdown_type string, breakdown_level_int int, customer string"


def rows_of(seed, n=240, types=2):
    rnd = random.Random(seed)
    return [
        (BASE + dt.timedelta(seconds=i // 3), i, rnd.choice([None, *[f"t{k}" for k in range(types)]]), rnd.choice([None, -1, 5]), rnd.choice(["x", "y", None]))
        for i in range(n)
    ]


def cut(rows, *places):
    return [rows[a:b] for a, b in zip((0, *places), (*places, len(rows)))]


def listed(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy(*cols[:2]).collect()]


COLUMNS = ("run_id", "Breakdown_Type", "Count_Successive", "Breakdowns_Level", "run_start", "first_key", "last_key")


@pytest.mark.parametrize("seed", range(3))
def test_merging_is_associative(spark, seed):
    rows = rows_of(seed)
    rnd = random.Random(seed)
    places = sorted(rnd.sample(range(1, len(rows)), 3))
    whole = listed(run_state(spark.createDataFrame(rows, SCHEMA)), *COLUMNS)
    a, b, c, d = [run_state(spark.createDataFrame(part, SCHEMA), rows_per_bucket=30 + 200 * (k % 2)) for k, part in enumerate(cut(rows, *places))]
    assert listed(merge_states([d, b, a, c]), *COLUMNS) == whole
    assert listed(merge_states([merge_states([a, b]), merge_states([c, d])]), *COLUMNS) == whole
    assert listed(merge_states([a, merge_states([merge_states([b, c]), d])]), *COLUMNS) == whole


def test_one_run_over_many_parts(spark):
    rows = [(BASE + dt.timedelta(seconds=i), i, "same", i, "x") for i in range(12)]
    parts = [run_state(spark.createDataFrame([r], SCHEMA)) for r in rows]
    assert listed(merge_states(parts[::-1]), *COLUMNS[:4]) == [(1, "same", 12, ",".join(map(str, range(12))))]


def test_partitions_have_edges_of_their_own(spark):
    rows = rows_of(5)
    cols = ("customer", *COLUMNS)
    whole = run_state(spark.createDataFrame(rows, SCHEMA), partition_by=("customer",))
    parts = [run_state(spark.createDataFrame(p, SCHEMA), partition_by=("customer",)) for p in cut(rows, 1, 2, 100)]
    key = lambda r: (str(r[0]), *map(str, r[1:2]))
    assert sorted(listed(merge_states(parts, ("customer",)), *cols), key=key) == sorted(listed(whole, *cols), key=key)


def test_parts_that_overlap_are_refused(spark):
    rows = rows_of(1, 30)
    with pytest.raises(PartsOverlap):
        merge_states([run_state(spark.createDataFrame(p, SCHEMA)) for p in (rows[:20], rows[19:])])


def test_stored_states(spark, tmp_dir):
    """Parts come in any order, are replaced and merged; the reports are always those of the whole."""
    rows = [(t, i, k or "t0", v, c) for t, i, k, v, c in rows_of(2, 90)]
    days = cut(rows, 20, 50)
    frame = lambda part: spark.createDataFrame(part, SCHEMA)
    states = RunStates(spark, f"{tmp_dir}/states")
    assert states.parts() == []
    states.add("3", frame(days[2]))
    states.add("1", frame(days[0][:5]))
    states.add("2", frame(days[1]))
    states.add("1", frame(days[0]))

    def same():
        good = frame(rows)
        assert [tuple(r) for r in states.timeline().collect()] == [tuple(r) for r in timeline_runs(good).collect()]
        assert sorted(map(tuple, states.summary().collect())) == sorted(map(tuple, type_summary(span_table(good)).collect()))

    same()
    states.compact(["1", "2"], "1-2")
    assert states.parts() == ["1-2", "3"]
    same()


def test_the_log_is_parsed_once(spark, tmp_dir, monkeypatch):
    """Every part of the merged reports, and each pass over it, reads stored good lines, not the log."""
    from streakline.plans import catalog

    spark.range(600).selectExpr(
        "id as event_id", "timestamp_micros(1700000000000000 + id * 1000003) as ts", "concat('t', id div 3 % 2) as event_type",
        "concat('{\"k\": ', id % 7, '}') as props").write.parquet(f"{tmp_dir}/events.parquet")
    want = sorted(map(tuple, type_summary(span_table(catalog._good(spark, tmp_dir))).collect()))
    read, real = [], RunStates.add

    def add(self, name, good, **kw):
        read.append(good.inputFiles())
        real(self, name, good, **kw)

    monkeypatch.setattr(RunStates, "add", add)
    assert sorted(map(tuple, catalog.q_summary_merged(spark, tmp_dir).collect())) == want
    assert len(read) == 3 and all(read) and not any("events.parquet" in f for files in read for f in files)
