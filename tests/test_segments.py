"""Run segmentation: bucketed (parallel) form == plain window form."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from streakline.operators import cut_in_order, ordinal, segment_runs, timeline_run_pieces, timeline_runs, type_ordered
from streakline.operators.segments import RANGE

BASE = dt.datetime(2024, 1, 1)


def tie_heavy(spark, seed: int, n_types: int):
    rnd = random.Random(seed)
    n = rnd.randint(300, 400)
    n_sec = rnd.randint(30, 40)
    rows = [
        (
            BASE + dt.timedelta(seconds=rnd.randrange(n_sec)),
            i,
            f"t{rnd.randrange(n_types)}",
            rnd.choice([None, 1, 2]),
            f"k{rnd.randrange(4)}",
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "timestamp timestamp, arrival_id long, breakdown_type string, "
                                       "breakdown_level_int int, key string")


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("n_types", [2, 4])
def test_global_runs_bucketed_equals_plain(spark, seed, n_types):
    df = tie_heavy(spark, seed, n_types)
    order = ("timestamp", "arrival_id")
    cols = df.columns + ["prev_type", "is_new_run", "run_id"]
    kw = dict(change_on=("breakdown_type",), lag_of={"prev_type": "breakdown_type"})
    plain = segment_runs(df, order, bucketed=False, **kw)
    for rpb in (17, 60):
        assert _rows(segment_runs(df, order, rows_per_bucket=rpb, **kw), cols) == _rows(plain, cols)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("partition_by", [("key",), ("breakdown_type",)])
def test_partitioned_runs_bucketed_equals_plain(spark, seed, partition_by):
    df = tie_heavy(spark, seed, 2 + seed % 3)
    order = ("timestamp", "arrival_id")
    kw = dict(change_on=("breakdown_level_int",), partition_by=partition_by, lag_of={"prev_ts": "timestamp"})
    cols = df.columns + ["prev_ts", "is_new_run", "run_id"]
    plain = segment_runs(df, order, bucketed=False, **kw)
    assert _rows(segment_runs(df, order, rows_per_bucket=25, **kw), cols) == _rows(plain, cols)


def test_null_change_values_are_compared_null_safely(spark):
    rows = [(BASE + dt.timedelta(seconds=i), i, t) for i, t in enumerate([None, None, "a", None, "a", "a"])]
    df = spark.createDataFrame(rows, "ts timestamp, id long, t string")
    out = segment_runs(df, ("ts", "id"), change_on=("t",), bucketed=False).orderBy("id")
    assert [r["run_id"] for r in out.collect()] == [1, 1, 2, 3, 4, 4]
    out_b = segment_runs(df, ("ts", "id"), change_on=("t",), rows_per_bucket=1).orderBy("id")
    assert [r["run_id"] for r in out_b.collect()] == [1, 1, 2, 3, 4, 4]


def test_type_spans_semantics(spark):
    """With change_on empty a partition is one run: run_id 1, flag only on the first row."""
    df = tie_heavy(spark, 3, 4)
    out = type_ordered(df, rows_per_bucket=20)
    assert {r["run_id"] for r in out.collect()} == {1}
    firsts = out.filter("is_new_run = 1").collect()
    assert sorted(r["breakdown_type"] for r in firsts) == ["t0", "t1", "t2", "t3"]
    assert all(r["prev_ts"] is None for r in firsts)


def test_timeline_bucketed_plan_has_no_single_partition_exchange(spark):
    df = tie_heavy(spark, 1, 2)
    plain = timeline_runs(df, bucketed=False)
    bucketed = timeline_runs(df, rows_per_bucket=30)
    assert "SinglePartition" in plain._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in bucketed._jdf.queryExecution().executedPlan().toString()
    assert sorted(plain.collect()) == sorted(bucketed.collect())


def sizes(df, order, rows_per_bucket, part=()):
    cut = cut_in_order(df, order, part, rows=df.count(), rows_per_bucket=rows_per_bucket)
    return [r["count"] for r in cut.groupBy(*part, RANGE).count().collect()]


def same_runs(df, order, rows_per_bucket, change_on=("t",), part=()):
    kw = dict(change_on=change_on, partition_by=part, lag_of={"before": order[0]}, position="pos")
    cols = [order[-1], "before", "is_new_run", "run_id", "pos"]
    key = lambda rows: sorted(rows, key=repr)
    fast = key(tuple(r[c] for c in cols) for r in segment_runs(df, order, rows_per_bucket=rows_per_bucket, **kw).collect())
    assert repr(fast) == repr(key(tuple(r[c] for c in cols) for r in segment_runs(df, order, bucketed=False, **kw).collect()))


def test_hot_second_is_split_on_tie_break_key(spark):
    """All rows in one timestamp: the tie-break key cuts them."""
    rows = [(BASE, i, f"t{(i // 3) % 2}") for i in range(200)]
    df = spark.createDataFrame(rows, "ts timestamp, id long, t string")
    assert max(sizes(df, ("ts", "id"), 20)) <= 20
    same_runs(df, ("ts", "id"), 20)


def test_hot_key_is_split(spark):
    """A partition key with most rows is cut into several ranges."""
    rows = [(BASE + dt.timedelta(seconds=i), i, "hot" if i % 10 else f"c{i}", i % 3) for i in range(500)]
    df = spark.createDataFrame(rows, "ts timestamp, id long, k string, s int")
    assert max(sizes(df, ("ts", "id"), 50, ("k",))) <= 50
    same_runs(df, ("ts", "id"), 50, ("s",), ("k",))


@pytest.mark.parametrize("kind", ["nanos", "decimal", "nan", "string", "geometric", "struct"])
def test_any_key_type_is_cut_exactly(spark, kind):
    rnd = random.Random(3)
    n = 300
    keys = {
        # distinct keys that a double can not tell apart
        "nanos": ("long", [1_700_000_000_000_000_000 + i // 2 for i in range(n)]),
        "decimal": ("decimal(30,4)", [Decimal(10) ** 22 + Decimal(i // 2) / 10000 for i in range(n)]),
        "nan": ("double", [[float("nan"), float("inf"), float("-inf"), None, float(i)][i % 5] for i in range(n)]),
        "string": ("string", [f"k{rnd.randrange(40)}" for _ in range(n)]),
        "geometric": ("double", [1.1**i for i in range(n)]),
        "struct": ("struct<file:string,row:long>", [(f"f{i % 2}", i) for i in range(n)]),
    }
    dtype, values = keys[kind]
    rows = [(v, i, f"t{rnd.randrange(2)}") for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"k {dtype}, id long, t string")
    assert max(sizes(df, ("k", "id"), 20)) <= 20
    same_runs(df, ("k", "id"), 20)


@pytest.mark.parametrize("name", ["m", "n", "lo1", "hi2", "first_chg", "cont", "off", "prev", "count", "row"])
def test_column_names_do_not_clash(spark, name):
    df = spark.createDataFrame([(i, f"t{i // 7 % 2}", i) for i in range(60)], f"id long, t string, {name} int")
    assert name in segment_runs(df, ("id",), ("t",), rows_per_bucket=9).columns
    same_runs(df.withColumn("k", F.col("id") % 2), ("id",), 9, ("t",), ("k",))


def test_run_over_many_ranges(spark):
    """One run holds most rows: counts, positions and levels join up across all its ranges."""
    rows = [(BASE + dt.timedelta(seconds=i), i, "long" if 10 <= i < 390 else f"t{i % 2}", i % 5) for i in range(400)]
    df = spark.createDataFrame(rows, "timestamp timestamp, arrival_id long, breakdown_type string, breakdown_level_int int")
    same_runs(df, ("timestamp", "arrival_id"), 15, ("breakdown_type",))
    assert timeline_runs(df, rows_per_bucket=15).collect() == timeline_runs(df, bucketed=False).collect()


def test_ranges_of_a_stored_table_are_reused(spark):
    df = tie_heavy(spark, 5, 3)
    order = ("timestamp", "arrival_id")
    cut = cut_in_order(df, order, rows=df.count(), rows_per_bucket=40).withColumnRenamed(RANGE, "time_range")
    assert cut.select("time_range").distinct().count() > 5
    assert timeline_runs(cut, ranges="time_range").collect() == timeline_runs(df, bucketed=False).collect()
    cols = [*df.columns, "prev_ts", "is_new_run", "run_id"]
    assert _rows(type_ordered(cut, ranges="time_range"), cols) == _rows(type_ordered(df, bucketed=False), cols)


def test_ordinal_numbers_ties_alike(spark):
    df = spark.createDataFrame([(i // 4, i) for i in range(200)], "k long, id long")
    for rows_per_bucket in (16, 10_000):
        assert sorted(r["position"] for r in ordinal(df, ("k",), rows_per_bucket=rows_per_bucket).collect()) == list(range(1, 201))


def test_ordinal_is_row_number(spark):
    df = tie_heavy(spark, 2, 2)
    out = ordinal(df, ("timestamp", "arrival_id"), rows_per_bucket=40).collect()
    expect = sorted(out, key=lambda r: (r["timestamp"], r["arrival_id"]))
    assert [r["position"] for r in expect] == list(range(1, len(out) + 1))


@pytest.mark.parametrize("seed", range(6))
def test_timeline_run_keys_bucketed_equals_plain(spark, seed):
    """timeline_runs keys runs without dense ids; bucketed output equals the plain window's."""
    df = tie_heavy(spark, seed, 2 + 2 * (seed % 2))
    plain = timeline_runs(df, bucketed=False).collect()
    for rpb in (5, 40):
        assert timeline_runs(df, rows_per_bucket=rpb).collect() == plain
    strip = lambda rows: [(r["key"], r["Breakdown_Type"], r["Count_Successive"], r["Breakdowns_Level"]) for r in rows]
    kw = dict(partition_by=("key",), keep_order_columns=True)
    assert strip(timeline_runs(df, rows_per_bucket=20, **kw).collect()) == strip(
        timeline_runs(df, bucketed=False, **kw).collect())


@pytest.mark.parametrize("order", ["files", "scan"])
def test_hot_second_in_text_log_is_split(spark, tmp_dir, order):
    """Every line in one second: either arrival order cuts it."""
    import os

    from streakline.functions import parse_lines
    from streakline.operators import split_valid
    from streakline.sources import read_log_lines

    log = os.path.join(tmp_dir, "hot.log")
    with open(log, "w") as f:
        for i in range(3000):
            f.write(f"2017-10-05 00:01:09@/m/slab/t{(i // 7) % 3}/256/{i % 5}/x\n")
    good, _ = split_valid(parse_lines(read_log_lines(spark, log, order=order)))
    assert max(sizes(good, ("timestamp", "arrival_id"), 100)) <= 100
    assert timeline_runs(good, rows_per_bucket=100).collect() == timeline_runs(good, bucketed=False).collect()


def test_null_order_keys_sort_first_in_both_forms(spark):
    rnd = random.Random(7)
    rows = [(None if i % 9 == 0 else BASE + dt.timedelta(seconds=rnd.randrange(20)), i, f"t{rnd.randrange(2)}")
            for i in range(150)]
    df = spark.createDataFrame(rows, "ts timestamp, id long, t string")
    kw = dict(order_by=("ts", "id"), type_col="t", level_col="id")
    assert timeline_runs(df, rows_per_bucket=10, **kw).collect() == timeline_runs(df, bucketed=False, **kw).collect()
    cols = ["id", "is_new_run", "run_id"]
    assert _rows(segment_runs(df, ("ts", "id"), change_on=("t",), rows_per_bucket=10), cols) == _rows(
        segment_runs(df, ("ts", "id"), change_on=("t",), bucketed=False), cols)


def test_null_order_keys_in_a_hot_partition(spark):
    rnd = random.Random(11)
    rows = [("hot" if i % 4 else f"k{i}", None if i % 7 == 0 else BASE + dt.timedelta(seconds=rnd.randrange(5)), i,
             rnd.randrange(2)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, id long, s int")
    kw = dict(change_on=("s",), partition_by=("k",), lag_of={"prev_ts": "ts"})
    cols = ["id", "prev_ts", "is_new_run", "run_id"]
    assert _rows(segment_runs(df, ("ts", "id"), rows_per_bucket=15, **kw), cols) == _rows(
        segment_runs(df, ("ts", "id"), bucketed=False, **kw), cols)


@pytest.mark.parametrize("seed", range(3))
def test_type_ordered_bucketed_equals_plain(spark, seed):
    """Span semantics (no change columns): edge table is a plain aggregate; lag crosses bucket edges."""
    df = tie_heavy(spark, seed, 3)
    cols = df.columns + ["prev_ts", "is_new_run", "run_id"]
    assert _rows(type_ordered(df, rows_per_bucket=12), cols) == _rows(type_ordered(df, bucketed=False), cols)


@pytest.mark.parametrize("rows_per_bucket", [8, 33, 10_000])
def test_timeline_pieces_depend_on_the_data_alone(spark, rows_per_bucket):
    rows = [(BASE + dt.timedelta(seconds=i // 3), i, "long" if 20 <= i < 90 else f"t{i % 2}", i % 4)
            for i in range(150)]
    df = spark.createDataFrame(rows, "timestamp timestamp, arrival_id long, breakdown_type string, "
                                     "breakdown_level_int int")
    runs = [[]]
    for _, i, t, level in rows:
        if runs[-1] and runs[-1][-1][0] != t:
            runs.append([])
        runs[-1].append((t, level))
    want = [(k, p // 16, run[0][0], len(run[p : p + 16]), ",".join(str(x) for _, x in run[p : p + 16]))
            for k, run in enumerate(runs, 1) for p in range(0, len(run), 16)]
    got = timeline_run_pieces(df, piece_rows=16, rows_per_bucket=rows_per_bucket).collect()
    assert [tuple(r) for r in got] == want


def test_null_first_key_next_to_single_value_cell(spark):
    """Regression (found by hypothesis): NULL key + one other value in a hot cell; tie-break split must not mix them."""
    df = spark.createDataFrame([(BASE, 0, "b"), (None, 1, None)], "ts timestamp, id long, c string")
    kw = dict(change_on=("c",), lag_of={"prev_c": "c"})
    cols = ["id", "prev_c", "is_new_run", "run_id"]
    assert _rows(segment_runs(df, ("ts", "id"), rows_per_bucket=1, **kw), cols) == _rows(
        segment_runs(df, ("ts", "id"), bucketed=False, **kw), cols) == [(0, None, 1, 2), (1, None, 1, 1)]
    tk = dict(order_by=("ts", "id"), type_col="c", level_col="id")
    assert timeline_runs(df, rows_per_bucket=1, **tk).collect() == timeline_runs(df, bucketed=False, **tk).collect()
