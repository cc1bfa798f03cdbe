"""Cuts from sketches: even ranges, heavy ties, any key; bitmaps and set difference beside them."""

from __future__ import annotations

import datetime as dt
import os
import random
import subprocess
import sys

import pytest
from conftest import ROOT
from pyspark.sql import functions as F

import streakline.operators.segments as segments
from streakline.functions import join_ints
from streakline.operators import bitmap_levels, cut_in_order, except_distinct, level_bitmaps, merge_bitmaps, ordinal
from streakline.operators.cuts import FAN, KeySketch, count_below, cut_by_sketch
from streakline.operators.segments import RANGE


def test_count_below(spark):
    values = [-(1 << 63), *range(0, 5000, 7), (1 << 63) - 1]
    for n in (0, 1, FAN, 2 * FAN + 1, len(values)):
        some = values[:n]
        got = spark.range(-3, 5010).select("id", count_below(some, F.col("id")).alias("n")).collect()
        assert all(r["n"] == sum(v < r["id"] for v in some) for r in got)


def test_sketches_merge(spark):
    whole, parts = KeySketch.of(spark.range(100_000), "id"), [KeySketch.of(spark.range(a, a + 50_000), "id") for a in (50_000, 0)]
    both = parts[0].merge(parts[1], spark)
    assert both.rows == whole.rows == 100_000
    for q, exact in zip(both.quantiles(10, spark), range(10_000, 100_000, 10_000)):
        assert abs(q - exact) < 500


@pytest.mark.parametrize("kind", ["long", "int", "date", "timestamp", "timestamp_ntz", "decimal(10,2)"])
def test_ranges_follow_the_order(spark, kind):
    cast = {"date": "date_add(date'2020-01-01', cast(k as int))", "timestamp": "timestamp_micros(k * 1000003)",
            "timestamp_ntz": "cast(timestamp_micros(k * 1000003) as timestamp_ntz)"}.get(kind, f"cast(k as {kind})")
    df = spark.range(4000).selectExpr("if(id % 50 = 0, null, (id * 7919) % 3001 - 1500) as k", "id").selectExpr(f"{cast} as k", "id")
    rows, cut = cut_by_sketch(df, ("k", "id"), (), RANGE, rows_per_bucket=200, per_range=100)
    assert rows == 4000
    sizes = {r[0]: r[1] for r in cut.groupBy(RANGE).count().collect()}
    assert max(sizes.values()) <= 200 and len(sizes) >= 30
    ordered = [r[RANGE] for r in cut.orderBy("k", "id").collect()]
    assert ordered == sorted(ordered)


def test_heavy_ties_are_cut_by_the_second_column(spark):
    df = spark.range(6000).selectExpr("if(id % 3 = 0, id, 7) as k", "(id * 31) % 6007 as j")
    rows, cut = cut_by_sketch(df, ("k", "j"), (), RANGE, rows_per_bucket=300, per_range=150)
    assert cut is not None and max(r["count"] for r in cut.groupBy(RANGE).count().collect()) <= 300
    ordered = [r[RANGE] for r in cut.orderBy("k", "j").collect()]
    assert ordered == sorted(ordered)


def test_more_ranges_than_one_sketch_cuts(spark, monkeypatch):
    import streakline.operators.cuts as cuts

    monkeypatch.setattr(cuts, "MOST_RANGES", 8)
    rows, cut = cut_by_sketch(spark.range(5000), ("id",), (), RANGE, rows_per_bucket=100, per_range=50)
    assert max(r["count"] for r in cut.groupBy(RANGE).count().collect()) <= 100
    ordered = [r[RANGE] for r in cut.orderBy("id").collect()]
    assert ordered == sorted(ordered)


def test_equal_keys_take_two_rounds_at_most(spark, monkeypatch):
    """100,000 rows of one key: the whole order has no more to say, so rows are numbered and cut."""
    rounds = []
    real = segments.stored_table
    monkeypatch.setattr(segments, "stored_table", lambda df, name: rounds.append(name) or real(df, name))
    df = spark.range(100_000).selectExpr("cast(5 as bigint) as k")
    positions = ordinal(df, ("k",), rows_per_bucket=20_000)
    assert [r[0] for r in positions.select("position").orderBy("position").collect()] == list(range(1, 100_001))
    assert rounds.count("ranges") <= 2

    stores = []
    cut = cut_in_order(df, ("k",), rows=100_000, rows_per_bucket=20_000, store=lambda out: stores.append(1) or real(out, "t"))
    assert len(stores) <= 2 and max(r["count"] for r in cut.groupBy(RANGE).count().collect()) <= 20_000


def test_many_small_partitions_are_cut(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, *range(40)]), dt.date(2020, 1, 1) + dt.timedelta(rnd.randrange(400)), i, rnd.choice("ab")) for i in range(2000)]
    df = spark.createDataFrame(rows, "key int, day date, id int, v string")
    kw = {"change_on": ("v",), "partition_by": ("key",), "lag_of": {"before": "v"}}
    plain = segments.segment_runs(df, ("day", "id"), bucketed=False, **kw)
    cut = segments.segment_runs(df, ("day", "id"), rows_per_bucket=8, **kw)
    assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))


def test_bitmaps_hold_all_levels(spark):
    levels = [None, 0, 1, -1, 32_768, 32_769, -32_768, -32_767, 2**31 - 1, -(2**31), 65_536, *range(90_000, 160_000)]
    rows = [("a", v) for v in levels] + [("b", None), (None, 4), (None, 4)]
    df = spark.createDataFrame(rows, "breakdown_type string, breakdown_level_int int").repartition(3)
    parts = [level_bitmaps(df.filter(c)) for c in ("breakdown_level_int < 5", "breakdown_level_int >= 5", "breakdown_level_int is null")]
    got = {r["breakdown_type"]: r["levels"] for r in bitmap_levels(merge_bitmaps(*parts)).collect()}
    assert got == {"a": sorted(v for v in levels if v is not None), "b": [], None: [4]}
    one = bitmap_levels(level_bitmaps(df)).select("breakdown_type", join_ints(F.col("levels")).alias("s"))
    assert {r[0]: r[1] for r in one.collect()}["b"] == ""


@pytest.mark.parametrize("limit", [24 << 20, 0])
def test_except_distinct(spark, limit):
    """Nulls equal nulls; a hot value and duplicates on both sides."""
    left = [(1, "a"), (1, "a"), (None, "b"), (None, None), (2, None), *[(7, "hot")] * 3000, *[(8, "hot")] * 3000]
    right = [(None, "b"), (2, None), (3, "c"), *[(7, "hot")] * 3000]
    make = lambda rows: spark.createDataFrame(rows, "x int, y string").repartition(4)
    got = except_distinct(make(left), make(right).toDF("p", "q"), prefilter_bytes=limit)
    assert sorted(map(tuple, got.collect()), key=str) == sorted({*left} - {*right}, key=str)
    assert got.columns == ["x", "y"]


def test_entry_works_without_what_the_text_queries_need():
    script = (
        "import sys; sys.modules['public_tokenizers'] = None; sys.path.insert(0, %r); import __spark_entry__ as e; "
        "from streakline.plans import QUERIES; assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql()); print(len(e.queries()))" % ROOT
    )
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=120, env=os.environ)
    assert done.returncode == 0, done.stderr


def test_short_ranges_share_tasks(spark):
    """Thousands of ranges are cut by a few tasks, so neither tasks nor key samples grow with their number."""
    df = spark.range(20_000).selectExpr("id % 3 as part", "(id * 7919) % 997 as k", "id")
    tasks = []

    def store(out):
        tasks.append(out.rdd.getNumPartitions())
        return segments.stored_table(out, "ranges")

    cut = cut_in_order(df, ("k",), ("part",), rows=20_000, rows_per_bucket=20, store=store)
    assert tasks == [8]  # the session's shuffle partitions
    sizes = {r[RANGE]: r["count"] for r in cut.groupBy(RANGE).count().collect()}
    assert max(sizes.values()) <= 20 and 2000 <= len(sizes) <= 2008 and sum(sizes.values()) == 20_000
    ordered = [r[RANGE] for r in cut.orderBy("part", "k", RANGE).collect()]
    assert ordered == sorted(ordered)
