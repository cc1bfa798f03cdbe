"""Parse and quarantine edge cases (hand-made lines)."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streakline.functions import lenient_int, parse_lines, segment_after, split_first
from streakline.operators import split_valid

T = "2017-10-05 00:01:09"

# line -> (good?, type, level text, level int)
CASES = {
    f"{T}@/m/slab/a/256/19/x": (True, "a", "19", 19),
    f"{T} @ /m/slab/a/256/19/x ": (True, "a", "19", 19),
    f"\t{T}@/m/slab/a/256/19/x": (False, "a", "19", 19),
    f"2017-10-5 00:01:09@/m/slab/a/256/19/x": (False, "a", "19", 19),
    f"{T}.123@/m/slab/a/256/19/x": (False, "a", "19", 19),
    "2017-10-05@/m/slab/a/256/19/x": (False, "a", "19", 19),
    "2017-13-05 00:01:09@/m/slab/a/256/19/x": (False, "a", "19", 19),
    "2017-02-30 00:01:09@/m/slab/a/256/19/x": (False, "a", "19", 19),
    f"{T}@/m/slab/a/256/19": (False, "a", "", None),
    f"{T}@/m/slab//256/19/x": (False, None, "19", 19),
    f"{T}@/m/slab/ /256/1/x": (True, " ", "1", 1),
    f"{T}@/m/slab/a@b/256/7/x@y": (True, "a@b", "7", 7),
    f"{T}@/m/multi-descr/q/256/3/slab/z/256/4/x": (True, "z", "3", 3),
    f"{T}@/m/multi-descr/q/256/3/x": (True, "q", "3", 3),
    f"{T}@/m/slab/a/256/zz/x": (True, "a", "zz", None),
    f"{T}@/m/slab/a/256/5.7/x": (True, "a", "5.7", 5),
    f"{T}@/m/slab/a/256/-5/x": (True, "a", "-5", -5),
    f"{T}@/m/slab/a/256/ 5 /x": (True, "a", " 5 ", 5),
    f"{T}@/m/slab/a/256/99999999999/x": (True, "a", "99999999999", None),
    "noat": (False, None, None, None),
    "": (False, None, None, None),
    "   ": (False, None, None, None),
}


def _lines(spark, values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, arrival_id long")


def test_parse_edge_cases(spark):
    parsed = parse_lines(_lines(spark, list(CASES)))
    good, bad = split_valid(parsed)
    got = {r["value"]: r for r in parsed.collect()}
    good_values = {r["value"] for r in good.collect()}
    for line, (ok, typ, lvl, lvl_int) in CASES.items():
        row = got[line]
        assert (line in good_values) == ok, line
        assert row["breakdown_type"] == typ, line
        assert row["breakdown_level"] == lvl, line
        assert row["breakdown_level_int"] == lvl_int, line
    assert {r["value"] for r in bad.collect()} == {k for k, v in CASES.items() if not v[0]}


def test_timestamp_and_trim(spark):
    row = parse_lines(_lines(spark, [f"  {T}  @  /m/slab/a/256/1/x  "])).collect()[0]
    assert row["ts_str"] == T and row["url"] == "/m/slab/a/256/1/x"
    assert row["timestamp"] == dt.datetime(2017, 10, 5, 0, 1, 9)


def test_bad_lines_are_distinct(spark):
    values = ["noat", "noat", "", "   ", "", f"{T}@/m/slab/a/256/1/x", f"{T}@/m/slab/a/256/1/x"]
    good, bad = split_valid(parse_lines(_lines(spark, values)))
    assert sorted(r["value"] for r in bad.collect()) == ["", "   ", "noat"]
    assert good.count() == 2  # good lines are not de-duplicated


def test_split_first_keeps_later_separators(spark):
    df = spark.createDataFrame([("a@b@c",), ("abc",)], "v string")
    head, tail = split_first("v")
    rows = df.select(head.alias("h"), tail.alias("t")).collect()
    assert [(r["h"], r["t"]) for r in rows] == [("a", "b@c"), ("abc", None)]


def test_segment_after_escapes_marker(spark):
    df = spark.createDataFrame([("/x/a.b/seg/",), ("/x/aXb/seg/",)], "u string")
    assert [r[0] for r in df.select(segment_after("u", "a.b")).collect()] == ["seg", ""]


LEGACY_ALPHABET = "0123456789+-. \t\n\x00\x7fe5x"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=LEGACY_ALPHABET, max_size=8), min_size=50, max_size=120))
def test_lenient_int_equals_legacy_cast(spark, texts):
    """lenient_int == the non-ANSI string->int cast, on random padded numbers."""
    extra = ["5.7", "5.", ".5", ".", "-.5", "-.", "+5", "007", "-5.9", " 5 ", "\t5\n", "5e1", "0x5", "zz",
             "1 2", "-", "", "+", "2147483647", "2147483648", "-2147483648", "-2147483649", "1.2.3", "\x7f7\x7f"]
    df = spark.createDataFrame([(t,) for t in texts + extra], "s string")
    mine = [r[0] for r in df.select(lenient_int("s")).collect()]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = [r[0] for r in df.select(F.col("s").cast("int")).collect()]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert mine == legacy
