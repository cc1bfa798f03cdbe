"""Declared schemas of the tables and reports (checked in tests, used to re-read CSV)."""

from __future__ import annotations

from pyspark.sql import types as T

ARRIVAL_FROM_FILES = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("row", T.LongType()),
])

PARSED = T.StructType([
    T.StructField("ts_str", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("arrival_id", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("breakdown_type", T.StringType()),
    T.StructField("breakdown_level", T.StringType()),
    T.StructField("breakdown_level_int", T.IntegerType()),
])

GOOD = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("arrival_id", T.LongType()),
    T.StructField("breakdown_type", T.StringType()),
    T.StructField("breakdown_level", T.StringType()),
    T.StructField("breakdown_level_int", T.IntegerType()),
    T.StructField("url", T.StringType()),
    T.StructField("value", T.StringType()),
])

BAD = T.StructType([T.StructField("value", T.StringType())])

ORDERED = T.StructType(GOOD.fields + [
    T.StructField("prev_ts", T.TimestampType()),
    T.StructField("is_new_run", T.IntegerType()),
    T.StructField("run_id", T.LongType()),
])

SPANS = T.StructType([
    T.StructField("breakdown_type", T.StringType()),
    T.StructField("run_id", T.LongType()),
    T.StructField("run_length", T.LongType()),
    T.StructField("run_start", T.TimestampType()),
    T.StructField("run_end", T.TimestampType()),
    T.StructField("levels_in_run_str", T.StringType()),
])

SUMMARY = T.StructType([
    T.StructField("breakdown_type", T.StringType()),
    T.StructField("total_events", T.LongType()),
    T.StructField("runs_count", T.LongType()),
    T.StructField("max_run_length", T.LongType()),
    T.StructField("avg_run_length", T.DoubleType()),
    T.StructField("distinct_levels_str", T.StringType()),
])

LEVELS = T.StructType([
    T.StructField("breakdown_type", T.StringType()),
    T.StructField("max_run_length", T.LongType()),
    T.StructField("levels", T.StringType()),
])

TIMELINE = T.StructType([
    T.StructField("Breakdown_Type", T.StringType()),
    T.StructField("Count_Successive", T.LongType()),
    T.StructField("Breakdowns_Level", T.StringType()),
])
