"""Query catalogue: every operator as a query over the test tables, with a SQL oracle.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE_SQL[name]`` is
DuckDB SQL over the same tables (registered as views) that must give the
same rows.  Timestamps leave both as zone-free ``timestamp_ntz``.

The log-format queries read ``lines_from_events(events)``: one rendered log
line per event, all events, nothing filtered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import first_segment, join_ints, lenient_int, parse_lines
from ..operators import (
    RunStates,
    except_distinct,
    level_bitmaps,
    merge_bitmaps,
    merge_states,
    ordinal,
    run_state,
    segment_runs,
    span_table,
    split_valid,
    timeline_run_pieces,
    timeline_runs,
    type_levels,
    type_levels_of_spans,
    type_ordered,
    type_spans,
    type_summary,
)
from ..operators.levels import bitmap_levels
from ..operators.segments import stored_table
from ..session import scratch_path
from ..sinks import Versions, read_csv_report, write_bad_lines, write_csv, write_one_file, write_table
from ..sources import lines_from_events, read_log_lines
from ..sources.numbering import dense_numbers, split_offsets
from .staged import run_once, stage_compute, stage_read, stage_save, stage_sort

Query = Callable[[SparkSession, str], DataFrame]


# ----------------------------------------------------------------- helpers
def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ntz(df: DataFrame) -> DataFrame:
    """Session-zone timestamps -> zone-free wall clock (as the SQL oracle returns them)."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_from_events(_table(spark, sf_dir, "events"))


def _parsed(spark, sf_dir):
    return parse_lines(_lines(spark, sf_dir))


def _good(spark, sf_dir):
    return split_valid(_parsed(spark, sf_dir))[0]


def _bad(spark, sf_dir):
    return split_valid(_parsed(spark, sf_dir))[1]


# ----------------------------------------------------------------- queries
def q_parse_fields(spark, sf_dir):
    return _ntz(_parsed(spark, sf_dir))


def q_good_lines(spark, sf_dir):
    return _ntz(_good(spark, sf_dir))


def q_bad_lines(spark, sf_dir):
    return _bad(spark, sf_dir)


def q_type_ordered(spark, sf_dir):
    return _ntz(type_ordered(_good(spark, sf_dir)))


def q_type_spans(spark, sf_dir):
    return _ntz(type_spans(_good(spark, sf_dir)))


def q_type_summary(spark, sf_dir):
    return type_summary(span_table(_good(spark, sf_dir)))


def q_type_summary_left_join(spark, sf_dir):
    spans = span_table(_good(spark, sf_dir))
    return type_summary(spans, levels=type_levels_of_spans(spans))


def q_type_levels(spark, sf_dir):
    return type_levels(type_summary(span_table(_good(spark, sf_dir))))


#: Rows per range of the queries that cut the test tables.
SMALL_RANGE = 2000
#: Rows per piece of the pieces query.
PIECE_ROWS = 3


def q_type_ordered_bucketed(spark, sf_dir):
    return _ntz(type_ordered(_good(spark, sf_dir), rows_per_bucket=SMALL_RANGE))


def q_timeline_runs(spark, sf_dir):
    return timeline_runs(_good(spark, sf_dir))


def q_timeline_runs_bucketed(spark, sf_dir):
    return timeline_runs(_good(spark, sf_dir), rows_per_bucket=SMALL_RANGE)


def q_timeline_runs_positioned(spark, sf_dir):
    """The report's order as a column: the number of each run."""
    runs = timeline_runs(_good(spark, sf_dir), rows_per_bucket=SMALL_RANGE, keep_order_columns=True)
    return _ntz(runs.withColumnRenamed("run_id", "position"))


def q_timeline_run_pieces(spark, sf_dir):
    """Levels of the runs in pieces of PIECE_ROWS rows, from a timeline that is cut, too."""
    return timeline_run_pieces(_good(spark, sf_dir), piece_rows=PIECE_ROWS, rows_per_bucket=SMALL_RANGE)


def _raw_events(spark, sf_dir):
    return _table(spark, sf_dir, "events").select(
        "ts", "event_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("level"))


_RAW = {"order_by": ("ts", "event_id"), "type_col": "event_type", "level_col": "level"}


def q_timeline_runs_raw(spark, sf_dir):
    """Timeline runs straight on ``events`` (microsecond times, event_id tie-break)."""
    return timeline_runs(_raw_events(spark, sf_dir), **_RAW)


def q_timeline_runs_raw_bucketed(spark, sf_dir):
    return timeline_runs(_raw_events(spark, sf_dir), rows_per_bucket=SMALL_RANGE, **_RAW)


def q_timeline_sorted(spark, sf_dir):
    """Good rows with their position in the global (timestamp, arrival) order."""
    return _ntz(ordinal(_good(spark, sf_dir), ("timestamp", "arrival_id")))


def q_timeline_sorted_bucketed(spark, sf_dir):
    return _ntz(ordinal(_good(spark, sf_dir), ("timestamp", "arrival_id"), rows_per_bucket=SMALL_RANGE))


def _status_runs(spark, sf_dir, key, **kw):
    orders = _table(spark, sf_dir, "orders").select(key, "o_orderdate", "o_orderkey", "o_orderstatus")
    seg = segment_runs(orders, ("o_orderdate", "o_orderkey"), change_on=("o_orderstatus",),
                       partition_by=(key,), **kw)
    return seg.groupBy(key, "run_id", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("run_length"),
        F.min("o_orderdate").alias("run_start"),
        F.max("o_orderdate").alias("run_end"),
    )


def q_status_runs_by_customer(spark, sf_dir):
    return _status_runs(spark, sf_dir, "o_custkey")


def q_status_runs_bucketed(spark, sf_dir):
    """Status runs per order priority: a few large partitions, each cut into ranges."""
    return _status_runs(spark, sf_dir, "o_orderpriority", rows_per_bucket=SMALL_RANGE)


def q_status_runs_by_customer_bucketed(spark, sf_dir):
    """Status runs per customer with every customer of more than CUSTOMER_RANGE orders cut: very many small partitions in ranges."""
    return _status_runs(spark, sf_dir, "o_custkey", rows_per_bucket=CUSTOMER_RANGE)


#: Rows per range of the query that cuts customers.
CUSTOMER_RANGE = 8


def _thirds(df, time):
    """Three parts of ``df`` by time, each as long."""
    low, high = df.agg(F.min(F.unix_micros(time)), F.max(F.unix_micros(time))).first()
    cuts = [low + (high + 1 - low) * k // 3 for k in range(4)]
    return [df.filter((F.unix_micros(time) >= a) & (F.unix_micros(time) < b)) for a, b in zip(cuts, cuts[1:])]


def _good_thirds(spark, sf_dir):
    """The good lines in three parts by time; stored first, what the reports take of them, so that the log is parsed once and not for every pass over a part."""
    good = _good(spark, sf_dir).select("timestamp", "arrival_id", "breakdown_type", "breakdown_level_int")
    return _thirds(stored_table(good, "good"), "timestamp")


def _merged(spark, sf_dir):
    """The log in three parts, fed last part first; the first two are merged to one."""
    states = RunStates(spark, scratch_path(spark, "run-states"))
    for name, part in reversed(list(zip("abc", _good_thirds(spark, sf_dir)))):
        states.add(name, part)
    states.compact(["b", "a"], "ab")
    return states


def q_timeline_runs_merged(spark, sf_dir):
    return _merged(spark, sf_dir).timeline()


def q_summary_merged(spark, sf_dir):
    return _merged(spark, sf_dir).summary()


def q_status_runs_merged(spark, sf_dir):
    """Status runs per customer from a state for each year of orders."""
    orders = _table(spark, sf_dir, "orders").withColumn("none", F.lit(None).cast("int"))
    years = [r[0] for r in orders.select(F.year("o_orderdate")).distinct().collect()]  # a row per part
    states = [
        run_state(orders.filter(F.year("o_orderdate") == y), order_by=("o_orderdate", "o_orderkey"), type_col="o_orderstatus", level_col="none", partition_by=("o_custkey",))
        for y in years
    ]
    return merge_states(states, ("o_custkey",)).select(
        "o_custkey", "run_id", F.col("Breakdown_Type").alias("o_orderstatus"), F.col("Count_Successive").alias("run_length"),
        "run_start", F.col("last_key.o_orderdate").alias("run_end"))


def q_arrival_numbers(spark, sf_dir):
    """Lines of a text log with their dense numbers by file and line."""
    lines = read_log_lines(spark, _text_log(spark, sf_dir))
    path, splits = scratch_path(spark, "arrived"), scratch_path(spark, "splits")
    write_table(lines, path)
    write_table(split_offsets(spark.read.parquet(path)), splits)
    return dense_numbers(spark.read.parquet(path), spark.read.parquet(splits))


def q_staged_dense(spark, sf_dir):
    """The staged timeline of a log whose arrival ids are dense numbers."""
    log, stage, out = _text_log(spark, sf_dir), scratch_path(spark, "stage"), scratch_path(spark, "out")
    stage_read(spark, log, stage, scratch_path(spark, "bad"), order="dense")
    stage_sort(spark, stage, rows_per_bucket=SMALL_RANGE)
    stage_compute(spark, stage, rows_per_bucket=SMALL_RANGE)
    stage_save(spark, stage, out, rows_per_bucket=SMALL_RANGE)
    return read_csv_report(spark, f"{out}/exo_runs_output.csv", schemas.TIMELINE)


def q_versioned_summary(spark, sf_dir):
    """The summary as the second version of a report, after the spans as its first and before a write that fails."""
    versions = Versions(spark, scratch_path(spark, "versions"))
    spans = span_table(_good(spark, sf_dir))
    versions.publish(lambda folder: write_csv(spans.drop("levels_in_run_int"), folder, single_part=True))
    versions.publish(lambda folder: write_csv(type_summary(spans), folder, single_part=True))

    def fails(folder):
        write_csv(type_summary(spans.limit(1)), folder, single_part=True)
        raise InterruptedError

    try:
        versions.publish(fails)
    except InterruptedError:
        pass
    return read_csv_report(spark, versions.folder(), schemas.SUMMARY)


def q_one_file_levels(spark, sf_dir):
    """The minimal summary as a single file of its own name."""
    path = f"{scratch_path(spark, 'reports')}/exo_output.csv"
    write_one_file(type_levels(type_summary(span_table(_good(spark, sf_dir)))), path)
    return read_csv_report(spark, path, schemas.LEVELS)


def q_bad_lines_except(spark, sf_dir):
    """Bad lines as all lines EXCEPT DISTINCT the good ones."""
    parsed = _parsed(spark, sf_dir)
    return except_distinct(parsed.select("value"), split_valid(parsed)[0].select("value"))


def q_type_levels_bitmaps(spark, sf_dir):
    """Distinct levels of each type from bitmaps of three parts of the log."""
    state = merge_bitmaps(*[level_bitmaps(part) for part in _good_thirds(spark, sf_dir)])
    return bitmap_levels(state).select("breakdown_type", join_ints(F.col("levels")).alias("distinct_levels_str"))


# fixed values: language path markers of the test pages, in priority order
PAGE_LANGUAGES = ("en", "fr", "de", "es")


def q_page_url_segments(spark, sf_dir):
    url = F.col("url")
    return _table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract(url, "^[a-z]+://([^/]+)/", 1).alias("host"),
        F.regexp_extract(url, "^[a-z]+://[^/]+/([^/]+)/", 1).alias("lang"),
        first_segment(url, PAGE_LANGUAGES).alias("item_segment"),
        lenient_int(F.regexp_extract(url, "^[a-z]+://[^/]+/[^/]+/([^/?#]+)", 1)).alias("item_no"),
    )


def q_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv_roundtrip")
    write_csv(type_summary(span_table(_good(spark, sf_dir))), path, single_part=True)
    return read_csv_report(spark, path, schemas.SUMMARY)


def q_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "parquet_roundtrip")
    write_table(_good(spark, sf_dir), path)
    return _ntz(spark.read.parquet(path))


def q_badline_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "bad_lines")
    write_bad_lines(_bad(spark, sf_dir), path, keep_history=True)
    return spark.read.text(path).select("value")


def _text_log(spark, sf_dir) -> str:
    """Rendered lines written as a text log, in event order, for the file-based stages."""
    path = scratch_path(spark, "log_text")
    _lines(spark, sf_dir).orderBy("arrival_id").select("value").write.text(path)
    return path


def _staged(spark, sf_dir) -> str:
    log, stage, out = _text_log(spark, sf_dir), scratch_path(spark, "stage"), scratch_path(spark, "out")
    stage_read(spark, log, stage, scratch_path(spark, "bad"))
    stage_sort(spark, stage)
    stage_compute(spark, stage)
    stage_save(spark, stage, out)
    return out


def q_staged_summary(spark, sf_dir):
    out = _staged(spark, sf_dir)
    return read_csv_report(spark, f"{out}/final.csv", schemas.SUMMARY)


def q_staged_timeline(spark, sf_dir):
    out = _staged(spark, sf_dir)
    return read_csv_report(spark, f"{out}/exo_runs_output.csv", schemas.TIMELINE)


def _oneshot(spark, sf_dir, **kw) -> str:
    out = scratch_path(spark, "oneshot")
    run_once(spark, _text_log(spark, sf_dir), out, scratch_path(spark, "bad"), **kw)
    return out


def q_oneshot_levels(spark, sf_dir):
    return read_csv_report(spark, f"{_oneshot(spark, sf_dir)}/exo_output.csv", schemas.LEVELS)


def q_oneshot_runs(spark, sf_dir):
    """The span and summary folders of the one-shot job, of a log that is cut into ranges on the way."""
    out = _oneshot(spark, sf_dir, rows_per_bucket=SMALL_RANGE)
    spans = read_csv_report(spark, f"{out}/runs", schemas.SPANS)
    return _ntz(spans.join(read_csv_report(spark, f"{out}/summary", schemas.SUMMARY), "breakdown_type"))


def q_oneshot_timeline(spark, sf_dir):
    out = _oneshot(spark, sf_dir, rows_per_bucket=SMALL_RANGE)
    return read_csv_report(spark, f"{out}/exo_runs_output.csv", schemas.TIMELINE)


QUERIES: dict[str, Query] = {
    "parse_fields": q_parse_fields,
    "good_lines": q_good_lines,
    "bad_lines": q_bad_lines,
    "type_ordered": q_type_ordered,
    "type_spans": q_type_spans,
    "type_summary": q_type_summary,
    "type_summary_left_join": q_type_summary_left_join,
    "type_levels": q_type_levels,
    "timeline_runs": q_timeline_runs,
    "timeline_run_pieces": q_timeline_run_pieces,
    "timeline_runs_raw": q_timeline_runs_raw,
    "timeline_sorted": q_timeline_sorted,
    "status_runs_by_customer": q_status_runs_by_customer,
    "page_url_segments": q_page_url_segments,
    "csv_roundtrip": q_csv_roundtrip,
    "parquet_roundtrip": q_parquet_roundtrip,
    "badline_roundtrip": q_badline_roundtrip,
    "staged_summary": q_staged_summary,
    "staged_timeline": q_staged_timeline,
    "oneshot_levels": q_oneshot_levels,
    "oneshot_runs": q_oneshot_runs,
    "oneshot_timeline": q_oneshot_timeline,
    "type_ordered_bucketed": q_type_ordered_bucketed,
    "timeline_runs_bucketed": q_timeline_runs_bucketed,
    "timeline_runs_positioned": q_timeline_runs_positioned,
    "timeline_runs_raw_bucketed": q_timeline_runs_raw_bucketed,
    "timeline_sorted_bucketed": q_timeline_sorted_bucketed,
    "status_runs_bucketed": q_status_runs_bucketed,
    "status_runs_by_customer_bucketed": q_status_runs_by_customer_bucketed,
    "timeline_runs_merged": q_timeline_runs_merged,
    "summary_merged": q_summary_merged,
    "status_runs_merged": q_status_runs_merged,
    "arrival_numbers": q_arrival_numbers,
    "staged_dense": q_staged_dense,
    "versioned_summary": q_versioned_summary,
    "one_file_levels": q_one_file_levels,
    "bad_lines_except": q_bad_lines_except,
    "type_levels_bitmaps": q_type_levels_bitmaps,
}


# ----------------------------------------------------------------- SQL oracle
# padding of a lenient number: control characters, space and DEL
_PAD = "[\\x00-\\x1F \\x7F]*"

_LINES = r"""
lines AS (
  SELECT event_id AS arrival_id,
    CASE
      WHEN event_id % 73 = 0 THEN CASE (event_id // 73) % 8
        WHEN 0 THEN '' WHEN 1 THEN chr(9) WHEN 2 THEN t || '@/map/1.0/slab//256/3/x'
        WHEN 3 THEN t || '@/map/1.0/multi-descr/second/256/4/slab/first/x' WHEN 4 THEN t || '@/map/1.0/slab/a/256//x'
        WHEN 5 THEN t || chr(9) || '@/map/1.0/slab/tab/256/6/x' WHEN 6 THEN t || '@/map/1.0/slab/one/slab/two/256/5/256/6/'
        ELSE t || '@' END
      WHEN event_id % 97 = 0 THEN m || ' ' || event_type
      WHEN event_id % 89 = 0 THEN t || '@' || p || k
      WHEN event_id % 83 = 0 THEN strftime(ts, '%Y/%m/%d %H:%M:%S') || '@' || p || k || '/' || CAST(event_id AS VARCHAR)
      WHEN event_id % 79 = 0 THEN t || '@' || p || 'hi/' || CAST(event_id AS VARCHAR) || s
      ELSE t || ' @ ' || p || k || '/' || CAST(event_id AS VARCHAR) || s
    END AS value
  FROM (
    SELECT *, '/map/1.0/' || m || '/' || event_type || '/256/' AS p
    FROM (
      SELECT event_id, ts, event_type,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS t,
        CASE WHEN event_id % 4 = 0 THEN 'multi-descr' ELSE 'slab' END AS m,
        CASE WHEN event_id % 71 <> 0 THEN json_extract_string(props, '$.k') ELSE CASE (event_id // 71) % 8
          WHEN 0 THEN '5.7' WHEN 1 THEN '+5' WHEN 2 THEN '-3' WHEN 3 THEN '99999999999'
          WHEN 4 THEN '.5' WHEN 5 THEN ' 5 ' WHEN 6 THEN '5.' ELSE chr(9) || '7' END END AS k,
        CASE WHEN event_id % 5 = 0 THEN '@v2' ELSE '' END AS s
      FROM events))
)"""

_PARSED = rf"""
split AS (
  SELECT
    trim(CASE WHEN strpos(value, '@') > 0 THEN substr(value, 1, strpos(value, '@') - 1) ELSE value END, ' ') AS ts_str,
    trim(CASE WHEN strpos(value, '@') > 0 THEN substr(value, strpos(value, '@') + 1) END, ' ') AS url,
    value, arrival_id
  FROM lines
),
lvl AS (
  SELECT *, regexp_extract(url, '/256/([^/]+)/', 1) AS breakdown_level FROM split
),
parsed AS (
  SELECT ts_str, url, value, arrival_id,
    -- strptime skips white space that the format does not have
    CASE WHEN regexp_matches(ts_str, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}$')
         THEN try_strptime(ts_str, '%Y-%m-%d %H:%M:%S') END AS "timestamp",
    coalesce(nullif(regexp_extract(url, '/slab/([^/]+)/', 1), ''),
             nullif(regexp_extract(url, '/multi-descr/([^/]+)/', 1), '')) AS breakdown_type,
    breakdown_level,
    CASE WHEN regexp_matches(breakdown_level, '^{_PAD}[+-]?\.[0-9]*{_PAD}$') THEN 0
         ELSE TRY_CAST(nullif(regexp_extract(breakdown_level, '^{_PAD}([+-]?[0-9]+)(\.[0-9]*)?{_PAD}$', 1), '') AS INTEGER)
    END AS breakdown_level_int
  FROM lvl
),
good AS (
  SELECT "timestamp", arrival_id, breakdown_type, breakdown_level, breakdown_level_int, url, value
  FROM parsed
  WHERE "timestamp" IS NOT NULL AND breakdown_type IS NOT NULL AND breakdown_type <> ''
    AND breakdown_level IS NOT NULL AND breakdown_level <> ''
)"""

_ORDERED = r"""
o1 AS (
  SELECT *, lag("timestamp") OVER (PARTITION BY breakdown_type ORDER BY "timestamp", arrival_id) AS prev_ts FROM good
),
o2 AS (SELECT *, CASE WHEN prev_ts IS NULL THEN 1 ELSE 0 END AS is_new_run FROM o1),
ordered AS (
  SELECT *, CAST(sum(is_new_run) OVER (PARTITION BY breakdown_type ORDER BY "timestamp", arrival_id
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run_id
  FROM o2
)"""

_LEVEL_LIST = ("coalesce(array_to_string(list_sort(list(DISTINCT breakdown_level_int) "
               "FILTER (WHERE breakdown_level_int IS NOT NULL)), ','), '')")

_SPANS = rf"""
spans AS (
  SELECT breakdown_type, run_id, count(*) AS run_length, min("timestamp") AS run_start,
         max("timestamp") AS run_end, {_LEVEL_LIST} AS levels_in_run_str
  FROM ordered GROUP BY breakdown_type, run_id
)"""

_SUMMARY = rf"""
core AS (
  SELECT breakdown_type, CAST(sum(run_length) AS BIGINT) AS total_events, count(run_id) AS runs_count,
         max(run_length) AS max_run_length, round(avg(run_length), 2) AS avg_run_length
  FROM spans GROUP BY breakdown_type
),
type_lv AS (SELECT breakdown_type, {_LEVEL_LIST} AS distinct_levels_str FROM ordered GROUP BY breakdown_type),
summary AS (SELECT core.*, type_lv.distinct_levels_str FROM core LEFT JOIN type_lv USING (breakdown_type))"""


def _timeline_sql(src: str, ts: str, aid: str, typ: str, lvl: str) -> str:
    return f"""
t1 AS (SELECT *, lag({typ}) OVER (ORDER BY {ts}, {aid}) AS prev_type FROM {src}),
t2 AS (SELECT *, CASE WHEN prev_type IS NULL OR prev_type <> {typ} THEN 1 ELSE 0 END AS f FROM t1),
t3 AS (SELECT *, sum(f) OVER (ORDER BY {ts}, {aid} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rid FROM t2),
timeline AS (
  SELECT {typ} AS Breakdown_Type, count(*) AS Count_Successive,
         coalesce(string_agg(CAST({lvl} AS VARCHAR), ',' ORDER BY {ts}, {aid}), '') AS Breakdowns_Level
  FROM t3 GROUP BY rid, {typ}
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_BASE = (_LINES, _PARSED)
_TIMELINE_GOOD = _timeline_sql("good", '"timestamp"', "arrival_id", "breakdown_type", "breakdown_level_int")
_SUMMARY_SQL = _with(*_BASE, _ORDERED, _SPANS, _SUMMARY) + "SELECT * FROM summary"
_TIMELINE_SQL = _with(*_BASE, _TIMELINE_GOOD) + "SELECT * FROM timeline"
_GOOD_SQL = _with(*_BASE) + "SELECT * FROM good"
_BAD_SQL = _with(*_BASE) + "SELECT value FROM lines EXCEPT SELECT value FROM good"
_LEVELS_SQL = (_with(*_BASE, _ORDERED, _SPANS, _SUMMARY)
               + "SELECT breakdown_type, max_run_length, distinct_levels_str AS levels FROM summary")

_RAW_SQL = _with(
        "ev AS (SELECT ts, event_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS level "
        "FROM events)",
        _timeline_sql("ev", "ts", "event_id", "event_type", "level"),
    ) + "SELECT * FROM timeline"
_SORTED_SQL = _with(*_BASE) + 'SELECT *, row_number() OVER (ORDER BY "timestamp", arrival_id) AS position FROM good'
_STATUS_SQL = """
WITH s1 AS (
  SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus,
    CASE WHEN row_number() OVER w = 1 OR lag(o_orderstatus) OVER w IS DISTINCT FROM o_orderstatus
         THEN 1 ELSE 0 END AS f
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
),
s2 AS (
  SELECT *, sum(f) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_id
  FROM s1
)
SELECT o_custkey, CAST(run_id AS BIGINT) AS run_id, o_orderstatus, count(*) AS run_length,
       min(o_orderdate) AS run_start, max(o_orderdate) AS run_end
FROM s2 GROUP BY o_custkey, run_id, o_orderstatus"""

ORACLE_SQL: dict[str, str] = {
    "parse_fields": _with(*_BASE) + "SELECT * FROM parsed",
    "good_lines": _GOOD_SQL,
    "bad_lines": _BAD_SQL,
    "type_ordered": _with(*_BASE, _ORDERED) + "SELECT * FROM ordered",
    "type_spans": _with(*_BASE, _ORDERED, _SPANS) + "SELECT * FROM spans",
    "type_summary": _SUMMARY_SQL,
    "type_summary_left_join": _SUMMARY_SQL,
    "type_levels": _LEVELS_SQL,
    "timeline_runs": _TIMELINE_SQL,
    "timeline_runs_bucketed": _TIMELINE_SQL,
    "timeline_runs_positioned": _with(*_BASE, _TIMELINE_GOOD) + (
        'SELECT row_number() OVER (ORDER BY rid) AS position, breakdown_type AS Breakdown_Type, count(*) AS Count_Successive, '
        "coalesce(string_agg(CAST(breakdown_level_int AS VARCHAR), ',' ORDER BY \"timestamp\", arrival_id), '') AS Breakdowns_Level, "
        'min("timestamp") AS run_start FROM t3 GROUP BY rid, breakdown_type'),
    "timeline_run_pieces": _with(*_BASE, _TIMELINE_GOOD) + (
        'SELECT CAST(rid AS BIGINT) AS run_id, CAST(p // 3 AS BIGINT) AS piece, breakdown_type AS Breakdown_Type, count(*) AS Count_In_Piece, '
        "coalesce(string_agg(CAST(breakdown_level_int AS VARCHAR), ',' ORDER BY \"timestamp\", arrival_id), '') AS Breakdowns_Level "
        'FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY "timestamp", arrival_id) - 1 AS p FROM t3) '
        'GROUP BY rid, p // 3, breakdown_type'),
    "timeline_runs_raw": _RAW_SQL,
    "timeline_runs_raw_bucketed": _RAW_SQL,
    "timeline_sorted": _SORTED_SQL,
    "timeline_sorted_bucketed": _SORTED_SQL,
    "type_ordered_bucketed": _with(*_BASE, _ORDERED) + "SELECT * FROM ordered",
    "status_runs_by_customer": _STATUS_SQL,
    "status_runs_bucketed": _STATUS_SQL.replace("o_custkey", "o_orderpriority"),
    "status_runs_by_customer_bucketed": _STATUS_SQL,
    "status_runs_merged": _STATUS_SQL,
    "timeline_runs_merged": _TIMELINE_SQL,
    "summary_merged": _SUMMARY_SQL,
    "arrival_numbers": _with(_LINES) + "SELECT value, row_number() OVER (ORDER BY arrival_id) - 1 AS arrival_id FROM lines",
    "staged_dense": _TIMELINE_SQL,
    "versioned_summary": _SUMMARY_SQL,
    "one_file_levels": _LEVELS_SQL,
    "bad_lines_except": _BAD_SQL,
    "type_levels_bitmaps": _with(*_BASE) + f"SELECT breakdown_type, {_LEVEL_LIST} AS distinct_levels_str FROM good GROUP BY breakdown_type",
    "page_url_segments": rf"""
SELECT page_id,
  regexp_extract(url, '^[a-z]+://([^/]+)/', 1) AS host,
  regexp_extract(url, '^[a-z]+://[^/]+/([^/]+)/', 1) AS lang,
  coalesce(nullif(regexp_extract(url, '/en/([^/]+)/', 1), ''), nullif(regexp_extract(url, '/fr/([^/]+)/', 1), ''),
           nullif(regexp_extract(url, '/de/([^/]+)/', 1), ''), nullif(regexp_extract(url, '/es/([^/]+)/', 1), ''))
    AS item_segment,
  CASE WHEN regexp_matches(seg, '^{_PAD}[+-]?\.[0-9]*{_PAD}$') THEN 0
       ELSE TRY_CAST(nullif(regexp_extract(seg, '^{_PAD}([+-]?[0-9]+)(\.[0-9]*)?{_PAD}$', 1), '') AS INTEGER)
  END AS item_no
FROM (SELECT *, regexp_extract(url, '^[a-z]+://[^/]+/[^/]+/([^/?#]+)', 1) AS seg FROM pages)""",
    "csv_roundtrip": _SUMMARY_SQL,
    "parquet_roundtrip": _GOOD_SQL,
    "badline_roundtrip": _BAD_SQL,
    "staged_summary": _SUMMARY_SQL,
    "staged_timeline": _TIMELINE_SQL,
    "oneshot_levels": _LEVELS_SQL,
    "oneshot_runs": _with(*_BASE, _ORDERED, _SPANS, _SUMMARY) + "SELECT * FROM spans JOIN summary USING (breakdown_type)",
    "oneshot_timeline": _TIMELINE_SQL,
}
