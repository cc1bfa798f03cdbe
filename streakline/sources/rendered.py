"""Log lines rendered from the ``events`` table.

The test tables hold no log text, so this turns each event into one request
line of the ``timestamp@url`` format, with a fixed share of defective lines.
The SQL oracle renders the same text with the same rules (see
``streakline.plans.catalog``), so both engines parse identical input.
Every event gives exactly one line; nothing is filtered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .parallel import spread

# --- fixed rendering rules (the SQL oracle uses the same values) ---
URL_PREFIX = "/map/1.0/"
# event_id divisible by ... -> defect (first match wins)
NO_SEPARATOR_EVERY = 97      # line without '@' and without timestamp: many duplicates
NO_TRAILING_SLASH_EVERY = 89  # url ends right after the level: no level match
BAD_TIMESTAMP_EVERY = 83     # date written with slashes
TEXT_LEVEL_EVERY = 79        # level 'hi': still a good line, no numeric level
MULTI_DESCR_EVERY = 4        # type under /multi-descr/ instead of /slab/
SECOND_SEPARATOR_EVERY = 5   # '@v2' appended: a later '@' stays inside the url
# level texts, one after the other, of events divisible by 71: fraction, signs, overflow, padding
LEVEL_FORMS_EVERY = 71
LEVEL_FORMS = ("5.7", "+5", "-3", "99999999999", ".5", " 5 ", "5.", "\t7")
# whole lines, one after the other, of events divisible by 73: blank, tab, empty type, both markers, no level, marker twice
LINE_FORMS_EVERY = 73
LINE_FORMS = (
    "", "\t", "{t}@/map/1.0/slab//256/3/x", "{t}@/map/1.0/multi-descr/second/256/4/slab/first/x", "{t}@/map/1.0/slab/a/256//x",
    "{t}\t@/map/1.0/slab/tab/256/6/x", "{t}@/map/1.0/slab/one/slab/two/256/5/256/6/", "{t}@",
)
# --- end of fixed rules ---


def _nth(forms: tuple[str, ...], every: int) -> Column:
    """The forms in turn, by the quotient of the event id."""
    return F.element_at(F.array(*map(F.lit, forms)), (F.floor(F.col("event_id") / every) % len(forms) + 1).cast("int"))


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def lines_from_events(events: DataFrame, *, min_partitions: int | None = None) -> DataFrame:
    """events -> (arrival_id = event_id, value = rendered line).

    Narrow projection; the events are first spread over the cluster when the
    scan yields fewer tasks than cores (see ``spread``).
    """
    events = spread(events.select("event_id", "ts", "event_type", "props"), min_partitions)
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    marker = F.when(_every(MULTI_DESCR_EVERY), F.lit("multi-descr")).otherwise(F.lit("slab"))
    level = F.when(_every(LEVEL_FORMS_EVERY), _nth(LEVEL_FORMS, LEVEL_FORMS_EVERY)).otherwise(F.get_json_object("props", "$.k"))
    eid = F.col("event_id").cast("string")
    path = F.concat(F.lit(URL_PREFIX), marker, F.lit("/"), F.col("event_type"), F.lit("/256/"))
    suffix = F.when(_every(SECOND_SEPARATOR_EVERY), F.lit("@v2")).otherwise(F.lit(""))
    value = (
        F.when(_every(LINE_FORMS_EVERY), F.replace(_nth(LINE_FORMS, LINE_FORMS_EVERY), F.lit("{t}"), ts))
        .when(_every(NO_SEPARATOR_EVERY), F.concat(marker, F.lit(" "), F.col("event_type")))
        .when(_every(NO_TRAILING_SLASH_EVERY), F.concat(ts, F.lit("@"), path, level))
        .when(
            _every(BAD_TIMESTAMP_EVERY),
            F.concat(F.date_format("ts", "yyyy/MM/dd HH:mm:ss"), F.lit("@"), path, level, F.lit("/"), eid),
        )
        .when(_every(TEXT_LEVEL_EVERY), F.concat(ts, F.lit("@"), path, F.lit("hi/"), eid, suffix))
        .otherwise(F.concat(ts, F.lit(" @ "), path, level, F.lit("/"), eid, suffix))
    )
    return events.select(F.col("event_id").alias("arrival_id"), value.alias("value"))
