"""Randomised shapes: bucketed segmentation and run keys equal the plain window."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from streakline.operators import segment_runs, timeline_runs

BASE = dt.datetime(2024, 1, 1)

row = st.tuples(
    st.one_of(st.none(), st.integers(0, 12)),        # seconds offset (NULL allowed, many ties)
    st.sampled_from(["a", "b", None]),                # change value (NULL allowed)
    st.sampled_from(["p", "p", "p", "q", None]),      # partition key (skewed, NULL allowed)
    st.one_of(st.none(), st.integers(0, 3)),          # level
)


@settings(max_examples=12, deadline=None)
@given(st.lists(row, min_size=1, max_size=120), st.integers(1, 30))
def test_random_shapes(spark, rows, rows_per_bucket):
    data = [(None if s is None else BASE + dt.timedelta(seconds=s), i, c, k, lv)
            for i, (s, c, k, lv) in enumerate(rows)]
    df = spark.createDataFrame(data, "ts timestamp, id long, c string, k string, lv int")
    order = ("ts", "id")
    cols = ["id", "prev_c", "is_new_run", "run_id"]

    def rows_of(frame):
        return sorted(tuple(r[c] for c in cols) for r in frame.collect())

    for part in ((), ("k",)):
        kw = dict(change_on=("c",), partition_by=part, lag_of={"prev_c": "c"})
        assert rows_of(segment_runs(df, order, rows_per_bucket=rows_per_bucket, **kw)) == rows_of(
            segment_runs(df, order, bucketed=False, **kw))
        tk = dict(order_by=order, type_col="c", level_col="lv", partition_by=part, keep_order_columns=True)
        strip = lambda rs: [tuple(r[x] for x in (*part, "Breakdown_Type", "Count_Successive", "Breakdowns_Level"))
                            for r in rs]
        assert strip(timeline_runs(df, rows_per_bucket=rows_per_bucket, **tk).collect()) == strip(
            timeline_runs(df, bucketed=False, **tk).collect())
