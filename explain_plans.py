"""Print the physical plans of the headline operators (markdown) for PLANS.md.

The bucketed forms are forced with a small ``rows_per_bucket`` so that the
plan a large input gets is visible on the sf0.01 tables; inputs are the
Parquet stage table a staged run reads.  Usage: python explain_plans.py > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="streakline-plans-")
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"{scratch}/ck")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from streakline.operators import segments, span_table, split_valid, timeline_runs, type_ordered, type_summary
    from streakline.plans import catalog

    sf = os.environ.get("PLANS_SF_DIR", "/root/testdata/sf0.01")
    catalog._good(spark, sf).write.parquet(f"{scratch}/good")
    good = spark.read.parquet(f"{scratch}/good")
    # the pass over the rows of the bucketed forms is the job that stores their ranges: keep its plan
    passes = []
    store = segments.stored_table
    segments.stored_table = lambda df, name: (passes.append(df) if name == "ranges" else None, store(df, name))[1]
    runs, ordered = timeline_runs(good, rows_per_bucket=2000), type_ordered(good, rows_per_bucket=1000)
    cases = [
        ("Quarantine: bad lines (filter + distinct, one pre-aggregated shuffle)",
         split_valid(catalog._parsed(spark, sf))[1]),
        ("Per-type summary (one groupBy over spans, no window, no join)", type_summary(span_table(good))),
        ("Timeline runs, bucketed (rows_per_bucket=2000): the pass over the event rows, one range and one hash exchange", passes[0]),
        ("Timeline runs, bucketed: joining up the ranges' runs", runs),
        ("Timeline runs, plain window (input under the threshold)", timeline_runs(good, bucketed=False)),
        ("Per-type ordered rows, hot types cut (rows_per_bucket=1000): the pass over the rows", passes[1]),
        ("Per-type ordered rows, hot types cut: the result", ordered),
    ]
    print("# Physical plans\n\nGenerated by `python explain_plans.py` on the sf0.01 tables "
          "(good rows read from a Parquet stage table).\n")
    for title, df in cases:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n\n")[0]
        scans = [ln.strip() for ln in text.splitlines() if ln.startswith(("ReadSchema", "Arguments: hashpartitioning",
                                                                          "Arguments: rangepartitioning",
                                                                          "Arguments: SinglePartition"))]
        print(f"## {title}\n\n```\n{tree.strip()}\n\n" + "\n".join(scans) + "\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
