"""streakline: run analytics over ordered event logs, on Spark DataFrames.

Layout
------
functions/  column expressions (parsing, lenient numbers, array helpers)
sources/    text-log scan with arrival key; lines rendered from ``events``
operators/  quarantine, run segmentation (plain or bucketed), run reports
sinks/      CSV reports, Parquet stage tables, bad-line history
plans/      one-shot and staged jobs, query catalogue with SQL oracles
streaming/  (nothing: the source system processes batch files only)
"""

__version__ = "0.1.0"
