"""Command line: ``python -m streakline`` locally, ``spark-submit job.py`` on a cluster.

One-shot:  --input LOGS --output DIR --bad DIR
Staged:    --stage read --input LOGS --stage_dir DIR --bad DIR
           --stage sort|compute --stage_dir DIR
           --stage save --stage_dir DIR --output DIR
Only the flags a stage uses are required.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import STAGES, TIMELINE_FORMS, run_once, run_stage


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="streakline", description=__doc__,
                                     formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--input", help="log file(s) or folder")
    parser.add_argument("--output", help="report folder")
    parser.add_argument("--bad", help="bad-line folder")
    parser.add_argument("--stage", choices=STAGES)
    parser.add_argument("--stage_dir", help="shared folder for stage tables")
    parser.add_argument("--order", choices=("files", "scan", "dense"), default="files",
                        help="tie order of equal timestamps: file name then line (default), the same as one dense number, or scan order")
    parser.add_argument("--final_csv", help="path of the final report (default: OUTPUT/final.csv)")
    parser.add_argument("--timeline", choices=TIMELINE_FORMS, default="levels",
                        help="timeline report: runs with their levels (default), run lengths alone, or levels in bounded pieces")
    parser.add_argument("--skip_done", action="store_true", help="leave out a stage that is complete for the same input and parameters")
    parser.add_argument("--one_file", action="store_true", help="write each per-type report as a single file under exactly its name")
    args = parser.parse_args(argv)
    needs = {None: ("input", "output", "bad"), "read": ("input", "stage_dir", "bad"),
             "sort": ("stage_dir",), "compute": ("stage_dir",), "save": ("stage_dir", "output")}[args.stage]
    missing = [f"--{n}" for n in needs if getattr(args, n) is None]
    if missing:
        parser.error(f"missing {' '.join(missing)}")
    spark = SparkSession.builder.appName("streakline").getOrCreate()
    try:
        if args.stage is None:
            run_once(spark, args.input, args.output, args.bad, order=args.order, final_csv=args.final_csv,
                     timeline=args.timeline, one_file=args.one_file)
        else:
            run_stage(spark, args.stage, input_path=args.input, stage_dir=args.stage_dir, bad_dir=args.bad,
                      output_dir=args.output, order=args.order, final_csv=args.final_csv, timeline=args.timeline,
                      skip_done=args.skip_done, one_file=args.one_file)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
