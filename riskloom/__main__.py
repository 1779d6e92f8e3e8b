"""python -m riskloom prepare | profile | run | score"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from riskloom.operators.encode import MAX_LEVELS
from riskloom.operators.evaluate import OPERATING_THRESHOLD
from riskloom.plans.jobs import prepare_job, profile_job, run_job, score_job
from riskloom.sources.csv_files import MissingInput


def main() -> int:
    parser = argparse.ArgumentParser(prog="riskloom")
    jobs = parser.add_subparsers(dest="job", required=True)
    prepare = jobs.add_parser("prepare", help="clean and encode raw loans")
    prepare.add_argument("features")
    prepare.add_argument("target")
    prepare.add_argument("out")
    prepare.add_argument("--key", help="key column of both files; without it rows match by position")
    prepare.add_argument("--cap-outliers", action="store_true", help="values outside the fences become quartiles")
    prepare.add_argument(
        "--exclude-target-inputs", action="store_true", help="drop the columns the loss severity is computed from"
    )
    prepare.add_argument("--null-category", action="store_true", help="a column of its own for missing texts")
    prepare.add_argument("--max-levels", type=int, default=MAX_LEVELS, help="most values of a text column")
    prepare.add_argument("--preparation", metavar="FOLDER", help="save what was learned, for scoring new loans")
    profile = jobs.add_parser("profile", help="describe a cleaned table")
    profile.add_argument("table")
    profile.add_argument("out")
    run = jobs.add_parser("run", help="train, score and report expected loss")
    run.add_argument("table")
    run.add_argument("out")
    run.add_argument("--no-search", action="store_true", help="default parameters instead of grid search")
    run.add_argument("--select-by", choices=["test", "cv"], default="test")
    run.add_argument("--exact", action="store_true", help="exactly a fifth of the loans for the test")
    run.add_argument("--stratify", metavar="COLUMN", help="an exact fifth of each class of this column")
    run.add_argument("--fill", action="append", default=[], metavar="COLUMN=VALUE", help="value for missing cells")
    run.add_argument("--thresholds", type=float, nargs="+", help="thresholds of the sweep")
    run.add_argument("--threshold", type=float, default=OPERATING_THRESHOLD, help="operating point")
    run.add_argument("--max-fit-rows", type=int, help="rows used to fit, about; all if absent")
    run.add_argument("--partitions", type=int, help="partitions of a fit; from the rows if absent")
    score = jobs.add_parser("score", help="score new raw loans with a saved preparation and the models of a run")
    score.add_argument("features")
    score.add_argument("preparation")
    score.add_argument("run", help="output folder of the run job")
    score.add_argument("out")
    score.add_argument("--key", help="key column; without it the position is the key")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("riskloom").getOrCreate()
    try:
        if args.job == "prepare":
            prepare_job(
                spark,
                args.features,
                args.target,
                args.out,
                args.key,
                args.preparation,
                cap_outliers=args.cap_outliers,
                exclude_target_inputs=args.exclude_target_inputs,
                null_category=args.null_category,
                max_levels=args.max_levels,
            )
        elif args.job == "profile":
            profile_job(spark, args.table, args.out)
        elif args.job == "score":
            score_job(spark, args.features, args.preparation, args.run, args.out, args.key)
        else:
            run_job(
                spark,
                args.table,
                args.out,
                search=not args.no_search,
                select_by=args.select_by,
                exact=args.exact,
                stratify=args.stratify,
                fill={c: float(v) for c, _, v in (x.rpartition("=") for x in args.fill)},
                thresholds=args.thresholds,
                threshold=args.threshold,
                max_fit_rows=args.max_fit_rows,
                partitions=args.partitions,
            )
    except MissingInput as e:
        print(f"[ERROR] {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
