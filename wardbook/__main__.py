"""``spark-submit``-able entry: runs the job and exits with the code of the gate that failed."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from wardbook.errors import JobStopped
from wardbook.operators.validity import MAX_QUARANTINE_RATE
from wardbook.plans.job import JobOptions, run
from wardbook.sources.contracts import read_contract


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="wardbook")
    parser.add_argument("--data-dir", required=True)
    parser.add_argument("--output-dir", required=True)
    parser.add_argument("--incremental", action="store_true", help="load only months not yet in the fact")
    parser.add_argument("--reprocess-corrected", action="store_true",
                        help="with --incremental, also reload months with later updates")
    parser.add_argument("--reference-metadata", help="metadata export to compare with")
    parser.add_argument("--contract", help="contract file to use instead of the built-in one")
    parser.add_argument("--multi-line", action="store_true", help="exports are pretty-printed")
    parser.add_argument("--data-values-as-lines", action="store_true",
                        help="data values are one record per line")
    parser.add_argument("--split-data-values", action="store_true",
                        help="data-value documents are big: read each with many tasks")
    parser.add_argument("--keep-corrupt", action="store_true", help="keep the text of documents that do not parse")
    parser.add_argument("--strict-periods", action="store_true", help="a period needs a month from 01 to 12")
    parser.add_argument("--max-quarantine-rate", type=float, default=MAX_QUARANTINE_RATE)
    parser.add_argument("--calendar", action="store_true", help="compare months by the calendar, not by rows")
    parser.add_argument("--min-periods", type=int, default=1, help="months a rolling average needs")
    parser.add_argument("--exclude-current", action="store_true", help="judge a value by the ones before it only")
    parser.add_argument("--equal-facilities", action="store_true", help="each facility weighs the same in mean scores")
    parser.add_argument("--keep-null-country", action="store_true", help="give the null country a reporting rate")
    parser.add_argument("--facility-register", action="store_true", help="expect all facilities of the tree to report")
    parser.add_argument("--additive-volumes", action="store_true", help="sum indicators that add up only")
    parser.add_argument("--tree-from-parents", action="store_true", help="take the tree from parent links, not from paths")
    parser.add_argument("--run-time", help="time of this run in the metadata history, now by default")
    parser.add_argument("--drift-since", help="also report metadata changes since this time")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("wardbook").getOrCreate()
    given = {k: v for k, v in vars(args).items() if k not in ("data_dir", "output_dir", "contract")}
    if args.contract:
        given["contract"] = tuple(read_contract(spark, args.contract))
    options = JobOptions(**given)
    try:
        run(spark, args.data_dir, args.output_dir, options)
    except JobStopped as stopped:
        print(f"{type(stopped).__name__}: {stopped}", file=sys.stderr)
        return stopped.exit_code
    return 0


if __name__ == "__main__":
    sys.exit(main())
