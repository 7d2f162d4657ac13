"""Command line of the four jobs:

    python -m tillwise quality   --input data.csv --output out/quality
    python -m tillwise etl       --input data.csv --output out
    python -m tillwise quarterly --input data.csv --output out/quarterly --year 2024
    python -m tillwise quarterly --input out/partitioned_transactions --input-format fact ...
    python -m tillwise benchmark --input data.csv --output out/benchmark

`quality` exits with 1 when the verdict is FAIL, so that a scheduler stops there.
`etl --only-touched-partitions` takes whole days and replaces these in what is stored.
"""

from __future__ import annotations

import argparse
import sys

from tillwise.plans import jobs
from tillwise.session import get_session
from tillwise.sinks.tables import read_output


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tillwise")
    parser.add_argument("job", choices=["quality", "etl", "quarterly", "benchmark"])
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", default=None, help="required except for quality")
    parser.add_argument("--year", type=int, default=2024)
    parser.add_argument("--input-format", choices=["csv", "fact"], default="csv", help="quarterly")
    parser.add_argument("--calendar", action="store_true", help="quarterly: calendar predecessors")
    parser.add_argument("--only-touched-partitions", action="store_true", help="etl")
    parser.add_argument("--rules", default="standard", help=f"quality: of {', '.join(jobs.RULE_SETS)}")
    parser.add_argument("--merchants", default=None, help="quality: Parquet merchant master")
    parser.add_argument("--history", default=None, help="quality: stored fact the input is to be added to")
    args = parser.parse_args(arguments)
    if args.output is None and args.job != "quality":
        parser.error("--output is required")
    spark = get_session(f"tillwise-{args.job}", [args.input, args.output or ""])
    try:
        if args.job == "quality":
            master = spark.read.parquet(args.merchants) if args.merchants else None
            stored = read_output(spark, args.history, "partitioned_transactions") if args.history else None
            verdict = jobs.run_quality(
                spark, args.input, args.output, rule_sets=args.rules.split(","), merchants=master, history=stored
            )
            print(verdict)
            return 1 if verdict == "FAIL" else 0
        if args.job == "etl":
            result = jobs.run_etl(
                spark,
                args.input,
                args.output,
                with_declared=True,
                only_touched_partitions=args.only_touched_partitions,
            )
        elif args.job == "quarterly":
            result = jobs.run_quarterly(
                spark, args.input, args.output, args.year, args.input_format, args.calendar
            )
        else:
            result = jobs.run_benchmark(spark, args.input, args.output, year=args.year)
        result.show(50, truncate=False)
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
