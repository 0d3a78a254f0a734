"""Run one job: `spark-submit -m postloom <job> --out FOLDER --log ... --posts ... --topics ...`."""

from __future__ import annotations

import argparse

from postloom.plans import jobs
from postloom.session import scratch, session

INPUTS = {
    "user": ("users",),
    "activity": ("log",),
    "content": ("log", "posts", "topics"),
    "interactions": ("log", "posts", "topics"),
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="postloom")
    parser.add_argument("job", choices=list(INPUTS))
    parser.add_argument("--out", required=True)
    parser.add_argument("--form", choices=("parquet", "tsv", "lines", "packed"), default="parquet", help="lines: text with one line per row, which Spark can split; packed: the same in gzip files")
    parser.add_argument("--cap", type=int, default=10_000, help="events from which a user counts as hyper-active")
    parser.add_argument("--cohort", type=int, default=5_000, help="users in the cohort")
    parser.add_argument("--seed", type=int, default=0)
    parser.add_argument("--order", choices=("reference", "user"), default="reference")
    parser.add_argument("--lenient-csv", action="store_true", help="leave out, and count, lines of posts and topics with too many fields")
    parser.add_argument(
        "--payloads", choices=("strict", "lenient"),
        help="raise on unusable payloads, or count and leave them out; strict for content, lenient for interactions unless given",
    )
    parser.add_argument("--strict-quotas", action="store_true", help="raise when a user has fewer negatives than are to be drawn")
    parser.add_argument("--pieces", action="store_true", help="content, interactions: write lists in pieces, without a bound on their length")
    parser.add_argument("--wide", action="store_true", help="interactions: also write tiers with the list of the user on each row")
    parser.add_argument("--single-line", action="store_true", help="no CSV cell holds a line break")
    for name in sorted({name for names in INPUTS.values() for name in names}):
        parser.add_argument(f"--{name}", help="CSV (path ends in .csv) or Parquet")
    args = parser.parse_args(arguments)
    spark = session(f"postloom {args.job}")

    with scratch(spark):
        inputs, counts = [], {}
        for name in INPUTS[args.job]:
            path = getattr(args, name)
            if not path:
                parser.error(f"job {args.job} needs --{name}")
            table, found = jobs.ingest(spark, name, path, not args.single_line, args.lenient_csv)
            inputs.append(table)
            counts |= found
        if args.job == "user":
            counts |= jobs.user_job(*inputs, args.out, args.form)
        elif args.job == "activity":
            counts |= jobs.activity_job(*inputs, args.out, args.form, args.cap, args.cohort, args.seed)
        elif args.job == "content":
            counts |= jobs.content_job(*inputs, args.out, args.form, args.cap, args.payloads != "lenient", args.pieces)
        else:
            counts |= jobs.interactions_job(
                *inputs, args.out, args.form, args.seed, args.payloads == "strict", args.strict_quotas, args.order, wide=args.wide, pieces=args.pieces
            )
    for name, value in counts.items():
        print(name, value)


if __name__ == "__main__":
    main()
