"""python -m gleaner: list the queries, run one over a folder of tables, report it."""

from __future__ import annotations

import argparse
import sys

from gleaner.operators.service import markdown
from gleaner.plans import registry
from gleaner.scratch import release
from gleaner.session import build_session, ship


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="gleaner", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of all queries")
    for name, text in (("run", "write a query's rows as Parquet"), ("report", "print a query's rows as Markdown"), ("explain", "print a query's plan")):
        one = commands.add_parser(name, help=text)
        one.add_argument("query")
        one.add_argument("--data", required=True, help="folder of Parquet tables")
        one.add_argument("--master", default="local[*]")
        if name == "run":
            one.add_argument("--out", required=True)
        else:
            one.add_argument("--rows", type=int, default=200)
    args = parser.parse_args(argv)
    registry.load()
    if args.command == "list":
        print("\n".join(sorted(registry.QUERIES)))
        return 0
    if args.query not in registry.QUERIES:
        print(f"there is no query {args.query!r}", file=sys.stderr)
        return 2
    spark = ship(build_session(args.master))
    rows = registry.QUERIES[args.query](spark, args.data)
    if args.command == "run":
        rows.write.mode("errorifexists").parquet(args.out)
    elif args.command == "report":
        print(markdown(args.query, rows.limit(args.rows), args.rows))
    else:
        rows.explain("formatted")
    release()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
