"""Command line: run a query, write the report, or resolve listings into a catalogue.

    python -m tarifa query NAME TABLES [--rows N]
    python -m tarifa report LISTINGS OUT.html
    python -m tarifa resolve LISTINGS CATALOGUE [--domain D] [--date YYYY-MM-DD] [--dry-run]
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from tarifa import queries, schemas
from tarifa.operators import matching
from tarifa.operators.upsert import SnapshotSet
from tarifa.plans import nightly, report
from tarifa.session import session
from tarifa.sources import readers


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tarifa", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    p = commands.add_parser("query")
    p.add_argument("name", choices=sorted(queries.QUERIES))
    p.add_argument("tables")
    p.add_argument("--rows", type=int, default=20)
    p = commands.add_parser("report")
    p.add_argument("listings")
    p.add_argument("out")
    p = commands.add_parser("resolve")
    p.add_argument("listings")
    p.add_argument("catalogue")
    p.add_argument("--domain")
    p.add_argument("--date")
    p.add_argument("--dry-run", action="store_true")
    args = parser.parse_args(argv)
    spark = session(f"tarifa {args.command}")
    if args.command == "query":
        queries.QUERIES[args.name](spark, args.tables).show(args.rows, truncate=60)
    elif args.command == "report":
        with open(args.out, "w", encoding="utf-8") as f:
            f.write(report.build(readers.listings(spark, args.listings)))
    else:
        stored = SnapshotSet(spark, args.catalogue, append_only=("log",))
        good, faulty = nightly.checked(readers.listings(spark, args.listings, args.domain, args.date))
        if args.dry_run:
            matches = nightly.resolve(good, nightly.catalogue(spark, stored.read()), F.current_timestamp())[1]
        else:
            matches = nightly.stored_run(stored, good, F.current_timestamp())
        matching.run_stats(matches, faulty).show()


if __name__ == "__main__":
    main()
