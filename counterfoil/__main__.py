"""Command line: extract, models, audit."""

from __future__ import annotations

import argparse

from counterfoil.plans import derive_models, extract_feeds, report_findings
from counterfoil.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="counterfoil")
    steps = parser.add_subparsers(dest="step", required=True)

    extract = steps.add_parser("extract", help="raw feeds to clean tables")
    extract.add_argument("--client", required=True)
    extract.add_argument("--server", required=True)
    extract.add_argument("--out", required=True)
    extract.add_argument("--lines", action="store_true", help="JSON Lines, not one array per file")
    extract.add_argument("--split", action="store_true", help="read each array by many tasks")
    extract.add_argument("--strict", action="store_true", help="fail on unreadable records")

    models = steps.add_parser("models", help="clean tables to marts")
    models.add_argument("--clean", required=True)
    models.add_argument("--out", required=True)
    models.add_argument("--save-db", metavar="NAME", help="save the models as tables of a database")
    models.add_argument("--strict", action="store_true", help="fail on unreadable values")

    audit = steps.add_parser("audit", help="findings from the mart")
    audit.add_argument("--clean", required=True)
    audit.add_argument("--mart", required=True)
    audit.add_argument("--out", required=True)
    audit.add_argument("--history", help="earlier report whose findings are left out")

    args = parser.parse_args(argv)
    spark = build_session()
    if args.step == "extract":
        counts = extract_feeds(
            spark, args.client, args.server, args.out, args.lines, args.strict, args.split
        )
        counts.show(truncate=False)
    elif args.step == "models":
        for result in derive_models(spark, args.clean, args.out, args.save_db, args.strict):
            result.show(truncate=False)
    else:
        report_findings(spark, args.clean, args.mart, args.out, args.history).show(truncate=False)


if __name__ == "__main__":
    main()
