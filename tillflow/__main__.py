"""``python -m tillflow validate --file F --source S`` (exit code 0 or 1) and ``python -m tillflow run --root R``."""

from __future__ import annotations

import argparse
import sys

from .plans.daily import run_all
from .plans.validate import validate
from .schemas import TOPICS
from .session import get_spark


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tillflow", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    check = commands.add_parser("validate", help="check a file against contract and business rules")
    check.add_argument("--file", required=True)
    check.add_argument("--source", required=True, choices=list(TOPICS))
    daily = commands.add_parser("run", help="bronze, silver, gate, gold and low-stock check below a root folder")
    daily.add_argument("--root", required=True)
    daily.add_argument("--pages", help="folder of landed product pages")
    args = parser.parse_args(argv)
    spark = get_spark()
    if args.command == "validate":
        return 0 if validate(spark, args.file, args.source) else 1
    print(run_all(spark, args.root, args.pages))
    return 0


if __name__ == "__main__":
    sys.exit(main())
