"""Run the daily job: ``python -m landmart --landing DIR --warehouse DIR [--latest | --date D] ...``."""

from __future__ import annotations

import argparse

from landmart.plans.jobs import run
from landmart.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="landmart", description="Load land snapshots and rebuild the marts.")
    parser.add_argument("--landing", required=True, help="folder of snapshot folders")
    parser.add_argument("--warehouse", required=True, help="folder of the tables")
    parser.add_argument("-l", "--latest", action="store_true", help="load the newest snapshot; wins over --date")
    parser.add_argument("-d", "--date", default="today", help="yyyy-mm-dd or all; today if not given")
    parser.add_argument("-o", "--overwrite", action="store_true", help="replace snapshots already loaded")
    parser.add_argument("-r", "--rebuild", action="store_true", help="rebuild the marts after loading")
    args = parser.parse_args()
    choice = "latest" if args.latest else args.date
    print(run(build_session(), args.landing, args.warehouse, choice, args.overwrite, args.rebuild))


if __name__ == "__main__":
    main()
