"""Run one day: python -m stormgrid --root <folder> --run-date <day> [--cities <csv>]"""

from __future__ import annotations

import argparse
import datetime
import logging

from stormgrid.plans import daily
from stormgrid.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="stormgrid", description=__doc__)
    parser.add_argument("--root", required=True, help="folder of the layers and serving tables")
    parser.add_argument("--run-date", required=True, help="yyyy-mm-dd")
    parser.add_argument("--loaded-at", default=datetime.datetime.now().isoformat(" ", "seconds"))
    parser.add_argument("--cities", help="CSV with city, lat, lng")
    parser.add_argument("--documents", action="store_true", help="bronze/<day>/<city>.json, one document per file")
    parser.add_argument("--csv", action="store_true", help="also write CSV copies of silver and gold")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = build_session()
    daily.run_day(spark, args.root, args.run_date, args.loaded_at, args.cities, args.documents, args.csv)


if __name__ == "__main__":
    main()
