"""Command line: run the pipeline, or one layer of it, as a Spark job.

    spark-submit --py-files orrery.zip orrery/__main__.py pipeline \\
        --items URI --ratings URI --root URI
    python -m orrery layer gold --input DIR --root URI

Each layer reads the previous layer's written tables under ``--root`` (any
Hadoop path, e.g. an object-store URI configured outside the code).
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orrery.plans.warehouse import Warehouse  # noqa: E402
from orrery.session import build_session  # noqa: E402


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="orrery")
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("pipeline", "layer"):
        p = sub.add_parser(name)
        if name == "layer":
            p.add_argument("layer", choices=["bronze", "silver", "gold", "train", "recommend"])
        p.add_argument("--input", help="folder with the driver tables (fixture inputs)")
        p.add_argument("--items", help="header CSV file or folder of items")
        p.add_argument("--ratings", help="header CSV file or folder of ratings")
        p.add_argument("--header", action="append", default=[], metavar="OURS=THEIRS",
                       help="a column's name in the CSV header; may be repeated")
        p.add_argument("--root", required=True, help="folder for the written layers")
        p.add_argument("--recommender", choices=["popularity", "als"], default="popularity")
        p.add_argument("--model", help="saved ALS model folder (layer recommend)")
        p.add_argument("--master", help="Spark master (default: from spark-submit)")
    args = parser.parse_args(argv)
    if not args.input and not (args.items and args.ratings):
        parser.error("give --items and --ratings, or --input")
    spark = build_session(args.master)
    wh = Warehouse(spark, args.input and args.input.rstrip("/"), args.root.rstrip("/"),
                   items_path=args.items, ratings_path=args.ratings,
                   header=dict(pair.split("=", 1) for pair in args.header))
    if args.command == "pipeline":
        wh.run(args.recommender)
    elif args.layer == "bronze":
        wh.catalog.create()
        wh.bronze()
    elif args.layer == "silver":
        wh.silver()
    elif args.layer == "gold":
        wh.gold()
    elif args.layer == "train":
        wh.train()
    else:
        wh.recommend(args.recommender, args.model)
    print(json.dumps(wh.counts, default=str))


if __name__ == "__main__":
    main()
