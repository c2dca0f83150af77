"""Run one layer or all: python -m parceltrail all --data FOLDER --warehouse FOLDER

The same file works with spark-submit. Layers can be run one at a time, in separate sessions.
"""

from __future__ import annotations

import argparse

from parceltrail.plans import layers
from parceltrail.session import LEAST_PARTITIONS, build_session, shuffle_partitions, stored_bytes
from parceltrail.sinks.layers import LayerStore

EMBEDDED_BREAKS = {"look": None, "yes": True, "no": False}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="parceltrail", description=__doc__)
    parser.add_argument("layer", choices=["bronze", "silver", "gold", "all"])
    parser.add_argument("--warehouse", required=True, help="folder of the tables")
    parser.add_argument("--data", help="folder of the CSV files (bronze and all)")
    parser.add_argument("--prefix", default="", help="put before the database names")
    parser.add_argument(
        "--embedded-breaks",
        choices=EMBEDDED_BREAKS,
        default="look",
        help="whether quoted CSV fields contain line breaks; 'look' costs one more pass",
    )
    parser.add_argument(
        "--shuffle-partitions", type=int, help="by default one for each 128 MB of input, 200 at least"
    )
    parser.add_argument("--keep", type=int, help="states of a loaded layer whose files stay; by default all do")
    args = parser.parse_args(argv)
    if args.layer in ("bronze", "all") and not args.data:
        parser.error("--data is needed to load the raw layer")
    spark = build_session(f"parceltrail {args.layer}")
    source = f"{args.data.rstrip('/')}/*" if args.data else f"{args.warehouse.rstrip('/')}/*"
    partitions = args.shuffle_partitions or shuffle_partitions(stored_bytes(spark, source))
    if args.shuffle_partitions or partitions > LEAST_PARTITIONS:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    store = LayerStore(spark, args.warehouse, args.prefix)
    if args.layer in ("bronze", "all"):
        multi_line = EMBEDDED_BREAKS[args.embedded_breaks]
        layers.load_bronze(store, args.data, multi_line=multi_line)
    if args.layer in ("silver", "all"):
        layers.build_silver(store)
    if args.layer in ("gold", "all"):
        layers.build_gold(store)
    if args.keep is not None:
        for layer in ("bronze", "silver", "gold") if args.layer == "all" else (args.layer,):
            store.clean(layer, args.keep)


if __name__ == "__main__":
    main()
