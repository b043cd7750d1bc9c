"""Run the streaming jobs: ``python -m tidemark --table orders --root /shared/shop``."""

from __future__ import annotations

import argparse
import logging
from dataclasses import replace

from tidemark.config import PipelineConfig
from tidemark.session import build_session
from tidemark.sources.kafka import read_topic_stream
from tidemark.streaming.jobs import run_tables, stop


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("--table", choices=["customers", "orders", "products", "all"], default="all")
    parser.add_argument(
        "--root", required=True, help="shared folder for change logs and checkpoints"
    )
    parser.add_argument("--debug", action="store_true", help="print changes instead of logging them")
    parser.add_argument("--long-ids", action="store_true", help="ids are 64-bit on the wire")
    parser.add_argument("--sink", choices=["log", "jdbc"], help="where changes go")
    parser.add_argument("--compact-every", type=int, help="fold the log after this many batches")
    parser.add_argument("--drop-folded", action="store_true", help="delete folders no longer needed")
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO)
    config = PipelineConfig.from_env()
    if args.debug:
        config = replace(config, debug=True)
    if args.long_ids:
        config = replace(config, long_ids=True)
    if args.compact_every is not None:
        config = replace(config, compact_every=args.compact_every)
    if args.drop_folded:
        config = replace(config, drop_folded=True)
    if args.sink:
        config = replace(config, sink=args.sink)
    config.validate()
    spark = build_session(config.app_name, config.master, config.shuffle_partitions)
    tables = list(config.topics) if args.table == "all" else [args.table]
    sources = {t: read_topic_stream(spark, config, [config.topics[t]]) for t in tables}
    runs = run_tables(spark, sources, args.root, config)
    try:
        spark.streams.awaitAnyTermination()
    finally:
        stop(runs)


if __name__ == "__main__":
    main()
