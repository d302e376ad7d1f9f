"""Batch job: take what has landed into the lake, refresh its dimensions, print the counters.

spark-submit ingest_job.py LANDING LAKE [--glob "*.jsonl"] [--max-bytes N] [--follow "5 seconds"]
    [--hourly PARTITIONS]
"""

from __future__ import annotations

import argparse
import json

from plantlens.session import build_session
from plantlens.streaming.chain import finish, follow, run
from plantlens.streaming.hourly import start_hourly


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("landing", help="folder with JSON lines, read with all its subfolders")
    parser.add_argument("lake", help="folder of the stored tables and their checkpoints")
    parser.add_argument("--glob", help="take only files whose name matches")
    parser.add_argument("--max-bytes", type=int, help="bound of a micro-batch")
    parser.add_argument("--follow", help="go on at this interval instead of stopping")
    parser.add_argument(
        "--hourly", type=int, help="keep hourly moments too; partitions of a state that is new"
    )
    options = parser.parse_args()

    spark = build_session("plantlens-ingest")
    arguments = {"path_glob": options.glob, "max_bytes": options.max_bytes}
    if options.follow:
        follow(spark, options.landing, options.lake, every=options.follow, **arguments)
        if options.hourly:
            start_hourly(spark, options.lake, options.follow, options.hourly)
        spark.streams.awaitAnyTermination()
    else:
        print(json.dumps(run(spark, options.landing, options.lake, **arguments)))
        if options.hourly:
            finish(start_hourly(spark, options.lake, partitions=options.hourly))
    spark.stop()


if __name__ == "__main__":
    main()
