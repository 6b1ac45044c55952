"""Entry points: `spark-submit loglake/main.py worker SPOOL ROOT [--once]`, `python -m loglake.main ingest SPOOL [PORT]`.

Settings of the worker are Spark's: --conf spark.loglake.done_ttl_s=3600 and so on, for each field of EngineConfig.
"""

from __future__ import annotations

import argparse


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="loglake")
    parts = parser.add_subparsers(dest="part", required=True)
    worker = parts.add_parser("worker", help="process the spool as a stream")
    worker.add_argument("spool")
    worker.add_argument("root")
    worker.add_argument("--once", action="store_true", help="process what is there and end")
    ingest = parts.add_parser("ingest", help="accept events over HTTP")
    ingest.add_argument("spool")
    ingest.add_argument("port", nargs="?", type=int, default=8080)
    given = parser.parse_args(args)
    if given.part == "ingest":
        from loglake.sources.http import serve

        serve(given.spool, given.port, "0.0.0.0").serve_forever()
        return
    from pyspark.sql import SparkSession

    from loglake.streaming.stream import run_stream

    spark = SparkSession.builder.appName("loglake").getOrCreate()
    run_stream(spark, given.spool, given.root, once=given.once).awaitTermination()


if __name__ == "__main__":
    main()
