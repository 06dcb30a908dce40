"""A stream to submit: `spark-submit run_stream.py access|behaviour --store PATH --checkpoint PATH ..`.

Records come from a topic (`--servers`, `--topic`) or from files of text (`--files`).
Mode `update` writes the changed keys, `complete` the whole result of each batch.
"""

import argparse

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tagweave.session import configure
from tagweave.streaming.jobs import access_job, behaviour_job
from tagweave.streaming.sinks import batch_sinks, keyed_sink, versioned_sink
from tagweave.streaming.sources import kafka_source, stream_source

KEYS = {"access": "ip", "behaviour": "user_id"}


def arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Keep the metrics of a stream of records.")
    parser.add_argument("job", choices=sorted(KEYS))
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--topic")
    source.add_argument("--files", help="folder of text files, one record a line")
    parser.add_argument("--servers", help="of the topic, host:port")
    parser.add_argument("--areas", help="Parquet table (lo, hi, area), for access")
    parser.add_argument("--store", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--mode", choices=("update", "complete"), default="update")
    parser.add_argument("--every", help="time between batches; without it all present input once")
    parser.add_argument("--option", action="append", default=[], help="k=v for the source")
    args = parser.parse_args(argv)
    if args.topic and not args.servers:
        parser.error("--topic needs --servers")
    if args.job == "access" and not args.areas:
        parser.error("access needs --areas")
    return args


def main(argv=None) -> StreamingQuery:
    args = arguments(argv)
    spark = configure(SparkSession.builder.appName(args.job).getOrCreate())
    options = dict(pair.split("=", 1) for pair in args.option)
    if args.topic:
        records = kafka_source(spark, args.servers, args.topic, **options)
    else:
        records = stream_source(spark, "text", args.files, **options)
    metrics = access_job(records, spark.read.parquet(args.areas)) if args.job == "access" else behaviour_job(records)
    sink = keyed_sink(args.store, KEYS[args.job]) if args.mode == "update" else versioned_sink(args.store)
    trigger = {"processingTime": args.every} if args.every else {"availableNow": True}
    return batch_sinks(metrics, [sink], args.checkpoint, args.mode, trigger)


if __name__ == "__main__":
    main().awaitTermination()
