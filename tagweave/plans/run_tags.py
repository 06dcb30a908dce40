"""A tag run to submit: `spark-submit run_tags.py --rules PATH --store PATH --as-of DAY`.

The rules are a Parquet table (id, pid, level, rule); each job's source is what its
level-4 rule names. Addresses and credentials of databases come as `--option k=v`,
never from the rules.
"""

import argparse

from pyspark.sql import SparkSession

from tagweave.operators.rules import RuleTree
from tagweave.plans.tag_jobs import JOBS, RunOptions, tag_store_run
from tagweave.session import configure
from tagweave.sources.scans import scan
from tagweave.sources.store import VersionedTable


def arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Tag all entities and commit the tag store's next version.")
    parser.add_argument("--rules", required=True, help="Parquet table of rules")
    parser.add_argument("--store", required=True, help="folder of the tag store")
    parser.add_argument("--as-of", required=True, help="day that recency counts to")
    parser.add_argument("--jobs", type=int, nargs="+", default=sorted(JOBS), choices=sorted(JOBS), help="category ids")
    parser.add_argument("--rank", type=int, default=1)
    parser.add_argument("--drop-stale", action="store_true")
    parser.add_argument("--option", action="append", default=[], help="k=v for the reader of the sources")
    return parser.parse_args(argv)


def main(argv=None) -> int:
    """Run and give the committed version."""
    args = arguments(argv)
    spark = configure(SparkSession.builder.appName("tags").getOrCreate())
    options = dict(pair.split("=", 1) for pair in args.option)
    return tag_store_run([JOBS[n] for n in args.jobs], RuleTree(spark.read.parquet(args.rules)),
                         lambda spec: scan(spark, spec, **options), VersionedTable(spark, args.store),
                         RunOptions(args.as_of, args.rank, args.drop_stale))


if __name__ == "__main__":
    main()
