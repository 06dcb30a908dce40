"""Time the registered queries; one JSON line on stdout.

Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS (3). Arguments name single queries;
`--udf` instead compares native enrichment with row-wise Python functions.
"""

import json
import os
import re
import statistics
import sys
import time
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession, functions as F  # noqa: E402

from workload import tables  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "tag_full_run", "tag_gender", "tag_job", "tag_age_band", "tag_consume_cycle", "tag_payway",
    "tag_political", "tag_marriage", "tag_merge", "tag_merge_union", "tag_upsert",
    "tag_equal_inner", "tag_equal_left", "tag_range_inner", "tag_range_left", "entity_mapping",
    "recency_days", "category_counts", "payway_top1", "payway_second", "keyed_reduce", "preview_topn",
    "access_log_parse", "access_metrics", "ip_area_join", "user_agent_classify",
    "event_json_parse", "behaviour_counts",
    "stream_access_metrics", "stream_behaviour_counts", "stream_append_sink",
    "minmax_scale", "string_index", "kmeans_assign", "model_score",
]


def session(cpus: str) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "16g")
             # Recording the Python call site of every column costs more than small queries take.
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action, runs: int) -> float:
    taken = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        taken.append(time.perf_counter() - start)
    return round(statistics.median(taken), 4)


def python_udfs():
    """Row-wise functions doing what the native expressions do."""
    areas = [(*[sum(int(o) << s for o, s in zip(ip.split("."), (24, 16, 8, 0))) for ip in pair], name)
             for *pair, name in tables.AREAS]
    rules = [[(re.compile(p), v) for p, v in group] for group in
             (tables.AGENT_RULES.os, tables.AGENT_RULES.device, tables.AGENT_RULES.browser)]

    @F.udf("string")
    def merge(new, old, category):
        if new is None or old is None:
            return new or old
        kept = set(old.split(",")) - set(category.split(","))
        return ",".join(sorted(kept | set(new.split(","))))

    @F.udf("string")
    def area(ip):
        number = sum(int(o) << s for o, s in zip(ip.split("."), (24, 16, 8, 0)))
        return next((a for lo, hi, a in areas if lo <= number <= hi), "unknown")

    @F.udf("string")
    def agent(text):
        return ",".join(next((v for p, v in group if p.search(text)), "Other") for group in rules)

    return merge, area, agent


def compare_udfs(spark, sf_dir, runs) -> dict:
    """Native against row-wise Python on the same input, in seconds."""
    from tagweave.functions.access_log import parse_lines
    from tagweave.operators.enrichment import add_agent, add_area
    from tagweave.operators.merging import merged_column

    merge, area, agent = python_udfs()
    # Parsed lines and stored tags are kept in memory, so that only the operator is timed.
    lines = parse_lines(tables.access_lines(tables.load(spark, sf_dir, "events"))).select("ip", "useragent")
    for _ in range(5):
        lines = lines.unionByName(lines)
    lines = lines.persist()
    tags = tables.load(spark, sf_dir, "orders").select(
        F.lit("25").alias("new"), F.concat_ws(",", F.lit("24"), (F.col("o_orderkey") % 90).cast("string")).alias("old"))
    for _ in range(5):
        tags = tags.unionByName(tags)
    tags = tags.persist()
    category = F.lit("24,25,26")
    cases = {
        "tag_merge": (lambda: tags.select(merged_column(F.col("new"), F.col("old"), category)),
                      lambda: tags.select(merge("new", "old", category))),
        "ip_area": (lambda: add_area(lines, tables.area_ranges(spark)), lambda: lines.withColumn("area", area("ip"))),
        "user_agent": (lambda: add_agent(lines, rules=tables.AGENT_RULES),
                       lambda: lines.withColumn("agent", agent("useragent"))),
    }
    return measure({f"{name}_{kind}": make for name, pair in cases.items()
                    for kind, make in zip(("native", "python_udf"), pair)}, runs)


def measure(cases: dict, runs: int) -> dict:
    """Median seconds of each case, after one round over all of them to warm up."""
    for make in cases.values():
        run(make())
    return {name: timed(lambda: run(make()), runs) for name, make in cases.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [a for a in sys.argv[1:] if not a.startswith("--")]
    if "--all" in sys.argv:
        names = list(QUERIES)
    spark = session(cpus)
    if "--udf" in sys.argv:
        times = compare_udfs(spark, sf_dir, runs)
    else:
        times = measure({name: partial(QUERIES[name], spark, sf_dir) for name in names or HEADLINE}, runs)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
