import random

import pytest
from pyspark.sql import functions as F

from tagweave.functions.user_agent import AgentRules
from tagweave.operators import enrichment, metrics
from tagweave.operators.joins import DEFAULT_BOUND, NEVER_BROADCAST

AREAS = [(0, 9, "a"), (10, 10, "b"), (20, 300, "c")]


def dotted(n):
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


@pytest.mark.parametrize("bound", [DEFAULT_BOUND, NEVER_BROADCAST])
def test_every_row_gets_one_area(spark, bound):
    rng = random.Random(3)
    ips = [dotted(5 if i % 3 == 0 else rng.randint(0, 400)) for i in range(300)] + ["", "x", None]
    df = spark.createDataFrame(list(enumerate(ips)), "n int, ip string")
    areas = spark.createDataFrame(AREAS, "lo bigint, hi bigint, area string")
    got = {r["n"]: r["area"] for r in enrichment.add_area(df, areas, bound=bound).collect()}

    def expected(ip):
        if not ip or ip == "x":
            return "unknown"
        number = sum(int(o) << s for o, s in zip(ip.split("."), (24, 16, 8, 0)))
        return next((a for lo, hi, a in AREAS if lo <= number <= hi), "unknown")

    assert got == {n: expected(ip) for n, ip in enumerate(ips)}


def test_overlapping_ranges_are_found(spark):
    schema = "lo bigint, hi bigint, area string"
    assert enrichment.overlapping(spark.createDataFrame(AREAS, schema)).count() == 0
    bad = AREAS + [(250, 70000, "d"), (65536 * 3, 65536 * 5, "e"), (65536 * 4, 65536 * 4, "f")]
    found = enrichment.overlapping(spark.createDataFrame(bad, schema)).collect()
    assert {r["area"] for r in found} == {"d", "f"}


@pytest.mark.parametrize("bound", [DEFAULT_BOUND, NEVER_BROADCAST])
def test_dictionary_equals_row_wise_classification(spark, bound):
    rules = AgentRules(os=(("Win", "W"), ("Windows", "never")), device=(), browser=(("curl", "curl"),))
    agents = ["Windows", "curl/7", "", None] * 20
    df = spark.createDataFrame(list(enumerate(agents)), "n int, useragent string")
    one = enrichment.add_agent(df, rules=rules).select("n", "os", "device", "browser").collect()
    two = enrichment.add_agent_by_dictionary(df, rules=rules, bound=bound).select("n", "os", "device", "browser").collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))
    assert sorted(map(tuple, one))[0] == (0, "W", "Other", "Other")


def test_access_metrics_take_the_earliest_line(spark):
    lines = spark.createDataFrame([
        ("0.0.0.5", "500", "curl/7", "2024-01-01 00:00:02"), ("0.0.0.5", "200", "Firefox/1", "2024-01-01 00:00:01"),
        ("0.0.0.5", "404", "Firefox/1", "2024-01-01 00:00:01"), ("0.0.0.5", "201", "x", None),
        ("9.9.9.9", "99999999999", "x", None)], "ip string, code string, useragent string, t string")
    lines = lines.withColumn("access_time", F.col("t").cast("timestamp"))
    areas = spark.createDataFrame(AREAS, "lo bigint, hi bigint, area string")
    got = {r["ip"]: tuple(r) for r in metrics.access_metrics(lines, areas).collect()}
    assert got["0.0.0.5"] == ("0.0.0.5", 4, 1, "a", 200, "Other", "Other", "Firefox", "2024-01-01 00:00:01")
    assert got["9.9.9.9"] == ("9.9.9.9", 1, 1, "unknown", None, "Other", "Other", "Other", None)


def test_behaviour_counts_only_ones(spark):
    flags = "is_browse string, is_order string, is_buy string, is_back_order string, is_received string"
    events = spark.createDataFrame([("u", "1", "0", "x", None, "1"), ("u", "1", "1", "", "2", "0"),
                                    (None, "1", "1", "1", "1", "1")], "user_id string, " + flags)
    got = {r["user_id"]: tuple(r)[1:] for r in metrics.behaviour_counts(events).collect()}
    assert got == {"u": (2, 1, 0, 0, 1), None: (0, 0, 0, 0, 0)}
