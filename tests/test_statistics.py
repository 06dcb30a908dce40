import random
from collections import Counter

from pyspark.sql import functions as F

from tagweave.operators import statistics


def orders(spark):
    rng = random.Random(5)
    # One member holds a third of all rows.
    rows = [(0 if i % 3 == 0 else rng.randint(1, 20), rng.choice("abcde"), rng.randint(0, 10**9)) for i in range(600)]
    return rows, spark.createDataFrame(rows, "m int, c string, t bigint")


def ranking(rows, member):
    counts = Counter(c for m, c, _ in rows if m == member)
    return sorted(counts, key=lambda c: (-counts[c], c))


def test_nth_most_frequent(spark):
    rows, df = orders(spark)
    members = {m for m, _, _ in rows}
    for n in (1, 2, 5):
        got = {r["m"]: r["c"] for r in statistics.nth_most_frequent(df, "m", "c", n).collect()}
        assert got == {m: ranking(rows, m)[n - 1] for m in members if len(ranking(rows, m)) >= n}


def test_both_statistics_equal_the_single_ones(spark):
    _, df = orders(spark)
    both = {tuple(r) for r in statistics.recency_and_favourite(df, "m", "t", "c", "2030-01-01").collect()}
    days = {r["m"]: r["days"] for r in statistics.recency_days(df, "m", "t", "2030-01-01").collect()}
    top = {r["m"]: r["c"] for r in statistics.nth_most_frequent(df, "m", "c").collect()}
    assert both == {(m, days[m], top[m]) for m in days}


def test_recency_counts_whole_days(spark):
    df = spark.createDataFrame([(1, 0), (1, 86399), (2, 86400), (3, None)], "m int, t bigint")
    got = {r["m"]: r["days"] for r in statistics.recency_days(df, "m", "t", "1970-01-03").collect()}
    assert got == {1: 2, 2: 1, 3: None}


def test_keyed_reduce(spark):
    df = spark.createDataFrame([("a", 3), ("a", -1), ("b", -5), ("c", None)], "k string, v bigint")
    got = {r["k"]: (r["reduced"], r["folded"], tuple(r["aggregated"])) for r in statistics.keyed_reduce(df, "k", "v").collect()}
    assert got == {"a": (2, 3, (2, 2)), "b": (-5, 0, (-5, 1)), "c": (None, 0, (None, 0))}


def test_changed_since_takes_either_time(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "2024-01-01"), (2, "2024-01-01", "2024-02-01"),
                                (3, "2024-02-01", None), (4, None, None)], "id int, c string, u string")
    df = df.select("id", F.col("c").cast("timestamp_ntz").alias("created_at"),
                   F.col("u").cast("timestamp_ntz").alias("updated_at"))
    got = {r["id"] for r in statistics.changed_since(df, "2024-02-01 00:00:00").collect()}
    assert got == {2, 3}


def test_preview_is_a_top_k(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(50)], "id int, g int")
    top = statistics.preview(df, [F.desc("g"), F.asc("id")], 3)
    assert [r["id"] for r in top.collect()] == [2, 5, 8]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_map_to_entity_drops_unowned_rows(spark):
    goods = spark.createDataFrame([("o1", "x"), ("o1", "y"), ("o9", "z")], "sn string, p string")
    owners = spark.createDataFrame([("o1", 7), ("o2", 8)], "ordersn string, memberid int")
    got = {tuple(r) for r in statistics.map_to_entity(goods, owners, "sn", "ordersn", "memberid").collect()}
    assert got == {(7, "o1", "x"), (7, "o1", "y")}


def test_days_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([(1, 1665619200 - 1), (2, 1665619200), (3, -1)], "k int, s bigint")
    try:
        found = []
        for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            found.append(sorted(map(tuple, statistics.recency_days(df, "k", "s", "2022-10-20").collect())))
        assert found == [[(1, 8), (2, 7), (3, 19286)]] * 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
