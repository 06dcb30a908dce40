from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tagweave.functions import access_log, behaviour, ip, tag_sets, text, user_agent

# Fixed value: a line in the log format.
SAMPLE_LINE = ('33.169.220.221 - - [13/Oct/2022:19:46:28 +0800] "GET /js/20.b9c086d.js HTTP/1.1" 200 159997 "-" '
               '"Mozilla/5.0 (X11; NetBSD) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/27.0.1453.116 '
               'Safari/537.36" "-"')


def value_of(spark, data, schema, column):
    return [r[0] for r in spark.createDataFrame(data, schema).select(column).collect()]


def test_union_is_sorted_and_unique(spark):
    got = value_of(spark, [("25", "24,8"), ("8,25", "8")], "a string, b string", tag_sets.union(F.col("a"), F.col("b")))
    assert got == ["24,25,8", "25,8"]


def test_without_removes_every_copy(spark):
    got = value_of(spark, [("24,8,24", "24,25"), ("24", "24")], "a string, b string",
                   tag_sets.without(F.col("a"), F.col("b")))
    assert got == ["8", None]


def test_text_parts_and_dates(spark):
    df = spark.createDataFrame([("19500101-19591231",), ("abc",), ("20010230",)], "r string")
    rows = df.select(text.part(F.col("r"), "-", 0).alias("a"), text.part(F.col("r"), "-", 1).alias("b"),
                     text.compact_date(text.part(F.col("r"), "-", 0)).cast("string").alias("d")).collect()
    assert [tuple(r) for r in rows] == [("19500101", "19591231", "1950-01-01"), ("abc", None, None),
                                        ("20010230", None, None)]


def test_ip_number(spark):
    data = [("10.1.0.2",), ("255.255.255.255",), ("256.1.1.1",), ("1.2.3",), ("",), (None,), ("a.b.c.d",)]
    got = [r["n"] for r in ip.with_ip_number(spark.createDataFrame(data, "v string"), "v", "n").collect()]
    assert got == [10 * 2**24 + 2**16 + 2, 2**32 - 1, None, None, None, None, None]


def test_sample_line_gives_ten_fields(spark):
    df = spark.createDataFrame([(SAMPLE_LINE,), ("prefix " + SAMPLE_LINE + " suffix",), ("broken",), ("",), (None,)],
                               "value string")
    rows = access_log.parse_lines(df).collect()
    assert len(rows) == 2
    row = rows[0]
    assert [row[f] for f in access_log.FIELDS[:8]] == [
        "33.169.220.221", "13/Oct/2022:19:46:28 +0800", "GET", "/js/20.b9c086d.js", "HTTP/1.1", "200", "159997", "-"]
    assert row["useragent"].startswith("Mozilla/5.0 (X11; NetBSD)") and row["proxyaddr"] == "-"
    assert row["access_time"] == datetime(2022, 10, 13, 19, 46, 28)
    assert [rows[1][f] for f in access_log.FIELDS] == [row[f] for f in access_log.FIELDS]
    assert {r["value"] for r in access_log.rejected_lines(df).collect()} == {"broken", "", None}


def test_matched_and_rejected_are_the_whole(spark):
    lines = [SAMPLE_LINE, SAMPLE_LINE.replace("200", "x"), SAMPLE_LINE + "\x01", "\x01" * 9, "\x01".join("0123456789"), SAMPLE_LINE[:40]]
    df = spark.createDataFrame([(v,) for v in lines * 3], "value string")
    assert [r["value"] for r in access_log.parse_lines(df).collect()] == [lines[0], lines[2]] * 3
    assert sorted(r["value"] for r in access_log.rejected_lines(df).collect()) == sorted([lines[1], *lines[3:]] * 3)


def test_access_time_text(spark):
    data = [("13/Oct/2022:19:46:28 +0800",), ("",), ("99/Oct/2022:19:46:28 +0800",), (None,)]
    got = value_of(spark, data, "v string", access_log.access_time_text(F.col("v")))
    assert got == ["2022-10-13 19:46:28", None, None, None]


@pytest.mark.parametrize("agent, expected", [
    ("Mozilla/5.0 (X11; NetBSD) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/27.0.1453.116 Safari/537.36",
     ("NetBSD", "Other", "Chrome")),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 15_0 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) "
     "Version/15.0 Mobile/15E148 Safari/604.1", ("iOS", "iPhone", "Mobile Safari")),
    ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/16.0 "
     "Safari/605.1.15", ("Mac OS X", "Mac", "Safari")),
    ("Mozilla/5.0 (Windows NT 10.0; Win64; x64; rv:105.0) Gecko/20100101 Firefox/105.0",
     ("Windows", "Other", "Firefox")),
    ("Mozilla/5.0 (Linux; Android 12; SM-S908B) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/105.0.0.0 Mobile "
     "Safari/537.36", ("Android", "Samsung", "Chrome Mobile")),
    ("something else", ("Other", "Other", "Other")),
])
def test_user_agent_rules(spark, agent, expected):
    df = spark.createDataFrame([(agent,)], "ua string")
    assert tuple(df.select(*user_agent.agent_columns(F.col("ua"))).first()) == expected


# An invented event; only the names of the fields are given.
EVENT = """{"phone_num": "0700555", "system_id": "till-3", "area": {"province": "North", "city": "Oak", "sp": "Fibre"},
 "user_name": "Robin", "user_id": "u-77", "visit_time": "2031-02-03 04:05:06", "goods_type": "tea",
 "minimum_price": 12.5, "user_behavior": {"is_browse": 1, "is_order": 0, "is_buy": 0, "is_back_order": 0,
 "is_received": 0}, "goods_detail": {"goods_name": "green", "browse_page": "https://shop.test/p?x=9&y=8",
 "browse_time": "2031-02-03 04:00:00", "to_page": "https://shop.test/q", "to_time": "2031-02-03 04:06:00",
 "page_keywords": "leaf"}}"""


def test_event_gives_21_columns(spark):
    df = spark.createDataFrame([(EVENT,), ("not json",), (None,)], "value string")
    rows = behaviour.parse_events(df).collect()
    assert len(rows[0]) == 21 and len(rows) == 3
    assert rows[0]["minimum_price"] == "12.5" and rows[0]["sp"] == "Fibre" and rows[0]["is_browse"] == "1"
    assert rows[0]["browse_page"] == "https://shop.test/p?x=9&y=8" and rows[0]["page_keywords"] == "leaf"
    assert all(v is None for v in rows[1]) and all(v is None for v in rows[2])


def test_json_paths_and_tuple(spark):
    df = spark.createDataFrame([('{"id":"1","properties":{"age":18,"address":"x"}}',)], "value string")
    row = behaviour.json_paths(df, age="$.properties.age", missing="$properties.address").first()
    assert (row["age"], row["missing"]) == ("18", None)
    assert tuple(behaviour.parse_top_fields(df, "id", "absent").first()) == ("1", None)
