import re

import pytest
from pyspark.sql import functions as F

from tagweave.functions.user_agent import DEFAULT_RULES, OS_RULES
from tagweave.operators import agents, enrichment
from tagweave.operators.joins import NEVER_BROADCAST, Bound
from workload import tables


@pytest.mark.parametrize("pattern, literals", [
    ("Chrome/", ["Chrome/"]), ("iPhone|iPad", ["iPhone", "iPad"]), ("Android.*Chrome/", ["Android"]),
    ("(iPhone|iPad).*Safari/", ["Safari/"]), ("SM-[A-Z0-9]+", ["SM-"]), ("colou?r", ["colo"]), ("ab*cde", ["cde"]),
    ("abc{0,2}def", ["def"]), (r"a\.b\(c", ["a.b(c"]), (r"x\dlong", ["long"]), ("(?i)chrome", [""]), ("abc|", ["abc", ""]),
    ("[^]|]abc", ["abc"]), ("(a(b|c)d)?efg", ["efg"]), ("(abc)*", [""]), ("", [""]), ("abc+d", ["abc"]), (r"\Qa|b\E", [""]),
    (r"\x41bcd", [""]), ("[a[bc]]def", [""]), (r"(x)\12abc", ["abc"]), ("[a-z&&x]abc", [""]), (r"[\]x]abc", ["abc"]),
    (r"\pLabc", [""]), (r"\p{L}abc", ["abc"]),
])
def test_needed_literals(pattern, literals):
    assert agents.needed_literals(pattern) == literals


def test_literals_are_in_every_match():
    texts = ["colr", "color", "colour", "acde", "abbbcde", "abdef", "abccdef", "a.b(c", "iPad Safari/", "abcccd", "efg"]
    for pattern in ["colou?r", "ab*cde", "abc{0,2}def", r"a\.b\(c", "(iPhone|iPad).*Safari/", "abc+d", "(a(b|c)d)?efg"]:
        for text in texts:
            if re.search(pattern, text):
                assert any(x in text for x in agents.needed_literals(pattern)), (pattern, text)


@pytest.mark.parametrize("bound", [None, NEVER_BROADCAST])
def test_as_the_ordered_rules(spark, sf_dir, bound):
    texts = tables.agent_texts(tables.load(spark, sf_dir, "events"))
    rules = agents.rule_rows(spark, {f: getattr(DEFAULT_RULES, f) for f in agents.FIELDS})
    kwargs = {} if bound is None else {"bound": bound}
    got = agents.add_agent_by_rules(texts, rules, **kwargs)
    want = enrichment.add_agent(texts)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_null_empty_repeated_and_long_texts(spark):
    rows = [(1, None), (2, ""), (3, "Ub"), (4, "Ubuntu"), (5, "Ubuntu"), (6, "x" * 50_000 + "Linux"), (7, "é☃Android😀")]
    df = spark.createDataFrame(rows, "id int, useragent string")
    rules = agents.rule_rows(spark, {"os": OS_RULES}).unionByName(
        spark.createDataFrame([("os", 0, None, "never"), ("os", 99, "^.{1,2}$", "short"), ("other", 0, ".", "unused")],
                              agents.RULE_SCHEMA))
    got = {r["id"]: r["os"] for r in agents.add_agent_by_rules(df, rules, fields=["os"]).collect()}
    assert got == {1: "Other", 2: "Other", 3: "short", 4: "Ubuntu", 5: "Ubuntu", 6: "Linux", 7: "Android"}


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "Linux")], "id int, useragent string")
    none = spark.createDataFrame([], agents.RULE_SCHEMA)
    assert [r["os"] for r in agents.add_agent_by_rules(df, none).collect()] == ["Other"]
    rules = agents.rule_rows(spark, {"os": OS_RULES})
    assert agents.add_agent_by_rules(df.where("id > 1"), rules).count() == 0


def test_of_one_rank_the_smaller_value(spark):
    rules = spark.createDataFrame([("os", 1, "Linux", "b"), ("os", 1, "Lin", "a"), ("os", 0, "Windows", "c")],
                                  agents.RULE_SCHEMA)
    df = spark.createDataFrame([("Linux",)], "useragent string")
    assert agents.add_agent_by_rules(df, rules, fields=["os"]).first()["os"] == "a"


def test_plan_is_of_one_size_and_rules_are_spread(spark, sf_dir):
    parts = tables.part_rules(tables.load(spark, sf_dir, "part"))
    texts = tables.model_texts(tables.load(spark, sf_dir, "events")).select("useragent").distinct()
    sizes = {len(agents.classify(texts, rules)._jdf.queryExecution().optimizedPlan().toString().splitlines())
             for rules in (parts, parts.limit(3))}
    assert len(sizes) == 1
    filed = agents.filed(parts)
    assert filed.groupBy("piece").count().agg(F.max("count")).first()[0] < parts.count() / 2


def model_rules(spark, count):
    return spark.range(count).selectExpr("'device' AS field", "id AS rank", "concat('Model-', id) AS pattern",
                                         "concat('model ', id) AS value")


def test_rules_a_piece_do_not_grow_with_the_table(spark):
    for count in (500, 5000):
        filed = agents.filed(model_rules(spark, count))
        assert filed.count() == count
        assert filed.groupBy("piece").count().agg(F.max("count")).first()[0] == 1


def test_rules_beyond_the_bound_are_narrowed_to_those_in_texts(spark):
    texts = spark.createDataFrame([(f"x Model-{n}; Android",) for n in (7, 42, 4999, 7000)], "useragent string")
    rules = model_rules(spark, 5000).unionByName(agents.rule_rows(spark, {"os": OS_RULES + (("^x", "short"),)}))
    bound = Bound(rows=100)
    filed = agents.filed(rules)
    known = texts.select(F.col("useragent").alias("_text"))
    held = agents._held(filed, agents._cut(known, filed, bound), bound)
    assert {r["pattern"] for r in held.collect()} == {"Model-7", "Model-4", "Model-42", "Model-49", "Model-499", "Model-4999",
                                                      "Model-70", "Model-700", "Android", "^x"}
    for given in (bound, NEVER_BROADCAST, Bound()):
        got = {r["useragent"]: (r["os"], r["device"]) for r in
               agents.add_agent_by_rules(texts, rules, fields=["os", "device"], bound=given).collect()}
        assert got == {"x Model-7; Android": ("Android", "model 7"), "x Model-42; Android": ("Android", "model 4"),
                       "x Model-4999; Android": ("Android", "model 4"), "x Model-7000; Android": ("Android", "model 7")}


@pytest.mark.parametrize("bound", [Bound(), Bound(rows=2), NEVER_BROADCAST])
def test_each_text_as_matched_with_every_rule(spark, bound):
    patterns = ["aaa", "aab|baa", "a\\.b", "é☃.😀", "x{2}yz", "[ab]{3}$", "^$", "aaaa+", "(aab|b)aaa", "aba|a", "☃😀☃", "aaa",
                "\\pLabc", None]
    rules = spark.createDataFrame([("os", i // 2, p, f"v{i}") for i, p in enumerate(patterns)] * 2, agents.RULE_SCHEMA)
    texts = ["", "a", "aa", "aaa", "aaaa", "baaab", "a.b", "é☃é😀", "é☃😀☃", "xxyz", "bbab", "abab", "zzz", "éabc", None, "aaa"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, useragent string")
    every = df.join(F.broadcast(rules), F.expr("useragent RLIKE pattern"), "left").groupBy("id", "useragent").agg(
        F.coalesce(F.min(F.when(F.col("pattern").isNotNull(), F.struct("rank", "value")))["value"], F.lit("Other")).alias("os"))
    got = agents.add_agent_by_rules(df, rules, fields=["os"], bound=bound)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, every.collect()), key=str)
