import pytest

from tagweave.operators.joins import NEVER_BROADCAST
from tagweave.operators.rules import RULE_SCHEMA, RuleTree
from tagweave.plans import tag_jobs
from tagweave.plans.tag_jobs import JOBS, RunOptions, TagJob
from tagweave.session import scratch_path
from tagweave.sources.store import VersionedTable
from workload import tables

ALL = list(JOBS.values())


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    return tables.rule_tree(spark), tables.source_reader(spark, sf_dir), tables.stored_tags(spark, sf_dir)


@pytest.mark.parametrize("drop_stale", [False, True])
@pytest.mark.parametrize("rank", [1, 2])
def test_one_pass_equals_jobs_in_turn(parts, drop_stale, rank):
    tree, read, stored = parts
    options = RunOptions(tables.AS_OF, rank, drop_stale)
    assert rows(tag_jobs.run_jobs(ALL, tree, read, stored, options)) == \
        rows(tag_jobs.run_jobs_in_turn(ALL, tree, read, stored, options))


@pytest.mark.parametrize("drop_stale", [False, True])
def test_rule_tree_beyond_the_bound_gives_the_same(parts, drop_stale):
    tree, read, stored = parts
    options = RunOptions(tables.AS_OF, drop_stale=drop_stale)
    large = RuleTree(tree.rules, NEVER_BROADCAST)
    assert not large.small
    assert rows(tag_jobs.run_jobs(ALL, large, read, stored, options)) == \
        rows(tag_jobs.run_jobs(ALL, tree, read, stored, options))


def test_copies_of_users_change_nothing(parts):
    tree, read, stored = parts
    options = RunOptions(tables.AS_OF)
    user_jobs = [job for job in ALL if job.key == "id"]

    def doubled(spec):
        df = read(spec)
        return df.unionByName(df).unionByName(df.where("id = 1")).unionByName(df.where("id = 1"))

    assert rows(tag_jobs.run_jobs(user_jobs, tree, doubled, stored, options)) == \
        rows(tag_jobs.run_jobs(user_jobs, tree, read, stored, options))
    gender = JOBS[4]
    assert rows(tag_jobs.run_job(gender, tree, doubled, stored)) == rows(tag_jobs.run_job(gender, tree, read, stored))


def test_jobs_on_one_source_share_its_scan(parts):
    tree, read, stored = parts
    plan = tag_jobs.run_jobs(ALL, tree, read, stored, RunOptions(tables.AS_OF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3  # users, orders, stored tags
    assert plan.count("Exchange hashpartitioning(userId") == 1
    assert "BatchEvalPython" not in plan and "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_two_jobs_with_one_statistic_do_not_share(spark):
    """A second recency category on the same source counts its own days."""
    tree = RuleTree(spark.createDataFrame(
        [(1, 0, 4, "inType=x##esNodes=##esIndex=o##esType=_doc##selectFields=m,bought"),
         (2, 0, 4, "inType=x##esNodes=##esIndex=o##esType=_doc##selectFields=m,returned"),
         (11, 1, 5, "0-5"), (12, 1, 5, "6-50"), (21, 2, 5, "0-5"), (22, 2, 5, "6-50")], RULE_SCHEMA))
    jobs = [TagJob(k, "j", "m", field, match=tag_jobs.NUMBERS, statistic=tag_jobs.RECENCY)
            for k, field in ((1, "bought"), (2, "returned"))]
    source = spark.createDataFrame([(7, 0, 86400 * 9)], "m bigint, bought bigint, returned bigint")
    stored = spark.createDataFrame([(7, "11,99")], "userId bigint, tagsId string")
    got = tag_jobs.run_jobs(jobs, tree, lambda spec: source.select(*spec.fields), stored, RunOptions("1970-01-11"))
    assert rows(got) == [(7, "12,21,99")]


def test_store_run_is_idempotent(spark, parts):
    tree, read, stored = parts
    options = RunOptions(tables.AS_OF)
    store = VersionedTable(spark, scratch_path(spark, "tags"))
    assert tag_jobs.tag_store_run(ALL, tree, read, store, options) == 0
    first = rows(store.read())
    assert first and all(tags for _, tags in first)
    assert tag_jobs.tag_store_run(ALL, tree, read, store, options) == 1
    assert rows(store.read()) == first


def test_first_run_without_a_store(parts):
    tree, read, _ = parts
    got = tag_jobs.run_job(JOBS[66], tree, read, None)
    assert {r["tagsId"] for r in got.collect()} == {"67", "68", "69"}


def test_as_of_is_required_for_recency(parts):
    tree, read, stored = parts
    with pytest.raises(ValueError):
        tag_jobs.run_job(JOBS[23], tree, read, stored)


def test_literal_rule_sets(spark):
    """The rule sets of each category on a few entities."""
    def run(tag_id, data, schema):
        frame = spark.createDataFrame(data, schema)
        tree = tables.rule_tree(spark)
        return sorted((r["userId"], r["tagsId"]) for r in
                      tag_jobs.compute(JOBS[tag_id], frame, tree, RunOptions(as_of="2022-10-20")).collect())

    assert run(7, [(1, 3), (2, 9)], "id bigint, job int") == [(1, "10"), (2, None)]
    assert run(4, [(1, "1"), (2, "3"), (3, None)], "id bigint, gender string") == [(1, "5")]
    assert run(14, [(1, "1993-07-12"), (2, "1985-02-03"), (3, "1974-09-08"), (4, "no date"), (5, "1949-12-31")],
               "id bigint, birthday string") == [(1, "19"), (2, "18"), (3, "17")]
    day = 1665619200  # 2022-10-13
    got = run(23, [(1, day), (1, day - 86400 * 40), (2, day - 86400 * 10**4), (3, day + 86400)],
              "memberid bigint, finishtime bigint")
    assert got == [(1, "24"), (1, "25"), (2, None), (3, "24")]
    pay = [(1, "alipay"), (1, "alipay"), (1, "cod"), (2, "cod"), (2, "alipay"), (3, "cash")]
    assert run(30, pay, "memberid bigint, paymentcode string") == [(1, "31"), (2, "31"), (3, None)]
    assert run(62, [(1, 2)], "id bigint, politicalface int") == [(1, "64")]


def test_unknown_kinds_are_refused():
    for wrong in ({"match": "equals"}, {"statistic": "favorite"}, {"how": "outer"}):
        with pytest.raises(ValueError):
            tag_jobs.TagJob(4, "x", "id", "gender", **wrong)
    with pytest.raises(ValueError):
        RunOptions(rank=0)


def test_decimals_match_exactly(spark):
    rules = spark.createDataFrame([(1, "9007199254740992"), (2, "1.5"), (3, "12")], "id int, rule string")
    df = spark.sql("SELECT id, cast(text AS decimal(20,0)) AS d FROM VALUES (1, '9007199254740993'), (2, '2'), (3, '12') AS t(id, text)")
    from tagweave.operators.matching import tag_equal

    assert sorted(map(tuple, tag_equal(df, "id", "d", rules).collect())) == [(1, None), (2, None), (3, "3")]
