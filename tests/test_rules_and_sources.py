import pytest
from pyspark.sql import functions as F

from tagweave.operators import rules
from tagweave.operators.joins import NEVER_BROADCAST
from tagweave.session import scratch_path
from tagweave.sources import scans
from tagweave.sources.spec import SourceSpec, decode_columns

SOURCE = "inType=parquet##esNodes=up:9200##esIndex=users##esType=_doc##selectFields=id,birthday"
TREE = [(14, 1, 4, SOURCE), (15, 14, 5, "19500101-19591231"), (16, 14, 5, "abc"), (9, 7, 5, "2"), (8, 7, 5, "1")]


@pytest.fixture(scope="module")
def tree_df(spark):
    return scans.rows(spark, TREE, rules.RULE_SCHEMA)


@pytest.mark.parametrize("bound", [None, NEVER_BROADCAST])
def test_source_rule_lookup(tree_df, bound):
    tree = rules.RuleTree(tree_df, bound) if bound else rules.RuleTree(tree_df)
    spec = tree.source_spec(14)
    assert spec == SourceSpec("parquet", "up:9200", "users", "_doc", ("id", "birthday"))
    with pytest.raises(LookupError):
        tree.source_spec(99)


def test_children_and_category_ids(tree_df):
    assert {tuple(r) for r in rules.children(tree_df, 7).collect()} == {(8, "1"), (9, "2")}
    assert {tuple(r) for r in rules.category_ids(tree_df).collect()} == {(1, "14"), (7, "8,9"), (14, "15,16")}
    assert rules.RuleTree(tree_df).tag_ids(7) == ["8", "9"]


def test_bad_range_rules_give_null_bounds(spark):
    df = scans.rows(spark, [(1, "0-7"), (2, "abc"), (3, ""), (4, "5-"), (5, "-5")], "id int, rule string")
    got = {r["id"]: (r["lo"], r["hi"]) for r in rules.number_ranges(df).collect()}
    assert got == {1: (0, 7), 2: (None, None), 3: (None, None), 4: (5, None), 5: (None, 5)}
    dates = scans.rows(spark, [(1, "19700101-19700102"), (2, "1970-01-01"), (3, "19701301-19701332")], "id int, rule string")
    got = {r["id"]: (r["lo"], r["hi"]) for r in rules.date_ranges(dates).collect()}
    assert got == {1: (0, 1), 2: (None, None), 3: (None, None)}


def test_rule_text_decodes_alike_on_driver_and_in_columns(spark):
    row = decode_columns(scans.rows(spark, [(1, SOURCE)], "id int, rule string")).first()
    spec = SourceSpec.from_text(SOURCE)
    assert (row["inType"], row["esNodes"], row["esIndex"], row["esType"]) == (
        spec.in_type, spec.nodes, spec.index, spec.doc_type)
    assert row["selectFields"] == ",".join(spec.fields)
    with pytest.raises(ValueError):
        SourceSpec.from_text("inType=parquet")


def test_scan_reads_only_the_named_fields(spark, sf_dir):
    spec = SourceSpec("parquet", sf_dir, "orders.parquet", "_doc", ("o_orderkey", "o_custkey"))
    df = scans.scan(spark, spec)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_catalog_table_scan(spark, sf_dir):
    name = "catalog_scan_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    path = scratch_path(spark, "catalog")
    spark.read.parquet(f"{sf_dir}/customer.parquet").write.option("path", path).saveAsTable(name)
    try:
        read = scans.read_table(spark, name).where("c_custkey > 4")
        assert read.count() == spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_custkey > 4").count()
        assert scans.scan(spark, SourceSpec("table", "", name, "_doc", ("c_custkey",))).columns == ["c_custkey"]
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_libsvm_scan(spark):
    path = scratch_path(spark, "libsvm")
    spark.createDataFrame([("0 1:1.0 2:1.0",), ("1 1:4.0 2:3.0",)], "value string").write.text(path)
    rows = scans.read_libsvm(spark, path, 2).orderBy("label").collect()
    assert [r["features"].toArray().tolist() for r in rows] == [[1.0, 1.0], [4.0, 3.0]]


def test_search_index_options():
    spec = SourceSpec.from_text(SOURCE)
    assert scans.search_options(spec) == {
        "es.resource": "users", "es.nodes": "up:9200", "es.read.field.include": "id,birthday",
        "es.mapping.date.rich": "false"}


class FakeReader:
    """Records the JDBC calls; no database is started for the tests."""

    def __init__(self, lo, hi):
        self.calls, self.span = [], (lo, hi)

    @property
    def read(self):
        return self

    def jdbc(self, url, table, **options):
        self.calls.append((table, options))
        return self

    def first(self):
        return self.span


def test_jdbc_read_splits_by_the_measured_span():
    reader = FakeReader(5, 104)
    scans.read_jdbc(reader, "jdbc:x", "t", {"user": "u"}, partition_column="id", num_partitions=4)
    assert "min(id)" in reader.calls[0][0]
    assert reader.calls[1] == ("t", {"column": "id", "lowerBound": 5, "upperBound": 105, "numPartitions": 4,
                                     "properties": {"user": "u"}})
    empty = FakeReader(None, None)
    scans.read_jdbc(empty, "jdbc:x", "t", partition_column="id")
    assert empty.calls[1] == ("t", {"properties": {}})
    whole = FakeReader(1, 2)
    scans.read_jdbc(whole, "jdbc:x", "t")
    assert whole.calls == [("t", {"properties": {}})]


def test_jdbc_overwrite_keeps_the_table_definition():
    class Writer:
        options, args = {}, None

        @property
        def write(self):
            return self

        def option(self, name, value):
            self.options = {name: value}
            return self

        def jdbc(self, url, table, mode, properties):
            self.args = (url, table, mode, properties)

    writer = Writer()
    scans.write_jdbc(writer, "jdbc:x", "t", {"user": "u"})
    assert writer.options == {"truncate": "true"} and writer.args == ("jdbc:x", "t", "overwrite", {"user": "u"})


def test_literal_rows_have_the_given_schema(spark):
    assert scans.rows(spark, [(1, "a")], "id int, name string").schema.simpleString() == "struct<id:int,name:string>"
    assert scans.rows(spark, [(1,)], "id bigint").select(F.col("id")).first()[0] == 1
