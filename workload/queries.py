"""The registered queries: one per operator and job, each over whole tables."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tagweave.functions import access_log, behaviour, tag_sets, text
from tagweave.functions.user_agent import DEFAULT_RULES
from tagweave.operators import (agents, clustering, enrichment, features, matching, merging, metrics,
                                rules, scoring, statistics)
from tagweave.operators.joins import NEVER_BROADCAST
from tagweave.operators.upsert import upsert
from tagweave.plans import tag_jobs
from tagweave.plans.incremental import refresh_tags
from tagweave.session import scratch_path
from tagweave.sources.buckets import BucketTable
from tagweave.sources.scans import scan
from tagweave.sources.spec import SourceSpec, decode_columns
from tagweave.sources.store import VersionedTable
from tagweave.streaming import jobs as stream_jobs
from tagweave.streaming.sinks import (appended_sink, batch_sinks, keyed_sink, read_appended, run_to_table, stream_sink,
                                      versioned_sink)
from tagweave.streaming.sources import from_positions, stream_source, table_stream, values
from workload import tables

# The stored tags are derived from customers, one row each.
OPTIONS = tag_jobs.RunOptions(as_of=tables.AS_OF, keyed_store=True)
QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# Sources and sinks

@query
def scan_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables.configure(spark)
    rule = {"inType": "parquet", "esNodes": sf_dir, "esIndex": "orders.parquet", "esType": "_doc",
            "selectFields": "o_orderkey,o_custkey"}
    return scan(spark, SourceSpec.from_map(rule))


@query
def tag_upsert(spark, sf_dir):
    return upsert(tables.stored_tags(spark, sf_dir), _gender_tags(spark, sf_dir), "userId")


@query
def tag_store_write(spark, sf_dir):
    """The same upsert through the versioned store, applied twice."""
    store = VersionedTable(spark, scratch_path(spark, "tags"))
    store.write(tables.stored_tags(spark, sf_dir))
    for _ in range(2):
        store.write(upsert(store.read(), _gender_tags(spark, sf_dir), "userId"))
    return store.read()


@query
def tag_upsert_buckets(spark, sf_dir):
    """The same upsert into a bucketed table, of which only the buckets of given keys are rewritten."""
    table = BucketTable(spark, scratch_path(spark, "tag-buckets"), "userId", 16)
    table.upsert(tables.stored_tags(spark, sf_dir))
    table.upsert(_gender_tags(spark, sf_dir))
    table.upsert(_gender_tags(spark, sf_dir).where("userId % 3 = 1"))
    return table.read()


@query
def tag_store_full_run(spark, sf_dir):
    """All jobs through the store: run, commit, read back, run again."""
    store = VersionedTable(spark, scratch_path(spark, "tags"))
    store.write(tables.stored_tags(spark, sf_dir))
    for _ in range(2):
        tag_jobs.tag_store_run(list(tag_jobs.JOBS.values()), tables.rule_tree(spark),
                               tables.source_reader(spark, sf_dir), store, OPTIONS)
    return store.read()


# Rules

@query
def rule_children(spark, sf_dir):
    """Children of every parent: the lookup of one parent, as a join over all."""
    tree = tables.derived_rules(spark, sf_dir)
    parents = tree.select(F.col("pid").alias("parent")).distinct()
    return parents.join(tree, F.col("parent") == F.col("pid")).select("parent", "id", "rule")


@query
def rule_decode(spark, sf_dir):
    return decode_columns(tables.derived_sources(spark, sf_dir))


@query
def rule_ranges(spark, sf_dir):
    return rules.number_ranges(tables.derived_rules(spark, sf_dir))


@query
def category_ids(spark, sf_dir):
    return rules.category_ids(tables.derived_rules(spark, sf_dir))


# Filters and joins

@query
def filter_gt(spark, sf_dir):
    return tables.users(spark, sf_dir).where("id > 4")


@query
def incremental_filter(spark, sf_dir):
    changed = statistics.changed_since(tables.pay_orders(spark, sf_dir), tables.SINCE)
    return changed.select("ordersn", "memberid")


@query
def tag_equal_inner(spark, sf_dir):
    return matching.tag_equal(tables.users(spark, sf_dir), "id", "gender",
                              tables.rule_tree(spark).children(4), "inner")


@query
def tag_equal_left(spark, sf_dir):
    return matching.tag_equal(tables.users(spark, sf_dir), "id", "job",
                              tables.rule_tree(spark).children(7), "left")


@query
def tag_equal_shuffled(spark, sf_dir):
    """The left match with the broadcast ruled out."""
    return matching.tag_equal(tables.users(spark, sf_dir), "id", "job",
                              tables.rule_tree(spark).children(7), "left", NEVER_BROADCAST)


@query
def tag_range_inner(spark, sf_dir):
    ranges = rules.date_ranges(tables.rule_tree(spark).children(14))
    day = text.day_number(text.compact_date(text.strip_dashes(F.col("birthday"))))
    return matching.tag_range(tables.users(spark, sf_dir), "id", day, ranges, "inner")


def _days(spark, sf_dir):
    return statistics.recency_days(tables.pay_orders(spark, sf_dir), "memberid", "finishtime", tables.AS_OF)


@query
def tag_range_left(spark, sf_dir):
    ranges = rules.number_ranges(tables.rule_tree(spark).children(23))
    return matching.tag_range(_days(spark, sf_dir), "memberid", F.col("days"), ranges, "left")


@query
def tag_range_shuffled(spark, sf_dir):
    """Every order's age matched left, with the broadcast ruled out."""
    ranges = rules.number_ranges(tables.rule_tree(spark).children(23))
    aged = tables.pay_orders(spark, sf_dir).select(
        "ordersn", statistics.days_since(F.col("finishtime"), F.to_date(F.lit(tables.AS_OF))).alias("days"))
    return matching.tag_range(aged, "ordersn", F.col("days"), ranges, "left", NEVER_BROADCAST)


@query
def entity_mapping(spark, sf_dir):
    goods = tables.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return statistics.map_to_entity(goods, tables.pay_orders(spark, sf_dir), "l_orderkey", "ordersn", "memberid")


# Aggregates, ranking, preview

@query
def recency_days(spark, sf_dir):
    return _days(spark, sf_dir)


@query
def category_counts(spark, sf_dir):
    return statistics.category_counts(tables.pay_orders(spark, sf_dir), "memberid", "paymentcode")


@query
def ranked_categories(spark, sf_dir):
    return statistics.rank_categories(tables.pay_orders(spark, sf_dir), "memberid", "paymentcode")


@query
def payway_top1(spark, sf_dir):
    return statistics.nth_most_frequent(tables.pay_orders(spark, sf_dir), "memberid", "paymentcode", 1)


@query
def payway_second(spark, sf_dir):
    return statistics.nth_most_frequent(tables.pay_orders(spark, sf_dir), "memberid", "paymentcode", 2)


@query
def recency_and_favourite(spark, sf_dir):
    return statistics.recency_and_favourite(
        tables.pay_orders(spark, sf_dir), "memberid", "finishtime", "paymentcode", tables.AS_OF)


@query
def keyed_reduce(spark, sf_dir):
    lines = tables.load(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").cast("bigint").alias("q"))
    reduced = statistics.keyed_reduce(lines, "l_suppkey", "q")
    return reduced.select("l_suppkey", "reduced", "folded",
                          F.col("aggregated.sum").alias("total"), F.col("aggregated.count").alias("items"))


@query
def preview_topn(spark, sf_dir):
    orders = tables.pay_orders(spark, sf_dir).select("ordersn", "memberid", "finishtime")
    return statistics.preview(orders, [F.desc("finishtime"), F.asc("ordersn")])


# Scalar functions

@query
def fn_strings(spark, sf_dir):
    birthday = F.col("birthday")
    return tables.users(spark, sf_dir).select(
        "id", text.strip_dashes(birthday).alias("compact"),
        text.part(birthday, "-", 0).alias("year"), text.part(birthday, "-", 1).alias("month"),
        text.part(birthday, "-", 5).alias("absent"))


@query
def fn_tag_sets(spark, sf_dir):
    new, old = F.lit("25,67"), F.col("tagsId")
    return tables.tag_texts(spark, sf_dir).select(
        "userId", tag_sets.without(old, new).alias("without"), tag_sets.union(new, old).alias("united"))


# Tag merge

def _gender_tags(spark, sf_dir):
    return matching.tag_equal(tables.users(spark, sf_dir), "id", "gender",
                              tables.rule_tree(spark).children(4), "inner")


def _cycle_tags(spark, sf_dir):
    ranges = rules.number_ranges(tables.rule_tree(spark).children(23))
    return merging.collapse(
        matching.tag_range(_days(spark, sf_dir), "memberid", F.col("days"), ranges, "left"))


@query
def tag_merge(spark, sf_dir):
    return merging.merge_tags(_cycle_tags(spark, sf_dir), tables.stored_tags(spark, sf_dir),
                              tables.rule_tree(spark).children(23))


@query
def tag_merge_unbounded(spark, sf_dir):
    """The same merge with the category too large for a literal."""
    return merging.merge_tags(_cycle_tags(spark, sf_dir), tables.stored_tags(spark, sf_dir),
                              tables.rule_tree(spark).children(23), bound=NEVER_BROADCAST)


@query
def tag_merge_drop_stale(spark, sf_dir):
    new = matching.tag_equal(tables.users(spark, sf_dir), "id", "job", tables.rule_tree(spark).children(7))
    return merging.merge_tags(new, tables.stored_tags(spark, sf_dir), tables.rule_tree(spark).children(7),
                              drop_stale=True)


@query
def tag_merge_union(spark, sf_dir):
    return merging.merge_union(_gender_tags(spark, sf_dir), tables.stored_tags(spark, sf_dir))


# Access log

# The columns records are made of.
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type")


def _events(spark, sf_dir):
    return tables.load(spark, sf_dir, "events").select(*EVENT_COLUMNS)


def _lines(spark, sf_dir):
    return tables.access_lines(_events(spark, sf_dir))


@query
def access_log_parse(spark, sf_dir):
    parsed = access_log.parse_lines(_lines(spark, sf_dir))
    return parsed.select(*access_log.FIELDS, access_log.access_time_text(F.col("datetime")).alias("access_time"))


@query
def access_log_rejects(spark, sf_dir):
    return access_log.rejected_lines(_lines(spark, sf_dir))


@query
def ip_area_join(spark, sf_dir):
    parsed = access_log.parse_lines(_lines(spark, sf_dir)).select("ip", "sendbytes")
    return enrichment.add_area(parsed, tables.area_ranges(spark))


@query
def ip_area_join_shuffled(spark, sf_dir):
    """Areas from a dimension that grows with the data, joined by shuffle."""
    parsed = access_log.parse_lines(_lines(spark, sf_dir)).select("ip", "sendbytes")
    return enrichment.add_area(parsed, tables.customer_ranges(spark, sf_dir), bound=NEVER_BROADCAST)


@query
def ip_area_mixed_widths(spark, sf_dir):
    """Areas of one address, of 256 and of 65,536 in one dimension."""
    parsed = access_log.parse_lines(_lines(spark, sf_dir)).select("ip", "sendbytes")
    return enrichment.add_area(parsed, tables.mixed_ranges(spark, sf_dir))


@query
def ip_area_mixed_widths_shuffled(spark, sf_dir):
    parsed = access_log.parse_lines(_lines(spark, sf_dir)).select("ip", "sendbytes")
    return enrichment.add_area(parsed, tables.mixed_ranges(spark, sf_dir), bound=NEVER_BROADCAST)


@query
def ip_area_nested(spark, sf_dir):
    """Areas from ranges inside each other: a /8, its /16, /24 and single addresses; the narrowest counts."""
    parsed = access_log.parse_lines(_lines(spark, sf_dir)).select("ip", "sendbytes")
    return enrichment.add_nested_area(parsed, tables.nested_ranges(spark, sf_dir))


@query
def user_agent_classify(spark, sf_dir):
    parsed = access_log.parse_lines(_lines(spark, sf_dir)).select("sendbytes", "useragent")
    return enrichment.add_agent(parsed, rules=tables.AGENT_RULES)


@query
def user_agent_dictionary(spark, sf_dir):
    parsed = access_log.parse_lines(_lines(spark, sf_dir)).select("sendbytes", "useragent")
    return enrichment.add_agent_by_dictionary(parsed, rules=tables.AGENT_RULES)


@query
def user_agent_default_rules(spark, sf_dir):
    """The shipped rules, over agents for each of their patterns."""
    return enrichment.add_agent(tables.agent_texts(_events(spark, sf_dir)))


@query
def user_agent_many_rules(spark, sf_dir):
    """Devices by a dictionary with a rule for each part, and the shipped rules for systems and browsers."""
    shipped = agents.rule_rows(spark, {"os": DEFAULT_RULES.os, "browser": DEFAULT_RULES.browser})
    rules_ = tables.part_rules(tables.load(spark, sf_dir, "part")).unionByName(shipped)
    return agents.add_agent_by_rules(tables.model_texts(_events(spark, sf_dir)), rules_)


@query
def access_metrics(spark, sf_dir):
    return stream_jobs.access_job(_lines(spark, sf_dir), tables.area_ranges(spark), tables.AGENT_RULES)


# Behaviour events

def _records(spark, sf_dir):
    return tables.behaviour_records(_events(spark, sf_dir))


@query
def event_json_parse(spark, sf_dir):
    return behaviour.parse_events(_records(spark, sf_dir))


@query
def event_json_tuple(spark, sf_dir):
    return behaviour.parse_top_fields(_records(spark, sf_dir))


@query
def event_json_paths(spark, sf_dir):
    return behaviour.json_paths(
        _records(spark, sf_dir), user_id="$.user_id", province="$.area.province",
        is_buy="$.user_behavior.is_buy", goods_name="$.goods_detail.goods_name")


@query
def event_json_full(spark, sf_dir):
    return behaviour.accepted_events(tables.full_records(_events(spark, sf_dir)))


@query
def event_json_rejects(spark, sf_dir):
    return behaviour.rejected_events(tables.full_records(_events(spark, sf_dir)))


@query
def behaviour_counts(spark, sf_dir):
    return stream_jobs.behaviour_job(_records(spark, sf_dir))


# Streams over the same table

def _event_stream(spark, sf_dir):
    return table_stream(spark, sf_dir, "events").select(*EVENT_COLUMNS)


@query
def stream_access_metrics(spark, sf_dir):
    tables.configure(spark)
    lines = tables.access_lines(_event_stream(spark, sf_dir))
    return run_to_table(stream_jobs.access_job(lines, tables.area_ranges(spark), tables.AGENT_RULES),
                        scratch_path(spark, "access"))


@query
def stream_behaviour_counts(spark, sf_dir):
    tables.configure(spark)
    records = tables.behaviour_records(_event_stream(spark, sf_dir))
    return run_to_table(stream_jobs.behaviour_job(records), scratch_path(spark, "behaviour"))


def _batched_events(spark, sf_dir):
    """The events in about three batches."""
    tables.configure(spark)
    path = tables.event_files(spark, sf_dir, EVENT_COLUMNS)
    files = max(1, spark.sparkContext.defaultParallelism // 3)
    return stream_source(spark, "parquet", path, spark.read.parquet(path).schema, maxFilesPerTrigger=files)


def _updated(spark, metrics, key, label):
    path = scratch_path(spark, label)
    batch_sinks(metrics, [keyed_sink(f"{path}/table", key, 8)], f"{path}/checkpoint", "update",
                {"availableNow": True}).awaitTermination()
    return BucketTable(spark, f"{path}/table", key, 8).read()


@query
def stream_access_update(spark, sf_dir):
    """Only the addresses a batch changed are written."""
    lines = tables.access_lines(_batched_events(spark, sf_dir))
    metrics = stream_jobs.access_job(lines, tables.area_ranges(spark), tables.AGENT_RULES)
    return _updated(spark, metrics, "ip", "access-update")


@query
def stream_behaviour_update(spark, sf_dir):
    """Only the users a batch changed are written."""
    records = tables.behaviour_records(_batched_events(spark, sf_dir))
    return _updated(spark, stream_jobs.behaviour_job(records), "user_id", "behaviour-update")


@query
def stream_restart_new_checkpoint(spark, sf_dir):
    """The same stream twice into one table; the second run starts with a new checkpoint."""
    path = scratch_path(spark, "restart")
    for attempt in ("first", "second"):
        records = tables.behaviour_records(_batched_events(spark, sf_dir))
        batch_sinks(stream_jobs.behaviour_job(records), [versioned_sink(f"{path}/table")], f"{path}/{attempt}",
                    "complete", {"availableNow": True}).awaitTermination()
    return VersionedTable(spark, f"{path}/table").read()


@query
def stream_append_sink(spark, sf_dir):
    """Projection only, appended to Parquet files."""
    tables.configure(spark)
    path = scratch_path(spark, "append")
    lines = values(tables.access_lines(_event_stream(spark, sf_dir)))
    stream_sink(lines, "parquet", f"{path}/checkpoint", "append", {"availableNow": True},
                path=f"{path}/table").awaitTermination()
    return spark.read.parquet(f"{path}/table")


@query
def stream_foreach_batch(spark, sf_dir):
    """One query, two sinks; the rows of both are given."""
    tables.configure(spark)
    path = scratch_path(spark, "fanout")
    records = tables.behaviour_records(_event_stream(spark, sf_dir))
    sinks = [versioned_sink(f"{path}/a"), versioned_sink(f"{path}/b")]
    batch_sinks(stream_jobs.behaviour_job(records), sinks, f"{path}/checkpoint", "complete",
                {"availableNow": True}).awaitTermination()
    first, second = [VersionedTable(spark, f"{path}/{name}").read() for name in ("a", "b")]
    return first.withColumn("sink", F.lit("a")).unionByName(second.withColumn("sink", F.lit("b")))


@query
def stream_append_once(spark, sf_dir):
    """Every batch is written twice, as after a failure between write and commit; its rows count once."""
    path = scratch_path(spark, "once")
    sink = appended_sink(f"{path}/table", "first")
    lines = values(tables.access_lines(_batched_events(spark, sf_dir)))
    batch_sinks(lines, [sink, sink], f"{path}/checkpoint", "append", {"availableNow": True}).awaitTermination()
    return read_appended(spark, f"{path}/table").select("value")


@query
def stream_from_position(spark, sf_dir):
    """Events as records of six partitions, read from a position in four of them, over two runs of one checkpoint."""
    tables.configure(spark)
    path = scratch_path(spark, "positions")
    records = _event_records(_batched_events(spark, sf_dir))
    wanted = from_positions(records, {0: 100, 1: -2, 2: 10**12, 3: 7}, others=50)
    for _ in range(2):
        batch_sinks(wanted, [appended_sink(f"{path}/table", "first")], f"{path}/checkpoint", "append",
                    {"availableNow": True}).awaitTermination()
    return read_appended(spark, f"{path}/table").select("partition", "offset", "event_type")


def _event_records(events):
    return events.select((F.col("event_id") % 6).alias("partition"), F.expr("event_id div 6").alias("offset"), "event_type")


@query
def stream_watermark_counts(spark, sf_dir):
    """Closed windows only: append mode gives a window once the watermark passes it."""
    tables.configure(spark)
    path = scratch_path(spark, "windows")
    records = tables.behaviour_records(_event_stream(spark, sf_dir))
    stream_sink(stream_jobs.windowed_behaviour_job(records), "parquet", f"{path}/checkpoint", "append",
                {"availableNow": True}, path=f"{path}/table").awaitTermination()
    return spark.read.parquet(f"{path}/table")


# Features, clusters, scores

def _vectors(spark, sf_dir):
    return features.to_vectors(tables.load(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding")


@query
def minmax_scale(spark, sf_dir):
    scaled = features.min_max_scale(_vectors(spark, sf_dir))
    cells = scaled.select("vec_id", F.posexplode(vector_to_array("scaled")).alias("dim", "value"))
    return cells.select("vec_id", "dim", F.round("value", 9).alias("value"))


@query
def string_index(spark, sf_dir):
    events = tables.load(spark, sf_dir, "events").select("event_id", "event_type")
    return features.index_strings(events, "event_type", "event_index")


@query
def string_index_distributed(spark, sf_dir):
    """The order keys of all lines as labels: as many as there are orders."""
    lines = tables.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return features.index_strings_distributed(lines, "l_orderkey", "order_index")


@query
def index_to_string(spark, sf_dir):
    events = tables.load(spark, sf_dir, "events").select("event_id", "event_type")
    indexed = features.index_strings(events, "event_type", "event_index")
    return features.restore_strings(indexed, "event_index", "restored").select("event_id", "restored")


def _clustered(spark, sf_dir):
    """Two clusters, each named by its smallest vector id."""
    vectors = features.to_vectors(tables.parity_vectors(spark, sf_dir), "embedding")
    return clustering.assign(clustering.fit_kmeans(vectors), vectors)


@query
def kmeans_assign(spark, sf_dir):
    assigned = _clustered(spark, sf_dir)
    names = assigned.groupBy("prediction").agg(F.min("vec_id").alias("cluster"))
    return assigned.join(names, "prediction").select("vec_id", "cluster")


@query
def kmeans_quality(spark, sf_dir):
    assigned = _clustered(spark, sf_dir)
    score = round(clustering.silhouette(assigned), 6)
    return assigned.groupBy("prediction").agg(
        F.min("vec_id").alias("cluster"), F.count("*").alias("members"), F.lit(score).alias("silhouette")).drop("prediction")


@query
def kmeans_raw_assign(spark, sf_dir):
    """Clusters of the vectors as they are; SQL cannot state these."""
    vectors = _vectors(spark, sf_dir)
    return clustering.assign(clustering.fit_kmeans(vectors), vectors).select("vec_id", "prediction")


@query
def kmeans_raw_quality(spark, sf_dir):
    return clustering.quality(_vectors(spark, sf_dir))


def _rounds(spark, sf_dir):
    """The raw vectors under three centres, after four steps from the vectors of the three smallest ids."""
    vectors = tables.load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    first = [list(r["embedding"]) for r in vectors.orderBy("vec_id").limit(3).collect()]
    return clustering.assign_nearest(vectors, clustering.lloyd(vectors, first, 4, "embedding"), "embedding")


@query
def kmeans_rounds_assign(spark, sf_dir):
    return _rounds(spark, sf_dir).select("vec_id", F.col("prediction").alias("cluster"))


@query
def kmeans_rounds_quality(spark, sf_dir):
    """Members and silhouette of each cluster, and that of all vectors."""
    found = clustering.moment_quality(_rounds(spark, sf_dir), "embedding")
    return found.select(F.col("prediction").alias("cluster"), "members", F.round("silhouette", 6).alias("silhouette"),
                        F.round("overall", 6).alias("overall"))


@query
def silhouette_given(spark, sf_dir):
    """The given labels as clusters."""
    vectors = tables.load(spark, sf_dir, "embeddings").select(
        "embedding", F.col("label").cast("double").alias("prediction"))
    score = round(clustering.silhouette(features.to_vectors(vectors, "embedding")), 6)
    return vectors.groupBy(F.col("prediction").cast("int").alias("label")).agg(
        F.count("*").alias("members"), F.lit(score).alias("silhouette"))


@query
def model_score(spark, sf_dir):
    orders = tables.load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    predicted = scoring.score_with(scoring.linear_model(0.5, 3.25), F.col("o_totalprice"))
    return orders.select("o_orderkey", predicted.cast("double").alias("prediction"))


@query
def pipeline_score(spark, sf_dir):
    """A saved pipeline, loaded and applied."""
    orders = tables.load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    path = scratch_path(spark, "model")
    stage = SQLTransformer(statement="SELECT o_orderkey, o_totalprice * 0.5D + 3.25D AS prediction FROM __THIS__")
    Pipeline(stages=[stage]).fit(orders).save(path)
    return scoring.score_pipeline(orders, path)


# Tag jobs

def _job_query(name: str, tag_id: int, options=OPTIONS):
    def run(spark, sf_dir):
        return tag_jobs.run_job(tag_jobs.JOBS[tag_id], tables.rule_tree(spark),
                                tables.source_reader(spark, sf_dir), tables.stored_tags(spark, sf_dir), options)

    QUERIES[name] = run


_job_query("tag_gender", 4)
_job_query("tag_job", 7)
_job_query("tag_age_band", 14)
_job_query("tag_consume_cycle", 23)
_job_query("tag_payway", 30)
_job_query("tag_payway_second", 30, tag_jobs.RunOptions(as_of=tables.AS_OF, rank=2))
_job_query("tag_political", 62)
_job_query("tag_marriage", 66)


def total_amount(orders: DataFrame) -> DataFrame:
    return orders.groupBy("memberid").agg(F.sum("amount").alias("amount"))


SPEND_BAND = tag_jobs.TagJob(80, "spend band", "memberid", "amount", match=tag_jobs.NUMBERS, statistic=total_amount)


@query
def tag_spend_band(spark, sf_dir):
    """A job with a statistic of the caller's own."""
    return tag_jobs.run_job(SPEND_BAND, tables.rule_tree(spark), tables.source_reader(spark, sf_dir),
                            tables.stored_tags(spark, sf_dir), OPTIONS)


@query
def tag_incremental_run(spark, sf_dir):
    """Recency and favourite tags after a first load and a batch of inserted, changed and deleted orders."""
    jobs = [tag_jobs.JOBS[23], tag_jobs.JOBS[30]]
    state = BucketTable(spark, scratch_path(spark, "order-counts"), "memberid", 16)
    tags = BucketTable(spark, scratch_path(spark, "order-tags"), "userId", 16)
    for changes in tables.order_changes(spark, sf_dir):
        refresh_tags(jobs, tables.rule_tree(spark), state, tags, changes, OPTIONS)
    return tags.read()


def _overlapping(name: str, tag_id: int) -> tag_jobs.TagJob:
    return tag_jobs.TagJob(tag_id, name, "memberid", "amount", match=tag_jobs.NUMBERS)


@query
def tag_overlapping_ranges(spark, sf_dir):
    """Two jobs of overlapping ranges on one source: each order keeps one row with all tags of both."""
    jobs = [_overlapping("spend band", 80), _overlapping("spend steps", 90)]
    found = tag_jobs.tagged_rows(tables.order_amounts(spark, sf_dir), jobs, tables.rule_tree(spark), OPTIONS)
    return found.groupBy("userId").agg(
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("found")))), ",").alias("tagsId"),
        F.count("*").alias("orders"), F.sum(F.size("found")).alias("matches"))


@query
def tag_full_run(spark, sf_dir):
    """All seven jobs against the stored tags: the new content of the tag store."""
    return tag_jobs.run_jobs(list(tag_jobs.JOBS.values()), tables.rule_tree(spark),
                             tables.source_reader(spark, sf_dir), tables.stored_tags(spark, sf_dir), OPTIONS)


@query
def tag_full_run_in_turn(spark, sf_dir):
    """The same by seven merges and upserts, one after the other."""
    return tag_jobs.run_jobs_in_turn(list(tag_jobs.JOBS.values()), tables.rule_tree(spark),
                                     tables.source_reader(spark, sf_dir), tables.stored_tags(spark, sf_dir),
                                     OPTIONS)
