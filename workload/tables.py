"""Business inputs derived from the given tables.

Every frame here is a projection of a whole table; `oracle.py` states the same
derivations in SQL. The small rule tables are the literal rows the jobs take as
configuration.
"""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tagweave.functions.user_agent import AgentRules
from tagweave.operators.enrichment import address_ranges
from tagweave.operators.rules import RuleTree
from tagweave.session import configure, scratch_path
from tagweave.sources.spec import SourceSpec

# The day after the last order at every scale.
AS_OF = "2001-08-02"
SINCE = "1998-06-01 00:00:00"

# Category rules (id, rule) by parent.
CATEGORY_RULES = {
    4: [(5, "1"), (6, "2")],
    7: [(8, "1"), (9, "2"), (10, "3"), (11, "4"), (12, "5"), (13, "6")],
    14: [(15, "19500101-19591231"), (16, "19600101-19691231"), (17, "19700101-19791231"),
         (18, "19800101-19891231"), (19, "19900101-19991231"), (20, "20000101-20091231"),
         (21, "20100101-20191231")],
    23: [(24, "0-7"), (25, "7-14"), (26, "15-30"), (27, "31-60"), (28, "61-90"), (29, "91-365"),
         (70, "366-3000")],
    30: [(31, "alipay"), (32, "wxpay"), (33, "chinapay"), (34, "kjtpay"), (35, "cod"), (36, "other")],
    62: [(63, "1"), (64, "2"), (65, "3")],
    66: [(67, "1"), (68, "2"), (69, "3")],
    80: [(81, "0-500000"), (82, "500001-2000000"), (83, "2000001-900000000")],
    90: [(91, "0-50000"), (92, "20000-150000"), (93, "100000-400000"), (94, "0-900000000")],
}
CATEGORY_SOURCES = {
    4: ("users", "id,gender"),
    7: ("users", "id,job"),
    14: ("users", "id,birthday"),
    23: ("pay_orders", "memberid,finishtime"),
    30: ("pay_orders", "memberid,paymentcode"),
    62: ("users", "id,politicalface"),
    66: ("users", "id,marriage"),
    80: ("order_amounts", "memberid,amount"),
    90: ("order_amounts", "memberid,amount"),
}
AREAS = [("10.0.0.0", "10.0.255.255", "north"), ("10.1.0.0", "10.1.255.255", "east"),
         ("10.2.0.0", "10.2.255.255", "south")]
AGENTS = [
    "Mozilla/5.0 (iPhone; CPU iPhone OS 15_0 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) "
    "Version/15.0 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/106.0.0.0 Safari/537.36",
    "Mozilla/5.0 (X11; Linux x86_64; rv:105.0) Gecko/20100101 Firefox/105.0",
    "curl/7.79.1",
]
# The classification rules of the registered queries: few enough to restate in SQL.
AGENT_RULES = AgentRules(
    os=(("iPhone", "iOS"), ("Windows NT", "Windows"), ("Linux", "Linux")),
    device=(("iPhone", "iPhone"),),
    browser=(("Firefox/", "Firefox"), ("Chrome/", "Chrome"), ("Safari/", "Safari")),
)
# A token for each pattern of the shipped rules.
OS_TOKENS = ("Windows Phone 10", "Windows NT 10.0", "iPad; CPU OS 15_0", "Android 12", "CrOS x86_64", "Mac OS X 10_15",
             "Ubuntu", "NetBSD amd64", "FreeBSD amd64", "OpenBSD amd64", "Linux x86_64", "Plan9")
DEVICE_TOKENS = ("Examplebot/2", "iPhone", "iPad", "iPod touch", "Macintosh", "HUAWEI P30", "Redmi 9", "SM-S908B", "x64")
BROWSER_TOKENS = ("MicroMessenger/8", "Edg/105", "OPR/90", "UCBrowser/13", "Firefox/105", "CriOS/105", "Chromium/105",
                  "Chrome/105", "MSIE 9", "Version/15 Safari/604", "curl/7", "Lynx")
FLAG_OF_TYPE = {"is_browse": "view", "is_order": "click", "is_buy": "purchase",
                "is_back_order": "error", "is_received": "signup"}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal(spark: SparkSession, columns: dict, types: dict) -> DataFrame:
    schema = pa.schema([(name, types[name]) for name in columns])
    return spark.createDataFrame(pa.table(columns, schema=schema))


def rule_rows() -> list[tuple]:
    """The rule tree as (id, pid, level, rule)."""
    rows = []
    for parent, rules in CATEGORY_RULES.items():
        index, fields = CATEGORY_SOURCES[parent]
        source = f"inType=derived##esNodes=##esIndex={index}##esType=_doc##selectFields={fields}"
        rows.append((parent, 1, 4, source))
        rows += [(tag, parent, 5, rule) for tag, rule in rules]
    return rows


def rule_tree(spark: SparkSession) -> RuleTree:
    ids, parents, levels, rules = zip(*rule_rows())
    frame = literal(
        spark, {"id": ids, "pid": parents, "level": levels, "rule": rules},
        {"id": pa.int32(), "pid": pa.int32(), "level": pa.int32(), "rule": pa.string()})
    return RuleTree(frame)


def area_ranges(spark: SparkSession) -> DataFrame:
    first, last, area = zip(*AREAS)
    text = {"first": pa.string(), "last": pa.string(), "area": pa.string()}
    return address_ranges(literal(spark, {"first": first, "last": last, "area": area}, text))


def derived_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule table that grows with `part`: eight level-5 rules below each parent."""
    part = load(spark, sf_dir, "part")
    key = F.col("p_partkey")
    low = (key % 97).cast("string")
    high = (key % 97 + 1 + key % 13).cast("string")
    rule = (F.when(key % 11 == 0, F.concat(F.lit("x"), low))
            .otherwise(F.concat(low, F.lit("-"), high)))
    return part.select(key.alias("id"), F.expr("p_partkey div 8").alias("pid"), rule.alias("rule"))


def derived_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of source rules that grows with `part`."""
    part = load(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    rule = F.concat(F.lit("inType=parquet##esNodes=node"), (F.col("p_partkey") % 5).cast("string"),
                    F.lit("##esIndex=table_"), key, F.lit("##esType=_doc##selectFields=id,f"), key)
    return part.select(F.col("p_partkey").alias("id"), rule.alias("rule"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1950-01-01").cast("date"), (key * 37 % 25000).cast("int"))
    return customer.select(
        key.alias("id"),
        (1 + key % 3).cast("string").alias("gender"),
        (1 + F.col("c_nationkey") % 7).alias("job"),
        (1 + key % 3).alias("marriage"),
        (1 + key * 7 % 4).alias("politicalface"),
        F.date_format(born, "yyyy-MM-dd").alias("birthday"),
    )


def _pay_code():
    code = F.col("o_orderpriority")
    return (F.when(code == "1-URGENT", "alipay").when(code == "2-HIGH", "wxpay")
            .when(code == "3-MEDIUM", "chinapay").when(code == "4-NOT SPECIFIED", "kjtpay")
            .otherwise("cod"))


def pay_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("ordersn"),
        F.col("o_custkey").alias("memberid"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("finishtime"),
        _pay_code().alias("paymentcode"),
        F.col("o_orderdate").alias("created_at"),
        (F.col("o_orderdate") + F.make_dt_interval(days=(F.col("o_orderkey") % 60).cast("int"))).alias("updated_at"),
    )


def order_changes(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """A change feed of the orders in two batches: those before SINCE, then what came, changed and went.

    Of the first orders, one in seven is deleted and one in seven is paid another way 40 days later.
    """
    orders = pay_orders(spark, sf_dir)
    known, fields = F.col("created_at") < F.lit(SINCE).cast("timestamp_ntz"), ["memberid", "finishtime", "paymentcode"]

    def change(where, kind: str, rows=orders):
        return rows.where(where).select(*fields, F.lit(kind).alias("change"))

    gone, changed = F.col("ordersn") % 7 == 0, F.col("ordersn") % 7 == 1
    later = orders.withColumn("finishtime", F.col("finishtime") + 40 * 86_400).withColumn("paymentcode", F.lit("other"))
    second = [change(~known, "insert"), change(known & gone, "delete"), change(known & changed, "update_preimage"),
              change(known & changed, "update_postimage", later)]
    return [change(known, "insert"), second[0].unionByName(second[1]).unionByName(second[2]).unionByName(second[3])]


def order_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each order came to, in whole units."""
    orders = load(spark, sf_dir, "orders")
    return orders.select(F.col("o_custkey").alias("memberid"), F.floor("o_totalprice").alias("amount"))


def stored_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored tags of all customers but those of one market segment."""
    customer = load(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'")
    kind = F.col("c_custkey") % 4
    tags = F.when(kind == 0, "8,67").when(kind == 1, "25,999").when(kind == 2, "999")
    return customer.select(F.col("c_custkey").alias("userId"), tags.alias("tagsId"))


def tag_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag sets of all customers, those of the left-out segment included."""
    customer = load(spark, sf_dir, "customer")
    kind = F.col("c_custkey") % 4
    tags = F.when(kind == 0, "8,67").when(kind == 1, "25,999").when(kind == 2, "999")
    return customer.select(F.col("c_custkey").alias("userId"), tags.alias("tagsId"))


def source_reader(spark: SparkSession, sf_dir: str):
    """Reader of the derived sources the rule tree names."""
    sources = {"users": users, "pay_orders": pay_orders, "order_amounts": order_amounts}

    def read(spec: SourceSpec) -> DataFrame:
        return sources[spec.index](spark, sf_dir).select(*spec.fields)

    return read


def access_lines(events: DataFrame) -> DataFrame:
    """One access line per event, some of them malformed; batch or stream."""
    user, event = F.col("user_id"), F.col("event_id")
    agents = F.array(*[F.lit(a) for a in AGENTS])
    line = F.concat(
        F.lit("10."), (user % 4).cast("string"), F.lit("."),
        F.expr("user_id div 256 % 256").cast("string"), F.lit("."), (user % 256).cast("string"),
        F.lit(" - - ["), F.date_format(F.col("ts").cast("timestamp"), "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0800] "'),
        F.when(F.col("event_type").isin("view", "click"), "GET").otherwise("POST"),
        F.lit(" /p/"), F.col("event_type"), F.lit("/"), (event % 50).cast("string"), F.lit(' HTTP/1.1" '),
        F.when(F.col("event_type") == "error", "500").otherwise("200"), F.lit(" "), event.cast("string"),
        F.lit(' "-" "'), F.get(agents, (event % len(AGENTS)).cast("int")), F.lit('" "-"'),
    )
    broken = F.concat(F.lit("malformed "), event.cast("string"))
    return events.select(F.when(event % 97 == 0, broken).otherwise(line).alias("value"))


def behaviour_records(events: DataFrame) -> DataFrame:
    """One JSON behaviour event per event row; batch or stream."""
    def flag(kind):
        return F.when(F.col("event_type") == kind, 1).otherwise(0)

    record = F.struct(
        F.col("user_id").cast("string").alias("user_id"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("visit_time"),
        F.col("event_id").alias("minimum_price"),
        F.struct(
            F.concat(F.lit("P"), (F.col("user_id") % 7).cast("string")).alias("province"),
            F.concat(F.lit("C"), (F.col("user_id") % 31).cast("string")).alias("city"),
        ).alias("area"),
        F.struct(*[flag(kind).alias(name) for name, kind in FLAG_OF_TYPE.items()]).alias("user_behavior"),
    )
    return events.select(F.to_json(record).alias("value"))


def full_records(events: DataFrame) -> DataFrame:
    """One JSON event per event row with every field filled, some of them cut short."""
    def numbered(prefix, column, modulus):
        return F.concat(F.lit(prefix), (F.col(column) % modulus).cast("string"))

    visited = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    flags = [F.when(F.col("event_type") == kind, 1).otherwise(0).alias(name) for name, kind in FLAG_OF_TYPE.items()]
    record = F.struct(
        numbered("07", "user_id", 1000).alias("phone_num"), numbered("till-", "event_id", 9).alias("system_id"),
        numbered("name ", "user_id", 501).alias("user_name"), F.col("user_id").cast("string").alias("user_id"),
        visited.alias("visit_time"), numbered("kind ", "event_id", 13).alias("goods_type"),
        F.col("event_id").alias("minimum_price"),
        F.struct(numbered("P", "user_id", 7).alias("province"), numbered("C", "user_id", 31).alias("city"),
                 numbered("S", "user_id", 4).alias("sp")).alias("area"),
        F.struct(*flags).alias("user_behavior"),
        F.struct(numbered("goods ", "event_id", 211).alias("goods_name"),
                 numbered("https://shop.test/p?x=1&y=", "event_id", 37).alias("browse_page"),
                 visited.alias("browse_time"), numbered("https://shop.test/q/", "user_id", 19).alias("to_page"),
                 visited.alias("to_time"), numbered("word ", "event_id", 5).alias("page_keywords")).alias("goods_detail"))
    text = F.to_json(record)
    return events.select(F.when(F.col("event_id") % 89 == 0, F.left(text, F.lit(25))).otherwise(text).alias("value"))


def agent_texts(events: DataFrame) -> DataFrame:
    """One user agent per event from all tokens."""
    def token(tokens, index):
        return F.get(F.array(*[F.lit(t) for t in tokens]), index.cast("int"))

    event = F.col("event_id")
    agent = F.concat(F.lit("Mozilla/5.0 ("), token(OS_TOKENS, event % len(OS_TOKENS)), F.lit("; "),
                     token(DEVICE_TOKENS, F.expr(f"event_id div 12 % {len(DEVICE_TOKENS)}")), F.lit(") "),
                     token(BROWSER_TOKENS, F.expr(f"event_id div 108 % {len(BROWSER_TOKENS)}")))
    return events.select("event_id", agent.alias("useragent"))


def part_rules(parts: DataFrame) -> DataFrame:
    """One device rule for each part, in an order unlike that of the keys, so that `Model-12` may come before `Model-123`.

    Every seventh asks for a bracket after the key, every eleventh has a second alternative.
    """
    key = F.col("p_partkey").cast("string")
    pattern = (F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("Model-"), key, F.lit("[;)]")))
               .when(F.col("p_partkey") % 11 == 0, F.concat(F.lit("Model-"), key, F.lit("|Type-"), key))
               .otherwise(F.concat(F.lit("Model-"), key)))
    return parts.select(F.lit("device").alias("field"), (F.col("p_partkey") * 7919 % 10007 * 1000000
                        + F.col("p_partkey")).alias("rank"), pattern.alias("pattern"),
                        F.concat("p_brand", F.lit(" "), key).alias("value"))


def model_texts(events: DataFrame) -> DataFrame:
    """One user agent per event, naming a model by the event's number."""
    number = (F.col("event_id") % 3001).cast("string")
    name = F.when(F.col("event_id") % 2 == 0, F.lit("Model-")).otherwise(F.lit("Type-"))
    return events.select("event_id", F.concat(F.lit("Mozilla/5.0 (Linux; Android 10; "), name, number,
                                              F.lit(") Mobile Safari/537.36")).alias("useragent"))


def event_files(spark: SparkSession, sf_dir: str, columns) -> str:
    """The events as a folder of several files, for streams of several batches."""
    path = scratch_path(spark, "events")
    events = load(spark, sf_dir, "events").select(*columns)
    events.repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
    return path


def parity_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given vectors, those of odd labels moved far away: two groups nobody can mistake."""
    moved = F.transform("embedding", lambda x: x.cast("double") + F.col("label") % 2 * 10)
    return load(spark, sf_dir, "embeddings").select("vec_id", moved.alias("embedding"))


def customer_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension that grows with `customer`: disjoint ranges of three addresses.

    Every block of four addresses with a customer in it is covered but for its last
    address, which is left to the fallback.
    """
    customer = load(spark, sf_dir, "customer")
    address = F.expr("167772160L + c_custkey % 4 * 65536 + c_custkey div 256 % 256 * 256 + c_custkey % 256")
    blocks = customer.groupBy((address - address % 4).alias("lo")).agg(F.min("c_custkey").alias("owner"))
    zone = F.concat(F.lit("zone-"), F.col("owner").cast("string"))
    return blocks.select("lo", (F.col("lo") + 2).alias("hi"), zone.alias("area"))


def mixed_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disjoint ranges of three widths from `customer`: 10.3/16 whole, 10.2 by /24, the rest by address."""
    customer = load(spark, sf_dir, "customer")
    address = F.expr("167772160L + c_custkey % 4 * 65536 + c_custkey div 256 % 256 * 256 + c_custkey % 256")
    length = (F.when(F.col("c_custkey") % 4 == 3, 65536).when(F.col("c_custkey") % 4 == 2, 256).otherwise(1)
              .cast("long"))
    starts = customer.select((address - address % length).alias("lo"), length.alias("n")).distinct()
    name = F.concat(F.lit("area-"), F.col("lo").cast("string"))
    return starts.select("lo", (F.col("lo") + F.col("n") - 1).alias("hi"), name.alias("area"))


def nested_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges inside each other from `customer`: all of 10/8, three of its /16, some /24 and some addresses."""
    customer = load(spark, sf_dir, "customer")
    address = F.expr("167772160L + c_custkey % 4 * 65536 + c_custkey div 256 % 256 * 256 + c_custkey % 256")
    key = F.col("c_custkey")
    width = (F.when(key % 5 == 0, 1).when(key % 5 == 1, 256).when((key % 5 == 2) & (key % 4 < 3), 65536)
             .otherwise(16777216).cast("long"))
    starts = customer.select((address - address % width).alias("lo"), width.alias("n")).distinct()
    name = F.concat(F.lit("area-"), F.col("n").cast("string"), F.lit("-"), F.col("lo").cast("string"))
    return starts.select("lo", (F.col("lo") + F.col("n") - 1).alias("hi"), name.alias("area"))
