"""Prefix trie of conversations, built as a burst trie over many tasks.

A conversation is its sequence of turns; a turn's id is a 128-bit hash of role and text. A prefix with more than
`container` conversations is a trie head: its conversations are dealt out by their next turn id, each to the container
under that id, or on to the head there if that has burst as well. So a container holds the suffixes of at most
`container` conversations, and a shard holds several containers. In its shard, a container is sorted and swept once,
with a stack of open nodes, into the nodes of its subtree; heads add up what is below them.

Heads: how many conversations pass through each prefix is counted by Spark, and `container` grows with the number of
turns so that at most HEADS of them burst; that bounds the one table that is broadcast. A first turn, or a whole
conversation, that a third of all share bursts down to where it ends; what ends at a head needs no container.

Nulls: a turn of null number comes first; null role or text is empty; rows without conv_id belong to no conversation.
Turns of one number follow by role, then text. Repeated rows are turns of their own. Empty table: no rows. Other columns
aren't read. One conversation's turn ids, 24 bytes a turn, fit a task's memory; its texts needn't.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.llm.batches import mix
from tagweave.llm.tables import written

CONTAINER = 1024
HEADS = 200_000
SHARD_TURNS = 200_000
END_BATCH = 10_000

ROOT = bytes(16)
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string")


def turns_kept(conv_id: Column) -> Column:
    """How many turns a rebuilt conversation takes from the first of its five."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 9).cast("int")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id and turns (id, bytes), in order, of every conversation with its first turns exchanged."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ids = [F.xxhash64(F.lit(seed), "role", "text") for seed in (1, 2)]
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    # The texts are used up here: sort and shuffle of what follows take 24 bytes a turn.
    rows = written(rows.select("conv_id", (F.row_number().over(order) - 1).alias("at"), ids[0].alias("a"), ids[1].alias("b"),
                               F.octet_length("text").cast("long").alias("bytes")), "turns")
    known = rows.select("conv_id").distinct()
    lent = rows.where("conv_id % 5 = 0 AND at < 8").withColumn("to", F.explode(F.expr("sequence(-4L, 4L)")))
    lent = (lent.withColumn("to", F.try_add("conv_id", "to")).where("to - to % 5 = conv_id")
            .where(F.col("at") < turns_kept(F.col("to"))).drop("conv_id").withColumnRenamed("to", "conv_id"))
    lent = lent.join(known, "conv_id", "left_semi").withColumn("own", F.lit(0))
    own = rows.where(F.col("at") >= turns_kept(F.col("conv_id"))).withColumn("own", F.lit(1))
    both = own.unionByName(lent).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("own", "at", "a", "b", "bytes"))).alias("turns"))
    return known.join(both, "conv_id", "left")


def prefixes(convs: DataFrame) -> DataFrame:
    """conv_id, turns (ids of 16 bytes), path (an id for each prefix, the root first) and bytes of each turn."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for turns in batch.column("turns"):
                own = turns.as_py() or []
                ids = np.array([(t["a"], t["b"]) for t in own], dtype=np.int64).reshape(-1, 2).view(np.uint64)
                place = mix(np.arange(1, 2 * len(own) + 1, dtype=np.uint64)).reshape(-1, 2)
                path = np.bitwise_xor.accumulate(mix(ids + place), axis=0) if len(own) else ids
                out.append(([x.tobytes() for x in ids], [ROOT, *(x.tobytes() for x in path)], [t["bytes"] for t in own]))
            ids, path, sizes = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(ids, type=pa.list_(pa.binary())), pa.array(path, type=pa.list_(pa.binary())),
                 pa.array(sizes, type=pa.list_(pa.int64()))], names=["conv_id", "turns", "path", "bytes"])

    return written(convs.mapInArrow(add, "conv_id long, turns array<binary>, path array<binary>, bytes array<long>"),
                   "trie-paths")


def sweep(rows: list[tuple[int, list[bytes], list[int]]], depth: int) -> tuple[list[tuple], int, int]:
    """Nodes of the conversations (conv_id, turn ids from `depth` on, their bytes) that share their first such turn.

    ([conv_id, depth, parent's, convs, children, leaves, saved, ends] of each, top last; leaves and saved of the top).
    """
    out, stack, before = [], [], []
    # An open node: smallest conversation, conversations, children, leaves, saved below, bytes, ends.

    def close() -> None:
        conv, n, children, leaves, saved, size, ends, below = stack.pop()
        leaves, saved = leaves or 1, saved + (n - 1) * size
        for node in below:
            node[2] = conv
        node = [conv, depth + len(stack) + 1, None, n, children, leaves, saved,
                hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest()]
        out.extend(below)
        if stack:
            top = stack[-1]
            top[0], top[2], top[3], top[4] = min(top[0], conv), top[2] + 1, top[3] + leaves, top[4] + saved
            top[7].append(node)
        else:
            out.append(node)

    for conv, turns, sizes in sorted(rows, key=lambda r: (r[1], r[0])):
        shared = 0
        while shared < min(len(before), len(turns)) and before[shared] == turns[shared]:
            shared += 1
        while len(stack) > shared:
            close()
        for size in sizes[shared:]:
            stack.append([conv, 0, 0, 0, 0, size, [], []])
        for node in stack:
            node[0], node[1] = min(node[0], conv), node[1] + 1
        stack[-1][6].append(conv)
        before = turns
    while stack:
        close()
    top = out[-1]
    return out, top[5], top[6]


def trie(convs: DataFrame, container: int = CONTAINER, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of `convs` (conv_id, turns as arrays of structs a, b, bytes)."""
    paths = prefixes(convs)
    steps = paths.select("conv_id", F.posexplode("path").alias("depth", "node"), "bytes").withColumn(
        "bytes", F.when(F.col("depth") > 0, F.element_at("bytes", F.greatest("depth", F.lit(1)))))
    total = paths.agg(F.sum(F.size("path"))).first()[0] or 0
    if not total:
        return paths.sparkSession.createDataFrame([], NODE)
    container = max(container, total // HEADS)
    heads = written(
        steps.groupBy("node").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
                                  F.max("bytes").alias("bytes")).where((F.col("n_convs") > container) | (F.col("depth") == 0)),
        "trie-heads")
    # At most HEADS rows of some 60 bytes, by the choice of `container` (and the root).
    burst = F.broadcast(heads.select("node", F.lit(True).alias("burst")))
    above = (steps.join(burst, "node").groupBy("conv_id").agg(F.count("*").cast("int").alias("heads")))
    placed = paths.join(above, "conv_id")
    ended = placed.where(F.size("path") == F.col("heads")).select("conv_id", F.element_at("path", -1).alias("node"))
    held = placed.where(F.size("path") > F.col("heads")).select(
        "conv_id", F.expr("path[heads]").alias("container"), F.expr("slice(path, 1, heads)").alias("above"), "heads",
        F.expr("slice(turns, heads, size(turns))").alias("turns"), F.expr("slice(bytes, heads, size(bytes))").alias("bytes"))
    shards = max(1, -(-total // shard_turns))
    held = held.withColumn("shard", F.pmod(F.xxhash64("container"), F.lit(shards)))

    def swept(shard: pd.DataFrame) -> pd.DataFrame:
        out = []
        for name, own in shard.groupby("container", sort=False):
            depth = int(own["heads"].iloc[0]) - 1
            rows = list(zip(own["conv_id"].tolist(), map(list, own["turns"]), map(list, own["bytes"]), strict=True))
            nodes, _, _ = sweep(rows, depth)
            out += [(*node, None) for node in nodes[:-1]]
            out.append((*nodes[-1], list(own["above"].iloc[0])))
        columns = [x.split()[0] for x in NODE.split(", ")]
        return pd.DataFrame(out, columns=[*columns, "above"]).astype({"parent_conv_id": "Int64"})

    nodes = written(held.groupBy("shard").applyInPandas(swept, f"{NODE}, above array<binary>"), "trie-nodes")
    return finished(heads, paths, nodes, ended)


def finished(heads: DataFrame, paths: DataFrame, nodes: DataFrame, ended: DataFrame) -> DataFrame:
    """All nodes: those of the containers with the parents of their tops, and the heads over what is below them."""
    names = F.broadcast(heads.select(F.col("node").alias("_node"), F.col("conv_id").alias("_conv")))
    tops = nodes.where("above IS NOT NULL").withColumn("_node", F.element_at("above", -1))
    whole = nodes.where("above IS NULL").drop("above").unionByName(
        tops.join(names, "_node").withColumn("parent_conv_id", F.col("_conv")).drop("_node", "_conv", "above"))
    # The path to each head: that of its smallest conversation.
    own = (F.broadcast(heads).join(paths.select("conv_id", "path"), "conv_id")
           .withColumn("above", F.expr("slice(path, 1, cast(depth AS int))")).drop("path"))
    own = written(own, "trie-head-paths")
    saved = F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("bytes")).otherwise(0)
    direct = (tops.select("_node").unionByName(own.where("depth > 0").select(F.element_at("above", -1).alias("_node")))
              .groupBy("_node").agg(F.count("*").alias("n_children")))
    direct = written(own.join(direct, own["node"] == direct["_node"], "left").drop("_node")
                     .withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-head-children")
    below = (tops.select(F.explode("above").alias("node"), "n_leaves", F.col("saved_tokens").alias("saved"))
             .unionByName(direct.select(F.explode(F.concat("above", F.array("node"))).alias("node"),
                                        (F.col("n_children") == 0).cast("long").alias("n_leaves"), saved.alias("saved")))
             .groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")))
    parents = names.withColumnRenamed("_conv", "parent_conv_id")
    top = (direct.join(below, "node").join(ends(ended), "node", "left")
           .withColumn("_node", F.when(F.col("depth") > 0, F.element_at("above", -1)))
           .join(parents, "_node", "left")
           .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256))))
    columns = [x.split()[0] for x in NODE.split(", ")]
    return whole.select(columns).unionByName(top.select(*(F.col(c).cast("long") if c != "ends_sha256" else F.col(c)
                                                          for c in columns)))


def ends(ended: DataFrame) -> DataFrame:
    """node, ends_sha256 of the conversations that end at heads.

    A head may end a third of all: its conversations are sorted over many tasks and joined to one string a task, and
    only these strings meet, in order, where they are hashed as they come in.
    """
    ordered = ended.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low in range(0, len(batch), END_BATCH):
                yield (batch.iloc[low:low + END_BATCH].groupby("node", sort=False)["conv_id"]
                       .agg(first="min", ids=lambda x: ",".join(map(str, x))).reset_index())

    packed = ordered.mapInPandas(pack, "node binary, first long, ids string")
    packed = packed.repartition("node").sortWithinPartitions("node", "first")

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for batch in batches:
            done = []
            for own, ids in zip(batch["node"], batch["ids"], strict=True):
                if own != node:
                    if state:
                        done.append((node, state.hexdigest()))
                    node, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(done, columns=["node", "ends_sha256"])
        if state:
            yield pd.DataFrame([(node, state.hexdigest())], columns=["node", "ends_sha256"])

    return packed.mapInPandas(hashed, "node binary, ends_sha256 string")


def query(conversations: DataFrame) -> DataFrame:
    return trie(rebuilt(conversations))


# DuckDB has no crc32: it is reduced bit by bit over the digits.
SQL = """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT conv_id, xor(4294967295, list_reduce(
        [4294967295] || flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [ascii(x), 0, 0, 0, 0, 0, 0, 0])),
        lambda c, e: xor(xor(c, e) >> 1, CASE WHEN xor(c, e) & 1 = 1 THEN 3988292384 ELSE 0 END))) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)),
steps AS (
    SELECT c.conv_id, 0 AS own, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND place < h
    UNION ALL SELECT conv_id, 1, place, role, text FROM convs JOIN turns USING (conv_id) WHERE place >= h),
numbered AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS d, md5(role || chr(31) || text) AS id,
           strlen(text) AS bytes FROM steps),
prefixes AS (
    SELECT conv_id, d, list(id) OVER (PARTITION BY conv_id ORDER BY d) AS path, bytes FROM numbered
    UNION ALL SELECT conv_id, 0, CAST([] AS VARCHAR[]), 0 FROM convs),
sized AS (SELECT *, max(d) OVER (PARTITION BY conv_id) AS len FROM prefixes),
nodes AS (
    SELECT path, d, min(conv_id) AS first, count(*) AS n, any_value(bytes) AS bytes,
           coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = len), '') AS ends
    FROM sized GROUP BY path, d),
children AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
whole AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
-- Each node is counted by its smallest conversation, for all nodes above it on that conversation's path.
below AS (
    SELECT conv_id, s.path, sum(CASE WHEN first = conv_id THEN (n - 1) * w.bytes ELSE 0 END) OVER up AS saved,
           sum(CASE WHEN first = conv_id AND n_children = 0 THEN 1 ELSE 0 END) OVER up AS leaves
    FROM sized s JOIN whole w ON w.path = s.path
    WINDOW up AS (PARTITION BY conv_id ORDER BY s.d DESC)),
sums AS (SELECT path, sum(saved) AS saved, sum(leaves) AS leaves FROM below GROUP BY path)
SELECT w.first AS conv_id, CAST(w.d AS BIGINT) AS depth, p.first AS parent_conv_id, w.n AS n_convs,
       CAST(w.n_children AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(w.ends) AS ends_sha256
FROM whole w JOIN sums ON sums.path = w.path LEFT JOIN nodes p ON w.d > 0 AND p.path = w.path[1:w.d - 1]
"""
