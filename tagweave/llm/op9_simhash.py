"""SimHash near-duplicates: candidates from shared bits, discarded by a pivot distance table, then verified.

Each fingerprint gets its Hamming distances to a set of reference fingerprints. Two fingerprints within the radius
differ by at most the radius in every one of these distances, so a larger difference in any discards the pair; what
survives is compared in full. Pairs are looked for only among fingerprints that agree on some chosen bits.

Exact tables cut the bits into n blocks: within radius r at least n - r blocks agree, and there is a table for every
choice of so many. n grows with the number of fingerprints, so that a bucket holds a few whatever the input; every n
finds the same links.

Copies share a fingerprint and are linked once, not pair by pair. A task turns the links it finds into a forest, so
links never outnumber the rows read; buckets beyond CELL rows are cut into chunks and every two chunks meet in a task
of their own.

`deduplicated` links by the exact Jaccard similarity of shingle sets. A fingerprint only estimates it, too roughly to
tell 0.75 from 0.8, so candidates come from bands of minimal hashes there, fingerprints and their pivot distances discard
those that are far apart, and every link is told by the sets themselves.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.batches import mix
from tagweave.llm.tables import put_back, set_aside, written

SEED = 42
PIVOTS = 16
CELL = 4096
GROUP_ROWS = 60_000
BLOCK = 1 << 14
BAND = 7
MISS = 1e-5
CELL_BYTES = 4 << 20
GROUP_BYTES = 12 << 20
SET_BITS, SET_PIVOTS = 256, 8
SET_RADIUS = 70
LEAST_SET = 64


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of each run of `size` words; of all words if there are fewer; none without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined, lengths = b" ".join(words), np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = starts + lengths
    k = min(size, len(words))
    hashed = xxhash.xxh64_intdigest
    return np.fromiter((hashed(joined[a:b], SEED) for a, b in zip(starts[:len(words) - k + 1].tolist(),
                                                                  ends[k - 1:].tolist(), strict=True)),
                       dtype=np.uint64, count=len(words) - k + 1)


def fingerprint(hashes: np.ndarray, bits: int = 64) -> np.ndarray:
    """Each bit is 1 if it is set in over half the hashes. Beyond 64 bits, hashes are mixed anew for every 64."""
    out = np.zeros(bits // 64, dtype=np.uint64)
    if not len(hashes):
        return out
    for i in range(bits // 64):
        with np.errstate(over="ignore"):
            own = hashes if i == 0 else mix(hashes + np.uint64(i) * np.uint64(0x9E3779B97F4A7C15))
        counts = np.zeros(64, dtype=np.int64)
        for low in range(0, len(own), BLOCK):
            part = own[low:low + BLOCK]
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
                axis=0, dtype=np.int32)
        out[i:i + 1] = np.packbits(2 * counts > len(own), bitorder="little").view(np.uint64)
    return out


def fingerprints(docs: DataFrame, size: int, bits: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, node (64 bits that stand for the fingerprint), fp (its bytes) and row (unique), as a written table."""
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"), *keep)
    fields = [f for f in rows.schema if f.name not in ("_id", "_text")]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(x.as_py(), size), bits) for x in batch.column("_text")]
            all_ = np.array(found, dtype=np.uint64).reshape(batch.num_rows, bits // 64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(nodes(all_)), pa.array([x.tobytes() for x in all_], type=pa.binary()),
                 *(batch.column(f.name) for f in fields)], names=["_id", "node", "fp", *(f.name for f in fields)])

    kinds = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in fields)
    made = rows.mapInArrow(add, f"_id long, node long, fp binary{kinds}")
    return written(made.withColumn("_row", F.monotonically_increasing_id()), "simhash")


def nodes(fps: np.ndarray) -> np.ndarray:
    """The fingerprint itself if it has 64 bits, else a hash of it."""
    if fps.shape[1] == 1:
        return fps[:, 0].view(np.int64)
    out = np.zeros(len(fps), dtype=np.uint64)
    for i in range(fps.shape[1]):
        out = mix(out * np.uint64(3) + fps[:, i])
    return out.view(np.int64)


def exact_tables(bits: int, radius: int, rows: int) -> np.ndarray:
    """Masks (tables x words) such that any two fingerprints within the radius agree on all bits of some mask."""
    blocks = next((n for n in range(radius + 1, 2 * radius + 2) if 2 ** (bits * (n - radius) // n) >= 2 * rows),
                  2 * radius + 2)
    edges = np.linspace(0, bits, blocks + 1).astype(int)
    return masks([[i for b in chosen for i in range(edges[b], edges[b + 1])]
                  for chosen in combinations(range(blocks), blocks - radius)], bits)


def masks(chosen: list[list[int]], bits: int) -> np.ndarray:
    out = np.zeros((len(chosen), bits), dtype=np.uint8)
    for i, own in enumerate(chosen):
        out[i, own] = 1
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64)


def merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each row's points at the smallest of its group) after linking a with b."""
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        if not apart.any():
            return label
        a, b = a[apart], b[apart]
        np.minimum.at(label, high[apart], low[apart])
        while not np.array_equal(jumped := label[label], label):
            label = jumped


def linked(cell: np.ndarray, chunk: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest over the rows: links within cells at the radius or less. `chunk`: rows of one chunk meet elsewhere
    unless it is -1."""
    pivots = mix(np.arange(1, PIVOTS * fps.shape[1] + 1, dtype=np.uint64)).reshape(PIVOTS, -1)
    near = np.stack([np.bitwise_count(fps ^ p).sum(axis=1, dtype=np.int16) for p in pivots], axis=1)
    order = np.lexsort((near[:, 0], cell))
    cell, chunk, fps, near = cell[order], chunk[order], fps[order], near[order]
    label = np.arange(len(cell))
    a, away = np.arange(len(cell)), 0
    while len(a):
        away += 1
        a = a[a + away < len(cell)]
        b = a + away
        a = a[(cell[a] == cell[b]) & (near[b, 0] - near[a, 0] <= radius)]
        first, second = a, a + away
        open_ = (label[first] != label[second]) & ((chunk[first] < 0) | (chunk[first] != chunk[second]))
        first, second = first[open_], second[open_]
        for k in range(1, PIVOTS):
            ok = np.abs(near[first, k] - near[second, k]) <= radius
            first, second = first[ok], second[ok]
        ok = np.bitwise_count(fps[first] ^ fps[second]).sum(axis=1) <= radius
        if ok.any():
            label = merged(label, first[ok], second[ok])
    child = np.flatnonzero(label != np.arange(len(label)))
    return order[child], order[label[child]]


def links(distinct: DataFrame, bits: int, radius: int, tables: np.ndarray) -> DataFrame:
    """node_a, node_b: links that join all fingerprints of a written table (node, fp) that are within the radius."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.frombuffer(b"".join(batch.column("fp").to_pylist()), dtype=np.uint64).reshape(-1, bits // 64)
            for i, mask in enumerate(tables):
                own = np.full(len(fps), i + 1, dtype=np.uint64)
                for k in range(fps.shape[1]):
                    own = mix(own * np.uint64(3) + (fps[:, k] & mask[k]))
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), batch.column("node")],
                                                 names=["key", "node"])

    rows = written(distinct.select("node", "fp").mapInArrow(keyed, "key long, node long"), "simhash-keys")
    crowded = rows.groupBy("key").count().where(F.col("count") > 1)
    crowded = written(crowded.withColumn("chunks", F.ceil(F.col("count") / CELL).cast("int")).drop("count"),
                      "simhash-buckets")
    # Most keys are met once; only the others need the fingerprints.
    both = rows.join(crowded, "key").join(distinct.select("node", "fp"), "node")
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    both = (both.withColumn("chunk", own).withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
            .select("node", "fp", F.when(F.col("chunks") > 1, F.col("chunk")).otherwise(-1).alias("chunk"),
                    (F.col("other") == F.col("chunk")).alias("inner"),
                    F.xxhash64("key", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("cell")))
    groups = max(1, -(-rows.count() // GROUP_ROWS))
    both = both.withColumn("group", F.pmod("cell", F.lit(groups)))

    def find(group: pd.DataFrame) -> pd.DataFrame:
        fps = np.frombuffer(b"".join(group["fp"]), dtype=np.uint64).reshape(-1, bits // 64)
        cells = group["cell"].to_numpy()
        # Where a chunk meets itself, all its rows are compared; where it meets another, only rows of different chunks.
        chunk = np.where(group["inner"].to_numpy(), -1, group["chunk"].to_numpy())
        mixed = pd.Series(chunk >= 0).groupby(cells).transform("any").to_numpy()
        chunk = np.where(mixed, group["chunk"].to_numpy(), -1)
        a, b = linked(cells, chunk, fps, radius)
        ids = group["node"].to_numpy()
        return pd.DataFrame({"node_a": ids[a], "node_b": ids[b]})

    return both.groupBy("group").applyInPandas(find, "node_a long, node_b long")


def stars(edges: DataFrame) -> DataFrame:
    """node, root of every linked node but the roots: alternating large and small stars until nothing changes."""
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = written(edges.select(F.greatest("node_a", "node_b").alias("a"), F.least("node_a", "node_b").alias("b"))
                    .where("a <> b").distinct(), "stars")
    now = state(edges)
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "stars-least")
        large = written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .distinct(), "stars-large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "stars-least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b")
        edges = written(small.distinct(), "stars")
        before, now = now, state(edges)
        if before == now:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, size: int = 4, bits: int = 64, radius: int = 4,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """_id, node, component_id (smallest doc_id of all that are linked, null only if none has one), first (whether the
    row is the one that stands for its component) and the columns of `keep`.

    Null and empty text, and text without words: fingerprint zero, linked like any other. Repeated rows are copies;
    exactly one row of a component is first. Empty table: no rows. Other columns are not read.
    """
    rows = fingerprints(docs, size, bits, keep)
    name = F.struct(F.col("_id").isNull().alias("missing"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    distinct = written(rows.groupBy("node").agg(F.first("fp").alias("fp"), F.min(name).alias("least")), "simhash-once")
    n = distinct.count()
    joined = stars(links(distinct, bits, radius, exact_tables(bits, radius, n)))
    members = distinct.select("node", "least").join(joined, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), "least")
    roots = written(members.groupBy("root").agg(F.min("least").alias("first")), "simhash-roots")
    named = written(members.drop("least").join(roots, "root").select("node", "first"), "simhash-named")
    return rows.join(named, "node").select(
        "_id", "node", F.col("first")["id"].alias("component_id"), (F.col("_row") == F.col("first")["row"]).alias("first"),
        *keep)


def query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")


def bands(similarity: float) -> int:
    """Bands of BAND minimal hashes each, so that two sets at the similarity share none with probability MISS at most."""
    return int(np.ceil(np.log(MISS) / np.log1p(-similarity ** BAND)))


def band_keys(hashes: np.ndarray, count: int) -> np.ndarray:
    """A key for each band; two sets share one with probability Jaccard ** BAND. The empty set: all of one key."""
    factor = mix(np.arange(1, count * BAND + 1, dtype=np.uint64)) | np.uint64(1)
    shift = mix(factor)
    least = np.full(count * BAND, np.iinfo(np.uint64).max, dtype=np.uint64)
    rows = max(1, BLOCK * 8 // len(factor))
    for low in range(0, len(hashes), rows):
        np.minimum(least, (hashes[low:low + rows, None] * factor + shift).min(axis=0), out=least)
    key = np.arange(1, count + 1, dtype=np.uint64)
    for k in range(BAND):
        key = mix(key * np.uint64(3) + least[k::BAND])
    return key


def shingle_set(text: str | None, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, size))


def set_node(hashes: np.ndarray) -> int:
    """64 bits that stand for a set."""
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED) - (1 << 63)


def shingled(docs: DataFrame, size: int, count: int, keep: tuple[str, ...]) -> DataFrame:
    """_id, node (of the shingle set), n (bytes of text), keys, size (of the set), fp (words of its fingerprint), near (the
    fingerprint's distances to the pivots), _row (unique) and the columns of `keep`, written."""
    pivots = mix(np.arange(1, SET_PIVOTS * SET_BITS // 64 + 1, dtype=np.uint64)).reshape(SET_PIVOTS, -1)
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"), *keep)
    fields = [f for f in rows.schema if f.name not in ("_id", "_text")]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            nodes_, keys, sizes, fps = [], [], [], np.zeros((len(texts), SET_BITS // 64), dtype=np.uint64)
            for i, text in enumerate(texts):
                own = shingle_set(text, size)
                nodes_.append(set_node(own))
                keys.append(band_keys(own, count).view(np.int64))
                sizes.append(len(own))
                # Small sets are never discarded by their fingerprints.
                if len(own) >= LEAST_SET:
                    fps[i] = fingerprint(own, SET_BITS)
            near = [np.bitwise_count(fps ^ p).sum(axis=1, dtype=np.int32) for p in pivots]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(nodes_, type=pa.int64()),
                 pa.array([len(x or "") for x in texts], type=pa.int64()), pa.array(keys, type=pa.list_(pa.int64())),
                 pa.array(sizes, type=pa.int64()), pa.array(list(fps.view(np.int64)), type=pa.list_(pa.int64())),
                 pa.array(list(np.stack(near, axis=1)), type=pa.list_(pa.int32())),
                 *(batch.column(f.name) for f in fields)],
                names=["_id", "node", "n", "keys", "size", "fp", "near", *(f.name for f in fields)])

    kinds = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in fields)
    made = rows.mapInArrow(add, "_id long, node long, n long, keys array<long>, size long, fp array<long>, "
                                f"near array<int>{kinds}")
    return written(made.withColumn("_row", F.monotonically_increasing_id()), "shingles")


def alike(cell: np.ndarray, chunk: np.ndarray, label: np.ndarray, sets: list[np.ndarray], similarity: float
          ) -> list[tuple[int, int]]:
    """A forest over the rows: pairs within cells at the Jaccard similarity or more, of rows not of one label yet.

    `chunk`: rows of one chunk meet elsewhere unless it is -1.
    """
    out = []
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    order = np.lexsort((sizes, cell))
    edges = np.flatnonzero(np.concatenate([[True], cell[order][1:] != cell[order][:-1], [True]]))
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
        own = order[low:high]
        tag, part, size = label[own].copy(), chunk[own], sizes[own]
        ends = np.cumsum(size)
        flat = np.concatenate([sets[i] for i in own])
        for i in range(len(own) - 1):
            last = int(np.searchsorted(size, size[i] / similarity + 1e-9, side="right"))
            j = np.arange(i + 1, last)
            j = j[(tag[j] != tag[i]) & ((part[j] < 0) | (part[j] != part[i]))]
            if not len(j) or not size[i]:
                continue
            if len(j) * 2 > last - i:
                # Most of the run takes part: one look-up over all of it.
                at, base = flat[ends[i]:ends[last - 1]], ends[i]
            else:
                at, base = np.concatenate([flat[ends[x] - size[x]:ends[x]] for x in j]), None
            mine = sets[own[i]]
            hit = mine[np.minimum(np.searchsorted(mine, at), len(mine) - 1)] == at
            total = np.concatenate([[0], np.cumsum(hit)])
            if base is None:
                stop = np.cumsum(size[j])
                both = total[stop] - total[stop - size[j]]
            else:
                both = total[ends[j] - base] - total[ends[j] - size[j] - base]
            for x in j[both >= similarity * (size[i] + size[j] - both) - 1e-9].tolist():
                if tag[x] != tag[i]:
                    out.append((int(own[i]), int(own[x])))
                    tag[tag == tag[x]] = tag[i]
    return out


def not_far(pairs: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """The pairs (rep, node) whose sets may be at the similarity.

    Sizes tell some. For sets of LEAST_SET shingles or more so do the fingerprints: first any pivot distance that differs
    by more than the radius, then the distance itself. At 0.8 it is 39 of 256 bits on average with a spread of 6, so
    SET_RADIUS is five spreads away.
    """
    both = (pairs.join(sketches.select(*(F.col(c).alias(f"{c}_a") for c in sketches.columns)).withColumnRenamed("node_a", "rep"),
                       "rep").join(sketches, "node"))
    apart = F.aggregate(F.zip_with("near", "near_a", lambda x, y: F.abs(x - y)), F.lit(0), lambda x, y: F.greatest(x, y))
    distance = F.aggregate(F.zip_with("fp", "fp_a", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    small, large = F.least("size", "size_a"), F.greatest("size", "size_a")
    return both.where((small >= similarity * large - 1e-9) & (small > 0) & (
        (small < LEAST_SET) | ((apart <= SET_RADIUS) & (distance <= SET_RADIUS)))).select("rep", "node", "n")


def similar(one: np.ndarray, other: np.ndarray, similarity: float) -> bool:
    both = len(np.intersect1d(one, other, assume_unique=True))
    return both >= similarity * (len(one) + len(other) - both) - 1e-9


def star_links(pairs: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """node_a, node_b: the pairs (rep, node, n bytes) at the similarity or more.

    The nodes of one rep are dealt out over as many cells as their bytes ask for; each has the rep's text.
    """
    held = pairs.groupBy("rep").agg(F.ceil((F.sum("n") + 1) / CELL_BYTES).cast("int").alias("cells"))
    placed = pairs.join(held, "rep").select("rep", F.pmod(F.xxhash64("node"), F.col("cells")).cast("int").alias("cell"), "node")
    placed = written(placed.unionByName(placed.select("rep", "cell", F.col("rep").alias("node")).distinct()), "star-cells")
    groups = max(1, -(-(placed.join(texts, "node").agg(F.sum(F.octet_length("text"))).first()[0] or 0) // GROUP_BYTES))
    both = placed.withColumn("group", F.pmod(F.xxhash64("rep", "cell"), F.lit(groups))).join(texts, "node")

    def find(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (rep, _), own in group.groupby(["rep", "cell"]):
            mine = shingle_set(own["text"][own["node"] == rep].iat[0], size)
            out += [(rep, n) for n, t in zip(own["node"], own["text"], strict=True)
                    if n != rep and similar(mine, shingle_set(t, size), similarity)]
        return pd.DataFrame(out, columns=["node_a", "node_b"], dtype="int64")

    return both.groupBy("group").applyInPandas(find, "node_a long, node_b long")


def jaccard_links(keys: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """node_a, node_b: links that join all sets that share a key and are at the similarity or more.

    `keys`: key, node, label (rows of one label are joined already) and n (bytes of text), a written table; keys met by
    one label alone are passed over. `texts`: node and text. Where a key's rows exceed a cell, those of its largest label
    and all others are cut into chunks of their own, and no two chunks of the largest label meet.
    """
    labels = keys.groupBy("key", "label").agg(F.sum("n").alias("bytes"))
    crowded = labels.groupBy("key").agg(F.max_by("label", "bytes").alias("main"), F.max("bytes").alias("most"),
                                        F.sum("bytes").alias("all"), F.count("*").alias("labels")).where("labels > 1")
    cells = [F.ceil((F.col(c) + 1) / CELL_BYTES).cast("int") for c in ("most", "rest")]
    crowded = written(crowded.withColumn("rest", F.col("all") - F.col("most")).select(
        "key", "main", F.when(F.col("all") < CELL_BYTES, 0).otherwise(cells[0]).alias("mains"), cells[1].alias("others")),
        "jaccard-buckets")
    hashed, main = F.xxhash64("node"), F.col("label") == F.col("main")
    own = (F.when(F.col("mains") == 0, 0).when(main, F.pmod(hashed, F.col("mains")))
           .otherwise(F.col("mains") + F.pmod(hashed, F.col("others"))).cast("int"))
    meets = F.expr("""CASE WHEN mains = 0 THEN array(0) WHEN label = main THEN sequence(mains, mains + others - 1)
                      ELSE sequence(0, mains + others - 1) END""")
    met = (keys.join(crowded, "key").withColumn("chunk", own).withColumn("other", F.explode(meets))
           .select("node", "label", "n", F.when(F.col("mains") > 0, F.col("chunk")).otherwise(-1).alias("chunk"),
                   (F.col("other") == F.col("chunk")).alias("inner"),
                   F.xxhash64("key", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("cell")))
    met = written(met, "jaccard-cells")
    groups = max(1, -(-(met.agg(F.sum("n")).first()[0] or 0) // GROUP_BYTES))
    both = met.withColumn("group", F.pmod("cell", F.lit(groups))).drop("n").join(texts, "node")

    def find(group: pd.DataFrame) -> pd.DataFrame:
        nodes_, first = np.unique(group["node"].to_numpy(), return_index=True)
        known = {n: shingle_set(group["text"].iat[i], size) for n, i in zip(nodes_.tolist(), first.tolist())}
        ids, cells_ = group["node"].to_numpy(), group["cell"].to_numpy()
        # A chunk that meets itself is compared whole; where two chunks meet, only rows of different ones.
        mixed = pd.Series(~group["inner"].to_numpy()).groupby(cells_).transform("any").to_numpy()
        chunk = np.where(mixed, group["chunk"].to_numpy(), -1)
        found = alike(cells_, chunk, group["label"].to_numpy(), [known[n] for n in ids.tolist()], similarity)
        a, b = np.array(found, dtype=np.int64).reshape(-1, 2).T
        return pd.DataFrame({"node_a": ids[a], "node_b": ids[b]})

    return both.groupBy("group").applyInPandas(find, "node_a long, node_b long")


def deduplicated(docs: DataFrame, similarity: float = 0.8, size: int = 5) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest doc_id.

    Documents are linked if the exact Jaccard similarity of their sets of `size`-word shingles is `similarity` or more.
    A pair is a candidate if it shares a band of minimal hashes; one at the very similarity shares none with a chance
    of MISS at most, closer ones far more rarely. Equal sets are one node. Texts are compared in two rounds: first each
    with the smallest node it shares a band with, if their fingerprints are not far apart; then only where a band is
    still shared by rows that are not joined.

    Null and empty texts, and texts without words: one empty set, of which one row stays. Repeated rows are copies of
    each other; exactly one row of a group stays. Null doc_id: after all others. An empty table: no rows. All columns
    stay as they are, whatever their names.
    """
    rows, names = set_aside(docs, "doc_id", "text")
    text = f"in_{docs.columns.index('text')}"
    rows = shingled(rows, size, bands(similarity), names)
    name = F.struct(F.col("_id").isNull().alias("missing"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    distinct = written(rows.groupBy("node").agg(F.min(name).alias("least")), "shingles-once")
    first = distinct.select(F.col("least")["row"].alias("_row"))
    keys = rows.select("_row", "node", "n", "keys").join(first, "_row", "left_semi")
    keys = written(keys.select("node", "n", F.explode("keys").alias("key")), "shingles-keys")
    # Most keys are met once; only the others need the texts.
    shared = keys.groupBy("key").agg(F.count("*").alias("rows"), F.min("node").alias("rep")).where("rows > 1").drop("rows")
    keys = written(keys.join(shared, "key"), "shingles-shared")
    wanted = keys.select("node").distinct().join(distinct, "node").select(F.col("least")["row"].alias("_row"))
    wanted = rows.join(wanted, "_row", "left_semi")
    texts = written(wanted.select("node", F.col(text).cast("string").alias("text")), "shingles-texts")
    sketches = written(wanted.select("node", "size", "fp", "near"), "shingles-sketches")
    pairs = written(not_far(keys.where("node <> rep").select("rep", "node", "n").distinct(), sketches, similarity),
                    "shingles-pairs")
    edges = written(star_links(pairs, texts, size, similarity), "shingles-links")
    late = keys.join(stars(edges), "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("label"))
    more = jaccard_links(written(late, "shingles-late"), texts, size, similarity)
    members = distinct.join(stars(edges.union(more)), "node", "left").select(
        F.coalesce("root", "node").alias("root"), "least")
    kept = members.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least")["row"].alias("_row"))
    return put_back(rows.join(kept, "_row", "left_semi"), docs)
