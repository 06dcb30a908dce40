"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class). A word's class comes from its spelling (its last two letters,
hashed), so words never seen have one too. The class is predicted by a softmax over hashed features of the history: the
word before, the one before that (a skip), both together, and the last three classes. Within its class a word counts
with one added, like in the base score; what is left is for unseen words.

Training: every partition takes gradient steps over its own documents in small batches, and the weights of each bucket
are averaged over the partitions that used it, weighed by how often they did. The weights have a fixed size.

Token counts are exact and over all training documents. Words are told apart by a 64-bit hash. The HEAD most frequent
are looked up in the task; the others of each document go through a join with the counts, one row per document and
word, so no table of words is ever held whole.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.batches import ALNUM, LOWER, NOT_WHITE, Words, chunks, mix
from tagweave.llm.tables import remainder, written

CLASSES = 32
# At most 2 ** 16: they are sorted as 16-bit numbers.
BUCKETS = 1 << 15
HEAD = 1_000_000
BATCH = 8192
FEW = 4
RATE = 0.25
HELD_OUT = (7, 2)
END = int(mix(np.array([0x5EED], dtype=np.uint64))[0])
KEPT_COUNTS = 1 << 20


class Tokens:
    """Tokens of a run of texts: words, then one end for each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        low = LOWER[data]
        words = Words(low, offsets, NOT_WHITE)
        ends_at = words.first[1:] + np.arange(len(offsets) - 1)
        is_word = np.ones(len(words) + len(offsets) - 1, dtype=bool)
        is_word[ends_at] = False
        self.hash = np.full(len(is_word), END, dtype=np.uint64)
        self.hash[is_word] = words.hashes()
        self.kind = np.zeros(len(is_word), dtype=np.int32)
        if len(words):
            last = words.ends - 1
            last = np.where(~ALNUM[low[last]] & (last > words.starts), last - 1, last)
            before = np.where(last > words.starts, low[np.maximum(last - 1, 0)], 0)
            code = before.astype(np.uint64) * np.uint64(256) + low[last]
            self.kind[is_word] = 1 + (mix(code) % np.uint64(CLASSES - 1)).astype(np.int32)
        self.counts = words.counts + 1
        self.firsts = np.concatenate([[0], np.cumsum(self.counts)[:-1]])
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)

    def features(self) -> np.ndarray:
        """Buckets (tokens x 4) of the history of each token; histories begin anew with each text."""
        n = len(self.hash)
        at = np.arange(n) - self.firsts[self.doc]
        none = np.uint64(1)
        one, two = np.full(n, none), np.full(n, none)
        one[1:], two[2:] = self.hash[:-1], self.hash[:-2]
        one[at < 1], two[at < 2] = none, none
        kinds = np.zeros(n, dtype=np.uint64)
        for back in (1, 2, 3):
            own = np.zeros(n, dtype=np.uint64)
            own[back:] = self.kind[:-back] + 1 if n > back else 0
            own[at < back] = 0
            kinds = kinds * np.uint64(CLASSES + 1) + own
        salt = [np.uint64(x * 0x9E3779B97F4A7C15 & (1 << 64) - 1) for x in (1, 2, 3, 4)]
        with np.errstate(over="ignore"):
            codes = [one ^ salt[0], two ^ salt[1], (one * np.uint64(3)) ^ mix(two ^ salt[2]), kinds + salt[3]]
        return np.stack([(mix(c) & np.uint64(BUCKETS - 1)).astype(np.int32) for c in codes], axis=1)


def shares(weights: np.ndarray, bias: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Probability of each class (tokens x CLASSES)."""
    z = weights[features[:, 0]]
    for k in range(1, features.shape[1]):
        z += weights[features[:, k]]
    z += bias
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def sums_by_bucket(buckets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets that occur, in order, the sum of the rows of each, and how many they are.

    Most buckets occur a few times in a batch: their first FEW rows are added place by place for all buckets at once,
    only the rest run by run. Sorting 16-bit numbers takes time in proportion to their number.
    """
    order = np.argsort(buckets.astype(np.uint16), kind="stable")
    ordered = buckets[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    times = np.diff(np.append(starts, len(order)))
    total = rows[order[starts]]
    for place in range(1, FEW):
        on = np.flatnonzero(times > place)
        total[on] += rows[order[starts[on] + place]]
    long = np.flatnonzero(times > FEW)
    if len(long):
        left = times[long] - FEW
        firsts = np.cumsum(left) - left
        at = np.repeat(starts[long] + FEW - firsts, left) + np.arange(left.sum())
        total[long] += np.add.reduceat(rows[order[at]], firsts, axis=0)
    return ordered[starts], total, times


class Trainer:
    """Gradient steps with a rate of its own for each bucket, smaller the more it has moved."""

    def __init__(self):
        self.weights = np.zeros((BUCKETS, CLASSES), dtype=np.float32)
        self.moved = np.full(BUCKETS, 1e-3, dtype=np.float32)
        self.used = np.zeros(BUCKETS, dtype=np.int64)
        self.bias, self.bias_moved, self.seen = np.zeros(CLASSES, dtype=np.float32), np.float32(1e-3), 0

    def step(self, features: np.ndarray, kinds: np.ndarray) -> None:
        slope = shares(self.weights, self.bias, features)
        slope[np.arange(len(kinds)), kinds] -= 1
        self.seen += len(kinds)
        total = slope.sum(axis=0)
        self.bias_moved += np.square(total).mean()
        self.bias -= RATE * total / np.sqrt(self.bias_moved)
        for k in range(features.shape[1]):
            own, total, times = sums_by_bucket(features[:, k], slope)
            self.moved[own] += np.einsum("ij,ij->i", total, total) / CLASSES
            total *= (RATE / np.sqrt(self.moved[own]))[:, None]
            self.weights[own] -= total
            self.used[own] += times


def training(docs: DataFrame) -> DataFrame:
    of, held = HELD_OUT
    return docs.where(remainder("doc_id", of) != held).select("text")


def token_counts(docs: DataFrame) -> DataFrame:
    """h, kind and n of each token, as a written table."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0

        def summed() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            h, at, which = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
            n = np.bincount(which, weights=np.concatenate([p[2] for p in parts]), minlength=len(h)).astype(np.int64)
            return h, np.concatenate([p[1] for p in parts])[at], n

        def batch_of(part) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), pa.array(part[1].astype(np.int32)),
                                               pa.array(part[2])], names=["h", "kind", "n"])

        for batch in batches:
            for _, _, data, offsets in chunks(batch):
                tokens = Tokens(data, offsets)
                h, at, n = np.unique(tokens.hash, return_index=True, return_counts=True)
                parts.append((h, tokens.kind[at], n))
                held += len(h)
                if held > 2 * KEPT_COUNTS:
                    parts = [summed()]
                    held = len(parts[0][0])
                    if held > KEPT_COUNTS:
                        yield batch_of(parts.pop())
                        held = 0
        if parts:
            yield batch_of(summed())

    found = docs.mapInArrow(count, "h long, kind int, n long")
    return written(found.groupBy("h").agg(F.min("kind").alias("kind"), F.sum("n").alias("n")), "lm-counts")


def trained(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Weights (BUCKETS x CLASSES) and bias."""
    names = [f"w{i}" for i in range(CLASSES)]

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Trainer()
        for batch in batches:
            for _, _, data, offsets in chunks(batch):
                tokens = Tokens(data, offsets)
                features = tokens.features()
                # In an order unlike that of the texts, so that a batch is no single text.
                order = np.random.default_rng(len(features)).permutation(len(features))
                features, kinds = features[order], tokens.kind[order]
                for low in range(0, len(kinds), BATCH):
                    own.step(features[low:low + BATCH], kinds[low:low + BATCH])
        if own.seen:
            used = np.flatnonzero(own.used)
            table = np.concatenate([own.weights[used], own.bias[None]]) * np.append(own.used[used], own.seen)[:, None]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(used, BUCKETS)), pa.array(np.append(own.used[used], own.seen)),
                 *(pa.array(table[:, i].astype(np.float32)) for i in range(CLASSES))], names=["bucket", "used", *names])

    rows = docs.mapInArrow(fit, "bucket long, used long, " + ", ".join(f"{n} float" for n in names))
    mean = rows.groupBy("bucket").agg(*((F.sum(n) / F.sum("used")).cast("float").alias(n) for n in names))
    table = np.zeros((BUCKETS + 1, CLASSES), dtype=np.float32)
    found = mean.toArrow()
    if found.num_rows:
        table[found["bucket"].to_numpy()] = np.stack([found[n].to_numpy() for n in names], axis=1)
    return table[:-1], table[-1]


def head(counts: DataFrame, most: int = HEAD) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes, in order, and counts of the most frequent tokens, `most` at most; all other counts are below the third."""
    sizes = sorted(((r["n"], r["count"]) for r in counts.groupBy(F.bit_length(F.bin("n")).alias("n")).count().collect()),
                   reverse=True)
    bits, total = 1 << 30, 0
    for n, size in sizes:
        if total + size > most:
            break
        bits, total = n // 8, total + size
    least = 1 << (bits - 1) if bits < 64 else 1 << 62
    found = counts.where(F.col("n") >= least).select("h", "n").toArrow()
    h = found["h"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], found["n"].to_numpy()[order], least


def scores(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10) of each row.

    Null or empty text: the end token alone. Null doc_id: a training row, by the checksum of the empty text. Repeated
    rows count as often as they occur and each has its own result. Empty table: no rows. Other columns are not read.
    """
    of, held = HELD_OUT
    train = training(docs)
    counts = token_counts(train)
    by_class = counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    total, different = sum(r["n"] for r in by_class), sum(r["v"] for r in by_class)
    rest = np.zeros(CLASSES)
    for r in by_class:
        rest[r["kind"]] = r["n"] + r["v"]
    hashes, numbers, least = head(counts)
    all_ = float(np.log10(total + different + 1))
    # Taken as a share of all at once: sums over long texts then lose no digits.
    shared = docs.sparkSession.sparkContext.broadcast(
        (*trained(train), hashes, np.log10(numbers + 1.0) - all_, np.log10(rest + 1) - all_))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder("doc_id", of) == held).alias("held_out"),
                       "text", *keep)
    fields = [f for f in rows.schema if f.name != "text"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, known, logs, spread = shared.value
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], []]
            for _, _, data, offsets in chunks(batch):
                tokens = Tokens(data, offsets)
                features = tokens.features()
                gain = np.empty(len(features))
                for low in range(0, len(features), 4 * BATCH):
                    part = shares(weights, bias, features[low:low + 4 * BATCH])
                    gain[low:low + 4 * BATCH] = np.log10(np.maximum(
                        part[np.arange(len(part)), tokens.kind[low:low + 4 * BATCH]], 1e-30))
                gain -= spread[tokens.kind]
                at = np.minimum(np.searchsorted(known, tokens.hash), max(len(known) - 1, 0))
                hit = known[at] == tokens.hash if len(known) else np.zeros(len(at), dtype=bool)
                n = len(tokens.counts)
                columns[0].append(tokens.counts)
                columns[1].append(np.bincount(tokens.doc, weights=hit, minlength=n).astype(np.int64))
                columns[2].append(np.bincount(tokens.doc[hit], weights=logs[at[hit]], minlength=n))
                columns[3].append(np.bincount(tokens.doc, weights=gain, minlength=n))
                order = np.lexsort((tokens.hash[~hit], tokens.doc[~hit]))
                h, doc = tokens.hash[~hit][order], tokens.doc[~hit][order]
                new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])) if len(h) else h
                new = new.astype(np.int64)
                ends = np.searchsorted(doc[new], np.arange(n + 1))
                sizes = np.diff(np.append(new, len(h)))
                for i in range(n):
                    columns[4].append(h[new[ends[i]:ends[i + 1]]].view(np.int64))
                    columns[5].append(sizes[ends[i]:ends[i + 1]])
            flat = [np.concatenate(c) if c else np.zeros(0) for c in columns[:4]]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in fields), pa.array(flat[0].astype(np.int64)),
                 pa.array(flat[1].astype(np.int64)), pa.array(flat[2].astype(float)), pa.array(flat[3].astype(float)),
                 pa.array(columns[4], type=pa.list_(pa.int64())), pa.array(columns[5], type=pa.list_(pa.int64()))],
                names=[*(f.name for f in fields), "n_tokens", "known", "logs", "gain", "other", "times"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    found = rows.mapInArrow(score, f"{kinds}, n_tokens long, known long, logs double, gain double, "
                                   "other array<long>, times array<long>")
    found = written(found.withColumn("_row", F.monotonically_increasing_id()), "lm-rows")
    pairs = found.select("_row", F.explode(F.arrays_zip("other", "times")).alias("x")).select(
        "_row", F.col("x.other").alias("h"), F.col("x.times").alias("times"))
    rare = counts.where(F.col("n") < least).select("h", F.log10(F.col("n") + 1.0).alias("log"))
    sums = pairs.join(rare, "h").groupBy("_row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.col("log"))
                                                     .alias("more_logs"))
    base = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - (F.col("n_tokens") - F.col("known")) * all_
    return found.join(written(sums, "lm-rare"), "_row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"), (base + F.col("gain")).alias("score"), *keep)


query = scores
