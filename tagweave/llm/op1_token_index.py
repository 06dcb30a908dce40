"""Token ids in raw binary shards, with a minimal perfect hash index from document keys to places in the shards.

Shard file: the ids of its documents one after another, each document followed by the end id, as little-endian
unsigned integers of 2 bytes (4 where the vocabulary needs them); then per document its number of ids (uint32), its
key (int64) and whether the key is null (uint8); then a tail of three uint64: documents, ids, bytes an id takes.

Index file, one for every part of the keys: the levels of the perfect hash, then one entry a key: a 32-bit fingerprint
of the key and where its documents are. A key hashes to one bit of a level; keys that meet on a bit go on to the next
level; the rank of a key's bit among all bits set is its entry. So a lookup looks at two levels on average, whatever
the number of keys, and reads one entry.

Files are named by the attempt that wrote them, and only those of tasks that Spark committed are listed: a lost or
repeated task leaves files nobody reads.
"""

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagweave.llm.batches import ASCII_LETTER, LOWER, NOT_WHITE, Words, chunks, mix
from tagweave.llm.tables import scratch_path, written

END_ID = 2
SHARD_BYTES = 32 << 20
PART_KEYS = 1 << 15
CACHED_WORDS = 1_000_000
LEVELS, SPARE = 48, 2

ROWS = "shard int, file string, row long, doc_id long, at long, n_tokens long"
ENTRY = np.dtype([("fingerprint", "<u4"), ("segments", "<u4"), ("shard", "<u4"), ("row", "<u4"), ("documents", "<u4"),
                  ("at", "<u8"), ("start", "<u8")])


class WordEncoder:
    """Ids of whole texts from a tokenizer for which white space always ends a token.

    A word then has the same ids wherever it stands, so each different word is encoded once and kept by a 64-bit hash.
    Lower case and a final comma or full stop after a letter don't change the other ids either: the tokenizer lowers
    case itself and never joins letters with punctuation. Words with '<' may be its special tokens and stay as they
    are. `most` bounds the words kept; beyond it the table starts anew.
    """

    def __init__(self, path: str, most: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind, self.most = np.dtype(f"<u{self.width}"), most
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.places, self.sizes = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=self.kind)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        low = LOWER[data]
        mark = (low == 0x2C) | (low == 0x2E)
        last = np.ones(len(low), dtype=bool)
        last[:-1] = ~NOT_WHITE[low[1:]]
        last[offsets[1:][offsets[1:] > 0] - 1] = True
        after = np.zeros(len(low), dtype=bool)
        after[1:] = ASCII_LETTER[low[:-1]]
        words = Words(low, offsets, NOT_WHITE, np.flatnonzero(mark & last & after))
        if not len(words):
            return np.zeros(0, dtype=self.kind), np.zeros(len(offsets) - 1, dtype=np.int64)
        special = np.flatnonzero(low == 0x3C)
        if len(special):
            for i in np.unique(np.searchsorted(words.starts, special, side="right") - 1):
                low[words.starts[i]:words.ends[i]] = data[words.starts[i]:words.ends[i]]
        hashes = words.hashes()
        at = self.find(hashes, words)
        sizes = self.sizes[at]
        before = np.cumsum(sizes) - sizes
        ids = self.ids[np.repeat(self.places[at] - before, sizes) + np.arange(int(sizes.sum()))]
        total = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(total[words.first])

    def find(self, hashes: np.ndarray, words: Words) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, hashes), max(len(self.keys) - 1, 0))
        missing = np.flatnonzero(self.keys[at] != hashes) if len(self.keys) else np.arange(len(hashes))
        if not len(missing):
            return at
        new, which = np.unique(hashes[missing], return_index=True)
        if len(self.keys) + len(new) > self.most and len(self.keys):
            self.clear()
            return self.find(hashes, words)
        texts = [words.text(i).decode() for i in missing[which]]
        ids, sizes = self.learn(texts)
        places = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, ids])
        where = np.searchsorted(self.keys, new)
        self.keys, self.places, self.sizes = (np.insert(a, where, b) for a, b in (
            (self.keys, new), (self.places, places), (self.sizes, sizes)))
        return np.searchsorted(self.keys, hashes)

    def learn(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and number of ids of each word, many words in one call, told apart by their places."""
        ids, sizes = [], []
        for low in range(0, len(texts), 2048):
            some = texts[low:low + 2048]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ends = np.cumsum([len(x) + 1 for x in some])
            begins = np.fromiter((a for a, _ in found.offsets), dtype=np.int64, count=len(found.ids))
            sizes.append(np.bincount(np.searchsorted(ends, begins, side="right"), minlength=len(some)))
            ids.append(np.array(found.ids, dtype=self.kind))
        return np.concatenate(ids), np.concatenate(sizes)


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One per Python worker: what it has learnt serves the worker's later tasks too."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def opened(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    return system, path


def new_file(folder: str, kind: str, number: int) -> tuple[str, fs.FileSystem, str]:
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    name = f"{kind}-{number:06d}-{uuid.uuid4().hex}"
    return f"{folder}/{name}", system, f"{path}/{name}"


def write_shards(docs: DataFrame, folder: str, tokenizer: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encodes `text` and writes the shards in ascending doc_id order; a row per document: where its ids are.

    Null keys come first. Documents of one key keep together, in order of their texts; such a run may go on in the
    next shard.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = (rows.repartitionByRange(max(1, -(-size // shard_bytes)), F.asc_nulls_first("doc_id"), F.xxhash64("text"))
               .sortWithinPartitions(F.asc_nulls_first("doc_id"), F.xxhash64("text"), "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number, stream, name = encoder(tokenizer), TaskContext.get().partitionId(), None, ""
        at, row, sizes, keys, nulls = 0, 0, [], [], []
        for batch in batches:
            if batch.num_rows and stream is None:
                name, system, path = new_file(folder, "ids", number)
                stream = system.open_output_stream(path, compression=None)
            for low, high, data, offsets in chunks(batch):
                ids, counts = own.encode(data, offsets)
                ids = np.insert(ids, np.cumsum(counts), END_ID)
                counts = counts + 1
                stream.write(ids.tobytes())
                ids_of = batch.column("doc_id").slice(low, high - low)
                places = at + np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(high - low, number, dtype=np.int32)), pa.array([name] * (high - low)),
                     pa.array(np.arange(row, row + high - low)), ids_of.cast(pa.int64()), pa.array(places),
                     pa.array(counts.astype(np.int64))],
                    names=["shard", "file", "row", "doc_id", "at", "n_tokens"])
                at, row = at + int(counts.sum()), row + high - low
                sizes.append(counts.astype("<u4"))
                keys.append(ids_of.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                nulls.append(ids_of.is_null().to_numpy(zero_copy_only=False).astype("u1"))
        if stream is not None:
            for part in (sizes, keys, nulls):
                stream.write(np.concatenate(part).tobytes())
            stream.write(np.array([row, at, own.width], dtype="<u8").tobytes())
            stream.close()

    return written(ordered.mapInArrow(write, ROWS), "token-rows")


def read_shard(uri: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, number of ids of each document, keys, whether the key is null)."""
    system, path = opened(uri)
    with system.open_input_file(path) as f:
        data = f.read()
    n, total, width = (int(x) for x in np.frombuffer(data[-24:], dtype="<u8"))
    at = total * width
    ids = np.frombuffer(data, dtype=f"<u{width}", count=total)
    sizes = np.frombuffer(data, dtype="<u4", count=n, offset=at)
    keys = np.frombuffer(data, dtype="<i8", count=n, offset=at + 4 * n)
    return ids, sizes, keys, np.frombuffer(data, dtype="u1", count=n, offset=at + 12 * n).astype(bool)


def key_hash(keys: np.ndarray, nulls: np.ndarray, segment) -> np.ndarray:
    with np.errstate(over="ignore"):
        salt = np.asarray(segment, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + nulls.astype(np.uint64)
        return mix(keys.astype(np.int64).view(np.uint64) ^ mix(salt))


def _slot(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(hashes + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(bits)


def _fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ np.uint64(0xA0761D6478BD642F)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


class PerfectHash:
    """n different 64-bit hashes to 0 .. n-1; hashes of which no level could make sense are listed."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.ranks, base = [], 0
        for bits in levels:
            ones = np.bitwise_count(bits)
            self.ranks.append(base + np.cumsum(ones) - ones)
            base += int(ones.sum())
        self.base = base

    @staticmethod
    def of(hashes: np.ndarray) -> "PerfectHash":
        levels, left = [], hashes
        while len(left) and len(levels) < LEVELS:
            bits = -(-SPARE * len(left) // 64) * 64
            slots = _slot(left, len(levels), bits)
            alone = np.bincount(slots.astype(np.int64), minlength=bits) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[slots.astype(np.int64)]]
        return PerfectHash(levels, np.sort(left))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash; of one that isn't a key, -1 or any place."""
        found = np.full(len(hashes), -1, dtype=np.int64)
        open_ = np.arange(len(hashes))
        for level, bits in enumerate(self.levels):
            slots = _slot(hashes[open_], level, 64 * len(bits))
            words, shift = (slots >> np.uint64(6)).astype(np.int64), slots & np.uint64(63)
            hit = (bits[words] >> shift) & np.uint64(1) == 1
            below = np.bitwise_count(bits[words[hit]] & ((np.uint64(1) << shift[hit]) - np.uint64(1)))
            found[open_[hit]] = self.ranks[level][words[hit]] + below
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, hashes[open_]), len(self.rest) - 1)
            same = self.rest[at] == hashes[open_]
            found[open_[same]] = self.base + at[same]
        return found

    def dump(self) -> bytes:
        head = np.array([len(self.levels), len(self.rest), *map(len, self.levels)], dtype="<u8")
        return b"".join(x.astype("<u8").tobytes() for x in (head, *self.levels, self.rest))

    @staticmethod
    def load(data: bytes) -> tuple["PerfectHash", int]:
        n, rest = (int(x) for x in np.frombuffer(data, dtype="<u8", count=2))
        sizes, at, levels = np.frombuffer(data, dtype="<u8", count=n, offset=16), 16 + 8 * n, []
        for size in map(int, sizes):
            levels.append(np.frombuffer(data, dtype="<u8", count=size, offset=at))
            at += 8 * size
        return PerfectHash(levels, np.frombuffer(data, dtype="<u8", count=rest, offset=at)), at + 8 * rest


def write_index(rows: DataFrame, folder: str, part_keys: int = PART_KEYS) -> DataFrame:
    """Index files over the rows of write_shards; one row per file: part, parts and index_file."""
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    segments = (rows.join(starts, "shard").groupBy("doc_id", "shard")
                .agg(F.min("row").alias("row"), F.min("at").alias("at"), F.count("*").alias("documents"),
                     F.min(F.col("at") + F.col("_start")).alias("start")))
    of_key = Window.partitionBy("doc_id")
    segments = segments.select("*", (F.row_number().over(of_key.orderBy("shard")) - 1).alias("segment"),
                               F.count("*").over(of_key).alias("segments"))
    parts = max(1, -(-rows.count() // part_keys))
    segments = segments.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        nulls = group["doc_id"].isna().to_numpy()
        hashes = key_hash(group["doc_id"].fillna(0).to_numpy(), nulls, group["segment"].to_numpy())
        perfect = PerfectHash.of(hashes)
        entries = np.zeros(len(group), dtype=ENTRY)
        place = perfect.find(hashes)
        entries["fingerprint"][place] = _fingerprint(hashes)
        for name in ("segments", "shard", "row", "documents", "at", "start"):
            entries[name][place] = group[name].to_numpy()
        part = int(group["part"].iloc[0])
        name, system, path = new_file(folder, "index", part)
        with system.open_output_stream(path, compression=None) as f:
            f.write(perfect.dump() + entries.tobytes())
        return pd.DataFrame({"part": [part], "parts": [parts], "index_file": [name]})

    return written(segments.withColumn("doc_id", F.col("doc_id").cast("long")).groupBy("part")
                   .applyInPandas(build, "part int, parts int, index_file string"), "token-index")


def look_up(keys: DataFrame, index: DataFrame) -> DataFrame:
    """Where the documents of each key (column doc_id, no key twice) are; a key that isn't there gives no row.

    One row per key and shard: doc_id, shard, row, documents, at, start.
    """
    parts = (index.first() or {"parts": 1})["parts"]
    placed = (keys.select(F.col("doc_id").cast("long").alias("doc_id"))
              .withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int")).join(index, "part"))

    def probe(group: pd.DataFrame) -> pd.DataFrame:
        system, path = opened(group["index_file"].iloc[0])
        with system.open_input_file(path) as f:
            data = f.read()
        perfect, at = PerfectHash.load(data)
        entries = np.frombuffer(data, dtype=ENTRY, offset=at)
        nulls = group["doc_id"].isna().to_numpy()
        keys_, open_, out, segment = group["doc_id"].fillna(0).to_numpy(), np.arange(len(group)), [], 0
        while len(open_):
            hashes = key_hash(keys_[open_], nulls[open_], segment)
            place = perfect.find(hashes)
            ok = (place >= 0) & (entries["fingerprint"][np.maximum(place, 0)] == _fingerprint(hashes))
            open_, found = open_[ok], entries[place[ok]]
            out.append(pd.DataFrame({"doc_id": group["doc_id"].to_numpy()[open_]} | {
                n: found[n].astype(np.int64) for n in ("shard", "row", "documents", "at", "start")}))
            segment += 1
            open_ = open_[found["segments"] > segment]
        return pd.concat(out)

    return placed.groupBy("part").applyInPandas(
        probe, "doc_id long, shard long, row long, documents long, at long, start long")


def read_documents(places: DataFrame, shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document at the places, from the shard files (shard, file)."""

    def read(group: pd.DataFrame) -> pd.DataFrame:
        ids, sizes, keys, nulls = read_shard(group["file"].iloc[0])
        ends = np.cumsum(sizes, dtype=np.int64)
        out = []
        for key, row, documents, at, start in zip(
                group["doc_id"], group["row"], group["documents"], group["at"], group["start"], strict=True):
            for i in range(row, row + documents):
                # The fingerprint has 32 bits; the shard tells for certain.
                if not (nulls[i] if pd.isna(key) else keys[i] == key and not nulls[i]):
                    continue
                low = int(ends[i] - sizes[i])
                own = ids[low:int(ends[i])]
                out.append((key, start + low - at, len(own), zlib.crc32(own.astype("<u4").tobytes())))
        return pd.DataFrame(out, columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})

    return places.join(shards, "shard").groupBy("shard").applyInPandas(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_index(docs: DataFrame, folder: str, tokenizer: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Writes shards and index below `folder`; gives the row, shard and index tables.

    Null or empty text: the end id alone. Null key: a key like any other. A repeated key: all its documents, in order
    of text. An empty table: no file. Columns other than doc_id and text are not read.
    """
    rows = write_shards(docs, folder, tokenizer)
    index = write_index(rows, folder)
    return rows, rows.groupBy("shard").agg(F.first("file").alias("file")), index


def query(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    _, shards, index = token_index(docs, scratch_path(spark, "token-ids"), tokenizer)
    return read_documents(look_up(docs.select("doc_id").distinct(), index), shards)
