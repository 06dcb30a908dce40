"""Alignment of two tokenizers' tokens by byte offsets, as an Arrow pipeline.

For a run of texts, the ids of each tokenizer are a list column. Flattened, with the parent index of each id, they get
their bytes' lengths from the vocabulary; a segmented cumulative sum gives the offset in the text at which each token
ends. A full outer hash join of both sides on document and end, put in order, has one row for each end of either side.
The bytes between two such rows belong to exactly one token of each side, so the rows are the links, and the ids of a
side are filled in from its next end. Rows where both ends met close a group.

Counts: each batch of texts counts its id pairs by Table.group_by, each pair once a document; Spark adds up these
partial counts for the whole corpus and finds each A id's highest. Each batch, which is one row of a table, then gets
the counts of its own pairs back and sums them over its documents. So a pair that all documents hold is one row a
batch, and links are kept as numbers into the batch's list of pairs.

Null or empty text, and text that either tokenizer doesn't give back byte by byte (it normalises some): no tokens, all
zeros and empty groups. Repeated rows are documents of their own; a null doc_id is one like any other. Empty table: no
rows. Other columns aren't read.
"""

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.tables import bucketed, written

BATCH_BYTES = 8 << 20
RUN_BYTES = 512 << 10
RUN_ROWS = 2048
BUCKETS_BYTES = 16 << 20
DEEP = re.compile(r"\s{1000}")

COUNTED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Side:
    """A tokenizer with the bytes of each of its ids."""

    def __init__(self, tokens: list[bytes]):
        self.ends = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.sizes = pa.array(np.diff(self.ends))

    def encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.ends[ids + 1] - self.ends[ids]
        before = np.cumsum(sizes) - sizes
        return self.bytes[np.repeat(self.ends[ids] - before, sizes) + np.arange(int(sizes.sum()))]


class ByteLevel(Side):
    """A tokenizer file whose tokens spell bytes as printable characters; special tokens are plain text.

    PATTERN cuts a text as the tokenizer does. The file's vocabulary, as ranks, then gives the same ids in a third of
    the time; texts with very long runs of white space, too deep for that engine, go through the tokenizer itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # Bytes that are printable in Latin-1 stand for themselves, all others for characters from 256 on.
        plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
        others = [b for b in range(256) if b not in set(plain)]
        spelt = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            tokens[i] = bytes(spelt[c] for c in token) if all(c in spelt for c in token) else token.encode()
        super().__init__(tokens)
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.ranked = tiktoken.Encoding("ranked", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
            tokens[i]: i for token, i in vocabulary.items() if token not in added})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.tokenizer.encode(" " + t, add_special_tokens=False).ids if DEEP.search(t)
                else self.ranked.encode_ordinary(" " + t) for t in texts]


class Pieces(Side):
    """A piece model, which puts a space before the text itself; bytes beyond its pieces are pieces <0xHH>."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        super().__init__([self.spelt(i) for i in range(self.model.get_piece_size())])

    def spelt(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


_sides: dict[tuple, Side] = {}


def side(kind: type[Side], path: str) -> Side:
    """One per Python worker."""
    if (kind, path) not in _sides:
        _sides[kind, path] = kind(path)
    return _sides[kind, path]


def flat(ids: list[list[int]], own: Side) -> pa.Table:
    """doc, end and id of each token: list flatten, parent index, segmented cumulative sum."""
    lists = pa.array(ids, type=pa.list_(pa.int32()))
    doc, id_ = pc.list_parent_indices(lists), pc.list_flatten(lists)
    total = pc.cumulative_sum(own.sizes.take(id_))
    first = lists.offsets.to_numpy()
    before = np.concatenate([[0], total.to_numpy()])[first[:-1]]
    end = pc.subtract(total, pa.array(before).take(doc))
    return pa.table({"doc": doc, "end": end, "id": id_})


def alike(ids: list[list[int]], own: Side, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each document's tokens spell its bytes."""
    sizes = np.array([len(x) for x in ids])
    ends = np.cumsum(sizes)
    every = np.fromiter((i for x in ids for i in x), dtype=np.int64, count=int(ends[-1]) if len(ends) else 0)
    spelt = own.joined(every)
    at = np.concatenate([[0], np.cumsum(own.ends[every + 1] - own.ends[every])])[np.concatenate([[0], ends])]
    same = np.diff(at) == np.diff(offsets)
    for i in np.flatnonzero(same):
        same[i] = np.array_equal(spelt[at[i]:at[i + 1]], data[offsets[i]:offsets[i + 1]])
    return same


def spans(values: pa.Array, edges: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edges, type=pa.int32()), values)


def listed(ends: pa.Table, closed: np.ndarray, docs: int) -> list[str]:
    """`a1,a2|b1;a3|b2` of each document, from its rows in order; `closed`: rows that close a group."""
    parts = []
    for name in ("a", "b"):
        own = ends.column(name).combine_chunks()
        known = np.concatenate([[0], np.cumsum(own.is_valid().to_numpy(zero_copy_only=False))])
        edges = known[np.concatenate([[0], np.flatnonzero(closed) + 1])]
        parts.append(pc.binary_join(spans(own.drop_null().cast(pa.string()), edges), ","))
    groups = pc.binary_join_element_wise(*parts, "|")
    of = ends.column("doc").to_numpy()[closed]
    return pc.binary_join(spans(groups, np.searchsorted(of, np.arange(docs + 1))), ";").to_pylist()


def aligned(texts: list[str], a: Side, b: Side) -> tuple[list[list[int]], pa.Table, np.ndarray, list[str]]:
    """(n_a, n_b, n_groups, n_links of each text; doc, a, b of each link; links of each text, groups as text)."""
    ids = [a.encode(texts), b.encode(texts)]
    data = [(" " + t).encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in data])])
    data = np.frombuffer(b"".join(data), dtype=np.uint8)
    good = np.array([bool(t) for t in texts]) & alike(ids[0], a, data, offsets) & alike(ids[1], b, data, offsets)
    ids = [[x if ok else [] for x, ok in zip(own, good, strict=True)] for own in ids]
    left, right = (flat(own, s).rename_columns({"id": n}) for own, s, n in zip(ids, (a, b), "ab", strict=True))
    ends = (left.join(right, ["doc", "end"], join_type="full outer")
            .sort_by([("doc", "ascending"), ("end", "ascending")]).combine_chunks())
    closed = pc.and_(pc.is_valid(ends.column("a")), pc.is_valid(ends.column("b"))).to_numpy()
    links = pa.table({"doc": ends.column("doc"), "a": pc.fill_null_backward(ends.column("a")),
                      "b": pc.fill_null_backward(ends.column("b"))})
    doc = ends.column("doc").to_numpy()
    counts = [[len(x) for x in ids[0]], [len(x) for x in ids[1]],
              np.bincount(doc[closed], minlength=len(texts)).tolist(), np.bincount(doc, minlength=len(texts)).tolist()]
    return counts, links, good, listed(ends, closed, len(texts))


def alignments(docs: DataFrame, a: str, b: str) -> DataFrame:
    """doc_id, groups (text) of each document: the general form, with the groups themselves."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in runs(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, type=pa.int64()),
                 pa.array(aligned(texts, side(ByteLevel, a), side(Pieces, b))[3], type=pa.string())],
                names=["doc_id", "groups"])

    return rows.mapInArrow(align, "doc_id long, groups string")


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """(doc_id, texts) of about RUN_BYTES; a longer text is a run of its own."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if texts and (size + len(text) > RUN_BYTES or len(texts) == RUN_ROWS):
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(text)
            size += len(text)
        if texts:
            yield ids, texts


class Batch:
    """What a batch of runs adds up to: one row."""

    def __init__(self):
        self.rows, self.digests, self.pairs, self.counts, self.size = [], [], [], [], 0

    def add(self, ids: list, texts: list[str], a: Side, b: Side) -> None:
        counts, links, good, groups = aligned(texts, a, b)
        shas = [hashlib.sha256(g.encode()).hexdigest() if ok else "" for g, ok in zip(groups, good, strict=True)]
        self.rows += list(zip(ids, *counts, strict=True))
        self.digests += shas
        key = pc.add(pc.multiply(links.column("a").cast(pa.int64()), 1 << 32), links.column("b").cast(pa.int64()))
        links = pa.table({"doc": links.column("doc"), "pair": key})
        once = links.group_by(["doc", "pair"]).aggregate([])
        self.counts.append(once.group_by("pair").aggregate([([], "count_all")]))
        self.pairs.append(key.to_numpy())
        self.size += sum(map(len, texts))

    def row(self, number: int) -> dict:
        total = pa.concat_tables(self.counts).group_by("pair").aggregate([("count_all", "sum")]).sort_by("pair")
        pairs = total.column("pair").to_numpy()
        codes = np.searchsorted(pairs, np.concatenate(self.pairs)).astype("<u4")
        return {"batch": number, "rows": [list(x) for x in zip(*self.rows)], "digests": self.digests,
                "links": pa.compress(codes.tobytes(), "zstd", asbytes=True),
                "pairs": pairs.tolist(), "counts": total.column("count_all_sum").to_pylist()}


_BATCH = pa.schema([("batch", pa.int64()), ("rows", pa.list_(pa.list_(pa.int64()))), ("digests", pa.list_(pa.string())),
                    ("links", pa.binary()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])


def batches_of(docs: DataFrame, a: str, b: str) -> DataFrame:
    """One row for each batch of texts: doc_id and counts of its documents, its links, its pairs with their counts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, own, number = side(ByteLevel, a), side(Pieces, b), Batch(), TaskContext.get().partitionId() << 32
        for ids, texts in runs(batches):
            own.add(ids, texts, first, second)
            if own.size >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist([own.row(number)], schema=_BATCH)
                own, number = Batch(), number + 1
        if own.rows:
            yield pa.RecordBatch.from_pylist([own.row(number)], schema=_BATCH)

    return rows.mapInArrow(align, "batch long, rows array<array<long>>, digests array<string>, links binary, "
                                  "pairs array<long>, counts array<long>")


def counted(docs: DataFrame, a: str, b: str) -> DataFrame:
    """The columns of COUNTED, a row per document."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    with bucketed(batches_of(docs, a, b), "alignment", "batch", max(1, size // BUCKETS_BYTES)) as batches:
        partial = batches.select("batch", F.posexplode(F.arrays_zip("pairs", "counts")).alias("code", "_p")).select(
            "batch", "code", F.col("_p.pairs").alias("pair"), F.col("_p.counts").alias("n"))
        pairs = partial.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.shiftright("pair", 32))
        pairs = written(pairs, "alignment-pairs")
        best = pairs.groupBy("a").agg(F.max("n").alias("best"))
        # Vocabularies bound both: one row an A id, and one a pair of ids.
        pairs = pairs.join(best, "a").select("pair", "n", (F.col("n") == F.col("best")).alias("is_best"))
        told = partial.select(F.col("batch").alias("to"), "code", "pair").join(pairs, "pair").drop("pair")

        def finish(own: pa.Table, told_: pa.Table) -> pa.Table:
            out = []
            order = told_.sort_by("code")
            n, best_ = order.column("n").to_numpy(), order.column("is_best").to_numpy()
            for r in own.select(["rows", "digests", "links"]).to_pylist():
                codes = np.frombuffer(pa.decompress(
                    r["links"], 4 * sum(r["rows"][4]), "zstd", asbytes=True), dtype="<u4")
                ends = np.concatenate([[0], np.cumsum(r["rows"][4])])
                sums = [np.concatenate([[0], np.cumsum(v[codes], dtype=np.int64)])[ends] for v in (n, best_)]
                out.append(pa.table({
                    **{c: pa.array(x, type=pa.int64()) for c, x in zip(
                        ("doc_id", "n_a", "n_b", "n_groups", "n_links"), r["rows"], strict=True)},
                    "n_best": np.diff(sums[1]), "count_sum": np.diff(sums[0]), "groups_sha256": r["digests"]}))
            return pa.concat_tables(out) if out else _COUNTED.empty_table()

        return written(batches.groupBy("batch").cogroup(told.groupBy("to")).applyInArrow(finish, COUNTED), "alignments")


_COUNTED = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in (x.split() for x in COUNTED.split(", "))])


def query(docs: DataFrame, a: str, b: str) -> DataFrame:
    return counted(docs, a, b)
