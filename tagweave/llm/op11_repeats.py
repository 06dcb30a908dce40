"""Repeats between documents by an enhanced suffix array and its common-prefix interval tree.

A repeat is a byte string of at least `length` bytes that several documents hold. The suffixes of all documents cannot
be sorted in one place, so they are dealt out by what they begin with: each run of `length` bytes (a window) has a
minimal k-gram, its anchor, which any other occurrence of the window has too. Windows next to each other mostly share
their anchor and travel as one segment, at most SPAN windows and the bytes under them.

1. `shared_anchors`: which anchors occur in several documents, by 32 bits of each different anchor of a chunk. Only
   their segments go on; each chunk gets its answer as one bit an anchor.
2. `interval_groups`: the segments of one anchor meet in one task. Their suffixes are sorted, the common prefixes of
   neighbours make the array enhanced, and a scan with a stack walks the intervals of the common-prefix tree. An
   interval is a repeat that cannot go on to the right; it is a maximal repeat if it cannot go on to the left either,
   that is, if its occurrences have different bytes before them. A segment's first suffix counts as different, since
   the byte before it belongs to another anchor: a long repeat comes as a chain of overlapping groups.
3. Each chunk gets the groups of its own segments and gives all occurrences of each (`repeat_groups`), or takes the
   bytes out that a document of a smaller doc_id has as well (`without_repeats`).

Documents stay where they are: the chunks are buckets of one table, only anchors, segments and answers are moved.
A chunk sends a text that it holds many times once. Anchors with more than HOT segments travel window by window, each
keyed by its own bytes, so a task gets such a window at most once from each chunk.

Null doc_id: less than any other; rows of one doc_id are one document to each other and never remove anything from
each other. Null text: empty. Texts shorter than `length`: no repeats. Empty table: no rows. Other columns aren't read.
"""

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.batches import mix
from tagweave.llm.tables import bucketed, written

LENGTH = 50
GRAM = 20
SPAN = 31
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
PART_ANCHORS = 2_000_000
GROUP_SEGMENTS = 20_000
HOT = 20_000
PIECE_BYTES = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_NO_ID = np.iinfo(np.int64).min


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` bytes from each position on, put together from hashes of powers of two."""
    with np.errstate(over="ignore"):
        power, width, out, done, left = _BYTE[data], 1, None, 0, size
        while left:
            if left & 1:
                if out is None:
                    out = power
                else:
                    n = len(power) - done
                    out = out[:n] * np.uint64(pow(_MULTIPLIER, width, 1 << 64)) + power[done:done + n]
                done += width
            left >>= 1
            if left:
                n = len(power) - width
                power = power[:n] * np.uint64(pow(_MULTIPLIER, width, 1 << 64)) + power[width:width + n]
                width *= 2
    return mix(out)


def sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    least, width = values, 1
    while width * 2 <= size:
        least = np.minimum(least[:len(least) - width], least[width:])
        width *= 2
    n = len(values) - size + 1
    return np.minimum(least[:n], least[size - width:size - width + n])


class Segments:
    """Runs of windows of one anchor in the texts: `start`, `windows`, `anchor`, `row`; their bytes end `length` - 1
    after the last window's start."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        gram = min(GRAM, length)
        self.data, self.length = data, length
        parts, row = [], 0
        rows = len(offsets) - 1
        while row < rows:
            # Pieces of several texts, or one long text: bounds the arrays of hashes.
            last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE_BYTES, side="right")) - 1)
            parts.append(self.some(offsets[row:last + 1], row, gram))
            row = last
        columns = zip(*parts) if parts else [[np.zeros(0, dtype=np.int64)]] * 4
        self.start, self.windows, self.anchor, self.row = map(np.concatenate, columns)
        self.anchor = self.anchor.astype(np.uint64)

    def some(self, offsets: np.ndarray, row: int, gram: int) -> tuple[np.ndarray, ...]:
        low, high = int(offsets[0]), int(offsets[-1])
        none = np.zeros(0, dtype=np.int64)
        if high - low < self.length:
            return none, none, np.zeros(0, dtype=np.uint64), none
        least = sliding_least(gram_hashes(self.data[low:high], gram), self.length - gram + 1)
        fits = np.maximum(np.diff(offsets) - self.length + 1, 0)
        begins = np.repeat(offsets[:-1] - low, fits)
        at = begins + np.arange(len(begins)) - np.repeat(np.cumsum(fits) - fits, fits)
        anchors = least[at]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (begins[1:] != begins[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(at)))
        pieces = -(-count // SPAN)
        order = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, count = np.repeat(first, pieces) + order * SPAN, np.repeat(count, pieces) - order * SPAN
        start = at[first] + low
        return (start, np.minimum(count, SPAN), mix(anchors[first]),
                row + np.searchsorted(offsets, start, side="right") - 1)


def texts_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_id, bytes of all texts, offsets) of a chunk, in order of its rows' numbers."""
    table = table.sort_by("at")
    ids = table.column("doc_id").to_numpy()
    texts = [x.as_py() or b"" for x in table.column("text")]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
    return ids, np.frombuffer(b"".join(texts), dtype=np.uint8), offsets


def several(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different keys in order, how often each occurs, whether in several documents)."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    last = np.append(first[1:], len(keys)) - 1
    return keys[first], last - first + 1, docs[first] != docs[last] if len(keys) else first.astype(bool)


def anchor_keys(segments: Segments, parts: int) -> np.ndarray:
    """Part of the anchor above 32 bits of it."""
    return ((segments.anchor % np.uint64(parts)) << np.uint64(32)) | (segments.anchor >> np.uint64(32))


def blobs(chunk: int, part: np.ndarray, *columns: np.ndarray) -> tuple[list, ...]:
    """One row for each part: chunk, part and the bytes of each column's values there; `part` is in order."""
    edges = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, dtype=np.int64)
    ends = np.append(edges[1:], len(part))
    return ([chunk] * len(edges), part[edges].astype(np.int64).tolist(),
            *([c[a:b].tobytes() for a, b in zip(edges.tolist(), ends.tolist())] for c in columns))


def table_of(names: str, columns: tuple[list, ...], kinds: list) -> pa.Table:
    return pa.table({n: pa.array(c, type=k) for n, c, k in zip(names.split(), columns, kinds, strict=True)})


_LONG, _BLOB = pa.int64(), pa.binary()


def shared_anchors(chunks: DataFrame, length: int, parts: int, hot: int) -> DataFrame:
    """chunk, part, shared and hot (bits, one for each different anchor of the chunk in order): in several documents;
    with more than `hot` segments."""
    def send(table: pa.Table) -> pa.Table:
        ids, data, offsets = texts_of(table)
        segments = Segments(data, offsets, length)
        keys, times, many = several(anchor_keys(segments, parts), ids[segments.row])
        times = np.minimum(times, 0x7FFF).astype("<u2") | (many.astype("<u2") << 15)
        rows = blobs(table.column("chunk")[0].as_py(), keys >> np.uint64(32), keys.astype("<u4"), times)
        return table_of("chunk part anchors times", rows, [_LONG, _LONG, _BLOB, _BLOB])

    def meet(table: pa.Table) -> pa.Table:
        anchors = [np.frombuffer(x.as_py(), dtype="<u4") for x in table.column("anchors")]
        times = np.concatenate([np.frombuffer(x.as_py(), dtype="<u2") for x in table.column("times")])
        _, which, chunks_ = np.unique(np.concatenate(anchors), return_inverse=True, return_counts=True)
        many = (np.bincount(which, weights=times >> 15) > 0) | (chunks_ > 1)
        crowded = np.bincount(which, weights=times & 0x7FFF) > hot
        ends = np.cumsum([len(x) for x in anchors])
        shared, busy = ([np.packbits(x).tobytes() for x in np.split(v[which], ends[:-1])] for v in (many, crowded & many))
        return pa.table({"chunk": table.column("chunk"), "part": table.column("part"), "shared": shared, "hot": busy,
                         "n": pa.array([int(x.sum()) for x in np.split(many[which], ends[:-1])], type=_LONG)})

    sent = chunks.groupBy("chunk").applyInArrow(send, "chunk long, part long, anchors binary, times binary")
    return written(sent.groupBy("part").applyInArrow(meet, "chunk long, part long, shared binary, hot binary, n long"),
                   "repeat-anchors")


class Shared:
    """A chunk's segments of shared anchors, each different content once, in an order that every run repeats.

    `place` tells for each occurrence (of `start`, `row`) which content it is; `part` deals the contents out.
    """

    def __init__(self, ids: np.ndarray, segments: Segments, answer: list[tuple], parts: int, groups: int):
        keys = anchor_keys(segments, parts)
        different, which = np.unique(keys, return_inverse=True)
        bits = {p: (s, h) for p, s, h in answer}
        shared, hot = (np.zeros(len(different), dtype=bool) for _ in range(2))
        own = (different >> np.uint64(32)).astype(np.int64)
        edges = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, dtype=np.int64)
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(own)]):
            for into, found in zip((shared, hot), bits[int(own[a])], strict=True):
                into[a:b] = np.unpackbits(np.frombuffer(found, dtype=np.uint8), count=b - a)
        at = np.flatnonzero(shared[which])
        start, windows, row, anchor = (x[at] for x in (segments.start, segments.windows, segments.row, segments.anchor))
        busy = hot[which[at]]
        if busy.any():
            apart = np.where(busy, windows, 1)
            step = np.arange(int(apart.sum())) - np.repeat(np.cumsum(apart) - apart, apart)
            busy, windows = np.repeat(busy, apart), np.repeat(windows, apart)
            start, row, anchor = np.repeat(start, apart) + step, np.repeat(row, apart), np.repeat(anchor, apart)
            windows[busy] = 1
        self.size = windows + segments.length - 1
        span = segments.length + SPAN - 1
        width = -(-span // 8) * 8
        words = np.zeros((len(start), width), dtype=np.uint8)
        for low in range(0, len(start), 1 << 14):
            some = start[low:low + (1 << 14), None] + np.arange(span)
            inside = np.arange(span) < self.size[low:low + (1 << 14), None]
            words[low:low + (1 << 14), :span] = np.where(inside, segments.data[np.minimum(some, len(segments.data) - 1)], 0)
        hashed = row_hash(words.view("<u8"), self.size)
        anchor = np.where(busy, hashed, anchor) if len(start) else anchor
        part = (mix(anchor) % np.uint64(groups)).astype(np.int64)
        order = np.lexsort((hashed, part))
        new = np.ones(len(order), dtype=bool)
        if len(order):
            new[1:] = ((hashed[order][1:] != hashed[order][:-1]) | (part[order][1:] != part[order][:-1])
                       | (words[order][1:] != words[order][:-1]).any(axis=1))
        self.place = np.empty(len(order), dtype=np.int64)
        self.place[order] = np.cumsum(new) - 1
        first = order[new]
        docs = ids[row]
        self.least, self.most = (np.full(len(first), v, dtype=np.int64) for v in (np.iinfo(np.int64).max, _NO_ID))
        np.minimum.at(self.least, self.place, docs)
        np.maximum.at(self.most, self.place, docs)
        self.start, self.row, self.part = start, row, part[first]
        self.words, self.size = words[first], self.size[first].astype("<u2")


def row_hash(words: np.ndarray, size: np.ndarray) -> np.ndarray:
    out = size.astype(np.uint64)
    for k in range(words.shape[1]):
        out = mix(out * np.uint64(3) + words[:, k])
    return out


def suffix_array(words: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(content, place, size, common prefix with the one before) of all suffixes of at least `length` bytes whose first
    `length` bytes occur twice, in order of their bytes."""
    count = size.astype(np.int64) - length + 1
    content = np.repeat(np.arange(len(size)), count)
    place = np.arange(len(content)) - np.repeat(np.cumsum(count) - count, count)
    flat = words.reshape(-1)
    hashes = gram_hashes(flat, length)[content * words.shape[1] + place] if len(content) else np.zeros(0, np.uint64)
    order = np.argsort(hashes, kind="stable")
    same = np.zeros(len(order) + 1, dtype=bool)
    same[1:-1] = hashes[order][1:] == hashes[order][:-1]
    order = np.sort(order[same[1:] | same[:-1]])
    content, place = content[order], place[order]
    left = size[content].astype(np.int64) - place
    width = words.shape[1]
    padded = np.concatenate([flat, np.zeros(width, dtype=np.uint8)])
    rows = np.empty((len(content), width), dtype=np.uint8)
    for low in range(0, len(content), 1 << 14):
        some = slice(low, low + (1 << 14))
        at = (content[some] * width + place[some])[:, None] + np.arange(width)
        rows[some] = np.where(np.arange(width) < left[some, None], padded[at], 0)
    keys = rows.view(">u8")
    order = np.lexsort((left, *(keys[:, k] for k in range(keys.shape[1] - 1, -1, -1))))
    rows, content, place, left = rows[order], content[order], place[order], left[order]
    common = np.zeros(len(order), dtype=np.int64)
    if len(order) > 1:
        differ = rows[1:] != rows[:-1]
        common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        common[1:] = np.minimum(common[1:], np.minimum(left[1:], left[:-1]))
    return content, place, left, common


def intervals(size: np.ndarray, common: np.ndarray, before: np.ndarray, least: np.ndarray, most: np.ndarray,
              length: int) -> list[tuple[int, int, int, int]]:
    """Maximal repeats of several documents: (first, last suffix, length, smallest document) of each interval of the
    common-prefix tree that is at least `length` deep and whose suffixes have different bytes before them.

    `before`: the byte before each suffix, -1 where it counts as different from all. A suffix alone is a leaf interval
    as deep as it is long, if several documents hold it.
    """
    out, stack = [], []
    size, common, before, least, most = (x.tolist() for x in (size, common, before, least, most))

    def close(node: list, last: int) -> None:
        if node[0] >= length and node[4] < 0 and node[2] != node[3]:
            out.append((node[1], last, node[0], node[2]))

    for i in range(len(size) + 1):
        shared = common[i] if i < len(size) else 0
        # [depth, first, smallest, largest document, byte before or -1]; deeper intervals end before suffix i.
        done = None
        while stack and stack[-1][0] > shared:
            node = stack.pop()
            if done:
                fold(node, done)
            close(node, i - 1)
            done = node
        if i == len(size):
            break
        if done:
            if stack and stack[-1][0] == shared:
                fold(stack[-1], done)
            else:
                stack.append([shared, *done[1:]])
        if shared < size[i]:
            if not stack or stack[-1][0] < size[i]:
                stack.append([size[i], i, least[i], most[i], before[i]])
        else:
            fold(stack[-1], [0, i, least[i], most[i], before[i]])
    return out


def fold(node: list, child: list) -> None:
    node[2], node[3] = min(node[2], child[2]), max(node[3], child[3])
    if node[4] != child[4]:
        node[4] = -1


def interval_groups(chunks: DataFrame, anchors: DataFrame, length: int, parts: int, groups: int) -> DataFrame:
    """chunk, part, content (number among the chunk's contents of the part), at (place in it), length, group, first_doc:
    the repeats in each chunk's segments, packed."""
    def send(docs: pa.Table, answer: pa.Table) -> pa.Table:
        ids, data, offsets = texts_of(docs)
        rows = list(zip(*(answer.column(c).to_pylist() for c in ("part", "shared", "hot")), strict=True))
        own = Shared(ids, Segments(data, offsets, length), rows, parts, groups)
        width = np.arange(own.words.shape[1])
        chunk, part, size, least, most, at = blobs(docs.column("chunk")[0].as_py(), own.part, own.size, own.least, own.most,
                                                   np.arange(len(own.part)))
        text = []
        for x in at:
            of = np.frombuffer(x, dtype=np.int64)
            text.append(pa.compress(own.words[of][width < own.size[of, None]].tobytes(), "zstd", asbytes=True))
        return table_of("chunk part size least most text", (chunk, part, size, least, most, text),
                        [_LONG, _LONG, *[_BLOB] * 4])

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        sizes = [np.frombuffer(x.as_py(), dtype="<u2") for x in table.column("size")]
        counts, size = np.array([len(x) for x in sizes]), np.concatenate(sizes)
        least, most = (np.concatenate([np.frombuffer(x.as_py(), dtype=np.int64) for x in table.column(c)])
                       for c in ("least", "most"))
        width = -(-(length + SPAN - 1) // 8) * 8
        words = np.zeros((len(size), width), dtype=np.uint8)
        words[np.arange(width) < size[:, None]] = np.frombuffer(b"".join(
            pa.decompress(x.as_py(), int(y.sum(dtype=np.int64)), "zstd", asbytes=True)
            for x, y in zip(table.column("text"), sizes, strict=True)), dtype=np.uint8)
        hashed = row_hash(words.view("<u8"), size)
        order = np.argsort(hashed, kind="stable")
        new = np.ones(len(order), dtype=bool)
        new[1:] = (hashed[order][1:] != hashed[order][:-1]) | (words[order][1:] != words[order][:-1]).any(axis=1)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.cumsum(new) - 1
        once = order[new]
        low, high = np.full(len(once), np.iinfo(np.int64).max), np.full(len(once), _NO_ID)
        np.minimum.at(low, place, least)
        np.maximum.at(high, place, most)
        return answers(table, key[0].as_py(), counts, place, words[once], size[once], low, high)

    def answers(table, part, counts, place, words, size, low, high) -> pa.Table:
        content, at, left, common = suffix_array(words, size, length)
        before = np.where(at > 0, words[content, np.maximum(at - 1, 0)].astype(np.int64), -1)
        found = intervals(left, common, before, low[content], high[content], length)
        # Whole contents that no other content shares a window with are leaves, which the array leaves out.
        alone = np.ones(len(size), dtype=bool)
        alone[content[at == 0]] = False
        alone = np.flatnonzero(alone & (low != high))
        first, last, deep, doc = np.array(found, dtype=np.int64).reshape(-1, 4).T
        many = last - first + 1
        member = np.repeat(first, many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        columns = [np.concatenate(x) for x in (
            (content[member], alone), (at[member], np.zeros(len(alone), dtype=np.int64)),
            (np.repeat(deep, many), size[alone].astype(np.int64)),
            (np.repeat(np.arange(len(first)), many), len(first) + np.arange(len(alone))),
            (np.repeat(doc, many), low[alone]))]
        order = np.argsort(columns[0], kind="stable")
        of, at, deep, group, doc = (x[order] for x in columns)
        begin = np.searchsorted(of, np.arange(len(size) + 1))
        out = []
        for chunk, a, b in zip(table.column("chunk").to_pylist(), np.cumsum(counts) - counts, np.cumsum(counts)):
            own = place[a:b]
            n = begin[own + 1] - begin[own]
            rows = np.repeat(begin[own], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            if len(rows):
                out.append((chunk, part, np.repeat(np.arange(b - a), n).astype("<u4").tobytes(), at[rows].astype("u1").tobytes(),
                            deep[rows].astype("<u2").tobytes(), group[rows].astype("<u4").tobytes(), doc[rows].tobytes()))
        return table_of("chunk part content at length group first_doc", tuple(zip(*out)) if out else ([],) * 7,
                        [_LONG, _LONG, *[_BLOB] * 5])

    sent = chunks.groupBy("chunk").cogroup(anchors.groupBy("chunk")).applyInArrow(
        lambda a, b: send(a, b) if len(a) else nothing("chunk part size least most text", 2, 4),
        "chunk long, part long, size binary, least binary, most binary, text binary")
    return written(sent.groupBy("part").applyInArrow(
        meet, "chunk long, part long, content binary, at binary, length binary, group binary, first_doc binary"),
        "repeat-groups")


def nothing(names: str, longs: int, blobs_: int) -> pa.Table:
    return table_of(names, ([],) * (longs + blobs_), [*[_LONG] * longs, *[_BLOB] * blobs_])


Occurrences = tuple[np.ndarray, ...]


def per_chunk(docs: DataFrame, length: int, each: Callable[[np.ndarray, np.ndarray, np.ndarray, Occurrences], pa.Table],
              schema: str, hot: int = HOT, group_segments: int = GROUP_SEGMENTS) -> DataFrame:
    """`each` of (doc_id, bytes, offsets, occurrences of repeats) over all chunks of the documents.

    Occurrences: row, start in the bytes, length, group, part of the group, smallest document of the group.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"),
                       F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b"")).alias("text"),
                       F.monotonically_increasing_id().alias("at"))
    count, total = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    total = total or 0
    held = max(1, int(CHUNK_BYTES * count / max(1, total)))
    rows = rows.withColumn("chunk", F.floor(F.col("at") / held).cast("long"))
    parts = max(1, -(-total // (17 * PART_ANCHORS)))
    with bucketed(rows, "repeat_documents", "chunk", max(1, -(-total // BUCKET_BYTES))) as chunks:
        anchors = shared_anchors(chunks, length, parts, hot)
        groups = max(1, -(-(anchors.agg(F.sum("n")).first()[0] or 0) // group_segments))
        found = interval_groups(chunks, anchors, length, parts, groups)
        told = anchors.select("chunk", "part", "shared", "hot", *(F.lit(None).cast("binary").alias(c) for c in (
            "content", "at", "length", "group", "first_doc"))).unionByName(found, allowMissingColumns=True)

        def finish(docs_: pa.Table, told_: pa.Table) -> pa.Table:
            ids, data, offsets = texts_of(docs_)
            segments = Segments(data, offsets, length)
            own, answer = [], []
            for r in told_.to_pylist():
                (own if r["content"] is None else answer).append(r)
            shared = Shared(ids, segments, [(r["part"], r["shared"], r["hot"]) for r in own], parts, groups)
            base = {p: i for p, i in zip(*np.unique(shared.part, return_index=True))}
            kinds = {"content": "<u4", "at": "u1", "length": "<u2", "group": "<u4", "first_doc": "<i8"}
            got = {c: np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r[c], dtype=k).astype(np.int64) for r in answer)])
                   for c, k in kinds.items()}
            many = [len(r["at"]) for r in answer]
            part = np.repeat(np.array([r["part"] for r in answer], dtype=np.int64), many)
            content = got["content"] + np.repeat(np.array([base[r["part"]] for r in answer], dtype=np.int64), many)
            order = np.argsort(content, kind="stable")
            begin = np.searchsorted(content[order], np.arange(len(shared.part) + 1))
            n = (begin[1:] - begin[:-1])[shared.place]
            of = order[np.repeat(begin[shared.place], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]
            return each(ids, data, offsets, (
                np.repeat(shared.row, n), np.repeat(shared.start, n) + got["at"][of], got["length"][of], got["group"][of],
                part[of], got["first_doc"][of]))

        empty = pa.schema([(name, {"string": pa.string(), "long": _LONG}[kind])
                           for name, kind in (x.split() for x in schema.split(", "))])
        return written(chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
            lambda a, b: finish(a, b) if len(a) else empty.empty_table(), schema), "repeats")


def repeat_groups(docs: DataFrame, length: int = LENGTH, **limits: int) -> DataFrame:
    """All occurrences of each group: part and group (together its name), length, doc_id, start (in bytes).

    A row that occurs twice gives its occurrences twice.
    """
    def each(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, found: Occurrences) -> pa.Table:
        row, start, size, group, part, _ = found
        return table_of("part group length doc_id start", (part, group, size, ids[row], start - offsets[row]), [_LONG] * 5)

    out = per_chunk(docs, length, each, "part long, group long, length long, doc_id long, start long", **limits)
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))


def merged(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges that overlap or touch in one row, as one."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], np.maximum.accumulate(end[order]) if len(order) else end
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(new)
    return row[first], start[first], end[np.append(first[1:], len(row)) - 1] if len(row) else end


def without_repeats(docs: DataFrame, length: int = LENGTH, texts: bool = False, **limits: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row without the bytes under repeats of smaller documents;
    with `texts` also kept, the bytes left as text (a character cut in two reads as U+FFFD)."""
    def each(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, found: Occurrences) -> pa.Table:
        row, start, size, _, _, first = found
        mine = first < ids[row]
        row, start, end = merged(row[mine], start[mine], start[mine] + size[mine])
        removed = np.bincount(row, weights=end - start, minlength=len(ids)).astype(np.int64)
        at, shas, kept, whole = np.searchsorted(row, np.arange(len(ids) + 1)), [], [], memoryview(data)
        for i in range(len(ids)):
            own = slice(at[i], at[i + 1])
            edges = [offsets[i], *np.stack([start[own], end[own]], axis=1).ravel(), offsets[i + 1]]
            left = b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            shas.append(hashlib.sha256(left).hexdigest())
            if texts:
                kept.append(left.decode(errors="replace"))
        out = table_of("doc_id n_bytes n_removed n_spans kept_sha256", (ids, np.diff(offsets), removed, np.diff(at), shas),
                       [*[_LONG] * 4, pa.string()])
        return out.append_column("kept", pa.array(kept, type=pa.string())) if texts else out

    out = per_chunk(docs, length, each, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                    + ", kept string" * texts, **limits)
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))


def query(docs: DataFrame) -> DataFrame:
    return without_repeats(docs)


# Windows as hexadecimal digits: DuckDB has no slices of blobs.
SQL = f"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
windows AS (SELECT doc_id, p, substr(x, 2 * p + 1, {2 * LENGTH}) AS w
            FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - {LENGTH - 1})) AS p FROM docs)),
least AS (SELECT w, min(doc_id) AS m FROM windows GROUP BY w HAVING count(*) > 1),
hit AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {LENGTH} THEN 0 ELSE 1 END AS new
        FROM windows JOIN least USING (w) WHERE m < doc_id),
spans AS (SELECT doc_id, min(p) AS a, max(p) + {LENGTH} AS b
          FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM hit) GROUP BY doc_id, span),
cuts AS (SELECT doc_id, a, b, 1 AS n FROM spans UNION ALL SELECT doc_id, length(x) // 2, length(x) // 2, 0 FROM docs),
left_over AS (SELECT doc_id, a, b, n, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a, b), 0) AS after FROM cuts)
SELECT doc_id, CAST(length(any_value(x)) // 2 AS BIGINT) AS n_bytes, CAST(sum(b - a) AS BIGINT) AS n_removed,
       CAST(sum(n) AS BIGINT) AS n_spans,
       sha256(unhex(string_agg(substr(x, 2 * after + 1, 2 * (a - after)), '' ORDER BY a, b))) AS kept_sha256
FROM left_over JOIN docs USING (doc_id) GROUP BY doc_id
"""
