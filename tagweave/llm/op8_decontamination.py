"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

The automaton holds every run of words of every item. Documents stream through it word by word; at each word it knows
the longest run ending there that some item holds. Where that is a window (10 words, or all of a shorter item), the
words of the window are hit. Before that, a numpy pass over hashed words drops what can't be part of a hit: a run of
words counts only if each two neighbours stand next to each other in some item.

Items are bounded per automaton: more of them than ITEM_WORDS words make several automata, each streamed over all
documents, one after the other, with the hits so far carried along in a written table.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.batches import ALNUM, LOWER, Words, chunks
from tagweave.llm.tables import put_back, set_aside, written

WINDOW = 10
ITEM_WORDS = 1_000_000


def text_words(text: str | None) -> tuple[Words, np.ndarray]:
    data = LOWER[np.frombuffer((text or "").encode(), dtype=np.uint8)]
    words = Words(data, np.array([0, len(data)]), ALNUM)
    return words, words.hashes()


class SuffixAutomaton:
    """Over runs of words (as integers) of several sequences; no run crosses from one into the next."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
                continue
            new, p = self._state(self.length[last] + 1, {}, 0), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            last = new

    def stream(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest run ending at each word."""
        state, length = 0, 0
        following, link, lengths = self.next, self.link, self.length
        for word in words:
            q = following[state].get(word)
            while q is None and state:
                state = link[state]
                length = lengths[state]
                q = following[state].get(word)
            if q is not None:
                state, length = q, length + 1
            yield state, length


class ItemIndex:
    """The automaton of some items, with the windows each state ends and the items that hold them."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.window, self.automaton = window, SuffixAutomaton()
        texts = [(name, text_words(text)[1].tolist()) for name, text in items]
        texts = [(name, words) for name, words in texts if words]
        self.least = min((min(len(w), window) for _, w in texts), default=1)
        vocabulary = {word: None for _, words in texts for word in words}
        self.known = np.sort(np.fromiter(vocabulary, dtype=np.uint64, count=len(vocabulary)))
        pairs = {(a, b) for _, words in texts for a, b in zip(words, words[1:])}
        first = np.array([a for a, _ in pairs], dtype=np.uint64)
        second = np.array([b for _, b in pairs], dtype=np.uint64)
        self.pairs = np.unique(self.pair(first, second))
        for _, words in texts:
            self.automaton.add(words)
        # Windows end in these states: by state, (length of the window, items).
        self.ends: dict[int, dict[int, set[str]]] = {}
        for name, words in texts:
            size = min(window, len(words))
            for i, (state, length) in enumerate(self.automaton.stream(words)):
                if i + 1 >= size:
                    self.ends.setdefault(self.shortest(state, length, size), {}).setdefault(size, set()).add(name)

    @staticmethod
    def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1))

    def shortest(self, state: int, length: int, size: int) -> int:
        """The state of the last `size` words of a run."""
        link, lengths = self.automaton.link, self.automaton.length
        while lengths[link[state]] >= size:
            state = link[state]
        return state

    def windows(self, words: list[int]) -> Iterator[tuple[int, int, set[str]]]:
        """(place of the last word, size, items) of each window in the words."""
        link, lengths = self.automaton.link, self.automaton.length
        for i, (state, length) in enumerate(self.automaton.stream(words)):
            while state > 0:
                found = self.ends.get(state)
                if found:
                    for size, items in found.items():
                        if size <= length:
                            yield i, size, items
                state = link[state]
                length = min(length, lengths[state])
                if length < self.least:
                    break

    def runs(self, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and word after the last of the runs that may hold a window."""
        if not len(hashes) or not len(self.known):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        known = self.known[at] == hashes
        both = known[:-1] & known[1:]
        both[words.first[1:-1][(words.first[1:-1] > 0) & (words.first[1:-1] < len(hashes))] - 1] = False
        where = np.flatnonzero(both)
        if len(where) and len(self.pairs):
            codes = self.pair(hashes[where], hashes[where + 1])
            at = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
            both[where[self.pairs[at] != codes]] = False
        elif not len(self.pairs):
            both[:] = False
        tied = np.concatenate([[False], both, [False]])
        starts = np.flatnonzero(known & ~tied[:-1])
        ends = np.flatnonzero(known & ~tied[1:]) + 1
        enough = ends - starts >= self.least
        return starts[enough], ends[enough]


def item_blocks(benchmark: DataFrame, most: int = ITEM_WORDS) -> Iterator[list[tuple[str, str]]]:
    """Items by id, in blocks of about `most` words, one block at a time on the driver. Equal texts are one item each."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             F.coalesce("text", F.lit("")).alias("text")).distinct()
    block, n = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        size = len(row["text"]) // 2 + 1
        if block and n + size > most:
            yield block
            block, n = [], 0
        block.append((row["item_id"], row["text"]))
        n += size
    yield block


HITS = "n_words long, hit_starts array<long>, hit_ends array<long>, items array<string>"


def scanned(docs: DataFrame, blocks: Iterator[list[tuple[str, str]]], window: int = WINDOW) -> DataFrame:
    """The columns of docs with n_words, the hit words (ranges of word numbers, apart from each other) and the items."""
    fields = [f for f in docs.schema]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    state, spark = docs, docs.sparkSession
    for number, block in enumerate(blocks):
        if number:
            state = written(state, "decontamination-block")
        shared = spark.sparkContext.broadcast(ItemIndex(block, window))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared, again=number > 0) -> Iterator[pa.RecordBatch]:
            index: ItemIndex = shared.value
            for batch in batches:
                counts, starts, ends, names = [], [], [], []
                for low, high, data, offsets in chunks(batch):
                    words = Words(LOWER[data], offsets, ALNUM)
                    hashes = words.hashes()
                    counts.append(words.counts)
                    spans: list[list[tuple[int, int]]] = [[] for _ in range(high - low)]
                    held: list[set[str]] = [set() for _ in range(high - low)]
                    if again:
                        for i in range(high - low):
                            spans[i] = list(zip(batch.column("hit_starts")[low + i].as_py(),
                                                batch.column("hit_ends")[low + i].as_py(), strict=True))
                            held[i] = set(batch.column("items")[low + i].as_py())
                    firsts, lasts = index.runs(words, hashes)
                    owners = np.searchsorted(words.first, firsts, side="right") - 1
                    for a, b, doc in zip(firsts.tolist(), lasts.tolist(), owners.tolist(), strict=True):
                        base = a - int(words.first[doc])
                        for i, size, items in index.windows(hashes[a:b].tolist()):
                            spans[doc].append((base + i + 1 - size, base + i + 1))
                            held[doc] |= items
                    for own, items in zip(spans, held, strict=True):
                        merged: list[list[int]] = []
                        for a, b in sorted(own):
                            if merged and a <= merged[-1][1]:
                                merged[-1][1] = max(merged[-1][1], b)
                            else:
                                merged.append([a, b])
                        starts.append([a for a, _ in merged])
                        ends.append([b for _, b in merged])
                        names.append(sorted(items))
                total = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(f.name) for f in fields), pa.array(total.astype(np.int64)),
                     pa.array(starts, type=pa.list_(pa.int64())), pa.array(ends, type=pa.list_(pa.int64())),
                     pa.array(names, type=pa.list_(pa.string()))],
                    names=[*(f.name for f in fields), "n_words", "hit_starts", "hit_ends", "items"])

        state = state.mapInArrow(scan, f"{kinds}, {HITS}")
    return state


def n_hit() -> Column:
    return F.aggregate(F.zip_with("hit_starts", "hit_ends", lambda a, b: b - a), F.lit(0).cast("long"),
                       lambda a, x: a + x)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each document.

    Null or empty text: no words, no hits. Null item text: never occurs; null item_id: written as an empty string.
    Repeated items of one id count once. Repeated documents: each its own row. Empty benchmark: no hits; empty
    documents: no rows. Other columns are not read.
    """
    found = scanned(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")
                                .alias("text")), item_blocks(benchmark))
    return found.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"))


def cleaned(docs: DataFrame, benchmark: DataFrame, most_share: float = 0.5, n_chars: str = "n_chars") -> DataFrame:
    """The documents without their hit spans; one of which more than `most_share` of the words is hit goes.

    A span goes with the characters between its words. Documents without a hit stay as they are, null and empty texts
    among them. Repeated rows are cut alike, each of its own. Empty benchmark: all stay; empty documents: no rows. Columns
    of any name come back unchanged, but for the text and its `n_chars`.
    """
    rows, names = set_aside(docs)
    text = names[docs.columns.index("text")]
    found = scanned(rows.withColumn("text", F.col(text).cast("string")), item_blocks(benchmark))
    left = found.where(n_hit() <= most_share * F.col("n_words")).select(*names, "hit_starts", "hit_ends")
    schema = found.select(*names).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ends = batch.column(text).to_pylist(), batch.column("hit_ends")
            for i, starts in enumerate(batch.column("hit_starts").to_pylist()):
                if starts:
                    raw = texts[i].encode()
                    words, _ = text_words(texts[i])
                    parts, at = [], 0
                    for a, b in zip(starts, ends[i].as_py(), strict=True):
                        parts.append(raw[at:words.starts[a]])
                        at = int(words.ends[b - 1])
                    texts[i] = b"".join([*parts, raw[at:]]).decode()
            columns = {n: batch.column(n) for n in names} | {text: pa.array(texts, type=pa.string())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    out = put_back(left.mapInArrow(cut, schema), docs)
    if n_chars in docs.columns:
        out = out.withColumn(n_chars, F.length("text").cast(docs.schema[n_chars].dataType))
    return out


query = contaminated

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
# The run of k words from each word on; null where the text ends before.
_RUNS = ", ".join(f"{'word' if k == 1 else f'r{k - 1} || chr(32) || lead(word, {k - 1}) OVER own'} AS r{k}"
                  for k in range(1, WINDOW + 1))
SQL = f"""WITH item_words AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_WORDS} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS run FROM (
  SELECT item_id, w, least(len(w), {WINDOW}) AS k, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i
  FROM item_words WHERE len(w) > 0)),
doc_words AS (SELECT row_number() OVER () AS place, doc_id, {_WORDS} AS w FROM documents),
said AS (SELECT place, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM doc_words),
after AS (SELECT place, i, {_RUNS} FROM said WINDOW own AS (PARTITION BY place ORDER BY i)),
runs AS (SELECT place, i, unnest(range(1, {WINDOW} + 1)) AS k, unnest([{", ".join(f"r{k}" for k in range(1, WINDOW + 1))}]) AS run
  FROM after),
found AS (SELECT place, i, k, item_id FROM runs JOIN windows USING (k, run)),
hits AS (SELECT place, count(DISTINCT p) AS n_hit FROM (SELECT place, unnest(range(i, i + k)) AS p FROM found) GROUP BY place),
held AS (SELECT place, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items
  FROM found GROUP BY place)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc_words LEFT JOIN hits USING (place) LEFT JOIN held USING (place)"""
