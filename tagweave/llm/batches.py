"""Words of Arrow text batches as numpy arrays: one pass over the bytes of many texts at a time.

UTF-8 keeps ASCII bytes apart from all others, so classes of ASCII characters can be told byte by byte.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
CHUNK_ROWS = 4096

_BYTES = np.arange(256)
WHITE = (_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))
NOT_WHITE = ~WHITE
# Letters (lower case), digits and everything beyond ASCII.
ALNUM = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
ASCII_LETTER = ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
LOWER = _BYTES.astype(np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them (the finisher of splitmix64)."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_NEAR = 64
_TABLE = mix(np.arange(_NEAR * 256, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))


class Words:
    """The words of some texts: byte ranges in `data`, and for each text where its words begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, cuts: np.ndarray | None = None):
        """`cuts`: positions at which a word is cut in two."""
        self.data, self.offsets = data, offsets
        inside = table[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        if cuts is not None:
            edge[cuts] = True
        before = np.empty(len(data) + 1, dtype=bool)
        before[0], before[1:] = False, inside
        after = np.zeros(len(data) + 1, dtype=bool)
        after[:-1] = inside
        self.starts = np.flatnonzero(after & (edge | ~before))
        self.ends = np.flatnonzero(before & (edge | ~after))
        self.inside = inside
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, from each byte and its place in the word."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        lengths = self.ends - self.starts
        at = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
        codes = place * 256 + self.data[self.inside]
        if lengths.max() <= _NEAR:
            parts = _TABLE[codes]
        else:
            parts = mix(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        return mix(np.add.reduceat(parts, at))

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def chunks(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES, rows: int = CHUNK_ROWS
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of texts of about `most` bytes; a null is an empty text.

    A text is never cut: one longer than `most` makes a run of its own.
    """
    if not batch.num_rows:
        return
    texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, min(int(np.searchsorted(ends, ends[low] + most, side="right")) - 1, low + rows))
        yield low, high, data[ends[low]:ends[high]], ends[low:high + 1] - ends[low]
        low = high
