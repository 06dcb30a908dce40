"""Language by nearest centroid: TF-IDF vectors of character n-grams against several centroids per language.

Runs of one to three bytes of the lower-cased text are hashed to DIMENSIONS buckets; a text's vector holds
1 + log(count), times the inverse document frequency, at length one. Document frequencies come from all training
documents. Centroids are clustered within each language (spherical k-means) on a sample of about FIT_ROWS training
documents in all: every one of the rarer languages, and of the others as many each as that leaves. A text gets the language of the nearest centroid by cosine; one nearer to none than REJECT is marked
rejected but keeps its nearest language.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.batches import ASCII_LETTER, LOWER, chunks
from tagweave.llm.tables import remainder, written

DIMENSIONS = 4096
CENTROIDS = 3
ROUNDS = 4
FIT_ROWS = 20_000
LEAST_ROWS = 64
REJECT = 0.15
HELD_OUT = (5, 0)
ROWS = 256


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts (texts x DIMENSIONS) of hashed runs of one, two and three bytes, white space as one kind of byte."""
    low = LOWER[data].astype(np.uint32)
    low[low <= 0x20] = 0x20
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))
    total = np.zeros((len(offsets) - 1) * DIMENSIONS, dtype=np.int32)
    code = np.zeros(len(low), dtype=np.uint32)
    for n in range(1, 4):
        if len(low) < n:
            break
        code = low[n - 1:] if n == 1 else code[:-1] * np.uint32(257) + low[n - 1:]
        whole = doc[:len(code)] == doc[n - 1:]
        bucket = ((code * np.uint32(2654435761) + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) >> np.uint32(20)).astype(np.int64)
        total += np.bincount((doc[:len(code)] * DIMENSIONS + bucket)[whole], minlength=len(total)).astype(np.int32)
    return total.reshape(-1, DIMENSIONS)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.log1p(counts, dtype=np.float32) * idf
    norm = np.sqrt(np.square(out).sum(axis=1, keepdims=True))
    return out / np.maximum(norm, 1e-12)


def training(docs: DataFrame) -> DataFrame:
    of, held = HELD_OUT
    return docs.where(F.col("lang").isNotNull() & (remainder("doc_id", of) != held)).select(
        F.col("lang").cast("string").alias("lang"), "text", F.col("doc_id").cast("string").alias("name"))


def frequencies(docs: DataFrame) -> np.ndarray:
    """Inverse document frequencies over all training documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(DIMENSIONS, dtype=np.int64), 0
        for batch in batches:
            for low, high, data, offsets in chunks(batch, rows=ROWS):
                found += (grams(data, offsets) > 0).sum(axis=0)
                n += high - low
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIMENSIONS)), pa.array(np.concatenate([[n], found]))],
                                             names=["bucket", "n"])

    counts = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = np.zeros(DIMENSIONS + 1)
    for r in counts.collect():
        found[r["bucket"]] = r["n"]
    n = int(found[-1])
    return (np.log((n + 1) / (found[:-1] + 1)) + 1).astype(np.float32)


def assigned(batches: Iterator[pa.RecordBatch], idf: np.ndarray, centres: dict[str, np.ndarray]
             ) -> Iterator[pd.DataFrame]:
    """Sums of the vectors of each language by their nearest centroid, one row for each centroid of the partition."""
    sums: dict[tuple[str, int], np.ndarray] = {}
    sizes: dict[tuple[str, int], int] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        keys = batch.column("seed").to_pylist()
        for low, high, data, offsets in chunks(batch, rows=ROWS):
            own = vectors(grams(data, offsets), idf)
            for i in range(high - low):
                lang = langs[low + i]
                k = int(np.argmax(centres[lang] @ own[i])) if centres else keys[low + i] % CENTROIDS
                if (lang, k) not in sums:
                    sums[lang, k], sizes[lang, k] = np.zeros(DIMENSIONS), 0
                sums[lang, k] += own[i]
                sizes[lang, k] += 1
    if sums:
        yield pd.DataFrame([(lang, k, total.astype("<f8").tobytes(), sizes[lang, k]) for (lang, k), total in sums.items()],
                           columns=["lang", "k", "total", "n"])


def rows_each(sizes: list[int], fit_rows: int) -> int:
    """Rows to take of each language at most, so that all take about `fit_rows`; LEAST_ROWS at least."""
    left, most = fit_rows, 0
    for i, n in enumerate(sorted(sizes)):
        most = left // (len(sizes) - i)
        if n > most:
            break
        left, most = left - n, n
    return max(most, LEAST_ROWS)


def sampled(docs: DataFrame, fit_rows: int) -> DataFrame:
    """Training rows chosen by hash, each language with a share of its own."""
    counts = docs.groupBy("lang").agg(F.count("*").alias("n"))
    most = rows_each([r["n"] for r in counts.collect()], fit_rows)
    shares = counts.select("lang", F.least(F.lit(1.0), F.lit(float(most)) / F.col("n")).alias("share"))
    hashed = F.pmod(F.xxhash64("name", "text"), F.lit(1 << 50)) / float(1 << 50)
    return docs.join(F.broadcast(shares), "lang").where(hashed < F.col("share")).drop("share")


def centroids(docs: DataFrame, idf: np.ndarray, fit_rows: int = FIT_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and unit centroids (one language may have several rows)."""
    sample = written(sampled(docs, fit_rows).withColumn(
        "seed", F.pmod(F.xxhash64("text"), F.lit(CENTROIDS)).cast("int")).drop("name"), "language-sample")
    centres: dict[str, np.ndarray] = {}
    for _ in range(ROUNDS):
        def add(batches: Iterator[pa.RecordBatch], centres=centres) -> Iterator[pa.RecordBatch]:
            for frame in assigned(batches, idf, centres):
                yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

        def total(group: pd.DataFrame) -> pd.DataFrame:
            found = sum(np.frombuffer(x, dtype="<f8") for x in group["total"])
            return pd.DataFrame({"lang": group["lang"].iloc[:1], "k": group["k"].iloc[:1],
                                 "total": [found.astype("<f4").tobytes()]})

        parts = sample.mapInArrow(add, "lang string, k long, total binary, n long")
        new: dict[str, np.ndarray] = {}
        for r in parts.groupBy("lang", "k").applyInPandas(total, "lang string, k long, total binary").collect():
            own = new.setdefault(r["lang"], np.zeros((CENTROIDS, DIMENSIONS), dtype=np.float32))
            own[r["k"]] = np.frombuffer(r["total"], dtype="<f4")
        centres = {lang: own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-12) for lang, own in new.items()}
    langs = [lang for lang in sorted(centres) for _ in range(CENTROIDS)]
    return langs, np.concatenate([centres[x] for x in sorted(centres)]) if centres else np.zeros((0, DIMENSIONS))


def languages(docs: DataFrame, fit_rows: int = FIT_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, lang_pred, score (cosine to the nearest centroid), rejected.

    Null text or text without a letter: und, score 0, rejected. Nothing to learn from: the same for all. Rows with a
    null language are predicted, not learnt from. Repeated rows: each its own result. Empty table: no rows.
    """
    train = training(docs)
    idf = frequencies(train)
    langs, centres = centroids(train, idf, fit_rows)
    model = docs.sparkSession.sparkContext.broadcast((langs, centres.astype(np.float32), idf))
    of, held = HELD_OUT
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder("doc_id", of) == held).alias("held_out"),
                       "text", *keep)
    fields = [f for f in rows.schema if f.name not in ("text",)]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs_, centres_, idf_ = model.value
        for batch in batches:
            names, scores = [], []
            for low, high, data, offsets in chunks(batch, rows=ROWS):
                letters = np.add.reduceat(np.append(ASCII_LETTER[data], False).astype(np.int32), offsets[:-1]) * (
                    np.diff(offsets) > 0)
                near = vectors(grams(data, offsets), idf_) @ centres_.T if langs_ else np.zeros((high - low, 1))
                best = near.argmax(axis=1)
                for i in range(high - low):
                    told = bool(langs_) and (letters[i] > 0 or any(
                        c.isalpha() for c in bytes(data[offsets[i]:offsets[i + 1]]).decode()))
                    names.append(langs_[best[i]] if told else "und")
                    scores.append(float(min(max(near[i, best[i]], 0.0), 1.0)) if told else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in fields), pa.array(names, type=pa.string()),
                 pa.array(scores, type=pa.float64()), pa.array([s < REJECT for s in scores], type=pa.bool_())],
                names=[*(f.name for f in fields), "lang_pred", "score", "rejected"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    out = rows.mapInArrow(predict, f"{kinds}, lang_pred string, score double, rejected boolean")
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected", *keep)


query = languages
