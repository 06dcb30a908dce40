"""Quality rules by robust multivariate outliers: minimum covariance determinant per language and source.

Each document gives a vector of transformed text statistics. For each group of language and source, two robust starts
are improved by concentration steps: distances under the present centre and scatter, then centre and scatter anew from
the nearest share of the rows. The start whose scatter ends with the smaller determinant wins, its scatter is made
consistent for normal rows and estimated once more from all rows that are no outliers. A document is rejected if its
squared Mahalanobis distance lies beyond the cutoff.

A step is one aggregation of the vectors' moments by group and bin of distance: what meets in one task is the bins of
a group, never its rows. The nearest share is rounded up to a whole bin.

Floors keep the scatter of a statistic that hardly varies (say, no symbols at all) from rejecting a trifle.
"""

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.tables import put_back, set_aside, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeats")
# Least standard deviation that a transformed statistic is taken to have. With TAIL, each share alone rejects from
# (0.1 * 6.57) ** 2 = 0.43 on where the group has none: below the base limit of repeats, and within the other ranges.
FLOORS = (0.5, 0.35, 0.1, 0.1, 0.1)
SHARE = 0.75
STEPS = 4
BINS = 64
MIN_ROWS = 60
# The estimate over all rows, for languages with under MIN_ROWS sound rows. It takes only the statistics that no
# language sets: length and spelling of words are not compared across languages.
POOLED = "all"
COMMON = [FEATURES.index(x) for x in ("symbols", "dup_lines", "repeats")]
# Chance that a normal row of five statistics lies beyond the cutoff.
TAIL = 1e-7

STATS = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         "base_failed boolean, n_lines long")


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    n, end = 0, 0
    for i, window in enumerate(windows):
        if seen[window] > 1:
            n += i + 3 - max(i, end)
            end = i + 3
    return n


def text_stats(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    data = text.encode()
    words = data.split()
    joined = b"".join(words)
    chars = len(joined) if text.isascii() else len(joined.decode())
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    return (len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words),
            len(lines))


def stats(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The base statistics of each document, with the group as JSON text, in which null differs from any name."""
    group = F.to_json(F.array(F.col("lang").cast("string"), F.col("source").cast("string")))
    language = F.to_json(F.array(F.col("lang").cast("string")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", group.alias("_group"),
                       language.alias("_lang"), *keep)
    extra = [f for f in rows.schema if f.name not in ("doc_id", "text")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([text_stats(x.as_py()) for x in batch.column("text")], dtype=np.int64).reshape(-1, 6)
            failed = (found[:, 0] < MIN_WORDS) | (100 * found[:, 4] > 50 * found[:, 0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(found[:, i]) for i in range(5)), pa.array(failed),
                 pa.array(found[:, 5]), *(batch.column(f.name) for f in extra)],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       "n_lines", *(f.name for f in extra)])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)
    return rows.mapInArrow(count, f"{STATS}, {kinds}")


def vectors(found: DataFrame) -> DataFrame:
    """Adds the transformed statistics; shares become the square root, which evens out the scatter of small ones."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return found.select(
        "*", F.log(words.cast("double")).alias("log_words"),
        (F.col("word_chars") / words).alias("word_length"),
        F.sqrt(F.least(F.col("n_symbols") / words, F.lit(1.0))).alias("symbols"),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("dup_lines"),
        F.sqrt(F.col("n_repeat_words") / words).alias("repeats"))


def chi2(p_tail: float, df: int) -> float:
    """Upper quantile of chi-squared, after Wilson and Hilferty."""
    low, high = 0.0, 40.0
    for _ in range(80):
        z = (low + high) / 2
        low, high = (z, high) if 0.5 * math.erfc(z / math.sqrt(2)) > p_tail else (low, z)
    return df * (1 - 2 / (9 * df) + low * math.sqrt(2 / (9 * df))) ** 3


def fitted(group: str, centre: np.ndarray, scatter: np.ndarray) -> tuple[list[float], list[float], float]:
    """Centre, inverse scatter (flat) and log determinant, with the floors on the scatter's diagonal.

    Of the pooled group only the common statistics are inverted; the others count nothing in a distance.
    """
    short = np.maximum(np.square(FLOORS) - np.diag(scatter), 0)
    scatter = scatter + np.diag(short)
    taken = np.ix_(COMMON, COMMON) if group == POOLED else np.ix_(range(len(FEATURES)), range(len(FEATURES)))
    inverse = np.zeros_like(scatter)
    inverse[taken] = np.linalg.inv(scatter[taken])
    return [*map(float, centre)], [*map(float, inverse.ravel())], float(np.linalg.slogdet(scatter[taken])[1])


def moments() -> list:
    pairs = [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[i:]]
    return [F.count("*").alias("n"), *(F.sum(x).alias(x) for x in FEATURES),
            *(F.sum(F.col(a) * F.col(b)).alias(f"{a}__{b}") for a, b in pairs)]


def centre_scatter(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    total = rows.drop(columns=["fit_group", "start", "bin"], errors="ignore").sum()
    n = total["n"]
    centre = np.array([total[x] / n for x in FEATURES])
    scatter = np.empty((len(FEATURES),) * 2)
    for i, a in enumerate(FEATURES):
        for j in range(i, len(FEATURES)):
            scatter[i, j] = scatter[j, i] = total[f"{a}__{FEATURES[j]}"] / n - centre[i] * centre[j]
    return centre, scatter, int(n)


def consistency(share: float) -> float:
    """What the scatter of the nearest `share` of normal rows must be multiplied by."""
    p = len(FEATURES)
    inside = chi2(1 - share, p)
    # The share of chi-squared with two more degrees below the same bound, by the quantile's inverse.
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2(max(1 - mid, 1e-12), p + 2) < inside else (low, mid)
    return share / max(low, 1e-6)


PARAMS = "fit_group string, start int, centre array<double>, inverse array<double>, logdet double, n long"


def distance():
    """Squared Mahalanobis distance under centre and inverse."""
    away = [F.col(x) - F.col("centre")[i] for i, x in enumerate(FEATURES)]
    p = len(FEATURES)
    total = None
    for i in range(p):
        for j in range(p):
            term = away[i] * away[j] * F.col("inverse")[i * p + j]
            total = term if total is None else total + term
    return F.greatest(total, F.lit(0.0))


def fit_groups(sound: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """_group, fit_group: the group itself, its whole language where it has under `min_rows` sound rows, or POOLED
    where the language has under `min_rows` too.
    """
    sizes = sound.groupBy("_group", "_lang").agg(F.count("*").alias("n"))
    languages = sizes.groupBy("_lang").agg(F.sum("n").alias("all"))
    return sizes.join(languages, "_lang").select(
        "_group", F.when(F.col("n") >= min_rows, F.concat(F.lit("g"), "_group"))
        .when(F.col("all") >= min_rows, F.concat(F.lit("l"), "_lang"))
        .otherwise(POOLED).alias("fit_group"))


def estimates(rows: DataFrame) -> DataFrame:
    """Centre and inverse scatter of each fit_group, from its rows; `rows` must be a written table."""
    marks = rows.groupBy("fit_group").agg(
        F.count("*").alias("n"),
        *(F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(x) for x in FEATURES))

    def starts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for r in frame.itertuples(index=False):
                marks_ = np.array([list(getattr(r, x)) for x in FEATURES])
                # The second start takes no notice of statistics on which most rows agree.
                spread = np.square((marks_[:, 2] - marks_[:, 0]) / 1.349)
                for start, scale in enumerate((spread, np.maximum(spread, np.square(FLOORS) * 4))):
                    centre, inverse, logdet = fitted(r.fit_group, marks_[:, 1], np.diag(scale))
                    out.append((r.fit_group, start, centre, inverse, logdet, r.n))
            yield pd.DataFrame(out, columns=["fit_group", "start", "centre", "inverse", "logdet", "n"])

    def step(share: float, scale: float):
        def concentrate(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("bin")
            inside = group["n"].cumsum().shift(fill_value=0) < share * group["n"].sum()
            centre, scatter, _ = centre_scatter(group[inside])
            name = group["fit_group"].iloc[0]
            centre, inverse, logdet = fitted(name, centre, scatter * scale)
            return pd.DataFrame([(name, group["start"].iloc[0], centre, inverse, logdet,
                                  int(group["n"].sum()))],
                                columns=["fit_group", "start", "centre", "inverse", "logdet", "n"])
        return concentrate

    params = written(marks.mapInPandas(starts, PARAMS), "mcd-start")
    for i in range(STEPS):
        near = rows.join(params.drop("n"), "fit_group")
        near = near.withColumn("bin", F.floor(F.log(distance() + 0.01) * 8).cast("int"))
        near = near.withColumn("bin", F.least(F.greatest(F.col("bin"), F.lit(-BINS)), F.lit(3 * BINS)))
        scale = consistency(SHARE) if i == STEPS - 1 else 1.0
        params = written(near.groupBy("fit_group", "start", "bin").agg(*moments()).groupBy("fit_group", "start")
                         .applyInPandas(step(SHARE, scale), PARAMS), "mcd-step")
    best = params.groupBy("fit_group").agg(
        F.min_by(F.struct("centre", "inverse"), F.struct("logdet", "start")).alias("best")).select(
            "fit_group", "best.*", F.lit(0).alias("start"))
    inner = rows.join(best, "fit_group").where(distance() <= chi2(0.025, len(FEATURES)))
    return written(inner.groupBy("fit_group", "start").agg(*moments(), F.lit(0).alias("bin"))
                   .groupBy("fit_group", "start").applyInPandas(step(1.0, 1.0), PARAMS), "mcd-final")


def judged(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The base statistics, distance2 and kept of each document.

    distance2 is null for a document of a group without any sound row; such a document is base_failed.
    Null or empty text: no words, base_failed. Null language or source: a group of its own. Languages of few rows are
    judged by an estimate over all rows, in which their own rows are a small part. Repeated documents count
    as often as they occur. Empty table: no rows. Other columns are not read, but for those named in `keep`.
    """
    found = written(vectors(stats(docs)), "quality-stats")
    sound = found.where(~F.col("base_failed"))
    groups = written(fit_groups(sound), "quality-groups")
    own = F.col("fit_group") != POOLED
    rows = sound.select("_group", *FEATURES).join(groups.where(own), "_group").select("fit_group", *FEATURES)
    if not groups.where(~own).isEmpty():
        rows = rows.unionByName(sound.select(F.lit(POOLED).alias("fit_group"), *FEATURES))
    params = estimates(written(rows, "quality-sound"))
    # Columns to keep may hold whole texts: these are scanned once more rather than written once more.
    scored = ((vectors(stats(docs, keep)) if keep else found).join(groups, "_group", "left").join(params.drop("start", "n", "logdet"), "fit_group", "left")
              .withColumn("distance2", distance()))
    cutoff = chi2(TAIL, len(FEATURES))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance2"), F.lit(0.0)) <= cutoff)
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         kept.alias("kept"), "distance2", *keep)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that aren't rejected, unchanged, columns of any name included.

    Null and empty texts have no words, so they go. Repeated rows are judged alike, each of its own. Empty table: no rows.
    """
    rows, names = set_aside(docs, "doc_id", "text", "lang", "source")
    return put_back(judged(rows, names).where("kept"), docs)
