"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model, a linear classifier.

Lexicon voters: words that labelled toxic documents use far more than others, dealt to LEXICONS voters by rank, and a
short list of insults. Pattern voters: masked swear words, shouting, insults at the reader. All documents are voted on;
the counts of vote patterns (at most 2 ** voters) give, by expectation-maximisation, each voter's hit and false alarm
rate, and how voters go together beyond what the label explains: a voter counts less the more others only repeat it.
The posterior labels of a sample of at most FIT_ROWS documents train a logistic classifier on the lexicon's words, and
its scale is set on labelled documents.

Only rows whose crc32(doc_id as text) mod 4 is not 2 lend their labels, FIT_ROWS of them at most. Words count by how
many different texts of a class use them, so that copies of one document count once.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.batches import ALNUM, LOWER, Words, chunks
from tagweave.llm.tables import remainder, written

FIT_ROWS = 15_000
LEXICON = 300
LEXICONS = 6
MIN_USES = 5
MIN_ODDS = 3.0
HELD_OUT = (4, 2)
THRESHOLD = 0.3
INSULTS = ("asshole bastard bitch clown dumbass fool fuck fucking idiot idiots imbecile jerk loser losers moron morons "
           "pathetic scum shit stupid trash worthless disgusting arschloch dummkopf idiota imbécile connard salaud").split()
PATTERNS = (r"\b[a-z]{1,2}\*{2,}[a-z]*", r"!{3,}", r"\b(?:you(?: are|'re)? (?:an? )?(?:[a-z]+ )?(?:idiot|loser|fool)|shut up)")
VOTERS = LEXICONS + 1 + len(PATTERNS)


def hashed(words: tuple[str, ...] | list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    return Words(LOWER[data], np.array([0, len(data)]), ALNUM).hashes()


def word_sets(docs: DataFrame, fields: list, wanted: np.ndarray | None = None) -> DataFrame:
    """`words` (different hashed words, of those wanted) beside the other columns of docs; the text goes."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for low, high, data, offsets in chunks(batch):
                words = Words(LOWER[data], offsets, ALNUM)
                h, doc = words.hashes(), words.doc()
                if wanted is not None:
                    own = among(h, wanted) >= 0
                    h, doc = h[own], doc[own]
                ends = np.searchsorted(doc, np.arange(high - low + 1))
                out += [np.unique(h[ends[i]:ends[i + 1]]).view(np.int64) for i in range(high - low)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields),
                                              pa.array(out, type=pa.list_(pa.int64()))],
                                             names=[*(f.name for f in fields), "words"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    return docs.select(*(f.name for f in fields), "text").mapInArrow(find, f"{kinds}words array<long>")


def among(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The place of each in the table (in order), or -1."""
    if not len(table):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
    return np.where(table[at] == h, at, -1)


def labelled(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """toxic, copy (a hash of the whole text) and words of at most `fit_rows` labelled documents, chosen by hash, as a written table."""
    of, held = HELD_OUT
    usable = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(remainder("doc_id", of) != held)
    ids = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id").select(
        "toxic", F.xxhash64(F.coalesce("text", F.lit(""))).alias("copy"), "text")
    return written(word_sets(rows, [f for f in rows.schema if f.name != "text"]), "toxic-labelled")


def lexicon(rows: DataFrame, most: int = LEXICON) -> list[int]:
    """Hashed words by falling log odds of toxic against other documents, each text counted once a class."""
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.countDistinct("copy").alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return []
    uses = (rows.select("toxic", "copy", F.explode("words").alias("h")).distinct().groupBy("h")
            .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).where(F.col("a") >= MIN_USES))
    odds = F.log((F.col("a") + 0.5) / n[1]) - F.log((F.col("b") + 0.5) / n[0])
    chosen = uses.withColumn("odds", odds).where(F.col("odds") >= MIN_ODDS).orderBy(F.desc("a"), F.desc("odds"), "h")
    return [r["h"] for r in chosen.select("h").limit(most).collect()]


class Voters:
    def __init__(self, words: list[int]):
        """`words` in falling order of use: the most used are dealt first, one to each voter in turn."""
        learnt = np.array(words, dtype=np.int64).view(np.uint64)
        given = hashed(INSULTS)
        table = np.unique(np.concatenate([learnt, given]))
        self.table = table
        self.votes = np.zeros((len(table), VOTERS), dtype=bool)
        self.votes[among(learnt, table), np.arange(len(learnt)) % LEXICONS] = True
        self.votes[among(given, table), LEXICONS] = True


def votes_of(docs: DataFrame, voters: Voters, keep: tuple[str, ...] = ()) -> DataFrame:
    """`words` (those of the voters' table) and `votes` (a bit for each voter) beside the columns of `keep`."""
    masks = [(sum(1 << int(j) for j in np.flatnonzero(own))) for own in voters.votes]
    kept = docs.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    low = F.lower("text")
    quick = [F.contains("text", F.lit("**")), F.contains("text", F.lit("!!!")),
             F.contains(low, F.lit("you")) | F.contains(low, F.lit("shut up"))]
    told = sum((F.when(q & low.rlike(p), 1 << (LEXICONS + 1 + i)).otherwise(0)
                for i, (p, q) in enumerate(zip(PATTERNS, quick, strict=True))), F.lit(0))
    rows = kept.withColumn("told", told.cast("long"))
    found = word_sets(rows, [f for f in rows.schema if f.name != "text"], voters.table)
    mask_of = {int(h): m for h, m in zip(voters.table.view(np.int64), masks, strict=True)}
    fields = [f for f in rows.schema if f.name not in ("text", "told")]

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for own, told_ in zip(batch.column("words").to_pylist(), batch.column("told").to_pylist(), strict=True):
                for h in own:
                    told_ |= mask_of[h]
                out.append(told_)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), batch.column("words"),
                                              pa.array(out, type=pa.int64())],
                                             names=[*(f.name for f in fields), "words", "votes"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    return found.mapInArrow(vote, f"{kinds}words array<long>, votes long")


def label_model(counts: dict[int, int], share: float, rounds: int = 100) -> dict[int, float]:
    """Posterior that a document is toxic, for each pattern of votes."""
    patterns = np.array(sorted(counts), dtype=np.int64)
    n = np.array([counts[p] for p in patterns.tolist()], dtype=float)
    x = (patterns[:, None] >> np.arange(VOTERS)) & 1
    hit, alarm = np.full(VOTERS, 0.4), np.full(VOTERS, 0.01)
    share, weight = min(max(share, 1e-3), 0.5), np.ones(VOTERS)
    p = np.zeros(len(patterns))
    for i in range(rounds):
        log = np.where(x == 1, np.log(hit / alarm), np.log((1 - hit) / (1 - alarm))) * weight
        p = 1 / (1 + np.exp(-np.clip(np.log(share / (1 - share)) + log.sum(axis=1), -500, 500)))
        share = float(np.clip(p @ n / max(n.sum(), 1), 1e-4, 0.5))
        # A voter that hardly ever votes keeps to the prior rates.
        hit = (((p * n) @ x) + 4) / ((p * n).sum() + 10)
        alarm = ((((1 - p) * n) @ x) + 0.1) / (((1 - p) * n).sum() + 10)
        if i % 10 == 9:
            mean = np.where(p[:, None] > 0.5, hit, alarm)
            apart = (x - mean) * np.sqrt(n)[:, None]
            size = np.sqrt(np.square(apart).sum(axis=0)) + 1e-9
            together = np.clip((apart.T @ apart) / np.outer(size, size), 0, 1)
            weight = 1 / np.maximum(1, np.where(together > 0.2, together, 0).sum(axis=1))
    return dict(zip(patterns.tolist(), p.tolist(), strict=True))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 200, decay: float = 1e-3) -> np.ndarray:
    """Weights, the last one for the constant."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    w, moved = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-8)
    for _ in range(rounds):
        slope = x.T @ (1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) - y) / max(len(x), 1) + decay * np.append(w[:-1], 0)
        moved += np.square(slope)
        w -= slope / np.sqrt(moved)
    return w


def presence(words: list[list[int]], table: np.ndarray) -> np.ndarray:
    out = np.zeros((len(words), len(table)), dtype=np.float32)
    for i, own in enumerate(words):
        at = among(np.array(own, dtype=np.int64).view(np.uint64), table)
        out[i, at[at >= 0]] = 1
    return out


def sampled_sets(voted: DataFrame, most: int) -> list:
    """votes, words and weight of at most `most` different sets, chosen by hash, each standing for `weight` rows.

    A priority sample: sets are ranked by count over a hashed uniform number, and one counts for the first rank left out
    if it occurs less often. So the rows of any kind of set keep their share on the average, the rare ones too. If all
    sets are taken, the weights are the counts.
    """
    uniform = (F.pmod(F.xxhash64("votes", "words"), F.lit(1 << 50)) + 1) / float(1 << 50)
    ranked = (voted.groupBy("votes", "words").count().withColumn("rank", F.col("count") / uniform)
              .orderBy(F.desc("rank"), "votes", "words").limit(most + 1))
    found = ranked.collect()
    bound = found[most]["rank"] if len(found) > most else 0.0
    return [{"votes": r["votes"], "words": r["words"], "weight": max(float(r["count"]), bound)} for r in found[:most]]


def classifier(docs: DataFrame, rows: DataFrame, voters: Voters, fit_rows: int) -> tuple[np.ndarray, float, float]:
    """Word weights with the constant, then scale and shift to labelled probabilities."""
    of, held = HELD_OUT
    train = docs.where(remainder("doc_id", of) != held)
    voted = written(votes_of(train, voters), "toxic-votes")
    counts = {r["votes"]: r["count"] for r in voted.groupBy("votes").count().collect()}
    known = [(r["toxic"], r["words"]) for r in rows.select("toxic", F.filter("words", lambda h: h.isin(
        voters.table.view(np.int64).tolist())).alias("words")).collect()]
    toxic = np.array([t for t, _ in known], dtype=float)
    posterior = label_model(counts, float(toxic.mean()) if len(toxic) else 0.1)
    sets = sampled_sets(voted, fit_rows)
    x, n = presence([r["words"] for r in sets], voters.table), np.array([r["weight"] for r in sets], dtype=float)
    p = np.array([posterior[r["votes"]] for r in sets])
    w = weighted(x, p, n)
    z = presence([own for _, own in known], voters.table) @ w[:-1] + w[-1]
    fit = logistic(np.clip(z, -10, 10)[:, None], toxic, 400, 0.0) if len(toxic) and 0 < toxic.sum() < len(toxic) else [1, 0]
    return w, float(max(fit[0], 1e-3)), float(fit[1])


def weighted(x: np.ndarray, p: np.ndarray, n: np.ndarray, rounds: int = 300, decay: float = 1e-4) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    w, moved, total = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-8), max(n.sum(), 1.0)
    for _ in range(rounds):
        slope = x.T @ (n * (1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) - p)) / total + decay * np.append(w[:-1], 0)
        moved += np.square(slope)
        w -= 0.5 * slope / np.sqrt(moved)
    return w


def toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted of each row.

    Null or empty text: no votes, the score of a document without any. Null doc_id: a training row without a label. Of
    several labels of one document the highest holds. No labels at all: only the insults and patterns vote. Repeated
    rows: each its own result. Empty table: no rows.
    """
    rows = labelled(docs, labels, fit_rows)
    voters = Voters(lexicon(rows))
    weights, scale, shift = classifier(docs, rows, voters, fit_rows)
    table = voters.table
    of, held = HELD_OUT
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder("doc_id", of) == held).alias("held_out"),
                      "text", *keep)
    found = word_sets(own, [f for f in own.schema if f.name != "text"], table)
    fields = [f for f in found.schema if f.name != "words"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = presence(batch.column("words").to_pylist(), table) @ weights[:-1] + weights[-1]
            p = 1 / (1 + np.exp(-np.clip(scale * np.clip(z, -10, 10) + shift, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), pa.array(p.astype(float))],
                                             names=[*(f.name for f in fields), "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    out = found.mapInArrow(score, f"{kinds}, score double")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), *keep)


query = toxicity
