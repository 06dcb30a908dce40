"""Operators with models, held against plain versions on small inputs."""

import math
from collections import defaultdict

import numpy as np
import pytest

from tagweave.llm import op2_outliers, op6_maxent
from tests.llm import helpers as h


def prose(rng, n, letters="abcdefghij", least=3, most=8):
    return " ".join("".join(rng.choice(list(letters), rng.integers(least, most))) for _ in range(n))


def test_a_rare_language_is_judged_by_all_rows(spark):
    rng = np.random.default_rng(5)
    clean = [prose(rng, int(rng.integers(80, 300))) for _ in range(200)]
    junk = [" ".join("###" + w for w in prose(rng, 120).split()) for _ in range(30)]
    # Words thrice as long, as another language may have them: no reason to reject.
    other = [prose(rng, 100, least=12, most=20) for _ in range(20)]
    lang = ["en"] * 200 + ["xx"] * 30 + ["yy"] * 20
    found = {r["doc_id"]: r for r in op2_outliers.judged(h.frame(spark, clean + junk + other, lang)).collect()}
    assert not any(found[i]["base_failed"] for i in found)
    assert not any(found[i]["kept"] for i in range(200, 230))
    assert all(found[i]["kept"] for i in range(230, 250))
    assert sum(found[i]["kept"] for i in range(200)) >= 198


def test_a_few_rows_alone_are_judged_too(spark):
    rng = np.random.default_rng(6)
    texts = [prose(rng, 90) for _ in range(8)] + [" ".join("##" + w for w in prose(rng, 90).split()), None, ""]
    found = {r["doc_id"]: r for r in op2_outliers.judged(h.frame(spark, texts, lang=[None] * 11)).collect()}
    assert [found[i]["kept"] for i in range(11)] == [True] * 8 + [False] * 3
    assert found[9]["base_failed"] and found[8]["distance2"] > 43


@pytest.mark.parametrize("different", [1, 3, 50, 30_000])
def test_sums_by_bucket(different):
    rng = np.random.default_rng(different)
    buckets = rng.integers(0, different, 5000).astype(np.int32) + op6_maxent.BUCKETS - different
    values = rng.normal(size=(5000, 7))
    own, total, times = op6_maxent.sums_by_bucket(buckets, values)
    want = defaultdict(lambda: np.zeros(7))
    for b, v in zip(buckets, values):
        want[b] += v
    assert own.tolist() == sorted(want)
    assert times.tolist() == [int((buckets == b).sum()) for b in own]
    assert np.allclose(total, [want[b] for b in own])


def plain_weights(features, kinds):
    """The trainer's steps token by token, in plain numbers."""
    weights, moved = defaultdict(lambda: [0.0] * op6_maxent.CLASSES), defaultdict(lambda: 1e-3)
    bias, bias_moved = [0.0] * op6_maxent.CLASSES, 1e-3
    for low in range(0, len(kinds), op6_maxent.BATCH):
        rows, own = features[low:low + op6_maxent.BATCH], kinds[low:low + op6_maxent.BATCH]
        slopes = []
        for f, kind in zip(rows, own):
            slope = np.exp(plain_logs(weights, bias, f))
            slope[kind] -= 1
            slopes.append(slope)
        total = np.sum(slopes, axis=0)
        bias_moved += np.mean(total ** 2)
        bias = bias - op6_maxent.RATE * total / math.sqrt(bias_moved)
        for k in range(4):
            sums = defaultdict(lambda: np.zeros(op6_maxent.CLASSES))
            for f, slope in zip(rows, slopes):
                sums[f[k]] += slope
            for bucket, total in sums.items():
                moved[bucket] += np.mean(total ** 2)
                weights[bucket] = weights[bucket] - op6_maxent.RATE / math.sqrt(moved[bucket]) * total
    return weights, bias


def plain_logs(weights, bias, features):
    z = np.sum([weights[b] for b in features], axis=0) + bias
    return z - np.logaddexp.reduce(z)


def test_scores_against_a_plain_version(spark):
    rng = np.random.default_rng(8)
    vocabulary = [prose(rng, 1) for _ in range(40)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(1, 60))) for _ in range(60)] + [None, "", "never seen"]
    docs = h.frame(spark, texts).coalesce(1)
    found = {r["doc_id"]: r for r in op6_maxent.scores(docs).collect()}

    def tokens(own):
        data = "".join(own).encode()
        ends = np.cumsum([0, *(len(t.encode()) for t in own)])
        return op6_maxent.Tokens(np.frombuffer(data, dtype=np.uint8), ends)

    train = tokens([t or "" for i, t in enumerate(texts) if h.crc(i, 7) != 2])
    order = np.random.default_rng(len(train.hash)).permutation(len(train.hash))
    weights, bias = plain_weights(train.features()[order].tolist(), train.kind[order].tolist())
    counts, by_kind = defaultdict(int), defaultdict(int)
    for x, kind in zip(train.hash.tolist(), train.kind.tolist()):
        by_kind[kind] += (x not in counts) + 1
        counts[x] += 1
    for i, text in enumerate(texts):
        own = tokens([text or ""])
        want = 0.0
        for x, kind, f in zip(own.hash.tolist(), own.kind.tolist(), own.features().tolist()):
            # The class by its history, then the word among those of its class and one place for unseen ones.
            want += plain_logs(weights, bias, f)[kind] / math.log(10)
            want += math.log10((counts.get(x, 0) + 1) / (by_kind[kind] + 1))
        assert found[i]["score"] == pytest.approx(want, abs=1e-3 * max(1, len(own.hash))), i
