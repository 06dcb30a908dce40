"""Repeats between documents, against all substrings."""

import hashlib
import random
from collections import defaultdict

import pytest
from tests.llm import helpers as h

from tagweave.llm import op11_repeats
from tagweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TINY = {"hot": 2, "group_segments": 5}


def plain(docs, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row, from the least document of each window."""
    docs = [(i, (t or "").encode()) for i, t in docs]
    order = lambda i: (i is not None, i)
    least = {}
    for i, t in docs:
        for p in range(len(t) - length + 1):
            w = t[p:p + length]
            if w not in least or order(i) < order(least[w]):
                least[w] = i
    out = []
    for i, t in docs:
        gone, end = bytearray(len(t)), 0
        for p in range(len(t) - length + 1):
            if order(least[t[p:p + length]]) < order(i):
                end = max(end, p)
                gone[end:p + length] = b"\1" * (p + length - end)
                end = p + length
        spans = sum(b and not a for a, b in zip(b"\0" + bytes(gone), gone))
        left = bytes(c for c, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


def got(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_bytes_removed_equal_all_windows(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(QUERIES["op11_repeats"](spark, SF)) == sorted(plain(pairs(df)), key=str)


@pytest.fixture(scope="module")
def awkward(spark):
    rng = random.Random(7)
    line = "".join(rng.choice("abc ") for _ in range(70))
    texts = h.AWKWARD + [line, "q" + line[5:], line[:60] + "z" * 60, "ab" * 100, "\0" * 80, "\0" * 120 + "x"]
    texts += ["".join(rng.choice("ab") for _ in range(40)) + line + "".join(rng.choice("ab") for _ in range(40))
              for _ in range(25)]
    texts += [line + texts[-1] + line, "漢" * 30, "x" + "漢" * 30]
    return h.frame(spark, texts)


@pytest.mark.parametrize("limits", [{}, TINY])
def test_awkward_texts(spark, awkward, limits, monkeypatch):
    monkeypatch.setattr(op11_repeats, "CHUNK_BYTES", 20_000)
    again = awkward.union(awkward.where("doc_id in (13, 20)"))
    again = again.union(awkward.where("doc_id = 30").selectExpr("cast(NULL AS long) AS doc_id", *awkward.columns[1:]))
    assert got(op11_repeats.without_repeats(again, **limits)) == sorted(plain(pairs(again)), key=str)


def test_texts_left(spark):
    line = "0123456789" * 6
    out = op11_repeats.without_repeats(h.frame(spark, [line, "a" + line + "b" + line, None]), texts=True)
    assert {r["doc_id"]: r["kept"] for r in out.collect()} == {0: line, 1: "ab", 2: ""}


def test_short_lengths_and_empty_tables(spark, awkward):
    few = awkward.where("length(text) < 300")
    assert got(op11_repeats.without_repeats(few, 12)) == sorted(plain(pairs(few), 12), key=str)
    assert not op11_repeats.without_repeats(h.empty(spark)).collect()
    assert not op11_repeats.repeat_groups(h.frame(spark, [None, "", "a"])).collect()


@pytest.mark.parametrize("limits", [{}, TINY])
def test_groups_hold_all_occurrences_of_maximal_repeats(spark, awkward, limits):
    docs = pairs(awkward.where("length(text) < 300"))
    texts = {i: t.encode() for i, t in docs}
    groups = defaultdict(set)
    for r in op11_repeats.repeat_groups(awkward.where("length(text) < 300"), **limits).collect():
        groups[r["part"], r["group"], r["length"]].add((r["doc_id"], r["start"]))
    covered = defaultdict(set)
    for (_, _, size), found in groups.items():
        (text,) = {texts[i][p:p + size] for i, p in found}
        assert size >= 50 and len({i for i, _ in found}) > 1
        # All occurrences, unless they belong to another segment that ends earlier or begins later.
        for i, p in found:
            covered[i].update(range(p, p + size))
        whole = {(i, p) for i, t in texts.items() for p in range(len(t) - size + 1) if t[p:p + size] == text}
        assert found <= whole
    windows = defaultdict(set)
    for i, t in texts.items():
        for p in range(len(t) - 49):
            windows[t[p:p + 50]].add((i, p))
    for found in windows.values():
        if len({i for i, _ in found}) > 1:
            for i, p in found:
                assert covered[i].issuperset(range(p, p + 50))
            if not limits:
                # Some group joins all occurrences of the window.
                assert any(all(any(q <= p and p + 50 <= q + size for j, q in own if j == i) for i, p in found)
                           for (_, _, size), own in groups.items())


def test_intervals_test_what_stands_before(spark):
    found = op11_repeats.intervals(*map(__import__("numpy").array, (
        [60, 60, 60], [0, 55, 52], [97, 97, 98], [1, 2, 3], [1, 2, 3])), 50)
    # Both suffixes of the deeper interval stand after the same byte, so it goes on to the left.
    assert found == [(0, 2, 52, 1)]
