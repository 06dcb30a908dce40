"""The trie's nodes, against prefixes in a dictionary."""

import random
from collections import defaultdict

import pytest
from tests.llm import helpers as h

from tagweave.llm import op13_prefix_trie
from tagweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, node string, path string, depth int"


def plain(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(own)] for c, own in convs.items()}
    made = {}
    for c, own in convs.items():
        keep = h.crc(c, 9)
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        made[c] = convs.get(base, [])[:keep] + own[keep:]
    members, ended = defaultdict(list), defaultdict(list)
    for c, own in made.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
        ended[tuple(own)].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children[path]
        leaves[path] = sum(leaves[x] for x in below) if below else 1
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        saved[path] = own + sum(saved[x] for x in below)
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                    h.sha(",".join(map(str, sorted(ended[p]))))) for p, m in members.items()), key=str)


def values(df):
    return [tuple(r)[:4] for r in df.select("conv_id", "turn", "role", "text").collect()]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_nodes_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    assert got(QUERIES["op13_prefix_trie"](spark, SF)) == plain(values(df))


@pytest.fixture(scope="module")
def awkward(spark):
    """Common first turns, equal conversations, turnless ones, nulls, repeated rows, ties and clashing columns."""
    rng, rows = random.Random(3), []
    for c in range(-12, 150):
        n = rng.choice([1, 2, 3, 5, 12])
        own = [("user", rng.choice(["hello", "hello", "é", ""])), *(
            (rng.choice(["user", "bot", None]), rng.choice(["a", "b", None, "long " * 50])) for _ in range(n - 1))]
        if rng.random() < 0.4:
            own = [("user", "hello"), ("bot", "hi"), ("user", "bye")]
        rows += [(c, rng.choice([i, i, None]), role, text, "x", "y", 1) for i, (role, text) in enumerate(own)]
    rows += [(None, 0, "user", "hello", "x", "y", 1), rows[5], rows[5]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("container", [1, 3, 20, 1024])
def test_containers_of_any_size_give_the_same_nodes(awkward, container):
    found = op13_prefix_trie.trie(op13_prefix_trie.rebuilt(awkward), container, shard_turns=50)
    assert got(found) == plain(values(awkward))


def test_long_lists_of_ends_are_hashed_in_pieces(awkward, monkeypatch):
    monkeypatch.setattr(op13_prefix_trie, "END_BATCH", 2)
    assert got(op13_prefix_trie.trie(op13_prefix_trie.rebuilt(awkward), 1)) == plain(values(awkward))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    found = op13_prefix_trie.query(empty)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                             "ends_sha256"] and not found.collect()
    only = spark.createDataFrame([(None, 0, "user", "a", "x", "y", 1)], SCHEMA)
    assert not op13_prefix_trie.query(only).collect()
