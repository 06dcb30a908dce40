"""Alignments against token by token comparison of byte ranges."""

from collections import Counter, defaultdict

import pytest
from tests.llm import helpers as h

from tagweave.llm import op12_alignment
from tagweave.llm.queries import QUERIES, tokenizer

SF = "/root/testdata/sf0.001"
PATHS = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer(PATHS[0]))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer(PATHS[1]))


def characters():
    """The characters that stand for bytes in byte-level tokens."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, more = {}, 256
    for b in range(256):
        if b in kept:
            out[chr(b)] = b
        else:
            out[chr(more)] = b
            more += 1
    return out


def plain(docs, tools):
    a, b = tools
    byte = characters()
    found, pairs = [], Counter()
    for i, text in docs:
        left = a.encode(" " + (text or ""), add_special_tokens=False)
        one = [(x, bytes(byte[c] for c in t)) for x, t in zip(left.ids, left.tokens)]
        two = []
        for x in b.encode(text or ""):
            piece = b.id_to_piece(x)
            two.append((x, bytes([int(piece[3:5], 16)]) if b.is_byte(x) else piece.replace("▁", " ").encode()))
        whole = (" " + (text or "")).encode()
        if not text or any(b"".join(t for _, t in own) != whole for own in (one, two)):
            found.append((i, 0, 0, 0, [], ""))
            continue
        ranges = []
        for own in (one, two):
            at, out = 0, []
            for x, t in own:
                out.append((x, at, at + len(t)))
                at += len(t)
            ranges.append(out)
        links, j = [], 0
        for x, p, q in ranges[0]:
            while ranges[1][j][2] <= p:
                j += 1
            k = j
            while k < len(ranges[1]) and ranges[1][k][1] < q:
                links.append((x, ranges[1][k][0]))
                k += 1
        cuts = sorted({q for _, _, q in ranges[0]} & {q for _, _, q in ranges[1]})
        groups, low = [], 0
        parts = [defaultdict(list), defaultdict(list)]
        for own, into in zip(ranges, parts):
            at = 0
            for x, _, q in own:
                while q > cuts[at]:
                    at += 1
                into[at].append(str(x))
        groups = ";".join(f"{','.join(parts[0][g])}|{','.join(parts[1][g])}" for g in range(len(cuts)))
        found.append((i, len(one), len(two), len(cuts), links, h.sha(groups)))
        pairs.update(set(links))
    best = defaultdict(int)
    for (x, _), n in pairs.items():
        best[x] = max(best[x], n)
    return sorted(((i, n, m, g, len(links), sum(pairs[p] == best[p[0]] for p in links), sum(pairs[p] for p in links), sha)
                   for i, n, m, g, links, sha in found), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_alignment_of_the_table(spark, tools):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(QUERIES["op12_alignment"](spark, SF)) == plain(pairs(df), tools)


@pytest.mark.parametrize("small", [False, True])
def test_awkward_texts(spark, tools, small, monkeypatch):
    texts = [*h.AWKWARD, "ﬁne ｆｕｌｌ", "é", " two  spaces ", "▁ mark", "<0x41><s></s><unk><|endoftext|>", "\0\x01",
             "\U0001F600\U0001F600 漢字", "a b", "tab\tand\nline", "the same", "the same", "a" + " \n" * 100_000 + "b",
             "don't we'll I'M <|endoftext|>x", "^" * 5000]
    df = h.frame(spark, texts)
    df = df.union(df.where("doc_id in (4, 13)")).union(
        df.where("doc_id = 4").selectExpr("cast(NULL AS long) AS doc_id", *df.columns[1:])).coalesce(2)
    if small:
        monkeypatch.setattr(op12_alignment, "BATCH_BYTES", 20)
        monkeypatch.setattr(op12_alignment, "RUN_ROWS", 2)
    assert got(op12_alignment.query(df, *map(tokenizer, PATHS))) == plain(pairs(df), tools)


def test_ranks_give_the_tokenizers_ids(tools):
    own = op12_alignment.side(op12_alignment.ByteLevel, tokenizer(PATHS[0]))
    for first in range(0, 0x110000, 97):
        text = "".join(f"a{c} {c}{c}1 \n{c}'s{c}  x" for c in map(chr, range(first, min(first + 97, 0x110000)))
                       if not "\ud800" <= c <= "\udfff")
        assert own.encode([text]) == [tools[0].encode(" " + text, add_special_tokens=False).ids]


def test_groups_as_text(spark, tools):
    df = h.frame(spark, ["Hello world", None])
    out = dict(map(tuple, op12_alignment.alignments(df, *map(tokenizer, PATHS)).collect()))
    sha = {i: x for i, *_, x in plain(pairs(df), tools)}
    assert h.sha(out[0]) == sha[0] and out[1] == "" and sha[1] == ""


def test_empty_table(spark):
    found = op12_alignment.query(h.empty(spark), *map(tokenizer, PATHS))
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert not found.collect()
