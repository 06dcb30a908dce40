import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tests.llm import helpers as h

from tagweave.llm import (op1_token_index, op2_outliers, op3_packing, op4_mixing, op5_personal_data, op6_maxent,
                          op7_toxicity, op8_decontamination, op9_simhash, op10_language)
from tagweave.llm.queries import QUERIES, tokenizer

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def awkward(spark):
    return h.frame(spark, h.AWKWARD, source=[None, "a", "b"] * 4 + ["a"])


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def both(docs, awkward):
    for df in (docs, awkward):
        yield df, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_token_files_hold_the_ids_of_whole_texts(spark, docs, awkward):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer())
    for df, texts in both(docs, awkward):
        found, start = rows(op1_token_index.query(spark, df, tokenizer())), 0
        assert len(found) == len(texts)
        for doc_id, text in sorted(texts):
            ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
            want = (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
            assert tuple(found[doc_id])[1:] == want, doc_id
            start += len(ids)


def test_index_finds_each_key_and_no_other(spark, docs, tmp_path):
    twice = docs.union(docs.where("doc_id < 5")).union(docs.where("doc_id = 7").selectExpr(
        "cast(NULL AS long)", "text", "lang", "source", "n_chars"))
    written, shards, index = op1_token_index.token_index(twice, str(tmp_path), tokenizer())
    keys = spark.createDataFrame([(i,) for i in (*range(300), None)], "doc_id long")
    got = op1_token_index.read_documents(op1_token_index.look_up(keys, index), shards).collect()
    counts = Counter(r["doc_id"] for r in got)
    assert counts == Counter([*range(200), *range(5), None])
    assert sorted(r["start"] for r in got)[0] == 0 and len({r["start"] for r in got}) == len(got)


def test_repeated_keys_may_go_on_in_the_next_shard(spark, docs, tmp_path):
    same = docs.selectExpr("cast(1 AS long) AS doc_id", "text")
    rows_ = op1_token_index.write_shards(same, str(tmp_path), tokenizer(), shard_bytes=50_000)
    index = op1_token_index.write_index(rows_, str(tmp_path))
    shards = rows_.selectExpr("shard", "file").distinct()
    assert shards.count() > 1
    found = op1_token_index.read_documents(op1_token_index.look_up(same.select("doc_id").distinct(), index), shards)
    assert found.count() == 200 and found.agg({"n_tokens": "sum"}).first()[0] == rows_.agg({"n_tokens": "sum"}).first()[0]


def test_perfect_hash_is_minimal():
    keys = op1_token_index.mix(np.arange(20_000, dtype=np.uint64))
    made = op1_token_index.PerfectHash.of(keys)
    assert np.array_equal(np.sort(made.find(keys)), np.arange(len(keys)))
    again, _ = op1_token_index.PerfectHash.load(made.dump())
    assert np.array_equal(again.find(keys), made.find(keys))


def test_quality_statistics(docs, awkward):
    for df, texts in both(docs, awkward):
        found = rows(op2_outliers.judged(df))
        assert len(found) == len(texts)
        for doc_id, text in texts:
            r = found[doc_id]
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                    r["base_failed"]) == h.stats(text)
            assert not (r["base_failed"] and r["kept"])


def test_outliers_go_and_clean_documents_stay(spark):
    import random

    dice = random.Random(3)
    known = ["".join(dice.choice("abcdefgh") for _ in range(dice.randint(2, 9))) for _ in range(5000)]
    clean = [" ".join(dice.choice(known) for _ in range(dice.randint(60, 900))) for _ in range(400)]
    junk = [" ".join(dice.choice(known) + "###" for _ in range(200)) for _ in range(20)]
    found = rows(op2_outliers.judged(h.frame(spark, clean + junk)))
    assert all(found[i]["kept"] for i in range(400)) and not any(found[i]["kept"] for i in range(400, 420))


def test_each_share_alone_rejects(spark):
    """Junk of duplicate lines, of repeated passages below the base limit, and of symbols, one kind a document."""
    import random

    dice = random.Random(6)
    known = ["".join(dice.choice("abcdefgh") for _ in range(dice.randint(2, 9))) for _ in range(5000)]
    say = lambda n: [dice.choice(known) for _ in range(n)]
    clean = [" ".join(say(dice.randint(100, 900))) for _ in range(300)]
    lines = ["\n".join([" ".join(say(300)), *["so it is"] * 30]) for _ in range(5)]
    repeats = [" ".join(say(160) + (own := say(72)) + own) for _ in range(5)]
    symbols = [" ".join(w + "#" * (i % 2) for i, w in enumerate(say(300))) for _ in range(5)]
    found = rows(op2_outliers.judged(h.frame(spark, clean + lines + repeats + symbols)))
    assert not any(found[i]["base_failed"] for i in found)
    assert [i for i in sorted(found) if not found[i]["kept"]] == list(range(300, 315))


def test_estimate_is_that_of_the_nearest_rows(spark):
    """Against concentration steps over plain arrays; bins round the share up, so the two agree roughly."""
    dice = np.random.default_rng(5)
    x = dice.normal(size=(3000, 5)) @ np.diag([1.0, 2, 1, 1, 1]) + 5
    x[:300] += 40
    df = spark.createDataFrame([("g", *map(float, r)) for r in x], "fit_group string, " + ", ".join(
        f"{f} double" for f in op2_outliers.FEATURES))
    found = op2_outliers.estimates(op2_outliers.written(df, "t")).first()
    clean = x[300:]
    assert np.allclose(found["centre"], clean.mean(axis=0), atol=0.15)
    scatter = np.linalg.inv(np.array(found["inverse"]).reshape(5, 5))
    assert np.allclose(np.diag(scatter), clean.var(axis=0), rtol=0.3)


def test_packing_keeps_groups_whole_and_sizes_near(docs, awkward):
    for df, texts in both(docs, awkward):
        found = op3_packing.query(df).collect()
        assert len(found) == len(texts)
        by_text, loads, slots = defaultdict(set), Counter({i: 0 for i in range(8)}), defaultdict(list)
        for r in found:
            text = dict(texts)[r["doc_id"]]
            assert r["size"] == len((text or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((text or "").encode())
            by_text[text].add(r["shard"])
            loads[r["shard"]] += r["size"]
            slots[r["shard"]].append(r["slot"])
        assert all(len(s) == 1 for s in by_text.values())
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        if df is docs:
            assert max(loads.values()) <= 1.02 * sum(loads.values()) / 8 and min(loads.values()) > 0.9 * sum(loads.values()) / 8


def test_best_fit_decreasing_is_that_of_single_items():
    dice = np.random.default_rng(1)
    sizes = sorted(dice.integers(1, 60, 300).tolist(), reverse=True)
    left, want = [], []
    for s in sizes:
        fits = [(r, i) for i, r in enumerate(left) if r >= s]
        if not fits:
            left.append(100)
            fits = [(100, len(left) - 1)]
        i = min(fits)[1]
        left[i] -= s
        want.append((s, i))
    plan, bins = op3_packing.best_fit_decreasing(list(Counter(sizes).items()), 100)
    assert bins == len(left)
    assert sorted((s, i) for s, a, b, i in plan for _ in range(b - a)) == sorted(want)
    tree = op3_packing.Capacities()
    for i in range(3000):
        tree.add(i * 7919 % 3001, i)
    assert [tree.take(1500)[0] for _ in range(3)] == [1500, 1501, 1502] and tree.take(5000) is None


def test_few_shards_at_a_capacity(docs):
    found = op3_packing.packed(docs, n_shards=None, capacity=40_000).collect()
    loads = Counter()
    for r in found:
        loads[r["shard"]] += r["size"]
    assert max(loads.values()) <= 40_000 and len(loads) <= -(-sum(loads.values()) // 40_000) + 1


def water(sizes, weights, total, epochs=3):
    goal, open_ = {}, set(sizes)
    while open_:
        level = (total - sum(goal.values())) / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] >= epochs * sizes[s]}
        if not over:
            return goal | {s: level * weights[s] for s in open_}
        goal |= {s: float(epochs * sizes[s]) for s in over}
        open_ -= over
    return goal


def test_targets_and_words_taken(docs, awkward):
    for df, texts in both(docs, awkward):
        source = {r["doc_id"]: r["source"] for r in df.select("doc_id", "source").collect()}
        found = rows(op4_mixing.query(df))
        sizes, taken, goal, largest = Counter(), Counter(), {}, Counter()
        for doc_id, text in texts:
            r, s = found[doc_id], source[doc_id]
            assert r["size"] == len(h.words(text)) and 0 <= r["taken"] <= 3 * r["size"]
            sizes[s] += r["size"]
            taken[s] += r["taken"]
            goal[s], largest[s] = r["target"], max(largest[s], r["size"])
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
        want = water(sizes, weights, sum(sizes.values()))
        assert all(abs(goal[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes)
        assert all(abs(taken[s] - goal[s]) <= largest[s] for s in sizes)


def test_the_mix_holds_what_the_plan_takes(docs):
    plan = rows(op4_mixing.query(docs))
    got = Counter(r["doc_id"] for r in op4_mixing.mix(docs).collect())
    assert all(got[i] * r["size"] == r["taken"] for i, r in plan.items())
    assert op4_mixing.mix(docs).columns == docs.columns


PII = ["write a.b@c.d_e@f.gh, x@y no@dot", "1.2.3.4.5 256.1.1.1 0001.02.003.0255 1.2.3 999.1.2.3.4", "é4111 1111-1111 1111 漢 +49 (30) 123456-78",
       "4111111111111112", "+1" * 300, "a@b" * 2000, "1.1.1.1 " * 500, "Mr. John Smith, phone (555) 123-4567 or 123-45-6789.",
       "+12345678901 john(at)mail(dot)org", "9" * 30_000, "a" * 50_000, "x@" + "a." * 5000, "\x01 +1 2"]


def test_base_spans(spark, docs, awkward):
    for df in (docs, awkward, h.frame(spark, PII)):
        found = rows(op5_personal_data.query(df))
        for r in df.select("doc_id", "text").collect():
            want, got = h.personal(r["text"]), found[r["doc_id"]]
            assert [got[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [
                sum(x[0] == k for x in want) for k in ("email", "ip", "card", "phone")], r["text"]
            base = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
            assert got["base_sha256"] == h.sha(base)
            spans = got["spans"].split(",") if got["spans"] else []
            assert set(base.split(",") if base else []) <= set(spans)
            assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def test_loose_spans_are_judged_by_their_voters(spark):
    good = [f"Please call the phone (555) {100 + i}-4{i:03d}. Thanks" for i in range(40)]
    bad = [f"order {100 + i}-200-4{i:03d}x of invoice" for i in range(40)]
    found = rows(op5_personal_data.query(h.frame(spark, good + bad + ["+49 30 12345678", "+33 1 23 45 67 89 00"] * 10)))
    assert all("phone" in found[i]["spans"] for i in range(40)) and not any(found[i]["spans"] for i in range(40, 80))


def test_language_model(docs, awkward):
    for df, texts in both(docs, awkward):
        counts = Counter()
        for i, t in texts:
            if h.crc(i, 7) != 2:
                counts.update([*h.words(h.lower(t)), None])
        n, v = sum(counts.values()), len(counts)
        found = rows(op6_maxent.query(df))
        gain = 0.0
        for i, t in texts:
            tokens = [*h.words(h.lower(t)), None]
            r = found[i]
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
                h.crc(i, 7) == 2, len(tokens), sum(counts[x] > 0 for x in tokens), n)
            assert r["base_score"] == pytest.approx(sum(np.log10((counts[x] + 1) / (n + v + 1)) for x in tokens), rel=1e-9)
            assert r["score"] <= 0
            gain += (r["score"] - r["base_score"]) * r["held_out"]
        if df is docs:
            assert gain > 0


def test_rare_words_are_counted_by_the_join(docs, monkeypatch):
    want = rows(op6_maxent.query(docs))
    few = op6_maxent.head
    monkeypatch.setattr(op6_maxent, "head", lambda counts: few(counts, 20))
    got = rows(op6_maxent.query(docs))
    for i, r in want.items():
        assert got[i]["n_known"] == r["n_known"] and got[i]["base_score"] == pytest.approx(r["base_score"], rel=1e-9)


def test_classes_sum_to_one():
    tokens = op6_maxent.Tokens(np.frombuffer(b"some words here and there", dtype=np.uint8), np.array([0, 10, 25]))
    trainer = op6_maxent.Trainer()
    trainer.step(tokens.features(), tokens.kind)
    assert np.allclose(op6_maxent.shares(trainer.weights, trainer.bias, tokens.features()).sum(axis=1), 1, atol=1e-5)
    assert tokens.counts.tolist() == [3, 4] and (tokens.kind == 0).sum() == 2


def test_toxicity_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = rows(op7_toxicity.query(docs, labels))
    assert len(found) == 1000
    held = [(r["toxic"], found[r["doc_id"]]["score"], found[r["doc_id"]]["predicted"]) for r in labels.collect()
            if found[r["doc_id"]]["held_out"]]
    assert all(found[i]["held_out"] == (h.crc(i, 4) == 2) for i in found)
    right = sum(t == p for t, _, p in held)
    assert right >= 0.9 * len(held) and sum(p for t, _, p in held if t == 0) <= 2


def test_toxicity_of_awkward_rows(spark, awkward):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = rows(op7_toxicity.query(awkward, none))
    assert len(found) == len(h.AWKWARD) and all(0 <= r["score"] <= 1 for r in found.values())


def test_texts_with_one_beginning_are_told_apart(spark):
    """A long header that all share: toxic words are learnt, and words of the clean texts are not."""
    head = "this notice stands at the beginning of every page of the source. "
    texts = [f"{head} page {i} snark venom" if i % 4 == 0 else f"{head} page {i} garden flower" for i in range(80)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(80)], "doc_id long, quality int, toxic int")
    learnt = op7_toxicity.lexicon(op7_toxicity.labelled(h.frame(spark, texts), labels))
    assert set(learnt) == set(op7_toxicity.hashed(["snark", "venom"]).view(np.int64).tolist())


def test_rare_word_sets_keep_their_share_of_the_sample(spark):
    """Many different sets that occur once beside few that occur often, of which the sample takes a part."""
    often = [(0, [i], 20) for i in range(300)]
    rare = [(1, [1000 + i, 9], 1) for i in range(3000)]
    voted = spark.createDataFrame([(v, w) for v, w, n in often + rare for _ in range(n)], "votes long, words array<long>")
    found = op7_toxicity.sampled_sets(voted, 600)
    assert len(found) == 600
    assert sum(r["weight"] for r in found if r["votes"] == 1) == pytest.approx(3000, rel=0.2)
    assert sum(r["weight"] for r in found) == pytest.approx(9000, rel=0.1)
    assert sorted(r["weight"] for r in op7_toxicity.sampled_sets(voted, 5000)) == [1.0] * 3000 + [20.0] * 300


def test_windows_hit(spark, docs, awkward):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    extra = [(900, "a"), (901, "same text"), (902, None), (903, " ... "), (904, items[0][1]), (904, items[0][1]),
             (905, "word " * 12), (906, "漢字 end")]
    bench = spark.createDataFrame(items + extra, "item_id long, text string")
    for df, texts in both(docs, awkward):
        found = rows(op8_decontamination.query(df, bench))
        for (i, _), (n, hit, names) in zip(texts, h.windows([t for _, t in texts], items + extra), strict=True):
            r = found[i]
            assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, len(hit), len(names)), i
            assert r["items_sha256"] == h.sha(",".join(sorted(names))) and r["contaminated"] == bool(hit)


def test_windows_of_random_words(spark):
    """Few different words, so that items overlap, nest and repeat themselves."""
    dice = np.random.default_rng(11)
    say = lambda n: " ".join(dice.choice(list("abc"), n))
    items = [(i, say(int(n))) for i, n in enumerate(dice.integers(1, 16, 40)) if n > 4]
    texts = [say(60) for _ in range(60)] + [items[3][1] + " " + items[5][1]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = h.windows(texts, items)
    for most in (1_000_000, 40):
        blocks = op8_decontamination.item_blocks(bench, most)
        found = rows(op8_decontamination.scanned(h.frame(spark, texts).select("doc_id", "text"), blocks))
        for i, (_, hit, names) in enumerate(want):
            got = {j for a, b in zip(found[i]["hit_starts"], found[i]["hit_ends"]) for j in range(a, b)}
            assert got == hit and set(found[i]["items"]) == names


def test_spans_are_cut_and_clean_documents_stay(spark):
    item = "one two three four five six seven eight nine ten eleven"
    filler = " ".join(f"w{i}" for i in range(40))
    texts = [f"{filler}. {item.upper()}! {filler}", filler, None, item]
    out = rows(op8_decontamination.cleaned(h.frame(spark, texts), spark.createDataFrame([(1, item)], "item_id int, text string")))
    assert set(out) == {0, 1, 2} and out[0]["text"] == f"{filler}. ! {filler}" and out[1]["text"] == filler
    assert out[0]["n_chars"] == len(out[0]["text"]) and out[0]["shard"] == "y"


def test_fingerprints_and_components(docs, awkward):
    for df, texts in both(docs, awkward):
        found = rows(op9_simhash.query(df))
        ids, values = [i for i, _ in texts], [h.simhash(t) for _, t in texts]
        for i, v, c in zip(ids, values, h.groups(ids, values), strict=True):
            assert (found[i]["fingerprint"], found[i]["component_id"]) == (f"{v:016x}", c)


@pytest.mark.parametrize("cell", [4096, 7])
def test_all_links_between_close_fingerprints(spark, monkeypatch, cell):
    monkeypatch.setattr(op9_simhash, "CELL", cell)
    dice = np.random.default_rng(2)
    centres = dice.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = set()
    for c in centres:
        for _ in range(30):
            flips = dice.choice(64, int(dice.integers(0, 6)), replace=False)
            values.add(int(c) ^ sum(1 << int(i) for i in flips))
    values = sorted(values)
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    table = op9_simhash.written(spark.createDataFrame(
        [(s, bytearray(v.to_bytes(8, "little"))) for s, v in zip(signed, values)], "node long, fp binary"), "t")
    for rows_ in (len(values), 1 << 24, 1 << 40):
        joined = {r["node"]: r["root"] for r in op9_simhash.stars(op9_simhash.links(
            table, 64, 4, op9_simhash.exact_tables(64, 4, rows_))).collect()}
        roots = [joined.get(s, s) for s in signed]
        want = h.groups(range(len(values)), values)
        assert len({*zip(roots, want)}) == len(set(roots)) == len(set(want))


def test_one_document_of_each_group_stays(spark, docs):
    text = " ".join(f"w{i}" for i in range(400))
    near = text.replace("w200", "other")
    far = " ".join(f"v{i}" for i in range(400))
    left = sorted(r["doc_id"] for r in op9_simhash.deduplicated(h.frame(spark, [text, far, near, text, None, ""])).collect())
    assert left == [0, 1, 4]
    copies = op9_simhash.deduplicated(docs.union(docs))
    assert copies.columns == docs.columns and copies.count() == copies.select("doc_id").distinct().count()


def test_near_duplicates_are_told_by_exact_similarity(spark):
    """Pairs on both sides of 0.8, against all pairs by brute force."""
    dice = np.random.default_rng(8)
    texts = []
    for i in range(150):
        own = [f"w{x}" for x in dice.integers(0, 1 << 30, 304)]
        texts.append(" ".join(own))
        for j in dice.choice(60, int(dice.integers(4, 13)), replace=False):
            own[2 + 5 * j] = "x"
        texts.append(" ".join(own))
    words_ = [t.split() for t in texts]
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in words_]
    close = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2])]
    assert sum(0.7 <= c < 0.8 for c in close) > 20 and sum(0.8 <= c < 0.9 for c in close) > 20
    want = [i for i in range(len(texts)) if i % 2 == 0 or close[i // 2] < 0.8]
    assert sorted(r["doc_id"] for r in op9_simhash.deduplicated(h.frame(spark, texts)).collect()) == want


@pytest.mark.parametrize("limit", [1 << 23, 20_000])
def test_groups_of_many_near_duplicates(spark, monkeypatch, limit):
    """One group far larger than a cell, whose texts are linked in a chain only."""
    monkeypatch.setattr(op9_simhash, "CELL_BYTES", limit)
    own, texts = [f"w{i}" for i in range(200)], []
    for i in range(120):
        own[i] = f"v{i}"
        texts.append(" ".join(own))
    far = " ".join(f"u{i}" for i in range(200))
    left = [r["doc_id"] for r in op9_simhash.deduplicated(h.frame(spark, [*texts, far])).collect()]
    assert sorted(left) == [0, 120]


def test_languages_of_held_out_rows(spark, awkward):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = rows(op10_language.query(docs))
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [i for i, r in found.items() if r["held_out"]]
    assert sum(found[i]["lang_pred"] == truth[i] for i in held) >= 0.97 * len(held)
    found = rows(op10_language.query(awkward))
    for i, text in enumerate(h.AWKWARD):
        told = any(c.isalpha() for c in text or "")
        assert found[i]["lang_pred"] == ("en" if told else "und") and 0 <= found[i]["score"] <= 1


def test_rare_languages_are_learnt_at_any_size(spark):
    """Few rows of one language beside many of another, of which the sample takes few."""
    dice = np.random.default_rng(4)
    say = lambda letters: " ".join("".join(dice.choice(list(letters), 6)) for _ in range(30))
    texts = [say("abcdefgh") for _ in range(2000)] + [say("stuvwxyz") for _ in range(8)]
    found = rows(op10_language.languages(h.frame(spark, texts, lang=["aa"] * 2000 + ["zz"] * 8), fit_rows=100))
    assert all(found[i]["lang_pred"] == ("aa" if i < 2000 else "zz") for i in found)
    train = op10_language.training(h.frame(spark, texts, lang=["aa"] * 2000 + ["zz"] * 8))
    taken = Counter(r["lang"] for r in op10_language.sampled(train, 100).collect())
    assert taken["zz"] == train.where("lang = 'zz'").count() and 50 < taken["aa"] < 150


def test_empty_tables(spark):
    none = h.empty(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for df in (op1_token_index.query(spark, none, tokenizer()), op2_outliers.judged(none), op3_packing.query(none),
               op4_mixing.query(none), op4_mixing.mix(none), op5_personal_data.query(none), op6_maxent.query(none),
               op7_toxicity.query(none, labels), op8_decontamination.query(none, bench),
               op8_decontamination.cleaned(none, bench), op9_simhash.query(none), op9_simhash.deduplicated(none),
               op2_outliers.kept_documents(none), op10_language.query(none)):
        assert df.count() == 0


def test_null_ids_and_languages(spark):
    df = spark.createDataFrame([(None, "some words here", None, None, None)] * 3 + [(1, None, None, None, None)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(None, "some words"), (None, None)], "item_id long, text string")
    for out in (op1_token_index.query(spark, df, tokenizer()), op2_outliers.judged(df), op3_packing.query(df),
                op4_mixing.query(df), op5_personal_data.query(df), op6_maxent.query(df), op7_toxicity.query(df, labels),
                op8_decontamination.query(df, bench), op9_simhash.query(df), op10_language.query(df)):
        assert out.count() == 4


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def test_many_spans_in_one_text(spark):
    """Time grows with the matches, not with their square; positions hold across blocks."""
    import time

    text = "1.1.1.1 " * 64_000
    found = op5_personal_data.query(h.frame(spark, ["a 9.9.9.9", text, None])).where("doc_id = 1")
    start = time.time()
    (row,) = found.collect()
    assert row["n_ip"] == 64_000 and row["base_sha256"] == h.sha(",".join(
        f"ip:{8 * i}:{8 * i + 7}" for i in range(64_000)))
    assert time.time() - start < 60
