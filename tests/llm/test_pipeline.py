import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tests.llm import helpers as h

from tagweave.llm import op3_packing

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark):
    """The documents that each stage but the last leaves."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = op3_packing.written(stage(spark, docs, SF), "t")
        out.append(docs)
    return out


def test_stages_keep_the_columns(spark, kept):
    for df in kept:
        assert df.columns == spark.read.parquet(f"{SF}/documents.parquet").columns


def test_quality_drops_what_fails(spark, kept):
    left = {r["doc_id"]: r["text"] for r in kept[0].collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        assert not (r["doc_id"] in left and h.stats(r["text"])[5])
        assert left.get(r["doc_id"], r["text"]) == r["text"]
    good = [r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()]
    assert sum(i in left for i in good) > 0.93 * len(good)


def shingles(text):
    own = h.lower(text).split()
    return {tuple(own[i:i + 5]) for i in range(max(1, len(own) - 4))}


def test_no_near_duplicates_are_left(kept):
    """By Jaccard similarity over all pairs that share a shingle."""
    before, after = ({r["doc_id"]: shingles(r["text"]) for r in df.collect()} for df in kept[:2])

    def pairs(sets, least):
        where = {}
        for i, own in sets.items():
            for s in own:
                where.setdefault(s, []).append(i)
        close = {(a, b) for own in where.values() for a in own for b in own if a < b}
        return {(a, b) for a, b in close if len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])}

    assert not pairs(after, 0.8)
    linked = {i for pair in pairs(before, 0.8) for i in pair}
    assert all(i in after for i in before if i not in linked)


def test_no_window_is_left(spark, kept):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = h.windows([r["text"] for r in kept[2].collect()], items)
    assert not any(hit for _, hit, _ in found)


def test_run_gives_all_rows_of_the_mix(spark, kept):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() == kept[3].count() and out.select("shard", "slot").distinct().count() == out.count()


@pytest.mark.parametrize("filled", [True, False])
def test_run_over_awkward_and_empty_tables(spark, tmp_path, filled):
    """Nulls, empty and very long texts, repeated rows, null ids, languages and sources, clashing column names."""
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    sound = [t for t in texts if t and not h.stats(t)[5]][:60]
    docs = h.empty(spark)
    if filled:
        kinds = [None if i % 9 == 0 else "en" for i in range(len(h.AWKWARD) + len(sound))]
        docs = h.frame(spark, [*h.AWKWARD, *sound], kinds, kinds)
        docs = docs.union(docs.where("doc_id > 20")).union(docs.where("doc_id = 30").withColumn("doc_id", F.lit(None).cast("long")))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    if not filled:
        assert out == []
        return
    assert {r["doc_id"] for r in out} <= set(range(len(h.AWKWARD), len(h.AWKWARD) + len(sound)))
    assert len({(r["shard"], r["slot"]) for r in out}) == len(out)
    by_crc = {}
    for r in out:
        by_crc.setdefault(r["text_crc32"], set()).add(r["doc_id"])
    assert len(by_crc) > 20 and all(len(ids) == 1 for ids in by_crc.values())
