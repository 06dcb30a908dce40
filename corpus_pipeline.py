"""From documents to shards: quality rules, near-duplicates, decontamination, mixing, sharding.

Each stage takes what the one before kept, as a table written in the shared folder. Quality rules drop the documents
they reject; of near-duplicates the one of the smallest doc_id stays; passages of benchmark items are cut out, and a
document that is mostly such passages goes; mixing gives each document as often as its source's target asks; sharding
puts the rows into shards, copies that the mix repeats together.
"""

from pyspark.sql import DataFrame, SparkSession

from tagweave.llm import op2_outliers, op3_packing, op4_mixing, op8_decontamination, op9_simhash
from tagweave.llm.tables import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    columns = docs.columns
    return op2_outliers.kept_documents(docs).select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op9_simhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op8_decontamination.cleaned(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op4_mixing.mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op3_packing.packed(docs, keep=("lang", "source")).select(
        "doc_id", "lang", "source", "size", "text_crc32", "shard", "slot")


STAGES = [("quality rules", quality), ("near-duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]

# The first stage's estimates and the fingerprints have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{number}")
    return docs
