"""The queries of the operators and their SQL, by name."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagweave.llm import (op1_token_index, op2_outliers, op3_packing, op4_mixing, op5_personal_data, op6_maxent,
                          op7_toxicity, op8_decontamination, op9_simhash, op10_language, op11_repeats, op12_alignment,
                          op13_prefix_trie)
from tagweave.llm.tables import table


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_index": lambda spark, d: op1_token_index.query(spark, table(spark, d, "documents"), tokenizer()),
    "op2_robust_outliers": lambda spark, d: op2_outliers.judged(table(spark, d, "documents")),
    "op3_best_fit_shards": lambda spark, d: op3_packing.query(table(spark, d, "documents")),
    "op4_water_filling": lambda spark, d: op4_mixing.query(table(spark, d, "documents")),
    "op5_personal_data": lambda spark, d: op5_personal_data.query(table(spark, d, "documents")),
    "op6_maxent_scores": lambda spark, d: op6_maxent.query(table(spark, d, "documents")),
    "op7_toxicity": lambda spark, d: op7_toxicity.query(table(spark, d, "documents"), table(spark, d, "labels")),
    "op8_decontamination": lambda spark, d: op8_decontamination.query(table(spark, d, "documents"),
                                                                      table(spark, d, "benchmark")),
    "op9_simhash_groups": lambda spark, d: op9_simhash.query(table(spark, d, "documents")),
    "op10_languages": lambda spark, d: op10_language.query(table(spark, d, "documents")),
    "op11_repeats": lambda spark, d: op11_repeats.query(table(spark, d, "documents")),
    "op12_alignment": lambda spark, d: op12_alignment.query(table(spark, d, "documents"), tokenizer("byte_bpe_50k.json"),
                                                            tokenizer("piece_bpe_32k.model")),
    "op13_prefix_trie": lambda spark, d: op13_prefix_trie.query(table(spark, d, "conversations")),
}

ORACLE: dict[str, str] = {"op4_water_filling": op4_mixing.SQL, "op8_decontamination": op8_decontamination.SQL,
                          "op11_repeats": op11_repeats.SQL, "op13_prefix_trie": op13_prefix_trie.SQL}
