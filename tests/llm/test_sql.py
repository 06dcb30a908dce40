"""The operators' SQL against their queries, on the given tables and on awkward ones."""

import numpy as np
import pytest
from oracle_check import connect, difference
from tests.llm import helpers as h

from tagweave.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) is None


def test_windows_of_awkward_tables(spark, tmp_path):
    """Null, empty and repeated texts and items, items shorter than a window, and few words that overlap and nest."""
    dice = np.random.default_rng(3)
    texts = [" ".join(dice.choice(list("abA"), 80)) for _ in range(80)]
    items = [(i, " ".join(dice.choice(list("abA"), n))) for i, n in enumerate(range(6, 18))]
    items += [(50, None), (51, ""), (52, " ..."), (3, items[3][1]), (60, items[3][1]), (None, "word " * 12), (61, "漢字 END")]
    docs = h.frame(spark, [*h.AWKWARD, *texts]).union(h.frame(spark, texts[:3]))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    query = QUERIES["op8_decontamination"](spark, str(tmp_path))
    db = connect(SF)
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert query.where("contaminated").count() > 20
    assert difference(query, db, ORACLE["op8_decontamination"]) is None
