"""The rule tree: (id, pid, level, rule).

A level-4 rule says where the business rows are, the level-5 rules below it say
which tag each of them gets, by equality (`alipay`) or by range (`0-7`).
"""

from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from tagweave.functions import text
from tagweave.operators.joins import DEFAULT_BOUND, Bound, fits
from tagweave.sources.spec import SourceSpec

RULE_SCHEMA = "id int, pid int, level int, rule string"


def children(rules: DataFrame, parent: int) -> DataFrame:
    return rules.where(F.col("pid") == parent).select("id", "rule")


def range_text(rule: Column) -> tuple[Column, Column]:
    """Both bounds of `lo-hi` as text; null where a part is missing."""
    return text.part(rule, "-", 0), text.part(rule, "-", 1)


def number_ranges(rules: DataFrame) -> DataFrame:
    """`lo-hi` rules as typed bounds (id, lo, hi); bad text gives null bounds."""
    lo, hi = range_text(F.col("rule"))
    return rules.select("id", lo.try_cast("bigint").alias("lo"), hi.try_cast("bigint").alias("hi"))


def date_ranges(rules: DataFrame) -> DataFrame:
    """`yyyyMMdd-yyyyMMdd` rules as day numbers (id, lo, hi)."""
    lo, hi = range_text(F.col("rule"))
    return rules.select(
        "id",
        text.day_number(text.compact_date(lo)).alias("lo"),
        text.day_number(text.compact_date(hi)).alias("hi"),
    )


def category_ids(rules: DataFrame) -> DataFrame:
    """Tag ids below each parent, as sorted comma text (pid, ids)."""
    ids = F.array_sort(F.collect_set(F.col("id").cast("string")))
    return rules.where("pid is not null").groupBy("pid").agg(F.array_join(ids, ",").alias("ids"))


class RuleTree:
    """A rule table with its size checked once.

    A tree within the bound is read once and kept on the driver, so that setting up
    a job starts no further Spark job for it.
    """

    def __init__(self, rules: DataFrame, bound: Bound = DEFAULT_BOUND):
        self.rules = rules
        self.bound = bound

    @cached_property
    def small(self) -> bool:
        return fits(self.rules, self.bound)

    @cached_property
    def _rows(self) -> list:
        return self.rules.select("id", "pid", "rule").collect() if self.small else []

    def children(self, parent: int) -> DataFrame:
        return children(self.rules, parent)

    def source_spec(self, tag_id: int) -> SourceSpec:
        if self.small:
            found = [r["rule"] for r in self._rows if r["id"] == tag_id]
        else:
            found = [r["rule"] for r in self.rules.where(F.col("id") == tag_id).select("rule").take(1)]
        if not found or found[0] is None:
            raise LookupError(f"no source rule with id {tag_id}")
        return SourceSpec.from_text(found[0])

    def tag_ids(self, parent: int) -> list[str]:
        """Tag ids of one category on the driver; only for a tree within the bound."""
        if not self.small:
            raise ValueError("the rule tree exceeds its bound")
        return sorted(str(r["id"]) for r in self._rows if r["pid"] == parent)
