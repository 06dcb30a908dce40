"""Tags of recency and favourite from changes: state and tags of the changed entities are renewed, nothing else is read."""

from pyspark.sql import DataFrame, functions as F

from tagweave.operators import incremental
from tagweave.operators.merging import collapse
from tagweave.operators.rules import RuleTree
from tagweave.plans.tag_jobs import FAVOURITE, RECENCY, RunOptions, TagJob, attach
from tagweave.session import written
from tagweave.sources.buckets import BucketTable


def refresh_tags(jobs: list[TagJob], tree: RuleTree, state: BucketTable, tags: BucketTable, changes: DataFrame,
                 options: RunOptions, kind: str = "change") -> None:
    """Bring `state` (key of the jobs) and `tags` (key userId) up to date with the changes.

    `changes` has the jobs' key and fields, and in `kind` what happened to the row. The first call fills both tables.
    An entity without rows left keeps a row without tags.
    """
    by_kind = {job.statistic: job for job in jobs}
    if set(by_kind) - {RECENCY, FAVOURITE} or len(by_kind) < len(jobs):
        raise ValueError("one recency and one favourite job at most")
    if options.rank != 1:
        raise ValueError("only the top favourite is kept")
    recency, favourite = by_kind[RECENCY], by_kind[FAVOURITE]
    if recency.key != favourite.key:
        raise ValueError("the jobs differ in their key")
    key = recency.key
    delta = written(incremental.day_counts(changes, key, favourite.field, recency.field,
                                           incremental.sign_of(F.col(kind))), "day-counts")
    counts = incremental.apply_changes(state, delta)
    tagged = incremental.recency_and_favourite(counts, key, favourite.field, options.day())
    for job in jobs:
        tagged = attach(tagged, job, tree)
    found = F.flatten(F.array(*[job.column for job in jobs]))
    new = tagged.select(F.col(key).alias("userId"), F.explode_outer(found).alias("tagsId"))
    seen = delta.select(F.col(key).alias("userId")).distinct()
    tags.upsert(collapse(new.unionByName(seen.withColumn("tagsId", F.lit(None).cast("string")))))
