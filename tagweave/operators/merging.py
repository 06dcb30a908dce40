"""New tags and stored tags to one tag set.

Rules: no new tag keeps the stored set; no stored set takes the new one; else the
stored tags of the same category go out and the new ones come in. Sets are sorted
comma text. Several rows of a user are one set before anything else, on either side
and on every path; rows without a user are left out. `keyed` is the caller's word that
the stored table has one row a user, as a keyed store has: it then meets the new tags
without an aggregate of its own.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tagweave.functions import tag_sets
from tagweave.operators.joins import DEFAULT_BOUND, Bound, fits, lookup_join


def collapse(new: DataFrame) -> DataFrame:
    """Several tag rows of one user to one sorted set; users without a tag keep null."""
    tags = F.array_distinct(F.flatten(F.collect_set(tag_sets.to_set(F.col("tagsId")))))
    return new.groupBy("userId").agg(tags.alias("_tags")).select("userId", tag_sets.filled(F.col("_tags")).alias("tagsId"))


def one_set(stored: DataFrame) -> DataFrame:
    """As `collapse`, but the text of a user with a single row stays as it is."""
    return stored.groupBy("userId").agg(stored_text(F.col("tagsId"), F.count("*")).alias("tagsId"))


def stored_text(tags: Column, rows: Column) -> Column:
    """Aggregate over the stored rows of a user."""
    every = F.array_distinct(F.flatten(F.collect_set(tag_sets.to_set(tags))))
    return F.when(rows == 1, F.max(tags)).otherwise(tag_sets.filled(every))


def merged_column(new: Column, old: Column, category: Column | None, drop_stale: bool = False) -> Column:
    """One merged set from the comma texts `new`, `old` and the category's ids.

    With `category` null or None the stored set is only added to. `drop_stale` also
    removes the category from the stored set when there is no new tag.
    """
    if category is None:
        return F.when(new.isNull(), old).when(old.isNull(), new).otherwise(tag_sets.union(new, old))
    unmatched = tag_sets.without(old, category) if drop_stale else old
    return F.when(new.isNull(), unmatched).when(old.isNull(), new).otherwise(tag_sets.replace(new, old, category))


def _stored_pair(new: DataFrame, stored: DataFrame, keyed: bool) -> DataFrame:
    known = stored.where(F.col("userId").isNotNull())
    old = (known if keyed else one_set(known)).select(F.col("userId").alias("_user"), F.col("tagsId").alias("_old"))
    return _of_users(new).join(old, F.col("userId") == F.col("_user"), "left").select("userId", "tagsId", "_old")


def _of_users(tags: DataFrame) -> DataFrame:
    return collapse(tags.where(F.col("userId").isNotNull()))


def merge_union(new: DataFrame, stored: DataFrame, keyed: bool = False) -> DataFrame:
    """Merge without removing the category."""
    merged = merged_column(F.col("tagsId"), F.col("_old"), None)
    return _stored_pair(new, stored, keyed).select("userId", merged.alias("tagsId"))


def merge_tags(new: DataFrame, stored: DataFrame, category: DataFrame | list[str], drop_stale: bool = False,
               bound: Bound = DEFAULT_BOUND, keyed: bool = False) -> DataFrame:
    """Merge one category's new tags.

    `category` holds its tag ids, as a list or as a frame with column `id`. A list,
    or a frame within the bound, becomes a literal set inside the expression. With a
    larger frame the old tags are looked up in it one by one.
    """
    if isinstance(category, DataFrame):
        ids = category.select(F.col("id").cast("string").alias("id"))
        literal = sorted({r["id"] for r in ids.collect()}) if fits(ids, bound) else None
    else:
        literal = category
    if literal is not None:
        merged = merged_column(F.col("tagsId"), F.col("_old"), F.lit(",".join(literal)), drop_stale)
        return _stored_pair(new, stored, keyed).select("userId", merged.alias("tagsId"))

    # One pass over the pairs: each old tag looks up whether the category holds it.
    pairs = _stored_pair(new, stored, keyed)
    single = pairs.select("*", F.explode_outer(tag_sets.to_set(F.col("_old"))).alias("tag"))
    members = ids.distinct().select(F.col("id").alias("tag"), F.lit(True).alias("_member"))
    checked = lookup_join(single, members, ["tag"], "left", small=False)
    kept = F.collect_set(F.when(F.col("_member").isNull(), F.col("tag")))
    per_user = checked.groupBy("userId").agg(
        F.any_value("tagsId").alias("tagsId"), F.any_value("_old").alias("_old"), kept.alias("_kept"))
    unmatched = tag_sets.filled(F.col("_kept")) if drop_stale else F.col("_old")
    both = tag_sets.to_text(F.concat(tag_sets.to_set(F.col("tagsId")), "_kept"))
    merged = F.when(F.col("tagsId").isNull(), unmatched).when(F.col("_old").isNull(), F.col("tagsId")).otherwise(both)
    return per_user.select("userId", merged.alias("tagsId"))


def merge_into_store(new: DataFrame, stored: DataFrame, category: list[str], drop_stale: bool = False) -> DataFrame:
    """The store after the merge: users without new rows keep theirs, new users come in.

    Merge and upsert in one full outer join, so each side is evaluated once. A new
    user without a tag is left out; a stored user never disappears.
    """
    old = one_set(stored.where(F.col("userId").isNotNull())).select(F.col("userId").alias("_user"), F.col("tagsId").alias("_old"))
    fresh = _of_users(new)
    joined = old.join(fresh, F.col("_user") == F.col("userId"), "full_outer")
    merged = merged_column(F.col("tagsId"), F.col("_old"), F.lit(",".join(category)), drop_stale)
    tags = F.when(F.col("userId").isNull(), F.col("_old")).otherwise(merged)
    kept = F.col("_user").isNotNull() | F.col("tagsId").isNotNull()
    return joined.where(kept).select(F.coalesce("_user", "userId").alias("userId"), tags.alias("tagsId"))
