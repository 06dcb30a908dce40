"""Algebra on comma-joined tag sets, as column expressions.

A tag set is stored as one comma-joined string and worked on as an array.
Results are de-duplicated and sorted as strings, so equal sets are equal text.
"""

from pyspark.sql import Column, functions as F


def to_set(tags: Column) -> Column:
    """Comma text to array; null stays null, empty parts are dropped."""
    return F.array_remove(F.split(tags, ","), "")


def to_text(tags: Column) -> Column:
    """Array to sorted comma text; an empty set is empty text."""
    return F.array_join(F.sort_array(F.array_distinct(tags)), ",")


def filled(tags: Column) -> Column:
    """As `to_text`, an empty set becoming null. For plain columns: they are read twice."""
    return F.when(F.size(tags) > 0, to_text(tags))


def union(left: Column, right: Column) -> Column:
    return F.array_join(F.sort_array(F.array_union(to_set(left), to_set(right))), ",")


def without(tags: Column, removed: Column) -> Column:
    """Every copy of the removed tags is dropped; null when none is left."""
    return F.nullif(to_text(F.array_except(to_set(tags), to_set(removed))), F.lit(""))


def replace(new: Column, old: Column, removed: Column) -> Column:
    """The old tags without the removed ones, and the new ones."""
    kept = F.array_except(to_set(old), to_set(removed))
    return F.array_join(F.sort_array(F.array_union(to_set(new), kept)), ",")
