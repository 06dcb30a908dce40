"""Rules to tags: an entity gets the id of every rule its attribute satisfies.

Each matcher is one join with the rules, a broadcast where their size allows (see
`joins`). Inner matching drops entities without a rule, left matching keeps them
with a null tag. A rule id becomes text, the form in which tags are stored.
"""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType, FractionalType, IntegralType

from tagweave.operators.joins import DEFAULT_BOUND, Bound, fits, lookup_join, range_join, range_matches


def _comparable(df: DataFrame, attribute: Column) -> str:
    """Type in which the attribute meets the rule text: numbers as numbers, else text."""
    kind = df.select(attribute.alias("a")).schema["a"].dataType
    if isinstance(kind, IntegralType):
        return "bigint"
    if isinstance(kind, DecimalType):
        return kind.simpleString()
    return "double" if isinstance(kind, FractionalType) else "string"


def _code(rule: Column, kind: str) -> Column:
    """The rule text as a value of the type; null where it is none, or a decimal of more digits."""
    value = rule.try_cast(kind)
    if not kind.startswith("decimal"):
        return value
    precision, scale = (int(x) for x in kind[8:-1].split(","))
    whole = rule.try_cast(f"decimal(38,{38 - precision + scale})")
    return F.when(value == whole, value)


def attach_equal(df: DataFrame, attribute: Column, rules: DataFrame, tag: str, how: str = "left",
                 bound: Bound = DEFAULT_BOUND, small: bool | None = None) -> DataFrame:
    """Add column `tag` by comparing the attribute with the rule text.

    A numeric attribute meets the number in the text; text that is no number matches
    nothing and raises nothing. `small` skips the size check where the caller has
    made it already.
    """
    kind = _comparable(df, attribute)
    lookup = rules.select(_code(F.col("rule"), kind).alias("_code"), F.col("id").cast("string").alias(tag))
    if small is None:
        small = fits(lookup, bound)
    coded = df.withColumn("_code", attribute.cast(kind))
    return lookup_join(coded, lookup, ["_code"], how, small, keep=df.columns)


def attach_range(df: DataFrame, value: Column, ranges: DataFrame, tag: str, how: str = "left",
                 bound: Bound = DEFAULT_BOUND, small: bool | None = None) -> DataFrame:
    """Add column `tag` by closed numeric ranges (id, lo, hi); overlaps give several rows."""
    lookup = ranges.select("lo", "hi", F.col("id").cast("string").alias(tag))
    valued = df.withColumn("_value", value.cast("bigint"))
    return range_join(valued, "_value", lookup, how, bound, small, keep=df.columns)


def attach_ranges(df: DataFrame, value: Column, ranges: DataFrame, tags: str, bound: Bound = DEFAULT_BOUND,
                  small: bool | None = None) -> DataFrame:
    """Add the array `tags` by closed numeric ranges (id, lo, hi): a row stays one row however many overlap."""
    lookup = ranges.select("lo", "hi", F.col("id").cast("string").alias("id"))
    found = range_matches(df.withColumn("_value", value.cast("bigint")), "_value", lookup, "_matches", bound, small)
    return found.select(*df.columns, F.col("_matches.id").alias(tags))


def tag_equal(df: DataFrame, key: str, attribute: str, rules: DataFrame, how: str = "left",
              bound: Bound = DEFAULT_BOUND) -> DataFrame:
    """(userId, tagsId) by equality rules (id, rule)."""
    entities = df.select(F.col(key).alias("userId"), F.col(attribute).alias("_attribute"))
    tagged = attach_equal(entities, F.col("_attribute"), rules, "tagsId", how, bound)
    return tagged.select("userId", "tagsId")


def tag_range(df: DataFrame, key: str, value: Column, ranges: DataFrame, how: str = "left",
              bound: Bound = DEFAULT_BOUND) -> DataFrame:
    """(userId, tagsId) by typed ranges (id, lo, hi)."""
    entities = df.select(F.col(key).alias("userId"), value.alias("_attribute"))
    tagged = attach_range(entities, F.col("_attribute"), ranges, "tagsId", how, bound)
    return tagged.select("userId", "tagsId")
