"""Joins of a large fact with a lookup side of measured size.

A lookup within `Bound` is broadcast. A larger one is shuffled: the lookup is
repeated once per salt and the fact spread over the salts, so that one hot key
meets several tasks; copies of one row share a salt and are left to the adaptive
skew join. The merge hint keeps an estimate that is too low from broadcasting it
after all. Both ways give the same rows.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import AtomicType, BinaryType, StringType


@dataclass(frozen=True)
class Bound:
    """What may be broadcast: checked by an aggregate over the lookup itself."""

    rows: int = 200_000
    text_bytes: int = 64 * 1024 * 1024

    def holds(self, rows: int, text_bytes: int) -> bool:
        return rows <= self.rows and text_bytes <= self.text_bytes


DEFAULT_BOUND = Bound()
NEVER_BROADCAST = Bound(rows=-1)
SALTS = 8
CROWD = 64


def _width(name: str, kind) -> Column:
    """Bytes of a value: text and binary by length, nested values as JSON text, others 8."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    if isinstance(kind, AtomicType):
        return F.lit(8)
    return F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{name}`")))), F.lit(0))


def size_columns(df: DataFrame) -> list[Column]:
    """Aggregates `_rows` and `_bytes` measuring a frame without collecting it."""
    width = reduce(lambda a, b: a + b, [_width(f.name, f.dataType) for f in df.schema.fields],
                   F.lit(0).cast("bigint"))
    return [F.count(F.lit(1)).alias("_rows"), F.coalesce(F.sum(width), F.lit(0)).alias("_bytes")]


def _salt(fact: DataFrame, on: list[str]) -> Column:
    """One of SALTS for each row, from all it can be told apart by; maps have no hash.

    A row with a null key meets nothing and gets a value of its own, so that such rows
    don't gather in a few tasks.
    """
    plain = [F.col(f"`{f.name}`") for f in fact.schema.fields
             if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    value = F.xxhash64(*plain)
    lost = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in on])
    return F.when(lost, value).otherwise(F.pmod(value, F.lit(SALTS)))


def fits(df: DataFrame, bound: Bound = DEFAULT_BOUND) -> bool:
    size = df.agg(*size_columns(df)).first()
    return bound.holds(size["_rows"], size["_bytes"])


def lookup_join(fact: DataFrame, lookup: DataFrame, on: list[str], how: str, small: bool,
                extra: Column | None = None, keep: list[str] | None = None,
                payload: list[str] | None = None) -> DataFrame:
    """Join on equal key columns `on` (same name on both sides) and `extra`.

    `how` is inner or left. The result has the fact's columns, or those in `keep`,
    and then the lookup's other columns, or those in `payload`. In `extra` the fact
    is `f` and the lookup `l`.
    """
    if keep is None:
        keep = fact.columns
    if payload is None:
        payload = [c for c in lookup.columns if c not in on]
    if small:
        right = F.broadcast(lookup.alias("l"))
        keys = list(on)
        left = fact.alias("f")
    else:
        left = fact.withColumn("_salt", _salt(fact, on)).alias("f")
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
        right = lookup.withColumn("_salt", every).alias("l").hint("merge")
        keys = [*on, "_salt"]
    condition = reduce(lambda a, b: a & b, [F.col(f"f.{k}") == F.col(f"l.{k}") for k in keys])
    if extra is not None:
        condition = condition & extra
    return left.join(right, condition, how).select(*[f"f.{c}" for c in keep], *[f"l.{c}" for c in payload])


def _width_classes(ranges: DataFrame, bound: Bound) -> list[tuple[int, int, bool]]:
    """(lowest level, highest level, whether its buckets may be broadcast) of each width class.

    The level of a range is the power of two its length fits in. A class of up to CROWD
    ranges joins the next wider one: so few never crowd a bucket.
    """
    levels = ranges.groupBy(_level().alias("_level")).agg(*size_columns(ranges)).collect()
    classes: list[list[int]] = []
    for row in sorted(levels, key=lambda r: r["_level"]):
        if classes and classes[-1][2] <= CROWD:
            classes[-1][1:] = [row["_level"], classes[-1][2] + row["_rows"], classes[-1][3] + row["_bytes"]]
        else:
            classes.append([row["_level"], row["_level"], row["_rows"], row["_bytes"]])
    return [(low, high, bound.holds(2 * rows, 2 * size)) for low, high, rows, size in classes]


def _level() -> Column:
    return F.least(F.length(F.bin(F.expr("hi - lo"))), F.lit(62))


def _bucket(name: str, level: int) -> Column:
    return F.expr(f"`{name}` div {1 << level}L")


def range_join(fact: DataFrame, value: str, ranges: DataFrame, how: str = "inner",
               bound: Bound = DEFAULT_BOUND, small: bool | None = None,
               keep: list[str] | None = None) -> DataFrame:
    """Rows of `ranges` (lo, hi, payload..) whose closed range holds `fact[value]`.

    Ranges are put into width classes, each cut into buckets as wide as its widest, so
    a range fills at most two buckets, and one wide range does not crowd many narrow
    ones together. Value and range then meet through one equi-join on the bucket for
    each class instead of a nested loop. Several classes (63 at most) are matched as
    arrays, see `range_matches`. Ranges with a null or reversed bound match nothing; a null value matches
    nothing. `small=False` rules the broadcast out; it is measured otherwise.
    """
    ranges = ranges.where("lo <= hi")
    payload = [c for c in ranges.columns if c not in ("lo", "hi")]
    keep = keep or fact.columns
    classes = _width_classes(ranges, bound) or [(0, 62, True)]

    if len(classes) == 1:
        _, high, fit = classes[0]
        inside = F.col(f"f.{value}").between(F.col("l.lo"), F.col("l.hi"))
        buckets = ranges.withColumn("_bucket", F.explode(F.sequence(_bucket("lo", high), _bucket("hi", high))))
        return lookup_join(fact.withColumn("_bucket", _bucket(value, high)), buckets, ["_bucket"], how,
                           fit and small is not False, inside, keep, payload)
    matched = range_matches(fact, value, ranges, "_inside", bound, small)
    each = (F.explode if how == "inner" else F.explode_outer)(F.col("_inside"))
    return matched.select(*keep, each.alias("_one")).select(*keep, *[F.col(f"_one.{c}") for c in payload])


def range_matches(fact: DataFrame, value: str, ranges: DataFrame, into: str, bound: Bound = DEFAULT_BOUND,
                  small: bool | None = None) -> DataFrame:
    """The fact with the array column `into`: all ranges (lo, hi, payload.. as structs) that hold `fact[value]`.

    A row stays one row however many ranges match, so several matches in turn never multiply. Each width class brings
    the ranges of the value's bucket, in order of `lo`, as one array; classes are as wide as their ranges, so a bucket
    holds little more than the ranges a value in it can meet. No match, or a null value: an empty array.
    """
    ranges = ranges.where("lo <= hi")
    columns, found = fact.columns, []
    payload = [c for c in ranges.columns if c not in ("lo", "hi")]
    classes = _width_classes(ranges, bound) or [(0, 62, True)]
    for low, high, fit in classes:
        found.append(f"_found_{high}")
        own = ranges.where(_level().between(low, high)) if len(classes) > 1 else ranges
        held = (own.withColumn("_bucket", F.explode(F.sequence(_bucket("lo", high), _bucket("hi", high))))
                .groupBy("_bucket").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", *payload))).alias(found[-1])))
        fact = lookup_join(fact.withColumn("_bucket", _bucket(value, high)), held, ["_bucket"], "left",
                           fit and small is not False, keep=fact.columns)
    near = F.flatten(F.array_compact(F.array(*found)))
    inside = F.filter(near, lambda r: F.col(value).between(r["lo"], r["hi"]))
    return fact.select(*columns, F.when(F.col(value).isNotNull(), inside).otherwise(F.filter(near, lambda r: F.lit(False)))
                       .alias(into))
