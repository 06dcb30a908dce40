"""Mixing sources to target weights by capped water-filling, then whole and fractional repetitions.

Water-filling in closed form: sources fill up in order of cap over weight; the level at which the budget is spent is
what repeated clamping and resharing ends at. A source's documents are all repeated as often as its target holds it
whole; of the rest, documents in seeded order are taken once more until the target is met to the nearest document.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.llm.tables import WORD, blocks, put_back, running, set_aside, written

SEED = "mix-1"
WEIGHTS = (5, 2, 1)
EPOCHS = 3


def targets(sizes: DataFrame, weight: Column, budget: Column, epochs: float = EPOCHS) -> DataFrame:
    """source, source_size, target: shares of the budget by weight, none above `epochs` times the source's size.

    `sizes` has a row per source: the two windows go over sources, not rows. What all caps together can't hold of the
    budget stays unspent.
    """
    cap = (F.col("source_size") * epochs).alias("cap")
    capped = sizes.select("*", weight.alias("weight"), cap, budget.alias("budget"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    full = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
    open_ = F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = capped.withColumn("level", full / open_)
    levels = levels.withColumn("clamped", F.col("cap") <= F.col("level") * F.col("weight"))
    # From the first source that isn't clamped on, none is; its level holds for all after it.
    first = F.min_by("level", F.when(~F.col("clamped"), F.struct(F.col("cap") / F.col("weight"),
                                                               F.col("source").isNull(), "source")))
    return (levels.withColumn("level", first.over(Window.partitionBy()))
            .select("source", "source_size",
                    F.when(F.col("clamped"), F.col("cap").cast("double"))
                    .otherwise(F.col("level") * F.col("weight")).alias("target")))


def sized(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source",
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def seeded(seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def mixed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, whole, seeded, once_more, taken (words) of each row.

    Sources weigh 5, 2, 1, repeating, by code point, null last, and share the words there are. Null text or text
    without words: size 0, taken 0. Repeated rows are documents of their own. Empty table: no rows. Other columns are
    not read.
    """
    rows = written(sized(docs), "mix-rows")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    goal = targets(totals.withColumn("_weight", weight), F.col("_weight"),
                   F.sum("source_size").over(Window.partitionBy()))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = written(goal.select(F.col("source").alias("_source"), "source_size", "target", whole.cast("long").alias("whole"),
                               F.row_number().over(Window.orderBy("target", "source_size", "source")).alias("_no")),
                   "mix-targets")
    n_blocks = blocks(rows.count())
    known = (rows.join(goal, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
             .withColumn("seeded", seeded(seed))
             .withColumn("block", F.floor(F.conv(F.substring("seeded", 1, 8), 16, 10).cast("long") * n_blocks
                                          / F.lit(1 << 32)).cast("int")))
    before = running(known, ["_no"], "block", [F.col("seeded"), F.col("doc_id"), F.col("size")], F.col("size"), "before")
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    once_more = (F.col("size") > 0) & (2 * F.col("before") + F.col("size") <= 2 * rest)
    return before.withColumn("once_more", once_more).select(
        "doc_id", "source", "size", "source_size", "target", "whole", "seeded", "once_more",
        (F.col("size") * (F.col("whole") + F.col("once_more").cast("long"))).alias("taken"))


def query(docs: DataFrame) -> DataFrame:
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken")


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The documents, each as often as the mix takes it.

    What is taken once more is all of a source up to one document in seeded order, so the texts need no shuffle: they
    meet a table with a row per source. Documents without words, null texts among them, are taken in no mix. Repeated rows
    are documents of their own. Empty table: no rows. Columns of any name come back unchanged.
    """
    last = F.max(F.when(F.col("once_more"), F.struct("seeded", F.coalesce("doc_id", F.lit(-1 << 62)), "size")))
    bounds = written(mixed(docs, seed).groupBy("source").agg(F.first("whole").alias("whole"), last.alias("last"))
                     .withColumnRenamed("source", "_source"), "mix-bounds")
    rows, _ = set_aside(docs, "doc_id", "source", "text")
    rows = rows.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
    known = rows.join(bounds, F.col("source").eqNullSafe(F.col("_source")))
    own = F.struct(seeded(seed), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1 << 62)), "size")
    times = F.when(F.col("size") > 0, F.col("whole") + F.coalesce((own <= F.col("last")).cast("long"), F.lit(0))).otherwise(0)
    taken = known.withColumn("times", times).where("times > 0")
    return put_back(taken.withColumn("copy", F.explode(F.expr("sequence(1L, times)"))), docs)


SQL = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END
    AS weight, source_size * 3 AS cap FROM totals),
filling AS (
  SELECT *, cap / weight AS ratio, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place FROM weighed),
levels AS (
  SELECT a.*, CAST((SELECT sum(source_size) FROM totals) - coalesce((SELECT sum(cap) FROM filling b
      WHERE b.place < a.place), 0) AS DOUBLE)
    / (SELECT sum(weight) FROM filling b WHERE b.place >= a.place) AS level
  FROM filling a),
level AS (SELECT level FROM levels WHERE NOT cap <= level * weight ORDER BY place LIMIT 1),
goals AS (
  SELECT source, source_size, CASE WHEN cap <= level * weight THEN CAST(cap AS DOUBLE)
    ELSE (SELECT level FROM level) * weight END AS target FROM levels),
known AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, d.source,
    CASE WHEN g.source_size > 0 THEN CAST(floor(g.target / g.source_size) AS BIGINT) ELSE 0 END AS whole,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), '')),
      d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN size > 0 AND 2 * before + size <= 2 * (target - whole * source_size)
    THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM known
"""
