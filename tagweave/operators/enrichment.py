"""Lookups on log lines: address to area, user agent to os, device and browser."""

import heapq

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tagweave.functions.ip import with_ip_number
from tagweave.functions.user_agent import DEFAULT_RULES, AgentRules, agent_columns
from tagweave.operators.joins import DEFAULT_BOUND, Bound, fits, lookup_join, range_join
from tagweave.session import written

UNKNOWN_AREA = "unknown"
BLOCK = 1 << 16


def address_ranges(cidr: DataFrame) -> DataFrame:
    """(first, last, area) with dotted addresses to numeric (lo, hi, area)."""
    return with_ip_number(with_ip_number(cidr, "first", "lo"), "last", "hi").select("lo", "hi", "area")


def overlapping(areas: DataFrame) -> DataFrame:
    """Ranges (lo, hi, ..) that start inside an earlier one of the same /16 block.

    An address has one area, so a dimension must give no rows here. Blocks keep the
    sort of each task small; two ranges that overlap share at least one block.
    """
    blocks = areas.where("lo <= hi").withColumn("_block", F.explode(F.sequence(F.expr("lo div 65536"), F.expr("hi div 65536"))))
    before = (Window.partitionBy("_block").orderBy("lo", "hi")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (blocks.withColumn("_reach", F.max("hi").over(before))
            .where("lo <= _reach").select(*areas.columns).distinct())


def most_specific(areas: DataFrame) -> DataFrame:
    """Ranges (lo, hi, area) that may nest or overlap, cut into disjoint pieces: the narrowest range gives the area.

    Of ranges of one width that overlap, the one that starts last wins, then the area that sorts first. Ranges are cut
    at blocks of 65,536 addresses, and each block is swept in a task by itself. A range that covers whole blocks sends
    none of them to a sweep: per block, an aggregate with map-side combine finds the narrowest such range, which is the
    whole answer unless narrower ranges begin or end in the block. Null or reversed bounds match nothing.
    """
    known = areas.where("lo <= hi").select(F.col("lo").cast("bigint"), F.col("hi").cast("bigint"), "area")
    order = F.struct((F.col("hi") - F.col("lo")).alias("width"), (-F.col("lo")).alias("start"), F.col("area").alias("name"))
    first, last = F.expr(f"(lo + {BLOCK - 1}) div {BLOCK}"), F.expr(f"(hi + 1) div {BLOCK} - 1")
    placed = known.withColumn("rank", order)
    whole = (placed.where(first <= last).withColumn("block", F.explode(F.sequence(first, last)))
             .groupBy("block").agg(F.min("rank").alias("rank")))
    ends = F.array_distinct(F.array(F.expr(f"lo div {BLOCK}"), F.expr(f"hi div {BLOCK}")))
    parts = placed.withColumn("block", F.explode(ends)).where((F.col("block") < first) | (F.col("block") > last))
    start = F.col("block") * BLOCK
    parts = parts.select("block", F.greatest("lo", start).alias("lo"), F.least("hi", start + BLOCK - 1).alias("hi"), "rank").distinct()
    swept = parts.select("block").distinct()
    behind = whole.select("block", start.alias("lo"), (start + BLOCK - 1).alias("hi"), "rank")
    alone = behind.join(swept, "block", "left_anti").select("lo", "hi", F.col("rank.name").alias("area"))
    swept = parts.unionByName(behind.join(swept, "block", "left_semi")).select("block", "lo", "hi", "rank.*")
    return alone.unionByName(swept.groupBy("block").applyInPandas(_swept, known.schema))


def _swept(block: pd.DataFrame) -> pd.DataFrame:
    """The ranges of a block, in order of their starts; at each bound the narrowest open range goes on."""
    rows = sorted(zip(block["lo"], block["hi"], block["width"], block["start"], block["name"].fillna(""),
                      block["name"].isna(), strict=True))
    bounds = sorted({lo for lo, *_ in rows} | {hi + 1 for _, hi, *_ in rows})
    opened, pieces, at = [], [], 0
    for low, after in zip(bounds, bounds[1:]):
        while at < len(rows) and rows[at][0] == low:
            lo, hi, *rank, empty = rows[at]
            heapq.heappush(opened, (*rank[:2], not empty, rank[2], hi))
            at += 1
        while opened and opened[0][-1] < low:
            heapq.heappop(opened)
        if not opened:
            continue
        own = opened[0][:4]
        if pieces and pieces[-1][1] == low - 1 and pieces[-1][2] == own:
            pieces[-1][1] = after - 1
        else:
            pieces.append([low, after - 1, own])
    return pd.DataFrame([(lo, hi, own[3] if own[2] else None) for lo, hi, own in pieces], columns=["lo", "hi", "area"])


def add_nested_area(df: DataFrame, areas: DataFrame, ip: str = "ip", fallback: str = UNKNOWN_AREA,
                    bound: Bound = DEFAULT_BOUND) -> DataFrame:
    """As `add_area`, for ranges that nest or overlap: the narrowest that holds the address."""
    return add_area(df, written(most_specific(areas), "areas"), ip, fallback, bound)


def add_area(df: DataFrame, areas: DataFrame, ip: str = "ip", fallback: str = UNKNOWN_AREA,
             bound: Bound = DEFAULT_BOUND) -> DataFrame:
    """Add `area` by disjoint address ranges (lo, hi, area); `fallback` elsewhere."""
    numbered = with_ip_number(df, ip, "_ip")
    found = range_join(numbered, "_ip", areas.select("lo", "hi", "area"), "left", bound, keep=df.columns)
    return found.withColumn("area", F.coalesce("area", F.lit(fallback)))


def add_agent(df: DataFrame, agent: str = "useragent", rules: AgentRules = DEFAULT_RULES) -> DataFrame:
    """Add os, device and browser row by row, in generated code."""
    return df.select("*", *agent_columns(F.col(agent), rules))


def add_agent_by_dictionary(df: DataFrame, agent: str = "useragent", rules: AgentRules = DEFAULT_RULES,
                            bound: Bound = DEFAULT_BOUND) -> DataFrame:
    """As `add_agent`, classifying each distinct text once; batch only.

    Reads `df` twice, so it pays when the rules are many: texts repeat a great deal
    and `distinct` combines them before its shuffle. The dictionary is written out,
    measured there, and broadcast if its size allows.
    """
    texts = df.select(F.col(agent)).where(F.col(agent).isNotNull()).distinct()
    dictionary = written(texts.select(agent, *agent_columns(F.col(agent), rules)), "agents")
    joined = lookup_join(df, dictionary, [agent], "left", fits(dictionary, bound))
    return joined.fillna(rules.fallback, ["os", "device", "browser"])
