"""Metrics per address and per user, the same function for batch and stream."""

from pyspark.sql import DataFrame, functions as F

from tagweave.functions.access_log import TEXT_TIME
from tagweave.functions.behaviour import FLAGS
from tagweave.functions.user_agent import DEFAULT_RULES, AgentRules, agent_columns
from tagweave.operators.enrichment import add_area
from tagweave.operators.joins import DEFAULT_BOUND, Bound


def access_per_ip(lines: DataFrame) -> DataFrame:
    """Views per address, with time, code and agent of its earliest line.

    Lines of one second order by code and agent, and a line without a readable time
    comes last, so the result does not depend on arrival order. The smallest struct
    is order and payload at once: the line's own text is not carried along.
    """
    unknown = F.col("access_time").isNull().alias("unknown")
    first = F.min(F.struct(unknown, "access_time", "code", "useragent"))
    if not lines.isStreaming:
        # Counts and times fit a hash aggregate, a struct does not: only the few kinds of
        # line of an address are sorted. A stream has one aggregate, over one micro-batch.
        kinds = lines.groupBy("ip", "code", "useragent").agg(
            F.count("ip").alias("n"), F.min("access_time").alias("access_time"))
        return kinds.groupBy("ip").agg(F.sum("n").alias("pv"), F.lit(1).alias("uv"), first.alias("first"))
    return lines.groupBy("ip").agg(F.count("ip").alias("pv"), F.lit(1).alias("uv"), first.alias("first"))


def access_metrics(lines: DataFrame, areas: DataFrame, agents: AgentRules = DEFAULT_RULES,
                   bound: Bound = DEFAULT_BOUND) -> DataFrame:
    """(ip, pv, uv, area, code, os, device, browser, datetime) from parsed lines.

    The area depends on the address alone, and only the first agent of an address
    is reported. Both are therefore looked up after the aggregation, once per
    address, instead of once per line before it.
    """
    located = add_area(access_per_ip(lines), areas, bound=bound)
    return located.select(
        "ip", "pv", "uv", "area",
        F.col("first.code").try_cast("int").alias("code"),
        *agent_columns(F.col("first.useragent"), agents),
        F.date_format("first.access_time", TEXT_TIME).alias("datetime"),
    )


def behaviour_counts(events: DataFrame) -> DataFrame:
    """Events of each kind per user: how often each flag is 1.

    Counts stay 64-bit: one busy user may exceed a 32-bit count.
    """
    counts = [
        F.count(F.when(F.col(flag).try_cast("int") == 1, F.col("user_id"))).alias(f"{flag}_cnt")
        for flag in FLAGS
    ]
    return events.groupBy("user_id").agg(*counts)


def windowed_behaviour_counts(events: DataFrame, window: str = "1 day", lateness: str = "10 minutes") -> DataFrame:
    """Flag counts per user-visit window, with a bound on how late an event may come."""
    timed = events.withColumn("visited", F.try_to_timestamp(F.col("visit_time")))
    counts = [F.count(F.when(F.col(flag).try_cast("int") == 1, F.lit(1))).alias(f"{flag}_cnt") for flag in FLAGS]
    grouped = timed.withWatermark("visited", lateness).groupBy(F.window("visited", window)).agg(*counts)
    return grouped.select(
        F.date_format("window.start", TEXT_TIME).alias("window_start"),
        *[f"{flag}_cnt" for flag in FLAGS],
    )
