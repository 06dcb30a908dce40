"""Dictionaries of many user-agent rules: a join on pieces of text picks the few rules worth trying.

A rule is a row (field, rank, pattern, value); of the rules of a field whose pattern is found in a text, the one of
least rank gives the value. A pattern that needs a literal can only be found in texts that hold the literal, so each
rule is filed under its whole literals. Texts are cut where three characters open a literal, in the lengths that
literals of that opening have, and meet rules by an equi-join on these pieces. Only the pairs that meet are matched.
The plan has one size for any number of rules.
"""

import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tagweave.functions.user_agent import FALLBACK
from tagweave.operators.joins import DEFAULT_BOUND, Bound, fits, lookup_join
from tagweave.session import written

OPENING = 3
FIELDS = ("os", "device", "browser")
RULE_SCHEMA = "field string, rank long, pattern string, value string"

# One part of a pattern: an escape, a character class, a quantifier, or a character.
_PART = re.compile(r"\\\d+|\\.|\[\^?\]?(?:\\.|[^\]\\])*\]|[*+?]|\{[^}]*\}|.", re.S)
# Flags and look-arounds, escapes that span further characters, classes within classes.
_UNCERTAIN = re.compile(r"\(\?|\\[xu0cNkQ]|\\[pP][^{]|\[\^?\]?(?:\\.|[^\]\\])*(?:\[|&&)", re.S)


def rule_rows(spark: SparkSession, fields: dict[str, Iterable[tuple[str, str]]]) -> DataFrame:
    """Ordered (pattern, value) pairs of each field as a table of rules."""
    rows = [(field, rank, pattern, value) for field, rules in fields.items()
            for rank, (pattern, value) in enumerate(rules)]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def needed_literals(pattern: str) -> list[str]:
    """For each top-level alternative the longest literal that every match holds; `""` where none is certain.

    What stands in groups is passed over, and so is a character that may be absent. Patterns with flags, quotations,
    numbered characters or nested classes, where plain characters mean something else, have no certain literal.
    """
    if _UNCERTAIN.search(pattern):
        return [""]
    found, runs, depth = [], [""], 0
    for part in _PART.findall(pattern):
        if part == "(":
            depth += 1
            runs.append("")
        elif part == ")":
            depth -= 1
            runs.append("")
        elif depth:
            continue
        elif part == "|":
            found.append(max(runs, key=len))
            runs = [""]
        elif part in "*?" or part[0] == "{":
            # The part before may be absent; a quantifier after a literal character takes that character back.
            runs[-1] = runs[-1][:-1]
            runs.append("")
        elif part[0] in "+.^$[":
            runs.append("")
        elif part[0] == "\\":
            if part[1].isalnum():
                runs.append("")
            else:
                runs[-1] += part[1]
        else:
            runs[-1] += part
    return [*found, max(runs, key=len)]


def filed(rules: DataFrame) -> DataFrame:
    """The rules with `piece`, one row for each different literal of their alternatives.

    A rule with an alternative of no literal as long as an opening is filed under the empty piece alone, which every
    text has.
    """
    def pieces_of(pattern: str) -> list[str]:
        pieces = set(needed_literals(pattern))
        return sorted(pieces) if all(len(x) >= OPENING for x in pieces) else [""]

    @F.pandas_udf("array<string>")
    def pieces(patterns: pd.Series) -> pd.Series:
        return patterns.map(lambda x: pieces_of(x) if x is not None else [])

    return written(rules.select("*", F.explode(pieces("pattern")).alias("piece")), "agent-rules")


def _cut(known: DataFrame, dictionary: DataFrame, bound: Bound) -> DataFrame:
    """(_text, piece): the different pieces of each text that have opening and length of a literal, and the empty one."""
    sizes = dictionary.select(F.col("piece").substr(1, OPENING).alias("opening"), F.length("piece").alias("size")).distinct()
    openings = written(sizes.groupBy("opening").agg(F.collect_list("size").alias("sizes")), "agent-openings")
    # Place -1 stands for the empty piece.
    places = F.sequence(F.lit(-1), F.greatest(F.length("_text") - OPENING, F.lit(-1)))
    opening = F.when(F.col("at") < 0, "").otherwise(F.col("_text").substr(F.col("at") + 1, F.lit(OPENING)))
    placed = known.select("_text", F.explode(places).alias("at")).withColumn("opening", opening)
    opened = lookup_join(placed, openings, ["opening"], "inner", fits(openings, bound))
    sized = opened.select("_text", "at", F.explode("sizes").alias("size")).where("at + size <= length(_text)")
    pieces = sized.select("_text", "at", F.col("_text").substr(F.col("at") + 1, F.col("size")).alias("piece"))
    return pieces.where("at < 0 OR instr(_text, piece) = at + 1").select("_text", "piece")


def _held(dictionary: DataFrame, cut: DataFrame, bound: Bound) -> DataFrame:
    """The filed rules whose piece is in some text."""
    seen = written(cut.select("piece").distinct(), "agent-seen")
    return written(lookup_join(dictionary, seen, ["piece"], "inner", fits(seen, bound)), "agent-held")


def classify(texts: DataFrame, rules: DataFrame, agent: str = "useragent", fields: Iterable[str] = FIELDS,
             fallback: str = FALLBACK, bound: Bound = DEFAULT_BOUND) -> DataFrame:
    """(agent, one column a field) for distinct texts; `fallback` where no rule is found.

    `rules` are (field, rank, pattern, value). Rules with a null pattern are never found, those of other fields are left
    out; of two rules of one rank the smaller value counts. Null texts have no row. Rules beyond `bound` are first
    narrowed to those whose piece is in some text. What is left is broadcast if it is within `bound`, else texts and
    rules are shuffled by piece.
    """
    fields = list(fields)
    dictionary = filed(rules.where(F.col("field").isin(fields)).select("field", "rank", "pattern", "value"))
    known = written(texts.select(F.col(agent).alias("_text")).where("_text IS NOT NULL").distinct(), "agent-texts")
    cut = _cut(known, dictionary, bound)
    small = fits(dictionary, bound)
    if not small:
        dictionary = _held(dictionary, cut, bound)
        small = fits(dictionary, bound)
    met = lookup_join(cut, dictionary, ["piece"], "inner", small).where(F.expr("_text RLIKE pattern"))
    first = [F.min(F.when(F.col("field") == f, F.struct("rank", "value"))).alias(f) for f in fields]
    found = met.groupBy("_text").agg(*first)
    joined = known.join(found, "_text", "left")
    return joined.select(F.col("_text").alias(agent),
                         *(F.coalesce(F.col(f"{f}.value"), F.lit(fallback)).alias(f) for f in fields))


def add_agent_by_rules(df: DataFrame, rules: DataFrame, agent: str = "useragent", fields: Iterable[str] = FIELDS,
                       fallback: str = FALLBACK, bound: Bound = DEFAULT_BOUND) -> DataFrame:
    """Add a column for each field, from a dictionary of rules of any size; batch only.

    Each distinct text is classified once. A null text gets `fallback`.
    """
    fields = list(fields)
    found = written(classify(df, rules, agent, fields, fallback, bound), "agents")
    return lookup_join(df, found, [agent], "left", fits(found, bound)).fillna(fallback, fields)
