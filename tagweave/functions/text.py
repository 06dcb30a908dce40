"""Small text helpers shared by the rule and attribute steps."""

from pyspark.sql import Column, functions as F


def strip_dashes(text: Column) -> Column:
    """'1992-05-31' to '19920531'."""
    return F.regexp_replace(text, "-", "")


def part(text: Column, separator: str, index: int) -> Column:
    """The index-th piece of split text, null when there is none."""
    return F.get(F.split(text, separator), F.lit(index))


def compact_date(text: Column) -> Column:
    """'19920531' to a date, null for anything else."""
    parsed = F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")
    return F.when(text.rlike("^[0-9]{8}$"), parsed)


def day_number(day: Column) -> Column:
    """Days since 1970-01-01, so that dates and integers share the range join."""
    return F.unix_date(day).cast("bigint")
