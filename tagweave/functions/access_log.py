"""Web-server access lines to typed columns.

All ten fields come out of ONE regular-expression pass per line: the pattern is
rewritten to its groups joined by a control character and split once. Ten
separate extractions would match the same line ten times.
"""

from pyspark.sql import Column, DataFrame, functions as F

# Field order of the log format, and the format of its time text.
FIELDS = ("ip", "datetime", "request", "url", "protocol", "code",
          "sendbytes", "referrer", "useragent", "proxyaddr")
TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"
TEXT_TIME = "yyyy-MM-dd HH:mm:ss"

# Never part of a field: the server writes control characters escaped.
SEPARATOR = "\x01"

LINE_PATTERN = (
    r'([0-9]+\.[0-9]+\.[0-9]+\.[0-9]+) - - \[([^\]\x01]+)\] '
    r'"([A-Z]+) ([^\s\x01]*) ([^\s"\x01]+)" ([0-9]+) ([0-9]+) '
    r'"([^"\x01]*)" "([^"\x01]+)" "([^"\x01]+)"'
)
_WHOLE_LINE = r"(?s)^.*?" + LINE_PATTERN + r".*$"
_GROUPS = SEPARATOR.join(f"${i + 1}" for i in range(len(FIELDS)))


def access_time(text: Column) -> Column:
    """'13/Oct/2022:19:46:28 +0800' to its wall time; the offset is dropped.

    Text that is no such time gives null instead of stopping the job.
    """
    wall = F.substring_index(text, " ", 1)
    return F.try_to_timestamp(wall, F.lit(TIME_FORMAT))


def access_time_text(text: Column) -> Column:
    return F.date_format(access_time(text), TEXT_TIME)


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines that match, as `value`, the ten text fields and `access_time`.

    A line that does not match comes out of the replacement unchanged. Fields come
    out of an outer `inline`: a filter on its output stays above it. A filter on the
    replaced text would be pushed below the projection and match every line twice.
    """
    joined = lines.select("value", F.regexp_replace("value", _WHOLE_LINE, _GROUPS).alias("_joined"))
    split = joined.withColumn("_parts", F.split("_joined", SEPARATOR))
    fields = F.struct(*[F.get("_parts", F.lit(i)).alias(name) for i, name in enumerate(FIELDS)])
    found = F.inline_outer(F.when(F.col("_joined") != F.col("value"), F.array(fields)))
    matched = split.select("value", found).where("ip is not null")
    return matched.withColumn("access_time", access_time(F.col("datetime")))


def rejected_lines(lines: DataFrame) -> DataFrame:
    """The lines `parse_lines` leaves out, whole, so that nothing is lost silently."""
    matches = F.coalesce(F.col("value").rlike(LINE_PATTERN), F.lit(False))
    return lines.where(~matches).select("value")
