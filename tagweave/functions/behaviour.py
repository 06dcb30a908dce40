"""Behaviour events: nested JSON text to flat columns.

The typed form parses each text once with `from_json`, however many fields are
taken. The path form parses it again for each field and is kept for ad-hoc use.
"""

from pyspark.sql import DataFrame, functions as F

# The fields of an event and of its nested objects.
TOP_FIELDS = ("phone_num", "system_id", "user_name", "user_id", "visit_time",
              "goods_type", "minimum_price")
NESTED_FIELDS = {
    "area": ("province", "city", "sp"),
    "user_behavior": ("is_browse", "is_order", "is_buy", "is_back_order", "is_received"),
    "goods_detail": ("goods_name", "browse_page", "browse_time", "to_page", "to_time",
                     "page_keywords"),
}
FLAGS = NESTED_FIELDS["user_behavior"]
# Where the parser leaves a text it cannot read.
CORRUPT = "_corrupt_record"


def _wanted(names, only) -> tuple:
    return tuple(name for name in names if only is None or name in only)


def event_schema(only=None) -> str:
    """DDL of one event; every leaf is text, as the sender writes it."""
    def struct(names):
        return ", ".join(f"{name}: string" for name in names)

    top = [f"{name} string" for name in _wanted(TOP_FIELDS, only)]
    nested = [f"{outer} struct<{struct(_wanted(names, only))}>"
              for outer, names in NESTED_FIELDS.items() if _wanted(names, only)]
    return ", ".join(top + nested)


def parse_events(events: DataFrame, only=None) -> DataFrame:
    """`value` text to the 21 flat text columns, or to those named in `only`.

    The parser skips every part of the text the schema does not name.
    """
    parsed = events.select(F.from_json("value", event_schema(only)).alias("e"))
    leaves = [F.col(f"e.{name}") for name in _wanted(TOP_FIELDS, only)]
    leaves += [F.col(f"e.{outer}.{inner}")
               for outer, names in NESTED_FIELDS.items() for inner in _wanted(names, only)]
    return parsed.select(*leaves)


def accepted_events(events: DataFrame, only=None) -> DataFrame:
    """As `parse_events`, without the texts `rejected_events` gives and without null texts.

    A generator keeps the check next to the one parse; a filter would parse once more.
    """
    parsed = F.from_json("value", f"{event_schema(only)}, {CORRUPT} string")
    sound = F.filter(F.array(parsed), lambda e: e.isNotNull() & e[CORRUPT].isNull())
    leaves = [F.col(f"e.{name}") for name in _wanted(TOP_FIELDS, only)]
    leaves += [F.col(f"e.{outer}.{inner}")
               for outer, names in NESTED_FIELDS.items() for inner in _wanted(names, only)]
    return events.select(F.explode(sound).alias("e")).select(*leaves)


def rejected_events(events: DataFrame) -> DataFrame:
    """Texts that are no JSON object, or hold another kind of value where a nested object belongs."""
    parsed = F.from_json("value", f"{event_schema()}, {CORRUPT} string")
    return events.where(parsed[CORRUPT].isNotNull()).select("value")


def parse_top_fields(events: DataFrame, *names: str) -> DataFrame:
    """Several top-level fields at once."""
    names = names or TOP_FIELDS
    return events.select(F.json_tuple("value", *names).alias(*names))


def json_paths(events: DataFrame, **paths: str) -> DataFrame:
    """One column per `name='$.a.b'`; an absent path gives null."""
    return events.select(*[F.get_json_object("value", p).alias(n) for n, p in paths.items()])
