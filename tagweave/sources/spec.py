"""Where a tag job reads its business rows from."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Keys of a source rule.
KEYS = ("inType", "esNodes", "esIndex", "esType", "selectFields")


def decode(rule: Column) -> Column:
    """`k=v##k=v` text to a map; commas inside a value survive."""
    return F.str_to_map(rule, F.lit("##"), F.lit("="))


def decode_columns(rules: DataFrame) -> DataFrame:
    """A whole table of source rules (id, rule) to one column per key."""
    spec = rules.select("id", decode(F.col("rule")).alias("spec"))
    return spec.select("id", *[F.col("spec").getItem(key).alias(key) for key in KEYS])


@dataclass(frozen=True)
class SourceSpec:
    in_type: str
    nodes: str
    index: str
    doc_type: str
    fields: tuple[str, ...]

    @staticmethod
    def from_text(rule: str) -> "SourceSpec":
        """One rule text; `decode` does the same for a column."""
        return SourceSpec.from_map(dict(pair.split("=", 1) for pair in rule.split("##") if "=" in pair))

    @staticmethod
    def from_map(values: dict) -> "SourceSpec":
        missing = [key for key in KEYS if key not in values]
        if missing:
            raise ValueError(f"source rule lacks {', '.join(missing)}")
        fields = tuple(f.strip() for f in values["selectFields"].split(",") if f.strip())
        return SourceSpec(values["inType"], values["esNodes"], values["esIndex"], values["esType"], fields)

    def with_fields(self, fields) -> "SourceSpec":
        merged = tuple(dict.fromkeys([*self.fields, *fields]))
        return SourceSpec(self.in_type, self.nodes, self.index, self.doc_type, merged)
