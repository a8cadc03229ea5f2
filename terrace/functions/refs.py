"""Entity references: 'Q42' and 'P31' as strings, with their kind and number where wanted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def Q(n: int) -> str:  # noqa: N802
    return f"Q{n}"


def P(n: int) -> str:  # noqa: N802
    return f"P{n}"


def parse_ref(ref: Column) -> Column:
    """struct<kind: string, num: bigint>; null where the text isn't a reference."""
    num = F.regexp_extract(ref, r"^[PQ](\d+)$", 1)
    return F.when(num != "", F.struct(F.substring(ref, 1, 1).alias("kind"), num.cast("bigint").alias("num")))


def format_ref(kind: Column, num: Column) -> Column:
    return F.concat(kind, num.cast("string"))


def ref_of_value(entityid: Column) -> Column:
    """'Q…' or 'P…' of an entity-id value."""
    return F.concat(F.when(entityid["entity_type"] == "property", F.lit("P")).otherwise(F.lit("Q")), entityid["numeric_id"].cast("string"))
