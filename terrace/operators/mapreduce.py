"""Generic map-reduce for closures that no DataFrame expression covers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType

#: Keys that a task holds.
KEYS = 100_000


def _pairs(held: dict, schema: pa.Schema) -> pa.RecordBatch:
    out = pa.RecordBatch.from_arrays([pa.array([*held], schema.field(0).type), pa.array([*held.values()], schema.field(1).type)], schema=schema)
    held.clear()
    return out


def map_reduce(df: DataFrame, mapper: Callable[[Row], Iterable[tuple[Any, Any]]], reducer: Callable[[Any, Any], Any], schema: str) -> DataFrame:
    """(key, value) after ``mapper`` gives any number of pairs per row and ``reducer`` joins values of a key. The reducer must be associative and commutative. No rows for no pairs.

    Rows come to the closures by Arrow batches. Each task joins values in a table of up to KEYS keys, which is put out when it is full; the pairs are dealt by key and sorted, so that
    the second step holds one key at a time. ``schema`` names the two columns and their types; keys must be hashable."""
    kinds = DataType.fromDDL(schema)
    arrow, key = to_arrow_schema(kinds), kinds.names[0]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            row = Row(*batch.schema.names)
            for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for k, v in mapper(row(*values)):
                    held[k] = reducer(held[k], v) if k in held else v
                    if len(held) >= KEYS:
                        yield _pairs(held, arrow)
        if held:
            yield _pairs(held, arrow)

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for k, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k in held:
                    held[k] = reducer(held[k], v)
                else:
                    if len(held) >= KEYS:  # sorted: none of these comes again
                        yield _pairs(held, arrow)
                    held[k] = v
        if held:
            yield _pairs(held, arrow)

    return df.mapInArrow(mapped, schema).repartition(key).sortWithinPartitions(key).mapInArrow(reduced, schema)


def par_foreach(df: DataFrame, each: Callable[[Row], None]) -> None:
    """Side effects only: ``each`` runs on the executors, and may run again for a row after a failure."""
    df.foreach(each)


def count_by(df: DataFrame, *keys) -> DataFrame:
    """The built-in way to count: stays in generated code with partial aggregation."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))
