"""Sinks: CSV, graph-loader files, TSV, lookup tables, triples by property."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions.entities import best_label
from terrace.functions.texts import csv_label, normalize_title, quoted_label


def titles(entities: DataFrame) -> DataFrame:
    """(id, label) with commas and line ends taken out of labels."""
    return entities.select("id", csv_label(best_label()).alias("label"))


def write_separated(df: DataFrame, path: str, sep: str, header: bool) -> None:
    """Values as they are, between separators; null is nothing. Nothing is quoted or escaped. ``header`` puts the column names first in each part."""
    first, schema = sep.join(df.columns), pa.schema([("value", pa.string())])

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([first])], schema=schema)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string())], schema=schema)

    lines = df.select(F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]).alias("value"))
    (lines.mapInArrow(headed, "value string") if header else lines).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """Unquoted CSV with a header; ``single`` gives one file through one task, for small tables only."""
    write_separated(df.coalesce(1) if single else df, path, ",", True)


def graph_nodes(entities: DataFrame) -> DataFrame:
    return entities.select(F.col("id").alias("qid:ID"), quoted_label(best_label()).alias("label:LABEL"))


def graph_edges(triples: DataFrame) -> DataFrame:
    return triples.select(F.col("source").alias(":START_ID"), F.col("prop").alias(":TYPE"), F.col("dest").alias(":END_ID"))


def write_graph(entities: DataFrame, triples: DataFrame, path: str) -> None:
    """nodes/ and tuples/ with a header in each part, separated by semicolons."""
    for name, df in (("nodes", graph_nodes(entities)), ("tuples", graph_edges(triples))):
        write_separated(df, f"{path}/{name}", ";", True)


def write_tsv(df: DataFrame, path: str) -> None:
    write_separated(df, path, "\t", False)


def title_table(pages: DataFrame) -> DataFrame:
    return pages.select("id", "title")


def text_table(pages: DataFrame) -> DataFrame:
    """(id, text), redirects as 'REDIRECT target'."""
    return pages.select("id", F.when(F.col("kind") == "redirect", F.concat(F.lit("REDIRECT "), F.coalesce("redirect", F.lit("")))).otherwise(F.col("text")).alias("text"))


def title_index(pages: DataFrame) -> DataFrame:
    """(title, id) by normalised title; titles that normalise alike each keep a row."""
    return pages.select(normalize_title(F.col("title")).alias("title"), "id")


def write_sorted(df: DataFrame, path: str, key: str) -> None:
    """A lookup table: range-partitioned and sorted, so that a point query reads one row group."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def write_by_property(triples: DataFrame, path: str) -> None:
    """Triples in a folder for each property, so that a join with a table of wanted properties reads those alone. Rows of frequent properties are spread over tasks, rare properties share one."""
    triples.hint("rebalance", "prop").write.mode("overwrite").partitionBy("prop").parquet(path)
