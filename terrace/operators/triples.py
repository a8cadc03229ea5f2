"""Entities to triples, and what is asked of triples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions.entities import best_label, relations


def triples(entities: DataFrame) -> DataFrame:
    """(source, prop, dest): one row per relation."""
    return entities.select(F.col("id").alias("source"), F.explode(relations()).alias("r")).select("source", "r.prop", "r.dest")


def label_index(entities: DataFrame) -> DataFrame:
    """(id, label)"""
    return entities.select("id", best_label().alias("label"))


def property_histogram(t: DataFrame, labels: DataFrame) -> DataFrame:
    """(n, prop, label); labels are joined to the counts, not to the triples."""
    counts = t.groupBy("prop").agg(F.count("*").alias("n"))
    return counts.join(labels.withColumnRenamed("id", "prop"), "prop", "left").select("n", "prop", F.coalesce("label", F.lit("no label")).alias("label"))


def match_count(t: DataFrame, prop: str, dest: str) -> DataFrame:
    return t.where((F.col("prop") == prop) & (F.col("dest") == dest)).agg(F.count("*").alias("n"))


def wanted(stored: DataFrame, filters: DataFrame) -> DataFrame:
    """Distinct (ident, source) of triples with a relation of a filter table (ident, prop, dest) of any length. Where the triples are stored by property, only
    the filters' properties are read: what they are is found out when the query runs."""
    asked = filters.where(F.col("prop").like("P%")).distinct()
    return stored.join(asked, ["prop", "dest"]).select("ident", "source").distinct()


def pool_pages(entities: DataFrame, t: DataFrame, filters: DataFrame, site: str = "enwiki") -> DataFrame:
    """Distinct (ident, title) of entities with any relation of a pool's filter rows (ident, prop, dest) and a link to ``site``. Filters are a parameter, a few rows."""
    hits = t.join(filters, ["prop", "dest"]).select("ident", F.col("source").alias("id")).distinct()
    titles = entities.select("id", F.try_element_at("sitelinks", F.lit(site))["title"].alias("title")).where("title is not null")
    return hits.join(titles, "id").select("ident", "title").distinct()
