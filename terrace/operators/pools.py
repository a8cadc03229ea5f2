"""URL pools: which link prefixes are typical of few topics."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.texts import links
from terrace.operators.triples import pool_pages
from terrace.operators.urls import aggregate_urls, rare_prefixes


def parse_filters(specs: list[str]) -> list[tuple[str, str, str]]:
    """'ident:P31Q1,P106Q2' to (ident, prop, dest) rows."""
    out = []
    for spec in specs:
        ident, _, pairs = spec.partition(":")
        for pair in pairs.split(","):
            m = re.fullmatch(r"P(\d+)Q(\d+)", pair.strip())
            if not m:
                raise ValueError(f"not a filter: {pair!r}")
            out.append((ident, f"P{m[1]}", f"Q{m[2]}"))
    return out


def filter_table(spark: SparkSession, specs: list[str]) -> DataFrame:
    return spark.createDataFrame(parse_filters(specs), "ident string, prop string, dest string").distinct()


def pool_urls(pages: DataFrame, pool_titles: DataFrame) -> DataFrame:
    """Distinct (ident, url) of links in text pages of each pool. Redirects give none."""
    text = pages.where("kind = 'text'").select("title", "text")
    return text.join(pool_titles, "title").select("ident", F.explode(links(F.col("text"))).alias("url")).distinct()


def pool_sizes(spark: SparkSession, specs: list[str], titles: DataFrame, urls: DataFrame) -> DataFrame:
    """(ident, pages, urls) for every pool, empty ones too."""
    idents = spark.createDataFrame([(s.partition(":")[0],) for s in specs], "ident string").distinct()
    a, b = titles.groupBy("ident").agg(F.count("*").alias("pages")), urls.groupBy("ident").agg(F.count("*").alias("urls"))
    return idents.join(a, "ident", "left").join(b, "ident", "left").select("ident", F.coalesce("pages", F.lit(0)).alias("pages"), F.coalesce("urls", F.lit(0)).alias("urls"))


def url_pools(spark: SparkSession, entities: DataFrame, t: DataFrame, pages: DataFrame, specs: list[str], site: str = "enwiki") -> DataFrame:
    """(wiki, ident, prefix): prefixes that aggregate well in a pool and are in fewer than half of the pools."""
    titles = pool_pages(entities, t, filter_table(spark, specs), site)
    found = aggregate_urls(pool_urls(pages, titles), by=("ident",))
    return rare_prefixes(found, len(specs)).select(F.lit(site).alias("wiki"), "ident", "prefix", "descendants", "direct")
