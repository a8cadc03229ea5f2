"""Page dumps in XML, plain or compressed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.schemas import MODELS, RAW_PAGE


def read_pages(spark: SparkSession, paths: str | list[str], strict: bool = False) -> DataFrame:
    """(id, title, ns, model, model_known, kind, text, redirect) of <page> elements; of several revisions the last. ``kind`` is 'redirect' where there is one. ``strict`` raises at unknown models."""
    raw = spark.read.format("xml").option("rowTag", "page").option("ignoreSurroundingSpaces", "false").schema(RAW_PAGE).load(paths)
    last = F.try_element_at("revision", F.lit(-1))
    known = last["model"].isin(MODELS)
    model = F.when(~known, F.raise_error(F.concat(F.lit("unknown model: "), last["model"])).cast("string")).otherwise(last["model"]) if strict else last["model"]
    return raw.select("id", "title", "ns", model.alias("model"), F.coalesce(known, F.lit(False)).alias("model_known"), F.when(F.col("redirect").isNotNull(), "redirect").otherwise("text").alias("kind"), F.coalesce(last["text"], F.lit("")).alias("text"), F.col("redirect._title").alias("redirect"))


def as_text(pages: DataFrame) -> DataFrame:
    """The view in which a redirect with text of its own is a text page."""
    return pages.withColumn("kind", F.when(F.col("text") != "", "text").otherwise(F.col("kind")))


def title_text(pages: DataFrame) -> DataFrame:
    return pages.select("title", "text")


def find_page(pages: DataFrame, title: str) -> DataFrame:
    """(content) of the first page with a title: its text, or 'REDIRECT target'. No row if there is none."""
    content = F.when(F.col("kind") == "redirect", F.concat(F.lit("REDIRECT "), F.coalesce("redirect", F.lit("")))).otherwise(F.col("text"))
    return pages.where(F.col("title") == title).select(content.alias("content")).limit(1)
