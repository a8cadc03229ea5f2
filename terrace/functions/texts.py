"""String functions: titles, labels for export, links in wikitext, URL lineage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: a bracketed external link: lazily to the first space, then to the last bracket of the line.
LINK = r"(?d)\[(http.*?) .*\]"


def normalize_title(title: Column) -> Column:
    """The first character in lower case; the rest as it is."""
    return F.concat(F.lower(F.left(title, F.lit(1))), F.substr(title, F.lit(2)))


def without(text: Column, *marks: str) -> Column:
    for mark in marks:
        text = F.replace(text, F.lit(mark), F.lit(""))
    return text


def csv_label(text: Column) -> Column:
    return without(text, ",", "\n")


def quoted_label(text: Column) -> Column:
    return F.concat(F.lit("'"), without(text, "'", "\n"), F.lit("'"))


def links(text: Column) -> Column:
    """URLs of bracketed links, at most one a line."""
    return F.regexp_extract_all(text, F.lit(LINK), F.lit(1))


def lineage(url: Column) -> Column:
    """array<struct<prefix, direct>>: every proper ancestor from the second segment on; direct marks the parent. Empty under three segments."""
    parts = F.split(url, "/", -1)
    n = F.size(parts)
    up = F.transform(F.sequence(F.lit(2), F.greatest(n - 1, F.lit(2))), lambda k: F.struct(F.concat_ws("/", F.slice(parts, F.lit(1), k)).alias("prefix"), (k == n - 1).alias("direct")))
    return F.when(n >= 3, up).otherwise(F.array().cast("array<struct<prefix: string, direct: boolean>>"))
