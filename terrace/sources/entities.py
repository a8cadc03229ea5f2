"""Entity dumps: a JSON array with one entity a line."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.schemas import CLAIM_TYPES, DATAVALUE, ENTITY, ENTITY_TYPES, RANKS, RAW_ENTITY, SNAKTYPES, VALUE_TYPES


def read_lines(spark: SparkSession, paths: str | list[str], partitions: int | None = None) -> DataFrame:
    """Lines of plain, .gz or .bz2 files. A .gz file is one task's: ``partitions`` spreads its lines before they are parsed."""
    lines = spark.read.text(paths)
    return lines.repartition(partitions) if partitions else lines


def _arms(value):
    """The typed arm that a raw value's type names; others stay null."""
    number = lambda name: F.try_variant_get(F.try_parse_json(value["value"]), f"$.{name}", "string").try_cast("double")
    get = lambda name, kind: F.get_json_object(value["value"], f"$['{name}']").try_cast(kind)
    of = lambda kind, x: F.when(value["type"] == kind, x)
    return F.when(
        value.isNotNull(),
        F.struct(
            value["type"].alias("type"),
            of("string", value["value"]).alias("string"),
            of("wikibase-entityid", F.struct(get("entity-type", "string").alias("entity_type"), get("numeric-id", "bigint").alias("numeric_id"))).alias("entityid"),
            of("globecoordinate", F.struct(*[get(x, "double").alias(x) for x in ("latitude", "longitude", "altitude", "precision")], get("globe", "string").alias("globe"))).alias("globecoordinate"),
            of("time", F.struct(get("time", "string").alias("time"), get("timezone", "bigint").alias("timezone"), get("precision", "bigint").alias("precision"), get("calendarmodel", "string").alias("calendarmodel"), get("before", "bigint").alias("before"), get("after", "bigint").alias("after"))).alias("time"),
            of("quantity", F.struct(number("amount").alias("amount"), number("lowerBound").alias("lowerBound"), number("upperBound").alias("upperBound"), get("unit", "string").alias("unit"))).alias("quantity"),
            of("monolingualtext", F.struct(get("language", "string").alias("language"), F.coalesce(get("value", "string"), get("text", "string")).alias("value"))).alias("monolingualtext"),
        ),
    ).cast(DATAVALUE)


def _unreadable(claim):
    """A claim of an unknown type or rank (missing ones will do), without a main snak of a known type, or with a value that is missing or of an unknown type."""
    snak, value = claim["mainsnak"], claim["mainsnak"]["datavalue"]
    unknown = lambda x, known: F.coalesce(~x.isin(known), F.lit(False))
    without = value["value"].isNull() | F.coalesce(~value["type"].isin(VALUE_TYPES), F.lit(True))
    return unknown(claim["type"], CLAIM_TYPES) | unknown(claim["rank"], RANKS) | F.coalesce(~snak["snaktype"].isin(SNAKTYPES), F.lit(True)) | (snak["snaktype"] == "value") & without


def parse_entities(lines: DataFrame, mode: str = "PERMISSIVE") -> DataFrame:
    """Entities of lines (value), with ``corrupt``: the line, where it isn't an entity of known types. FAILFAST raises instead.

    Maps that are missing or given as [] are empty. Missing scalars are null.
    """
    if mode not in ("PERMISSIVE", "FAILFAST"):
        raise ValueError(f"no such mode: {mode}")
    raw, *columns = _parsed(lines.sparkSession, mode)
    line = F.regexp_replace(F.trim("value"), r",$", "")
    lines = lines.where(~F.trim("value").isin("[", "]", "")).select(line.alias("line"))
    return lines.select("line", raw).select(*columns)


@lru_cache(maxsize=4)
def _parsed(spark: SparkSession, mode: str) -> list[Column]:
    """The raw entity of a ``line`` and the columns made of it. They are thousands of calls, so a session that compiles many batches makes them once."""
    # a map given as [] would make the whole row corrupt
    fixed = F.regexp_replace("line", r'("(?:labels|descriptions|aliases|claims|sitelinks)"\s*:\s*)\[\s*\]', "$1{}")
    raw = F.from_json(fixed, RAW_ENTITY, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("e")
    snaks = lambda f: F.exists(F.flatten(F.map_values("e.claims")), f)
    bad = F.col("e._corrupt_record").isNotNull() | F.col("e.id").isNull() | F.coalesce(~F.col("e.type").isin(ENTITY_TYPES), F.lit(True))
    bad = bad | F.coalesce(snaks(_unreadable), F.lit(False))
    corrupt = F.when(bad, F.col("line") if mode == "PERMISSIVE" else F.raise_error(F.concat(F.lit("not an entity: "), F.left("line", F.lit(200)))).cast("string"))
    claims = F.transform_values(
        "e.claims",
        lambda _, cs: F.transform(cs, lambda c: F.struct(c["id"].alias("id"), c["type"].alias("type"), c["rank"].alias("rank"), F.struct(c["mainsnak"]["property"].alias("property"), c["mainsnak"]["datatype"].alias("datatype"), c["mainsnak"]["snaktype"].alias("snaktype"), _arms(c["mainsnak"]["datavalue"]).alias("datavalue")).alias("mainsnak"))),
    )
    kinds = dict(x.split(" ", 1) for x in ENTITY.replace(", labels", "\nlabels").replace(", descriptions", "\ndescriptions").replace(", aliases", "\naliases").replace(", claims", "\nclaims").replace(", sitelinks", "\nsitelinks").replace("id string, type", "id string\ntype").split("\n"))
    maps = {"labels": F.col("e.labels"), "descriptions": F.col("e.descriptions"), "aliases": F.col("e.aliases"), "claims": claims, "sitelinks": F.col("e.sitelinks")}
    return [raw, F.col("e.id").alias("id"), F.col("e.type").alias("type"), *[F.coalesce(x.cast(kinds[k]), F.create_map().cast(kinds[k])).alias(k) for k, x in maps.items()], corrupt.alias("corrupt")]


def read_entities(spark: SparkSession, paths: str | list[str], mode: str = "PERMISSIVE", partitions: int | None = None) -> DataFrame:
    return parse_entities(read_lines(spark, paths, partitions), mode)
