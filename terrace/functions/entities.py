"""Column functions over a nested entity: labels, links, claims and relations. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace.functions.refs import ref_of_value


def lookup(entries: Column, key: str) -> Column:
    """Value of a map key, or null."""
    return F.try_element_at(entries, F.lit(key))


def in_language(texts: Column, language: str) -> Column:
    """Text in a language; an entry marked as removed counts as missing."""
    entry = lookup(texts, language)
    return F.when(entry["removed"].isNull(), entry["value"])


def label(language: str, labels: str = "labels") -> Column:
    return in_language(F.col(labels), language)


def description(language: str, descriptions: str = "descriptions") -> Column:
    return in_language(F.col(descriptions), language)


def first_label(labels: str = "labels") -> Column:
    """Text of the first entry in byte order of the keys; null where that is removed or there is none."""
    entry = F.try_element_at(F.col(labels), F.try_element_at(F.array_sort(F.map_keys(labels)), F.lit(1)))
    return F.when(entry["removed"].isNull(), entry["value"])


def best_label(labels: str = "labels", ident: str = "id", languages: tuple[str, ...] = ("en", "fr", "es")) -> Column:
    """The first of some languages, else the first entry, else the id."""
    return F.coalesce(*[label(x, labels) for x in languages], first_label(labels), F.col(ident))


def sitelink(site: str, sitelinks: str = "sitelinks") -> Column:
    return lookup(F.col(sitelinks), site)["title"]


def claims_of(prop: str, claims: str = "claims") -> Column:
    return lookup(F.col(claims), prop)


def has_claim(prop: str, claims: str = "claims") -> Column:
    """Whether there is a claim of a property, whatever its value."""
    return F.coalesce(F.map_contains_key(F.col(claims), prop), F.lit(False))


def relations(claims: str = "claims") -> Column:
    """array<struct<prop, dest>> of claims whose main value is an entity, in byte order of the map's keys; duplicates and all ranks stay."""
    keys = F.array_sort(F.map_keys(claims))
    all_ = F.flatten(F.transform(keys, lambda k: F.col(claims)[k]))
    return F.coalesce(_linked(all_), F.array().cast("array<struct<prop: string, dest: string>>"))


def _linked(some: Column) -> Column:
    linked = F.filter(some, lambda c: (c["mainsnak"]["snaktype"] == "value") & (c["mainsnak"]["datavalue"]["type"] == "wikibase-entityid") & c["mainsnak"]["datavalue"]["entityid"].isNotNull())
    return F.transform(linked, lambda c: F.struct(c["mainsnak"]["property"].alias("prop"), ref_of_value(c["mainsnak"]["datavalue"]["entityid"]).alias("dest")))


def has_relation(*pairs: tuple[str, str], claims: str = "claims") -> Column:
    """Whether any of some (property, destination) pairs is a relation of the entity. Only those properties' claims are read."""
    one = lambda prop, dest: F.coalesce(F.exists(_linked(claims_of(prop, claims)), lambda r: r["dest"] == dest), F.lit(False))
    out = F.lit(False)
    for pair in pairs:
        out = out | one(*pair)
    return out


def first_destination(prop: str, claims: str = "claims") -> Column:
    return F.try_element_at(_linked(claims_of(prop, claims)), F.lit(1))["dest"]


def coordinates(prop: str = "P625", claims: str = "claims") -> Column:
    """array of globe coordinates of a property's claims."""
    some = F.filter(claims_of(prop, claims), lambda c: (c["mainsnak"]["snaktype"] == "value") & (c["mainsnak"]["datavalue"]["type"] == "globecoordinate"))
    return F.transform(some, lambda c: c["mainsnak"]["datavalue"]["globecoordinate"])
