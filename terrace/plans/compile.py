"""Compile jobs: landed dumps into snapshots of typed tables."""

from __future__ import annotations

from terrace.sources import sinks
from terrace.sources.catalog import Catalog
from terrace.sources.pages import read_pages
from terrace.sources.parts import PART
from terrace.streaming.compile import compile_entities

__all__ = ["compile_all", "compile_entities", "compile_pages", "compile_tables"]


def compile_pages(catalog: Catalog, wiki: str, date: str, strict: bool = False, part_bytes: int = PART) -> None:
    """download/wiki/date (XML, plain or compressed) to pages/wiki/date, in parts of about ``part_bytes``. What was there goes when all is written, the marker comes last; Spark starts the largest splits first."""
    catalog.write(read_pages(catalog.spark, catalog.inputs(wiki, date), strict), "pages", wiki, date, part_bytes)


def compile_all(catalog: Catalog, entities: str = "entities", again: bool = False) -> list[tuple[str, str]]:
    """Compile the latest landed snapshot of everything under download that isn't compiled yet (all with ``again``); what was compiled."""
    done = []
    for name in catalog.names("download"):
        date, state = catalog.latest("download", name), "entities" if name == entities else "pages"
        if date is None or (not again and date in catalog.dates(state, name)):
            continue
        (compile_entities if name == entities else compile_pages)(catalog, name, date)
        done.append((name, date))
    return done


def compile_tables(catalog: Catalog, wiki: str, date: str | None = None) -> None:
    """tables/wiki/date: ids to titles and to texts (redirects as such), and normalised titles to ids, each sorted by its key."""
    date = date or catalog.latest("pages", wiki)
    pages = catalog.pages(wiki, date)
    for name, table, key in (("titles", sinks.title_table(pages), "id"), ("texts", sinks.text_table(pages), "id"), ("ids", sinks.title_index(pages), "title")):
        sinks.write_sorted(table, f"{catalog.path('tables', wiki, date)}/{name}", key)
