"""Queries that write the driver's tables in the formats of the sources and sinks, and read them through these; with their SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.entities import best_label, claims_of, coordinates, description, relations, sitelink
from terrace.operators import graph
from terrace.operators.order import numbered
from terrace.operators.pools import filter_table
from terrace.operators.triples import label_index, triples, wanted
from terrace.operators.urls import aggregate_urls, ordered
from terrace.plans import fixtures as fx
from terrace.plans.compile import compile_entities, compile_pages, compile_tables
from terrace.scratch import folder
from terrace.sources import sinks
from terrace.sources.catalog import Catalog
from terrace.sources.entities import read_entities
from terrace.sources.framed import read_framed, read_framed_lines, write_framed
from terrace.sources.pages import find_page, read_pages, title_text

DATE = "20240101"


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A root element around the lines of each part."""
    line = lambda x: pa.RecordBatch.from_arrays([pa.array(x, pa.string())], names=["value"])
    yield line(["<mediawiki>"])
    for batch in batches:
        yield line(batch.column("value").to_pylist())
    yield line(["</mediawiki>"])


def _xml(spark: SparkSession, sf: str) -> DataFrame:
    """Dumps, one <page> a line: every seventh a redirect, every eleventh of an unknown model, all with an older revision."""
    p, k = fx.pages(spark, sf), F.col("id")
    head = F.concat(F.lit("<page><title>"), "title", F.lit("</title><ns>0</ns><id>"), k.cast("string"), F.lit("</id>"))
    target = F.when(k % 7 == 0, F.concat(F.lit("<redirect title='Page_"), (k + 1).cast("string"), F.lit("'/>"))).otherwise("")
    model = F.when(k % 11 == 0, F.lit("odd")).otherwise("wikitext")
    text = F.when(k % 7 == 0, F.lit("")).otherwise(_escaped(F.replace("text", F.lit("\n"), F.lit(" / "))))
    revision = lambda m, t: F.concat(F.lit("<revision><id>1</id><model>"), m, F.lit("</model><text>"), t, F.lit("</text></revision>"))
    return p.select(F.concat(head, target, revision(F.lit("wikitext"), F.lit("old")), revision(model, text), F.lit("</page>")).alias("value")).mapInArrow(_rooted, "value string")


def _page_file(spark: SparkSession, sf: str) -> DataFrame:
    path = folder(spark, "xml")
    _xml(spark, sf).write.option("compression", "bzip2").text(path)
    return read_pages(spark, f"{path}/*.bz2")


def pages_from_xml(spark: SparkSession, sf: str) -> DataFrame:
    return _page_file(spark, sf).select("id", "title", "ns", "model", "model_known", "kind", "text", "redirect")


def redirect_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return find_page(_page_file(spark, sf), "Page_7")


def links_without_redirects(spark: SparkSession, sf: str) -> DataFrame:
    p = _page_file(spark, sf).where("kind = 'text'")
    return p.select("id", F.size(F.split("text", r"\[http")).cast("long").alias("n"))


def wiki_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Landed XML, compiled, then looked up by normalised title and id."""
    c = Catalog(spark, folder(spark, "wiki"))
    _xml(spark, sf).write.option("compression", "bzip2").text(c.path("download", "w", DATE))
    compile_pages(c, "w", DATE)
    compile_tables(c, "w")
    at = lambda name: spark.read.parquet(f"{c.path('tables', 'w', DATE)}/{name}")
    return at("ids").join(at("texts"), "id").select("id", "title", "text")


def _json(spark: SparkSession, sf: str) -> DataFrame:
    """An entity a line for each part, with a claim of every kind of value, removed labels, maps given as [] and lines that are none."""
    part = fx.table(spark, sf, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    claim = lambda prop, kind, value: F.concat(F.lit(f'"{prop}":[{{"id":"x","type":"statement","rank":"normal","mainsnak":{{"property":"{prop}","snaktype":"value","datavalue":{{"type":"{kind}","value":'), value, F.lit("}}}]"))
    text = lambda *x: F.concat(*[y if isinstance(y, Column) else F.lit(y) for y in x])
    n = lambda x: x.cast("string")
    claims = F.concat_ws(
        ",",
        claim("P31", "wikibase-entityid", text('{"entity-type":"item","numeric-id":', n(size), "}")),
        claim("P1", "string", F.to_json(F.struct("p_brand")).substr(F.lit(12), F.length(F.to_json(F.struct("p_brand"))) - 12)),
        claim("P2", "quantity", text('{"amount":"+', n(size), '","unit":"1"}')),
        claim("P3", "time", text('{"time":"+2000-01-01T00:00:00Z","timezone":', n(-size), ',"precision":11}')),
        claim("P4", "monolingualtext", text('{"language":"en","text":"size ', n(size), '"}')),
        claim("P625", "globecoordinate", text('{"latitude":', n(k % 90), '.5,"longitude":-', n(k % 180), "}")),
    )
    labels = F.when(size % 4 == 0, F.lit("[]")).when(size % 4 == 1, F.lit('{"en":{"language":"en","removed":""},"fr":{"language":"fr","value":"pièce"}}')).otherwise(text('{"en":{"language":"en","value":"part ', n(k), '"}}'))
    line = text('{"id":"Q', n(k), '","type":"', F.when(size % 10 == 0, F.lit("thing")).otherwise("item"), '","labels":', labels, ',"claims":', F.when(size % 9 == 0, F.lit("[]")).otherwise(text("{", claims, "}")), "},")
    return part.select(line.alias("value"))


def _entity_file(spark: SparkSession, sf: str) -> DataFrame:
    path = folder(spark, "json")
    _json(spark, sf).write.option("compression", "gzip").text(path)
    return read_entities(spark, path, partitions=int(spark.conf.get("spark.sql.shuffle.partitions")))


def _values(e: DataFrame) -> DataFrame:
    first = lambda prop: F.try_element_at(claims_of(prop), F.lit(1))["mainsnak"]["datavalue"]
    at = F.try_element_at(coordinates(), F.lit(1))
    return e.select(
        "id", best_label().alias("label"), F.try_element_at(relations(), F.lit(1))["dest"].alias("dest"), first("P1")["string"].alias("brand"), first("P2")["quantity"]["amount"].alias("amount"),
        first("P3")["time"]["timezone"].alias("timezone"), first("P4")["monolingualtext"]["value"].alias("words"), at["latitude"].alias("latitude"), at["longitude"].alias("longitude"),
    )


def entities_from_json(spark: SparkSession, sf: str) -> DataFrame:
    return _values(_entity_file(spark, sf).where("corrupt is null"))


def quarantined_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _entity_file(spark, sf).where("corrupt is not null").groupBy(F.lit("no entity").alias("why")).agg(F.count("*").alias("n"))


def compiled_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Landed framed Snappy, compiled; what is stored as triples and labels of the date."""
    c = Catalog(spark, folder(spark, "entities"))
    write_framed(_json(spark, sf), c.path("download", "entities", DATE))
    compile_entities(c, "entities", DATE)
    return c.triples(DATE).join(c.labels(DATE).withColumnRenamed("id", "source"), "source").select("source", "prop", "dest", "label")


def _snaks(spark: SparkSession, sf: str) -> DataFrame:
    """An entity a line for each supplier, with what else entities hold: sitelinks, aliases, descriptions, snaks without a value, references to properties, and claims that can't be read."""
    s = fx.table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    n, name = k.cast("string"), F.regexp_extract(F.to_json(F.struct("s_name")), r"^\{\"s_name\":(.*)\}$", 1)
    text = lambda *x: F.concat(*[y if isinstance(y, Column) else F.lit(y) for y in x])
    ref = lambda kind: text('"mainsnak":{"property":"P5","snaktype":"value","datavalue":{"type":"wikibase-entityid","value":{"entity-type":"', kind, '","numeric-id":', n, "}}}")
    given = '"type":"statement","rank":"normal",'
    claims = [
        text(given, ref("item")),
        F.lit(given + '"mainsnak":{"property":"P5","snaktype":"somevalue"}'),
        F.lit(given + '"mainsnak":{"property":"P5","snaktype":"novalue"}'),
        F.lit('"type":"statement","rank":"normal"'),
        F.lit(given + '"mainsnak":{"property":"P5","datavalue":{"type":"string","value":"x"}}'),
        text('"type":"odd","rank":"normal",', ref("item")),
        F.lit(given + '"mainsnak":{"property":"P5","snaktype":"value"}'),
        text('"type":"claim",', ref("property")),
    ]
    claim = F.element_at(F.array(*claims), (k % 8 + 1).cast("int"))
    mono = lambda v: text('{"language":"en","value":', v, "}")
    line = text('{"id":"Q', n, '","type":"item","labels":{},"descriptions":{"en":', mono(name), '},"aliases":{"en":[', mono(name), ",", mono(text('"S', n, '"')), ']},"sitelinks":{"enwiki":{"site":"enwiki","title":', name, '}},"claims":{"P5":[{"id":"x",', claim, "}]}}")
    return s.select(line.alias("value"))


def _snak_file(spark: SparkSession, sf: str) -> DataFrame:
    path = folder(spark, "snaks")
    _snaks(spark, sf).write.option("compression", "bzip2").text(path)
    return read_entities(spark, path)


def entity_extras(spark: SparkSession, sf: str) -> DataFrame:
    e = _snak_file(spark, sf).where("corrupt is null")
    also = F.array_join(F.transform(F.try_element_at("aliases", F.lit("en")), lambda x: x["value"]), "|")
    kind = F.try_element_at(claims_of("P5"), F.lit(1))["mainsnak"]["snaktype"]
    return e.select("id", sitelink("enwiki").alias("page"), description("en").alias("description"), also.alias("aliases"), kind.alias("snaktype"), F.try_element_at(relations(), F.lit(1))["dest"].alias("dest"))


def quarantined_claims(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of entities with a claim that can't be read: the whole line is set apart."""
    return _snak_file(spark, sf).where("corrupt is not null").select(F.regexp_extract("corrupt", r'"id":"(Q\d+)"', 1).alias("id"))


def export_line_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of the exports as often as it is there, without the parts' headers."""
    path, e = folder(spark, "exports"), fx.place_entities(spark, sf)
    sinks.write_csv(_odd_labels(spark, sf), f"{path}/csv")
    sinks.write_graph(e, triples(e), path)
    lines = lambda name, header: spark.read.text(f"{path}/{name}").where(F.col("value") != header).select(F.lit(name).alias("file"), "value")
    every = lines("csv", "id,label").unionByName(lines("nodes", "qid:ID;label:LABEL")).unionByName(lines("tuples", ":START_ID;:TYPE;:END_ID"))
    return every.groupBy("file", "value").agg(F.count("*").alias("n"))


def compile_counters(spark: SparkSession, sf: str) -> DataFrame:
    """What a compile job counts while it reads the dump once, half of it framed Snappy and half gzip, two files a batch."""
    c = Catalog(spark, folder(spark, "entities"))
    lines, path = _json(spark, sf).repartition(4), c.path("download", "entities", DATE)
    even = F.regexp_extract("value", r'^\{"id":"Q(\d+)"', 1).cast("long") % 2 == 0
    write_framed(lines.where(even), path, most=2_000_000)
    lines.where(~even).write.mode("append").option("compression", "gzip").text(path)
    compile_entities(c, "entities", DATE, files_per_batch=2)
    total = [F.sum(x).cast("long").alias(x) for x in ("lines", "entities", "corrupt", "relations")]
    stored = c.entities(DATE).agg(F.count("*").alias("stored")), c.triples(DATE).agg(F.count("*").alias("triples")), c.labels(DATE).agg(F.count("*").alias("labels"))
    out = c.progress(DATE).agg(*total)
    for one in stored:  # a row each
        out = out.crossJoin(F.broadcast(one))
    return out


def raw_cat(spark: SparkSession, sf: str) -> DataFrame:
    """Characters of the raw content of framed files, counted; ranges are small, so that many tasks read a file."""
    path = folder(spark, "cat")
    write_framed(fx.table(spark, sf, "customer").select(F.concat_ws("|", "c_custkey", "c_name", "c_mktsegment").alias("value")), path)
    content = read_framed(spark, f"{path}/*.sz", range_bytes=1 << 18).select(F.explode(F.split(F.decode("content", "utf-8"), "")).alias("letter"))
    return content.where("letter <> ''").groupBy("letter").agg(F.count("*").alias("n"))


def pages_by_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Landed XML, compiled into parts that are cut by bytes."""
    c = Catalog(spark, folder(spark, "wiki"))
    _xml(spark, sf).write.option("compression", "bzip2").text(c.path("download", "w", DATE))
    compile_pages(c, "w", DATE, part_bytes=64_000)
    return c.pages("w").select("id", "title", "model", "kind", "text")


def forest_tree(spark: SparkSession, sf: str) -> DataFrame:
    """The tree of places as lines, each with its path in the order of the document."""
    places = fx.place_entities(spark, sf)
    return graph.forest_lines(graph.edges(triples(places), "P279"), label_index(places))


def framed_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = folder(spark, "framed")
    write_framed(fx.table(spark, sf, "customer").select(F.concat_ws("|", "c_custkey", "c_name").alias("value")), path)
    return read_framed_lines(spark, f"{path}/*.sz").select("value")


def _odd_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels with separators, quotes and nothing in them."""
    k = F.col("c_custkey")
    return fx.table(spark, sf, "customer").select(F.concat(F.lit("Q"), k.cast("string")).alias("id"), F.when(k % 5 == 0, F.lit("")).when(k % 5 == 1, F.lit(None).cast("string")).otherwise(F.concat(F.lit("'a; b\t\"c\" "), "c_name")).alias("label"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).distinct()  # each part has the header


def csv_file(spark: SparkSession, sf: str) -> DataFrame:
    path = folder(spark, "csv")
    sinks.write_csv(_odd_labels(spark, sf), path)
    return _lines(spark, path)


def tsv_file(spark: SparkSession, sf: str) -> DataFrame:
    path = folder(spark, "tsv")
    sinks.write_tsv(_odd_labels(spark, sf), path)
    return _lines(spark, path)


def graph_files(spark: SparkSession, sf: str) -> DataFrame:
    path, e = folder(spark, "graph_files"), fx.place_entities(spark, sf)
    sinks.write_graph(e, triples(e), path)
    return _lines(spark, f"{path}/nodes").unionByName(_lines(spark, f"{path}/tuples"))


def url_prefixes_in_order(spark: SparkSession, sf: str) -> DataFrame:
    found = ordered(aggregate_urls(fx.table(spark, sf, "pages").select("url")))
    return found.select("prefix", "descendants", "direct")


def url_prefix_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The aggregated prefixes with their places in the listing."""
    return numbered(aggregate_urls(fx.table(spark, sf, "pages").select("url")), "prefix").select("at", "prefix", "descendants", "direct")


def titles_and_texts(spark: SparkSession, sf: str) -> DataFrame:
    return title_text(_page_file(spark, sf))


def wanted_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Entities of a filter table, from triples that are stored by property: the pools, the orders of every seventh customer, and a property that isn't there."""
    path = folder(spark, "by_property")
    sinks.write_by_property(fx.all_triples(spark, sf), path)
    customers = fx.table(spark, sf, "customer").where("c_custkey % 7 = 0").select(F.lit("orders").alias("ident"), F.lit("P50").alias("prop"), F.concat(F.lit("Q"), (10000000 + F.col("c_custkey")).cast("string")).alias("dest"))
    asked = filter_table(spark, [*fx.POOLS, "none:P404Q1"]).unionByName(customers)
    return wanted(spark.read.parquet(path), graph.cut(asked))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (pages_from_xml, redirect_lookup, links_without_redirects, wiki_tables, entities_from_json, quarantined_lines, compiled_entities, compile_counters, framed_lines, raw_cat, pages_by_bytes, forest_tree, entity_extras, quarantined_claims, export_line_counts, url_prefix_listing, titles_and_texts, wanted_entities, csv_file, tsv_file, graph_files, url_prefixes_in_order)}


_PAGES = """
p AS (SELECT page_id AS id, 'Page_' || page_id AS title, 0 AS ns, CASE WHEN page_id % 11 = 0 THEN 'odd' ELSE 'wikitext' END AS model, page_id % 11 <> 0 AS model_known,
 CASE WHEN page_id % 7 = 0 THEN 'redirect' ELSE 'text' END AS kind,
 CASE WHEN page_id % 7 = 0 THEN '' ELSE 'See [' || url || ' ref] and [' || url || '/x more] / * [' || regexp_replace(url, '/[^/]*$', '') || '/s' || page_id || ' b] [nolink] http://bare ' END AS text,
 CASE WHEN page_id % 7 = 0 THEN 'Page_' || (page_id + 1) END AS redirect FROM pages)
"""
_LABEL = "CASE p_size % 4 WHEN 0 THEN 'Q' || p_partkey WHEN 1 THEN 'pièce' ELSE 'part ' || p_partkey END"
_ODD = """
c AS (SELECT 'Q' || c_custkey AS id, CASE WHEN c_custkey % 5 < 2 THEN '' ELSE '''a; b' || chr(9) || '"c" ' || c_name END AS label FROM customer)
"""

_TREE = """
WITH RECURSIVE {labels}, {edges}, r(path, node, depth) AS (SELECT DISTINCT parent, parent, 0 FROM e WHERE parent NOT IN (SELECT child FROM e) UNION ALL SELECT r.path || chr(1) || e.child, e.child, depth + 1 FROM r JOIN e ON e.parent = r.node),
x AS (SELECT path, depth, repeat('    ', depth) AS pad, '  <a anchor=' || chr(39) || node || chr(39) || '/><b>' || node || '</b> ' || coalesce(label, 'no label') AS name FROM r LEFT JOIN l ON l.id = node)
SELECT path, CASE WHEN depth > 0 THEN repeat('    ', depth - 1) || '  <ul>' || chr(10) ELSE '' END || pad || '<li>' || chr(10) || pad || name AS line FROM x
UNION ALL SELECT path || chr(2), pad || '</li>' || CASE WHEN depth > 0 THEN chr(10) || repeat('    ', depth - 1) || '  </ul>' ELSE '' END FROM x
"""


def oracle_sql() -> dict[str, str]:
    from terrace.plans.catalogue import _EDGES, _LABELS, _TRIPLES, _UP

    given = lambda x: f"CASE WHEN p_size % 9 <> 0 THEN {x} END"
    return {
        "pages_from_xml": f"WITH {_PAGES} SELECT * FROM p",
        "redirect_lookup": f"WITH {_PAGES} SELECT 'REDIRECT ' || redirect AS content FROM p WHERE title = 'Page_7'",
        "links_without_redirects": f"WITH {_PAGES} SELECT id, len(string_split(text, '[http')) AS n FROM p WHERE kind = 'text'",
        "wiki_tables": f"WITH {_PAGES} SELECT id, 'p' || substr(title, 2) AS title, CASE kind WHEN 'redirect' THEN 'REDIRECT ' || redirect ELSE text END AS text FROM p",
        "entities_from_json": f"SELECT 'Q' || p_partkey AS id, {_LABEL} AS label, {given("'Q' || p_size")} AS dest, {given('p_brand')} AS brand, {given('p_size::DOUBLE')} AS amount, {given('-p_size::BIGINT')} AS timezone, {given("'size ' || p_size")} AS words, {given('p_partkey % 90 + 0.5::DOUBLE')} AS latitude, {given('(-(p_partkey % 180))::DOUBLE')} AS longitude FROM part WHERE p_size % 10 <> 0",
        "quarantined_lines": "SELECT 'no entity' AS why, count(*) AS n FROM part WHERE p_size % 10 = 0",
        "compiled_entities": f"SELECT 'Q' || p_partkey AS source, 'P31' AS prop, 'Q' || p_size AS dest, {_LABEL} AS label FROM part WHERE p_size % 10 <> 0 AND p_size % 9 <> 0",
        "compile_counters": "SELECT *, entities AS stored, relations AS triples, entities AS labels FROM (SELECT count(*) AS lines, count(*) FILTER (p_size % 10 <> 0) AS entities, count(*) FILTER (p_size % 10 = 0) AS corrupt, count(*) FILTER (p_size % 10 <> 0 AND p_size % 9 <> 0) AS relations FROM part)",
        "raw_cat": "SELECT letter, count(*) AS n FROM (SELECT unnest(string_split(c_custkey || '|' || c_name || '|' || c_mktsegment || chr(10), '')) AS letter FROM customer) GROUP BY letter",
        "pages_by_bytes": f"WITH {_PAGES} SELECT id, title, model, kind, text FROM p",
        "entity_extras": "SELECT 'Q' || s_suppkey AS id, s_name AS page, s_name AS description, s_name || '|S' || s_suppkey AS aliases, ['value', 'somevalue', 'novalue', '', '', '', '', 'value'][s_suppkey % 8 + 1] AS snaktype, CASE s_suppkey % 8 WHEN 0 THEN 'Q' || s_suppkey WHEN 7 THEN 'P' || s_suppkey END AS dest FROM supplier WHERE s_suppkey % 8 NOT IN (3, 4, 5, 6)",
        "quarantined_claims": "SELECT 'Q' || s_suppkey AS id FROM supplier WHERE s_suppkey % 8 IN (3, 4, 5, 6)",
        "export_line_counts": f"WITH {_ODD}, {_LABELS}, {_TRIPLES}, x AS (SELECT 'csv' AS file, id || ',' || label AS value FROM c UNION ALL SELECT 'nodes', id || ';' || chr(39) || replace(replace(label, chr(39), ''), chr(10), '') || chr(39) FROM l WHERE length(id) IN (4, 5) OR id LIKE 'Q10%' UNION ALL SELECT 'tuples', source || ';' || prop || ';' || dest FROM t WHERE length(source) IN (4, 5) OR source LIKE 'Q10%') SELECT file, value, count(*) AS n FROM x GROUP BY ALL",
        "url_prefix_listing": f"WITH u AS (SELECT DISTINCT url FROM pages), {_UP.format(by='')} SELECT row_number() OVER (ORDER BY prefix) AS at, * FROM agg WHERE descendants > 1 AND descendants > (SELECT count(*) FROM u) // 1000 AND direct > descendants // 2",
        "titles_and_texts": f"WITH {_PAGES} SELECT title, text FROM p",
        "wanted_entities": f"WITH {_TRIPLES} SELECT DISTINCT CASE prop WHEN 'P361' THEN 'pool' || (substr(dest, 2)::BIGINT - 900) ELSE 'orders' END AS ident, source FROM t WHERE prop = 'P361' OR (prop = 'P50' AND substr(dest, 2)::BIGINT % 10000000 % 7 = 0)",
        "forest_tree": f"{_TREE.format(labels=_LABELS, edges=_EDGES)}",
        "framed_lines": "SELECT c_custkey || '|' || c_name AS value FROM customer",
        "csv_file": f"WITH {_ODD} SELECT 'id,label' AS value UNION SELECT id || ',' || label FROM c",
        "tsv_file": f"WITH {_ODD} SELECT id || chr(9) || label AS value FROM c",
        "graph_files": f"WITH {_LABELS}, {_TRIPLES} SELECT 'qid:ID;label:LABEL' AS value UNION SELECT ':START_ID;:TYPE;:END_ID' UNION SELECT id || ';' || chr(39) || replace(replace(label, chr(39), ''), chr(10), '') || chr(39) FROM l WHERE length(id) IN (4, 5) OR id LIKE 'Q10%' UNION SELECT source || ';' || prop || ';' || dest FROM t WHERE length(source) IN (4, 5) OR source LIKE 'Q10%'",
        "url_prefixes_in_order": f"WITH u AS (SELECT DISTINCT url FROM pages), {_UP.format(by='')} SELECT * FROM agg WHERE descendants > 1 AND descendants > (SELECT count(*) FROM u) // 1000 AND direct > descendants // 2 ORDER BY prefix",
    }
