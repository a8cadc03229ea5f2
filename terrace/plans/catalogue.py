"""The engine's queries over the driver's tables, and the same rows in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.texts import csv_label, links, normalize_title
from terrace.operators import graph, mapreduce, pools, triples, urls
from terrace.plans import fixtures as fx
from terrace.plans import jobs
from terrace.sources import pages as page_source
from terrace.sources import sinks


def url_prefix_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    return urls.aggregate_urls(fx.table(spark, sf, "pages").select("url"))


def extract_urls(spark: SparkSession, sf: str) -> DataFrame:
    return fx.pages(spark, sf).where("kind = 'text'").select("id", F.explode(links(F.col("text"))).alias("url"))


def _pool_titles(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.page_entities(spark, sf)
    return triples.pool_pages(e, triples.triples(e), pools.filter_table(spark, fx.POOLS))


def url_pools(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.page_entities(spark, sf)
    return pools.url_pools(spark, e, triples.triples(e), fx.pages(spark, sf), fx.POOLS)


def pool_sizes(spark: SparkSession, sf: str) -> DataFrame:
    titles = _pool_titles(spark, sf)
    return pools.pool_sizes(spark, [*fx.POOLS, "empty:P361Q999"], titles, pools.pool_urls(fx.pages(spark, sf), titles))


def _places(spark: SparkSession, sf: str) -> DataFrame:
    return graph.edges(triples.triples(fx.place_entities(spark, sf)), "P279")


def subclass_closure(spark: SparkSession, sf: str) -> DataFrame:
    e = _places(spark, sf)
    return graph.descendants(e, graph.roots(e).withColumnRenamed("node", "root"))


def subclass_roots(spark: SparkSession, sf: str) -> DataFrame:
    return graph.roots(_places(spark, sf))


def adjacency(spark: SparkSession, sf: str) -> DataFrame:
    return graph.children(_places(spark, sf)).select("node", F.size("kids").cast("long").alias("n"), F.array_join("kids", ",").alias("kids"))


def relation_property_histogram(spark: SparkSession, sf: str) -> DataFrame:
    names = spark.createDataFrame([("P31", "instance of"), ("P279", "subclass of")], "id string, label string")
    return triples.property_histogram(fx.all_triples(spark, sf), names)


def triples_export(spark: SparkSession, sf: str) -> DataFrame:
    return fx.all_triples(spark, sf)


def titles_export(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.titles(fx.entities(spark, sf))


def clean_labels(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "documents").select("doc_id", csv_label(F.col("text")).alias("label"))


def entities_with_relation(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.entities_with_relation(fx.entities(spark, sf), "P39", "Q11696")


def role_holders_classified(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.entities(spark, sf)
    return jobs.role_holders(e, triples.label_index(e))


def relation_and_claim_count(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.count_relation_and_claim(fx.entities(spark, sf), ("P31", "Q5"), "P1258")


def identical_labels(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.identical_labels(fx.part_entities(spark, sf))


def triple_match_count(spark: SparkSession, sf: str) -> DataFrame:
    return triples.match_count(fx.all_triples(spark, sf), "P39", "Q11696")


def coordinates(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.entity_coordinates(fx.entities(spark, sf))


def page_text_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return page_source.find_page(fx.pages(spark, sf), "Page_7")


def title_index(spark: SparkSession, sf: str) -> DataFrame:
    c = fx.table(spark, sf, "customer")
    return c.select(normalize_title(F.col("c_name")).alias("title"), F.col("c_custkey").alias("id"))


def text_table(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.text_table(fx.pages(spark, sf))


def label_index(spark: SparkSession, sf: str) -> DataFrame:
    return triples.label_index(fx.entities(spark, sf))


def graph_load_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.graph_nodes(fx.entities(spark, sf)).toDF("qid", "label")


def graph_load_edges(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.graph_edges(fx.all_triples(spark, sf)).toDF("start_id", "kind", "end_id")


def map_reduce_generic(spark: SparkSession, sf: str) -> DataFrame:
    t = triples.triples(fx.place_entities(spark, sf))
    return mapreduce.map_reduce(t, lambda r: [((r["prop"]), 1)], lambda a, b: a + b, "prop string, n long")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            url_prefix_aggregate, extract_urls, url_pools, pool_sizes, subclass_closure, subclass_roots, adjacency, relation_property_histogram,
            triples_export, titles_export, clean_labels, entities_with_relation, role_holders_classified, relation_and_claim_count, identical_labels,
            triple_match_count, coordinates, page_text_lookup, title_index, text_table, label_index, graph_load_nodes, graph_load_edges, map_reduce_generic,
        )
    }


_UP = """
up AS (SELECT {by} array_to_string(p[1:k], '/') AS prefix, k = n - 1 AS direct FROM (SELECT {by} p, len(p) AS n, unnest(range(2, len(p))) AS k FROM (SELECT {by} string_split(url, '/') AS p FROM u))),
agg AS (SELECT {by} prefix, count(*) AS descendants, count(*) FILTER (direct) AS direct FROM up GROUP BY ALL)
"""
_WIKI = """
w AS (SELECT page_id AS id, 'Page_' || page_id AS title, page_id % 5 AS pool, 'See [' || url || ' ref] and [' || url || '/x more]' || chr(10) || '* [' || regexp_replace(url, '/[^/]*$', '') || '/s' || page_id || ' b] [nolink] http://bare ' AS text FROM pages)
"""
_LINKS = r"unnest(regexp_extract_all(text, '\[(http.*?) .*\]', 1)) AS url"
_POOL_URLS = f"{_WIKI}, u AS (SELECT DISTINCT 'pool' || pool AS ident, url FROM (SELECT pool, {_LINKS} FROM w))"
_EDGES = "e AS (SELECT 'Q' || (1000 + n_nationkey) AS child, 'Q' || (100 + n_regionkey) AS parent FROM nation UNION SELECT 'Q' || (10000000 + c_custkey), 'Q' || (1000 + c_nationkey) FROM customer)"
_LABELS = """
l AS (SELECT 'Q' || (100 + r_regionkey) AS id, r_name AS label FROM region UNION ALL SELECT 'Q' || (1000 + n_nationkey), n_name FROM nation
 UNION ALL SELECT 'Q' || (10000000 + c_custkey), c_name FROM customer UNION ALL SELECT 'Q' || (20000000 + s_suppkey), s_name FROM supplier
 UNION ALL SELECT 'Q' || (30000000 + p_partkey), CASE WHEN p_size % 5 = 0 THEN 'Q' || (30000000 + p_partkey) ELSE p_name END FROM part
 UNION ALL SELECT 'Q' || (50000000 + page_id), 'Q' || (50000000 + page_id) FROM pages)
"""
_TRIPLES = """
t AS (SELECT 'Q' || (100 + r_regionkey) AS source, 'P31' AS prop, 'Q1' AS dest FROM region
 UNION ALL SELECT 'Q' || (1000 + n_nationkey), unnest(['P31', 'P279']), unnest(['Q2', 'Q' || (100 + n_regionkey)]) FROM nation
 UNION ALL SELECT 'Q' || (10000000 + c_custkey), unnest(['P31', 'P279']), unnest(['Q3', 'Q' || (1000 + c_nationkey)]) FROM customer
 UNION ALL SELECT 'Q' || (20000000 + s_suppkey), unnest(['P31', 'P17']), unnest(['Q4', 'Q' || (1000 + s_nationkey)]) FROM supplier
 UNION ALL SELECT 'Q' || (30000000 + p_partkey), 'P31', 'Q5' FROM part
 UNION ALL SELECT 'Q' || (30000000 + p_partkey), 'P31', 'Q95074' FROM part WHERE p_size % 14 = 0
 UNION ALL SELECT 'Q' || (30000000 + p_partkey), 'P39', 'Q11696' FROM part WHERE p_size % 7 = 0
 UNION ALL SELECT 'Q' || (30000000 + p_partkey), 'P1441', CASE WHEN p_size % 4 = 0 THEN 'Q99999999' ELSE 'Q' || (20000000 + p_partkey % 10 + 1) END FROM part WHERE p_size % 2 = 0
 UNION ALL SELECT 'Q' || (50000000 + page_id), unnest(['P31', 'P361']), unnest(['Q7', 'Q' || (900 + page_id % 5)]) FROM pages
 UNION ALL SELECT 'Q' || (40000000 + o_orderkey), 'P50', 'Q' || (10000000 + o_custkey) FROM orders
 UNION ALL SELECT 'Q' || (40000000 + l_orderkey), 'P51', 'Q' || (30000000 + l_partkey) FROM lineitem
 UNION ALL SELECT 'Q' || (40000000 + l_orderkey), 'P52', 'Q' || (20000000 + l_suppkey) FROM lineitem)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "url_prefix_aggregate": f"WITH u AS (SELECT DISTINCT url FROM pages), {_UP.format(by='')} SELECT * FROM agg WHERE descendants > 1 AND descendants > (SELECT count(*) FROM u) // 1000 AND direct > descendants // 2",
        "extract_urls": f"WITH {_WIKI} SELECT id, {_LINKS} FROM w",
        "url_pools": f"WITH {_POOL_URLS}, {_UP.format(by='ident,')}, n AS (SELECT ident, count(*) AS n FROM u GROUP BY ALL), a AS (SELECT agg.* FROM agg JOIN n USING (ident) WHERE descendants > 1 AND descendants > n // 1000 AND direct > descendants // 2) SELECT 'enwiki' AS wiki, ident, prefix, descendants, direct FROM (SELECT *, count(*) OVER (PARTITION BY prefix) AS c FROM a) WHERE c < 5 // 2",
        "pool_sizes": f"WITH {_POOL_URLS}, p AS (SELECT 'pool' || pool AS ident, count(*) AS pages FROM w GROUP BY ALL), n AS (SELECT ident, count(*) AS urls FROM u GROUP BY ALL) SELECT i.ident, coalesce(pages, 0) AS pages, coalesce(urls, 0) AS urls FROM (SELECT unnest(['pool0', 'pool1', 'pool2', 'pool3', 'pool4', 'empty']) AS ident) i LEFT JOIN p USING (ident) LEFT JOIN n USING (ident)",
        "subclass_closure": f"WITH RECURSIVE {_EDGES}, r(root, node) AS (SELECT DISTINCT parent, parent FROM e WHERE parent NOT IN (SELECT child FROM e) UNION SELECT r.root, e.child FROM r JOIN e ON e.parent = r.node) SELECT * FROM r WHERE root <> node",
        "subclass_roots": f"WITH {_EDGES} SELECT DISTINCT parent AS node FROM e x WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.child = x.parent)",
        "adjacency": f"WITH {_EDGES} SELECT parent AS node, count(*) AS n, string_agg(child, ',' ORDER BY child) AS kids FROM e GROUP BY ALL",
        "relation_property_histogram": f"WITH {_TRIPLES} SELECT count(*) AS n, prop, CASE prop WHEN 'P31' THEN 'instance of' WHEN 'P279' THEN 'subclass of' ELSE 'no label' END AS label FROM t GROUP BY prop",
        "triples_export": f"WITH {_TRIPLES} SELECT * FROM t",
        "titles_export": f"WITH {_LABELS} SELECT id, replace(replace(label, ',', ''), chr(10), '') AS label FROM l",
        "clean_labels": "SELECT doc_id, replace(replace(text, ',', ''), chr(10), '') AS label FROM documents",
        "entities_with_relation": f"WITH {_LABELS}, {_TRIPLES} SELECT id, label FROM l WHERE EXISTS (SELECT 1 FROM t WHERE source = id AND prop = 'P39' AND dest = 'Q11696')",
        "role_holders_classified": f"WITH {_LABELS}, {_TRIPLES} SELECT h.id, CASE WHEN p_size % 14 = 0 THEN h.label || ' (' || coalesce(x.label, 'unknown work') || ')' ELSE h.label || ', REAL' END AS line FROM part JOIN l h ON h.id = 'Q' || (30000000 + p_partkey) LEFT JOIN t ON t.source = h.id AND t.prop = 'P1441' LEFT JOIN l x ON x.id = t.dest WHERE p_size % 7 = 0",
        "relation_and_claim_count": "SELECT count(*) AS n FROM part WHERE p_size % 3 = 0",
        "identical_labels": "SELECT coalesce(CASE WHEN p_size % 5 <> 0 THEN p_name END = CASE WHEN p_size % 5 <> 0 THEN CASE WHEN p_size % 3 = 0 THEN p_name ELSE p_brand END END, false) AS identical, count(*) AS n FROM part GROUP BY ALL",
        "triple_match_count": f"WITH {_TRIPLES} SELECT count(*) AS n FROM t WHERE prop = 'P39' AND dest = 'Q11696'",
        "coordinates": "SELECT 'Q' || (20000000 + s_suppkey) AS id, s_name AS label, (s_suppkey % 180 - 90)::DOUBLE AS latitude, (s_suppkey % 360 - 180)::DOUBLE AS longitude FROM supplier WHERE s_suppkey % 3 <> 0",
        "page_text_lookup": f"WITH {_WIKI} SELECT text AS content FROM w WHERE title = 'Page_7'",
        "title_index": "SELECT lower(left(c_name, 1)) || substr(c_name, 2) AS title, c_custkey AS id FROM customer",
        "text_table": f"WITH {_WIKI} SELECT id, text FROM w",
        "label_index": f"WITH {_LABELS} SELECT id, label FROM l",
        "graph_load_nodes": f"WITH {_LABELS} SELECT id AS qid, chr(39) || replace(replace(label, chr(39), ''), chr(10), '') || chr(39) AS label FROM l",
        "graph_load_edges": f"WITH {_TRIPLES} SELECT source AS start_id, prop AS kind, dest AS end_id FROM t",
        "map_reduce_generic": f"WITH {_TRIPLES} SELECT prop, count(*) AS n FROM t WHERE length(source) IN (4, 5) OR source LIKE 'Q10%' GROUP BY prop",
    }
