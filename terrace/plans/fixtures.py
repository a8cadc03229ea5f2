"""A knowledge graph derived from star-schema tables, so that every operator has something to work on.

Ids: region Q(100+k), nation Q(1000+k), customer Q(10000000+k), supplier Q(20000000+k), part Q(30000000+k),
order Q(40000000+k), page Q(50000000+k). P31 gives the class (Q1 to Q7), P279 the next higher place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.triples import triples
from terrace.schemas import CLAIM, DATAVALUE, MONO

POOLS = [f"pool{i}:P361Q{900 + i}" for i in range(5)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _claim(prop: str, kind: str, value: Column | None = None) -> Column:
    arms = {"entityid": None, "globecoordinate": None} | ({kind: value} if value is not None else {})
    name = {"entityid": "wikibase-entityid", "globecoordinate": "globecoordinate"}.get(kind)
    null = F.lit(None)
    data = F.struct(F.lit(name).alias("type"), null.cast("string").alias("string"), *[(arms[k] if arms[k] is not None else null).alias(k) for k in ("entityid", "globecoordinate")], *[null.alias(k) for k in ("time", "quantity", "monolingualtext")]).cast(DATAVALUE)
    snak = F.struct(F.lit(prop).alias("property"), F.lit(None).cast("string").alias("datatype"), F.lit("value" if value is not None else "novalue").alias("snaktype"), (data if value is not None else null.cast(DATAVALUE)).alias("datavalue"))
    return F.struct(null.cast("string").alias("id"), F.lit("statement").alias("type"), F.lit("normal").alias("rank"), snak.alias("mainsnak")).cast(CLAIM)


def link(prop: str, num: Column | int) -> Column:
    num = F.lit(num) if isinstance(num, int) else num
    return _claim(prop, "entityid", F.struct(F.lit("item").alias("entity_type"), num.cast("bigint").alias("numeric_id")))


def place(prop: str, lat: Column, lon: Column) -> Column:
    return _claim(prop, "globecoordinate", F.struct(lat.cast("double").alias("latitude"), lon.cast("double").alias("longitude"), F.lit(None).cast("double").alias("altitude"), F.lit(None).cast("double").alias("precision"), F.lit(None).cast("string").alias("globe")))


def _text(language: str, value: Column) -> Column:
    return F.struct(F.lit(language).alias("k"), F.struct(F.lit(language).alias("language"), value.alias("value"), F.lit(None).cast("string").alias("removed")).cast(MONO).alias("v"))


def _entity(df: DataFrame, num: Column, labels: list[Column], claims: list[tuple[str, Column]], site: Column | None = None) -> DataFrame:
    """``claims`` are (property, array of claims or null)."""
    kinds = dict(zip(("labels", "descriptions", "aliases", "claims", "sitelinks"), (f"map<string, {MONO}>", f"map<string, {MONO}>", f"map<string, array<{MONO}>>", f"map<string, array<{CLAIM}>>", "map<string, struct<site: string, title: string>>"), strict=True))
    pairs = lambda entries: F.map_from_entries(F.filter(F.array(*entries), lambda x: x["v"].isNotNull()))
    held = pairs([F.struct(F.lit(p).alias("k"), c.alias("v")) for p, c in claims])
    named = F.map_from_entries(F.filter(F.array(*labels), lambda x: x["v"]["value"].isNotNull())) if labels else F.create_map()
    links = F.create_map(F.lit("enwiki"), F.struct(F.lit("enwiki").alias("site"), site.alias("title"))) if site is not None else F.create_map()
    return df.select(F.concat(F.lit("Q"), num.cast("bigint").cast("string")).alias("id"), F.lit("item").alias("type"), named.cast(kinds["labels"]).alias("labels"), F.create_map().cast(kinds["descriptions"]).alias("descriptions"), F.create_map().cast(kinds["aliases"]).alias("aliases"), held.cast(kinds["claims"]).alias("claims"), links.cast(kinds["sitelinks"]).alias("sitelinks"))


def part_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts: two languages, roles (P39), some of them fictional (P31 Q95074) with a work (P1441), claims without a value (P1258)."""
    part = table(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    named = size % 5 != 0
    labels = [_text("en", F.when(named, F.col("p_name"))), _text("de", F.when(named, F.when(size % 3 == 0, F.col("p_name")).otherwise(F.col("p_brand"))))]
    work = F.when(size % 4 == 0, 99999999).otherwise(20000000 + k % 10 + 1)
    claims = [
        ("P31", F.when(size % 14 == 0, F.array(link("P31", 5), link("P31", 95074))).otherwise(F.array(link("P31", 5)))),
        ("P39", F.when(size % 7 == 0, F.array(link("P39", 11696)))),
        ("P1441", F.when(size % 2 == 0, F.array(link("P1441", work)))),
        ("P1258", F.when(size % 3 == 0, F.array(_claim("P1258", "entityid")))),
    ]
    return _entity(part, 30000000 + k, labels, claims)


def supplier_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    spot = F.when(k % 3 == 0, F.array(_claim("P625", "globecoordinate"))).otherwise(F.array(place("P625", k % 180 - 90, k % 360 - 180)))
    return _entity(s, 20000000 + k, [_text("en", F.col("s_name"))], [("P31", F.array(link("P31", 4))), ("P17", F.array(link("P17", 1000 + F.col("s_nationkey")))), ("P625", spot)])


def page_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    return _entity(table(spark, sf_dir, "pages"), 50000000 + k, [], [("P31", F.array(link("P31", 7))), ("P361", F.array(link("P361", 900 + k % 5)))], F.concat(F.lit("Page_"), k.cast("string")))


def place_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, n, c = (table(spark, sf_dir, x) for x in ("region", "nation", "customer"))
    r = _entity(r, 100 + F.col("r_regionkey"), [_text("en", F.col("r_name"))], [("P31", F.array(link("P31", 1)))])
    n = _entity(n, 1000 + F.col("n_nationkey"), [_text("en", F.col("n_name"))], [("P31", F.array(link("P31", 2))), ("P279", F.array(link("P279", 100 + F.col("n_regionkey"))))])
    c = _entity(c, 10000000 + F.col("c_custkey"), [_text("en", F.col("c_name"))], [("P31", F.array(link("P31", 3))), ("P279", F.array(link("P279", 1000 + F.col("c_nationkey"))))])
    return r.unionByName(n).unionByName(c)


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entities; columns as in schemas.ENTITY."""
    return place_entities(spark, sf_dir).unionByName(supplier_entities(spark, sf_dir)).unionByName(part_entities(spark, sf_dir)).unionByName(page_entities(spark, sf_dir))


def order_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order to customer (P50), to each line's part (P51) and supplier (P52), duplicates kept."""
    q = lambda base, c: F.concat(F.lit("Q"), (base + F.col(c)).cast("string"))
    o = table(spark, sf_dir, "orders").select(q(40000000, "o_orderkey").alias("source"), F.lit("P50").alias("prop"), q(10000000, "o_custkey").alias("dest"))
    lines = table(spark, sf_dir, "lineitem").select(q(40000000, "l_orderkey").alias("source"), F.explode(F.array(F.struct(F.lit("P51").alias("prop"), q(30000000, "l_partkey").alias("dest")), F.struct(F.lit("P52").alias("prop"), q(20000000, "l_suppkey").alias("dest")))).alias("x"))
    return o.unionByName(lines.select("source", "x.prop", "x.dest"))


def all_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples(entities(spark, sf_dir)).unionByName(order_triples(spark, sf_dir))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with wikitext: three bracketed links, of which one shares its line."""
    p = table(spark, sf_dir, "pages")
    k = F.col("page_id").cast("string")
    text = F.concat(F.lit("See ["), "url", F.lit(" ref] and ["), "url", F.lit("/x more]\n* ["), F.regexp_replace("url", "/[^/]*$", ""), F.lit("/s"), k, F.lit(" b] [nolink] http://bare "))
    return p.select(F.col("page_id").cast("bigint").alias("id"), F.concat(F.lit("Page_"), k).alias("title"), F.lit(0).alias("ns"), F.lit("wikitext").alias("model"), F.lit(True).alias("model_known"), F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("redirect"))
