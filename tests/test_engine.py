import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from terrace.functions import entities as fe
from terrace.functions.refs import P, Q, parse_ref
from terrace.functions.texts import links, normalize_title
from terrace.operators import graph, mapreduce, pools, urls
from terrace.plans import catalogue, compile, roundtrips
from terrace.sources import catalog, entities, framed, landing, pages, sinks

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
URLS = ["https://x.org", "https://x.org/one", "https://x.org/one/", "https://x.org/two/p", "https://x.org/two/q", "https://x.org/two/r/s", "https://x.org-z/one", "ftp://y.net/"]


def test_url_vector(spark):
    df = spark.createDataFrame([(u,) for u in [*URLS, URLS[3], "plain", "a/b"]] + [(None,)], "url string")
    got = {tuple(r) for r in urls.prefix_counts(df).collect()}
    assert got == {("https:/", 7, 1), ("https://x.org", 5, 1), ("https://x.org/one", 1, 1), ("https://x.org/two", 3, 2), ("https://x.org/two/r", 1, 1), ("https://x.org-z", 1, 1), ("ftp:/", 1, 0), ("ftp://y.net", 1, 1)}
    assert [tuple(r) for r in urls.aggregate_urls(df).collect()] == [("https://x.org/two", 3, 2)]


def test_links_and_titles(spark):
    df = spark.createDataFrame([("[http://a x] [http://b y]\n[http://c\rz q]\n[http://d] http://e",)], "t string")
    assert df.select(links(F.col("t"))).first()[0] == ["http://a", "http://c\rz"]
    assert [r[0] for r in spark.createDataFrame([("Émile",), ("",), ("ABC",)], "t string").select(normalize_title(F.col("t"))).collect()] == ["émile", "", "aBC"]


def entity(ident, **kw):
    return json.dumps({"id": ident, "type": "item"} | kw)


def claim(prop, kind=None, value=None, snak="value", rank="normal"):
    return {"id": "x", "type": "statement", "rank": rank, "mainsnak": {"property": prop, "snaktype": snak, **({"datavalue": {"type": kind, "value": value}} if kind else {})}}


def test_entities(spark, tmp_path):
    ref = lambda n: {"entity-type": "item", "numeric-id": n}
    rows = [
        entity("Q1", labels={"zh": {"language": "zh", "value": "z"}, "ar": {"language": "ar", "value": "a"}}, claims={"P31": [claim("P31", "wikibase-entityid", ref(5)), claim("P31", "wikibase-entityid", ref(5), rank="deprecated")], "P1258": [claim("P1258", snak="novalue")], "P625": [claim("P625", "globecoordinate", {"latitude": 1.5, "longitude": -2})]}, sitelinks={"enwiki": {"site": "enwiki", "title": "One"}}),
        entity("Q2", labels={"en": {"language": "en", "removed": ""}, "fr": {"language": "fr", "value": "f"}}, claims=[], aliases=[]),
        entity("Q3", labels={"aa": {"language": "aa", "removed": ""}}, claims={"P1": [claim("P1", "quantity", {"amount": "+10", "unit": "1"}), claim("P1", "time", {"time": "+2000-00-00T00:00:00Z", "timezone": -60}), claim("P1", "monolingualtext", {"text": "m", "language": "en"}), claim("P1", "string", "s")]}),
        "broken {",
        json.dumps({"id": "Q9", "type": "thing"}),
    ]
    path = tmp_path / "dump.json"
    path.write_text("[\n" + ",\n".join(rows) + "\n]\n")
    e = entities.read_entities(spark, str(path)).cache()
    assert e.where("corrupt is not null").count() == 2
    good = e.where("corrupt is null")
    assert {r["id"]: r["l"] for r in good.select("id", fe.best_label().alias("l")).collect()} == {"Q1": "a", "Q2": "f", "Q3": "Q3"}
    assert [tuple(x) for x in good.where("id = 'Q1'").select(fe.relations()).first()[0]] == [("P31", "Q5")] * 2
    assert good.where(fe.has_claim("P1258")).count() == 1 and good.where(fe.has_relation(("P31", "Q5"))).count() == 1
    assert [tuple(c)[:2] for c in good.where("id = 'Q1'").select(fe.coordinates()).first()[0]] == [(1.5, -2.0)]
    v = [c["mainsnak"]["datavalue"] for c in good.where("id = 'Q3'").select(fe.claims_of("P1")).first()[0]]
    assert (v[0]["quantity"]["amount"], v[1]["time"]["timezone"], v[2]["monolingualtext"]["value"], v[3]["string"]) == (10.0, -60, "m", "s")
    assert good.where("id = 'Q1'").select(fe.sitelink("enwiki")).first()[0] == "One"
    with pytest.raises(Exception):  # noqa: B017
        entities.read_entities(spark, str(path), "FAILFAST").collect()


def test_pages(spark, tmp_path):
    path = tmp_path / "d.xml"
    path.write_text("<m><page><title>A</title><ns>0</ns><id>1</id><revision><id>9</id><model>wikitext</model><text>old</text></revision><revision><id>10</id><model>wikitext</model><text> new </text></revision></page><page><title>B</title><ns>-2</ns><id>2</id><redirect title='A'/><revision><id>11</id><model>odd</model><text></text></revision></page></m>")
    p = pages.read_pages(spark, str(path)).orderBy("id").collect()
    assert [(r["id"], r["kind"], r["text"], r["redirect"], r["model_known"]) for r in p] == [(1, "text", " new ", None, True), (2, "redirect", "", "A", False)]
    df = pages.read_pages(spark, str(path))
    assert pages.find_page(df, "B").first()[0] == "REDIRECT A" and pages.find_page(df, "C").isEmpty()
    with pytest.raises(Exception):  # noqa: B017
        pages.read_pages(spark, str(path), strict=True).collect()


def test_refs_and_filters(spark):
    df = spark.createDataFrame([("Q42",), ("P31",), ("X1",), (None,)], "r string").select(parse_ref(F.col("r")).alias("x"))
    assert [tuple(r["x"]) if r["x"] else None for r in df.collect()] == [("Q", 42), ("P", 31), None, None]
    assert (P(1), Q(2)) == ("P1", "Q2")
    assert pools.parse_filters(["a:P31Q1,P106Q2"]) == [("a", "P31", "Q1"), ("a", "P106", "Q2")]
    with pytest.raises(ValueError):
        pools.parse_filters(["a:Q1P2"])


def test_closure_with_cycles(spark):
    rng = random.Random(3)
    e = {(f"n{rng.randrange(12)}", f"n{rng.randrange(12)}") for _ in range(18)} | {("c1", "c2"), ("c2", "c1")}
    got = {tuple(r) for r in graph.descendants(spark.createDataFrame(sorted(e), "child string, parent string"), spark.createDataFrame([("n0",), ("c1",)], "root string")).collect()}
    want = set()
    for root in ("n0", "c1"):
        seen, todo = {root}, [root]
        while todo:
            at = todo.pop()
            for c, p in e:
                if p == at and c not in seen:
                    seen.add(c)
                    todo.append(c)
        want |= {(root, x) for x in seen - {root}}
    assert got == want


def test_forest(spark):
    e = spark.createDataFrame([("b", "a"), ("c", "a"), ("d", "b"), ("d", "c")], "child string, parent string")
    lines = list(graph.forest(e, spark.createDataFrame([("a", "top")], "id string, label string")))
    assert sum("anchor=" in x for x in lines) == 4 and sum("href=" in x for x in lines) == 1 and "<b>a</b> top" in lines[1]


def test_map_reduce(spark):
    df = spark.createDataFrame([("a b",), ("b",), ("",)], "t string")
    assert dict(mapreduce.map_reduce(df, lambda r: [(w, 1) for w in r["t"].split()], lambda a, b: a + b, "k string, n long").collect()) == {"a": 1, "b": 2}


def test_catalog_and_sinks(spark, tmp_path):
    c = catalog.Catalog(spark, str(tmp_path))
    df = spark.createDataFrame([("Q1", "it's, a\nlabel")], "id string, label string")
    c.write(df, "labels", "entities", "20240101")
    c.write(df, "labels", "entities", "20240301")
    (tmp_path / "labels" / "entities" / "20250101").mkdir()
    assert c.latest("labels", "entities") == "20240301" and c.latest("pages", "x") is None
    assert c.labels().count() == 1
    sinks.write_tsv(df.select("id"), str(tmp_path / "tsv"))
    assert spark.read.text(str(tmp_path / "tsv")).first()[0] == "Q1"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.gz").write_bytes(b"x")
    assert landing.import_snapshot(str(tmp_path / "in"), str(tmp_path), "w", "20240101") == ["a.gz"]
    assert landing.import_snapshot(str(tmp_path / "in"), str(tmp_path), "w", "20240101") == []


def test_framed(spark, tmp_path):
    import pyarrow as pa

    packed = pa.Codec("snappy").compress(b"hello " * 9).to_pybytes()
    frame = lambda kind, body, raw: bytes([kind]) + (len(body) + 4).to_bytes(3, "little") + framed.checksums([raw])[0].to_bytes(4, "little") + body
    whole = framed.MAGIC + frame(0, packed, b"hello " * 9) + frame(1, b"raw", b"raw")
    (tmp_path / "x.sz").write_bytes(whole)
    assert framed.checksums([b"123456789"])[0] == ((0xE3069283 >> 15 | 0xE3069283 << 17) + 0xA282EAD8) & 0xFFFFFFFF  # the published check value
    for bad in (whole + b"\x00\xff", whole[:-1], whole[:-1] + b"W"):
        with pytest.raises(ValueError):
            list(framed.frames(bad))
    big = random.Random(1).randbytes(200_000) + b"line\n" * 20_000
    assert b"".join(framed.frames(framed.framed(big))) == big
    assert bytes(framed.read_framed(spark, str(tmp_path / "x.sz")).first()["content"]) == b"hello " * 9 + b"raw"


def test_compile(spark, tmp_path):
    """What has landed is compiled once, with what can't be read apart; stored triples are those of the date asked for."""
    c = catalog.Catalog(spark, str(tmp_path))
    for day in ("20240101", "20240201"):
        (tmp_path / "in" / day).mkdir(parents=True)
        ref = {"entity-type": "item", "numeric-id": int(day)}
        (tmp_path / "in" / day / "e.json").write_text("[\n" + entity("Q1", claims={"P1": [claim("P1", "wikibase-entityid", ref)]}) + ",\nbroken\n]\n")
        landing.import_snapshot(str(tmp_path / "in" / day), str(tmp_path), "entities", day)
    (tmp_path / "wiki").mkdir()
    (tmp_path / "wiki" / "p.xml").write_text("<m><page><title>A</title><ns>0</ns><id>1</id><revision><id>9</id><model>wikitext</model><text>t</text></revision></page></m>")
    landing.import_snapshot(str(tmp_path / "wiki"), str(tmp_path), "w", "20240301")
    assert compile.compile_all(c) == [("entities", "20240201"), ("w", "20240301")] and compile.compile_all(c) == []
    compile.compile_entities(c, "entities", "20240101")
    assert [tuple(r) for r in c.triples("20240101").collect()] == [("Q1", "P1", "Q20240101")] and c.triples().first()["dest"] == "Q20240201"
    assert c.entities().count() == 1 and spark.read.parquet(c.path("quarantine", "entities", "20240201")).count() == 1
    assert c.pages("w").first()["title"] == "A"
    with pytest.raises(FileNotFoundError):
        compile.compile_pages(c, "w", "20200101")


def test_closure_is_whole(spark):
    e = spark.createDataFrame([(f"n{i + 1}", f"n{i}") for i in range(5)], "child string, parent string")
    with pytest.raises(ValueError):
        graph.descendants(e, spark.createDataFrame([("n0",)], "root string"), most_rounds=3)


@pytest.mark.parametrize("name", sorted({**catalogue.queries(), **roundtrips.queries()}))
def test_catalogue(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = {**catalogue.queries(), **roundtrips.queries()}[name](spark, SF)
    cols = sorted(df.columns)
    cur = con.execute({**catalogue.oracle_sql(), **roundtrips.oracle_sql()}[name])
    names = [d[0] for d in cur.description]
    want = sorted(str([row[names.index(c)] for c in cols]) for row in cur.fetchall())
    got = sorted(str([r[c] for c in cols]) for r in df.collect())
    assert got == want and got
