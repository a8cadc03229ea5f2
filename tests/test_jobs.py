"""Sources, sinks, compile jobs and operators that work by ranges, parts and batches, against brute force."""

import json
import os
import random
from collections import Counter, defaultdict
from datetime import UTC, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from terrace.functions.refs import format_ref, parse_ref
from terrace.functions.texts import lineage
from terrace.operators import graph, mapreduce, urls
from terrace.sources import catalog, entities, framed, landing, parts
from terrace.streaming import compile


def lines_of(rng, n):
    return ["".join(rng.choice("abcdefgh ij\x00\x01é") for _ in range(rng.choice([0, 1, 30, 200, 3000]))) for _ in range(n)]


@pytest.mark.parametrize("range_bytes", [150_000, 700_000, 10**9])
def test_framed_ranges(spark, tmp_path, range_bytes):
    lines = [*lines_of(random.Random(1), 1500), "z" * 400_000, "", "last without an end"]
    data = "\n".join(lines).encode()
    (tmp_path / "x.sz").write_bytes(framed.framed(data))
    df = framed.read_framed_lines(spark, str(tmp_path / "x.sz"), range_bytes)
    assert df.rdd.getNumPartitions() == -(-os.path.getsize(tmp_path / "x.sz") // range_bytes)
    assert sorted(r["value"] for r in df.collect()) == sorted(lines)
    raw = sorted((r["at"], bytes(r["content"])) for r in framed.read_framed(spark, str(tmp_path / "x.sz"), range_bytes).collect())
    assert b"".join(x for _, x in raw) == data


def test_every_range_of_a_small_file(tmp_path):
    """Cuts at every byte near frames: each line comes once, from one of two ranges."""
    lines = [b"", b"a", b"bc" * 40_000, b"", b"d" * 70_000, b"e"]
    for end in (b"", b"\n"):
        data = framed.framed(b"\n".join(lines) + end)
        (tmp_path / "x.sz").write_bytes(data)
        heads = [at for at, *_ in framed._stored(_Whole(data), len(data), 0)]
        cuts = {c for h in heads for c in (h - 1, h, h + 1, h + 4)} | {1, 5, len(data) - 1}
        for cut in cuts:
            if 0 < cut < len(data):
                with framed.opened(str(tmp_path / "x.sz")) as f:
                    got = [*framed.range_lines(f, len(data), 0, cut), *framed.range_lines(f, len(data), cut, len(data))]
                assert got == lines, cut


class _Whole:
    def __init__(self, data):
        self.data, self.at = data, 0

    def seek(self, at):
        self.at = at

    def read(self, n):
        out = self.data[self.at : self.at + n]
        self.at += n
        return out


def test_frames_inside_frames_are_an_error_not_rows(tmp_path):
    """Framed data stored as it is in framed data: a range that begins inside it would take the inner frame for one of its own."""
    inner = framed.framed(b"inner\n" * 100)[len(framed.MAGIC) :]
    body = framed.checksums([inner])[0].to_bytes(4, "little") + inner
    whole = framed.MAGIC + b"\x01" + len(body).to_bytes(3, "little") + body + framed.framed(b"outer\n")[len(framed.MAGIC) :]
    (tmp_path / "x.sz").write_bytes(whole)
    with framed.opened(str(tmp_path / "x.sz")) as f, pytest.raises(ValueError):
        list(framed.range_lines(f, len(whole), 0, len(framed.MAGIC) + 6))
    with framed.opened(str(tmp_path / "x.sz")) as f:
        assert b"".join(x for _, _, x in framed.range_frames(f, len(whole), 0, len(whole))) == inner + b"outer\n"


def test_parts_are_cut_and_committed(spark, tmp_path):
    lines = lines_of(random.Random(2), 3000)
    df = spark.createDataFrame([(x,) for x in lines], "value string").repartition(3)
    for kind, read in (("framed", lambda p: framed.read_framed_lines(spark, p).select("value")), ("parquet", spark.read.parquet)):
        path = str(tmp_path / kind)
        for _ in range(2):  # the second replaces the first
            parts.write_parts(df, path, kind, 300_000)
            assert sorted(r["value"] for r in read(path).collect()) == sorted(lines)
        names = os.listdir(path)
        assert len([x for x in names if x.startswith("part-")]) > 3 and "_SUCCESS" in names and not any("temporary" in x for x in names)
    nested = df.select(F.create_map(F.lit("k"), F.struct("value")).alias("m"), F.array("value").alias("a"), F.lit(None).cast("int").alias("n"))
    parts.write_parts(nested, str(tmp_path / "nested"))
    assert spark.read.parquet(str(tmp_path / "nested")).schema.simpleString() == nested.schema.simpleString()
    parts.write_parts(df.limit(0), str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "none")).columns == ["value"] and spark.read.parquet(str(tmp_path / "none")).isEmpty()


def test_a_failed_task_leaves_no_part(spark, tmp_path):
    def fails(batches):
        yield from batches
        raise RuntimeError("lost")

    path = tmp_path / "p"
    good = spark.range(3).select(F.col("id").cast("string").alias("value"))
    parts.write_parts(good, str(path))
    before = sorted(os.listdir(path))
    with pytest.raises(Exception):  # noqa: B017
        parts.write_parts(spark.range(5000).select(F.col("id").cast("string").alias("value")).mapInArrow(fails, "value string"), str(path), most=1000)
    assert sorted(os.listdir(path)) == before and spark.read.parquet(str(path)).count() == 3


def entity(i):
    ref = {"entity-type": "item", "numeric-id": i % 3}
    return json.dumps({"id": f"Q{i}", "type": "item", "labels": {"en": {"language": "en", "value": f"l{i}"}}, "claims": {"P1": [{"id": "x", "type": "statement", "rank": "normal", "mainsnak": {"property": "P1", "snaktype": "value", "datavalue": {"type": "wikibase-entityid", "value": ref}}}]}})


def landed(root, day="20240101", files=5, lines=20):
    folder = Path(root, "download", "entities", day)
    folder.mkdir(parents=True)
    for f in range(files):
        text = "[\n" + ",\n".join([entity(f * lines + i) for i in range(lines)] + ["broken"]) + "\n]\n"
        if f == 0:
            (folder / f"e{f}.sz").write_bytes(framed.framed(text.encode()))
        else:
            (folder / f"e{f}.json").write_text(text)
    (folder / "ok").touch()


def stored(c, day="20240101"):
    table = lambda df: sorted(str(tuple(r)) for r in df.collect())
    numbers = c.progress(day).select("batch", "files", "lines", "entities", "corrupt", "relations")
    return [table(x) for x in (c.entities(day), c.labels(day), c.triples(day), c.spark.read.parquet(c.path("quarantine", "entities", day)).select("corrupt"), numbers)]


def test_a_killed_compile_goes_on(spark, tmp_path, monkeypatch):
    for name in ("whole", "killed"):
        landed(tmp_path / name)
    whole, killed = (catalog.Catalog(spark, str(tmp_path / x)) for x in ("whole", "killed"))
    compile.compile_entities(whole, "entities", "20240101", files_per_batch=2)
    total = whole.progress("20240101").agg(*[F.sum(x) for x in ("files", "lines", "entities", "corrupt", "relations")]).first()
    assert tuple(total) == (5, 105, 100, 5, 100) and whole.progress("20240101").count() == 3
    assert whole.entities("20240101").count() == 100 and whole.triples("20240101").count() == 100

    real, calls = compile.triples, []

    def dies(entities):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("killed in the second batch, after its entities were written")
        return real(entities)

    monkeypatch.setattr(compile, "triples", dies)
    with pytest.raises(Exception):  # noqa: B017
        compile.compile_entities(killed, "entities", "20240101", files_per_batch=2)
    assert killed.dates("entities", "entities") == [] and killed.progress("20240101").count() == 1  # nothing to be seen but how far it got
    monkeypatch.setattr(compile, "triples", real)
    compile.compile_entities(killed, "entities", "20240101", files_per_batch=2)
    got, want = stored(killed), stored(whole)
    assert got[:4] == want[:4] and [x.split(",")[1:2] for x in got[4]] == [x.split(",")[1:2] for x in want[4]]
    assert sum(int(r["lines"]) for r in killed.progress("20240101").collect()) == 105
    compile.compile_entities(killed, "entities", "20240101")  # anew, in one batch
    assert stored(killed)[:4] == want[:4] and killed.progress("20240101").count() == 1


def test_compile_reads_the_dump_once(spark, tmp_path, monkeypatch):
    landed(tmp_path, files=3)
    seen, real = [], compile.entity_lines
    monkeypatch.setattr(compile, "entity_lines", lambda s, files, n=None: seen.append(files) or real(s, files, n))
    compile.compile_entities(catalog.Catalog(spark, str(tmp_path)), "entities", "20240101", files_per_batch=2)
    assert sorted(x.rpartition("/")[2] for files in seen for x in files) == ["e0.sz", "e1.json", "e2.json"]


def prefixes_by_hand(rows):
    total, direct = Counter(), Counter()
    for by, url in {r for r in rows if r[1] is not None}:
        p = url.split("/")
        for k in range(2, len(p)):
            total[by, "/".join(p[:k])] += 1
            direct[by, "/".join(p[:k])] += k == len(p) - 1
    return {(*k, n, direct[k]) for k, n in total.items()}


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_prefixes_by_stack(spark, partitions):
    rng, segments = random.Random(4), ["", "a", "b", "a.b", "a-b", "é", "a b", "~"]
    rows = [(rng.choice(["p", "q", None]), rng.choice(["http:", "x", ""]) + "/" + "/".join(rng.choice(segments) for _ in range(rng.randrange(6)))) for _ in range(600)]
    rows += [("p", None), ("p", ""), ("p", "none"), ("p", "/"), ("p", "//"), ("p", "///")] + [("q", "http://hot/a")] * 300
    df = spark.createDataFrame(rows, "pool string, url string")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert {tuple(r) for r in urls.prefix_counts(df, by=("pool",)).collect()} == prefixes_by_hand(rows)
        one = [("x", u) for _, u in rows]
        assert {tuple(r) for r in urls.prefix_counts(df.select("url")).collect()} == {x[1:] for x in prefixes_by_hand(one)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    up = df.select("pool", "url", F.explode(lineage(F.col("url"))).alias("a")).distinct().groupBy("pool", "a.prefix").agg(F.count("*").alias("n"), F.count_if("a.direct").alias("d"))
    assert {tuple(r) for r in up.collect()} == prefixes_by_hand(rows)


def walked(edges, labels):
    """The tree by a plain walk."""
    kids, lines, done = defaultdict(set), [], set()
    for child, parent in edges:
        kids[parent].add(child)

    def show(node, depth):
        pad, title = "    " * depth, f"<b>{node}</b> {labels.get(node, 'no label')}"
        lines.append(f"{pad}<li>")
        if node in done:
            lines.append(f"{pad}  <a href='#{node}'>{title}</a>")
        else:
            done.add(node)
            lines.append(f"{pad}  <a anchor='{node}'/>{title}")
            for kid in sorted(kids[node]):
                lines.append(f"{pad}  <ul>")
                show(kid, depth + 1)
                lines.append(f"{pad}  </ul>")
        lines.append(f"{pad}</li>")

    children = {c for c, _ in edges}
    for root in sorted({p for _, p in edges} - children):
        show(root, 0)
    return lines


@pytest.mark.parametrize("seed", range(3))
def test_forest_against_a_walk(spark, tmp_path, seed):
    rng = random.Random(seed)
    n = 14
    edges = {(f"Q{rng.randrange(n)}", f"Q{rng.randrange(n)}") for _ in range(22)} | {("Q1", "top"), ("Q12", "top"), ("Q3", "top2"), ("Q1", "Q1"), ("lost", "lost2"), ("lost2", "lost")}
    labels = {f"Q{i}": f"label {i}" for i in range(0, n, 2)}
    e = spark.createDataFrame(sorted(edges), "child string, parent string")
    names = spark.createDataFrame(sorted(labels.items()), "id string, label string")
    assert list(graph.forest(e, names)) == walked(edges, labels)
    graph.write_forest(e, names, str(tmp_path / "tree"))
    written = "".join((tmp_path / "tree" / x).read_text() for x in sorted(os.listdir(tmp_path / "tree")) if x.startswith("part-"))
    assert written.splitlines() == walked(edges, labels)


def test_map_reduce_by_batches(spark, monkeypatch):
    monkeypatch.setattr(mapreduce, "KEYS", 3)
    rng = random.Random(6)
    rows = [(" ".join(rng.choice(["a", "b", "hot", "hot", "hot", "c", "d", "e"]) for _ in range(rng.randrange(9))), i) for i in range(500)] + [(None, 1)]
    df = spark.createDataFrame(rows, "t string, i int").repartition(5)
    want = defaultdict(lambda: -1)
    for t, i in rows:
        for w in (t or "").split():
            want[w] = max(want[w], i)
    got = mapreduce.map_reduce(df, lambda r: [(w, r["i"]) for w in (r["t"] or "").split()], max, "k string, most int").collect()
    assert len(got) == len(want) and {r["k"]: r["most"] for r in got} == dict(want)
    assert mapreduce.map_reduce(df, lambda r: [], max, "k string, most int").isEmpty()


def test_par_foreach(spark, tmp_path):
    folder = str(tmp_path)

    def touch(row):
        Path(folder, str(row["id"])).touch()

    mapreduce.par_foreach(spark.range(5), touch)
    assert sorted(os.listdir(folder)) == ["0", "1", "2", "3", "4"]


def test_dates_and_listings():
    assert landing.yesterday(datetime(2024, 3, 1, 5, tzinfo=UTC)) == "20240229"
    listing = '<a href="../">..</a><a href="20240101/">x</a><a href="20240220/">x</a><a href="latest/">x</a>'
    assert landing.last_listed(listing) == "20240220" and landing.last_listed("") is None


def test_references_there_and_back(spark):
    df = spark.createDataFrame([("Q42",), ("P31",), ("Q4294967295",), ("q1",), ("Q",), (None,)], "r string").select("r", parse_ref(F.col("r")).alias("x"))
    got = df.select("r", format_ref(F.col("x.kind"), F.col("x.num")).alias("back")).collect()
    assert [r["back"] for r in got] == ["Q42", "P31", "Q4294967295", None, None, None]


def test_which_files_make_up_a_dump():
    listing = '<a href="/w/20240101/w-20240101-pages-articles1.xml-p1p9.bz2">1</a> <a href="/w/20240101/w-20240101-pages-articles2.xml-p10.bz2">2</a><a href="/w/20240101/w-20240101-pages-articles.xml.bz2">all</a><a href="/w/20240101/w-20240101-stub.xml.gz">s</a>'
    assert landing.wiki_files(landing.linked(listing), "w", "20240101") == ["w-20240101-pages-articles1.xml-p1p9.bz2", "w-20240101-pages-articles2.xml-p10.bz2"]
    assert landing.wiki_files([], "w", "20240101") == ["w-20240101-pages-articles.xml.bz2"]
    assert landing.latest_entities('<a href="20231231.json.gz"><a href="20240108.json.gz">\n<a href="20240108.json.bz2">') == "20240108" and landing.latest_entities("") is None
    assert landing.latest_in_feed("<rss>\n<link>http://mirror/w</link>\n<link>http://mirror/w/20240220</link><link>http://mirror/w/20240101</link>") == "20240101"
    assert landing.latest_in_feed("<link>http://mirror/w/20240220</link>\n<link>http://mirror/w/20240101</link>") == "20240220" and landing.latest_in_feed("") is None
    names = ["pagecounts-20240229-000000.gz", "pagecounts-20240229-010000.gz", "pagecounts-20240301-000000.gz", "projectcounts-20240229-000000", "pagecounts-20240229-000000.gz"]
    assert landing.pagecounts_folder("20240229") == "2024/2024-02" and landing.pagecounts_files(names, "20240229") == names[:2]


def test_taking_over_is_done_once(spark, tmp_path):
    mirror, root = tmp_path / "mirror", tmp_path / "root"
    mirror.mkdir()
    for name, size in (("a.gz", 10), ("b.gz", 3000), ("c.txt", 5)):
        (mirror / name).write_bytes(name.encode() * size)
    assert landing.import_snapshot(str(mirror), str(root), "w", "20240101", "*.gz", spark) == ["b.gz", "a.gz"]
    assert landing.import_snapshot(str(mirror), str(root), "w", "20240101", "*.gz", spark) == []
    target = root / "download" / "w" / "20240101"
    (target / "b.gz").write_bytes(b"cut off")
    assert landing.import_snapshot(str(mirror), str(root), "w", "20240101", "*.gz", spark) == ["b.gz"]
    assert {x: (target / x).read_bytes() for x in ("a.gz", "b.gz")} == {x: (mirror / x).read_bytes() for x in ("a.gz", "b.gz")}
    assert sorted(os.listdir(target)) == ["a.gz", "b.gz", "ok"]
    with pytest.raises(FileNotFoundError):
        landing.import_snapshot(str(mirror), str(root), "w", "20240102", names=["d.gz"], spark=spark)
    assert catalog.Catalog(spark, str(root)).latest("download", "w") == "20240101"


def test_only_wanted_properties_are_read(spark, tmp_path):
    from terrace.operators.triples import wanted
    from terrace.sources.sinks import write_by_property

    t = spark.createDataFrame([(f"Q{i}", f"P{i % 40}", f"Q{i % 7}") for i in range(2000)], "source string, prop string, dest string")
    write_by_property(t, str(tmp_path / "t"))
    filters = spark.createDataFrame([("a", "P3", "Q1"), ("b", "P3", "Q1"), ("c", "P999", "Q1")] + [("many", f"P{i % 2}", f"Q{i}") for i in range(10_000)], "ident string, prop string, dest string")
    filters.write.parquet(str(tmp_path / "f"))
    found = wanted(spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "f")))
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    rows = [(f"Q{i}", i % 40, i % 7) for i in range(2000)]
    want = {(x, s) for s, p, d in rows for x in ("a", "b") if (p, d) == (3, 1)} | {("many", s) for s, p, d in rows if p < 2 and any(k % 2 == p for k in range(d, 10_000, 10_000))}
    assert {tuple(r) for r in found.collect() if r["ident"] != "many"} == {x for x in want if x[0] != "many"}
    assert {r["source"] for r in found.where("ident = 'many'").collect()} == {s for s, p, d in rows if p < 2 and p == d % 2}


def test_places_in_an_order(spark):
    from terrace.operators.order import numbered

    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("x")).repartition(6)
    got = {r["at"]: r["x"] for r in numbered(df, "x").collect()}
    assert [got[i + 1] for i in range(1000)] == sorted(i * 7919 % 1009 for i in range(1000))
    assert numbered(df.limit(0), "x").collect() == []


def test_a_strict_compile_shows_nothing(spark, tmp_path):
    landed(tmp_path, files=2)
    c = catalog.Catalog(spark, str(tmp_path))
    with pytest.raises(Exception):  # noqa: B017
        compile.compile_entities(c, "entities", "20240101", mode="FAILFAST")
    assert [c.dates(x, "entities") for x in compile.TABLES] == [[]] * 5
    compile.compile_entities(c, "entities", "20240101")
    assert [c.dates(x, "entities") for x in compile.TABLES] == [["20240101"]] * 5 and c.labels().count() == 40


def test_pages_of_several_files_in_parts(spark, tmp_path):
    from terrace.plans.compile import compile_pages

    folder = tmp_path / "download" / "w" / "20240101"
    folder.mkdir(parents=True)
    for f in range(3):
        pages = "".join(f"<page><title>T{f * 50 + i}</title><ns>0</ns><id>{f * 50 + i}</id><revision><id>1</id><model>wikitext</model><text>{'x' * 2000}{i}</text></revision></page>" for i in range(50))
        (folder / f"p,{f}.xml").write_text(f"<m>{pages}</m>")
    (folder / "ok").touch()
    c = catalog.Catalog(spark, str(tmp_path))
    compile_pages(c, "w", "20240101", part_bytes=1)
    assert sorted(r["id"] for r in c.pages("w").collect()) == list(range(150)) and c.latest("pages", "w") == "20240101"
    assert len([x for x in os.listdir(tmp_path / "pages" / "w" / "20240101") if x.startswith("part-")]) > 3


def test_small_framed_files_are_spread(spark, tmp_path):
    """Two small .sz files are read by as many tasks as there are, up to a least range, with the same lines; what parses them is made once a session."""
    rng = random.Random(8)
    lines = [f"{i} {rng.randbytes(300).hex()}" for i in range(3000)]
    framed.write_framed(spark.createDataFrame([(x,) for x in lines], "value string").repartition(2), str(tmp_path / "sz"))
    files = sorted(str(x) for x in (tmp_path / "sz").glob("*.sz"))
    got = compile.entity_lines(spark, files, 8)
    assert len(files) == 2 and got.rdd.getNumPartitions() >= 8 and sorted(r["value"] for r in got.collect()) == sorted(lines)
    assert entities._parsed(spark, "PERMISSIVE") is entities._parsed(spark, "PERMISSIVE")
