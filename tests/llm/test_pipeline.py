"""Each stage of the pipeline on what the stage before it kept, against brute force."""


import os
import random
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from terrace.llm import common, mixing, packing, quality
from test_operators import components_by_force, covered_by_repeats, words

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept.append([tuple(r) for r in docs.collect()])
        if i < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
    assert kept[0] and all(len(words(r[1])) >= 1 for r in kept[0])
    groups = components_by_force(kept[0], 5, 80, 100)
    assert {r[0] for r in kept[1]} == {c for _, _, c in groups}
    gone = covered_by_repeats(kept[1], 35)
    want = {r[0]: [w for i, w in enumerate(words(r[1])) if i not in g] for r, g in zip(kept[1], gone, strict=True)}
    assert {r[0]: words(r[1]) for r in kept[2]} == {k: w for k, w in want.items() if w}
    assert {r[0] for r in kept[3]} <= {r[0] for r in kept[2]}
    assert sum(r[2] for r in kept[4]) >= len(kept[3])


def test_null_and_repeated_ids(spark):
    """Rows without an id, and rows that share one, go through the stages that look for copies and that mix."""
    rng = random.Random(6)
    prose = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    near = lambda w: [*w[:-1], "changed"]
    a, b, c, d, e = (prose(n) for n in (120, 130, 140, 150, 160))
    rows = [(None, a, "x"), (None, near(a), "x"), (None, b, "y"), (1, c, "x"), (None, near(c), "x"), (9, d, "x"), (9, e, "y"), (9, e, "y"), (8, near(d), "y")]
    docs = spark.createDataFrame([(i, " ".join(w), "en", s, 7) for i, w, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect())
    first = [x for x in kept if x[0] is None and x[1] in {" ".join(a), " ".join(near(a))}]
    assert len(first) == 1
    assert kept == Counter([*first, (None, " ".join(b)), (1, " ".join(c)), (9, " ".join(e)), (8, " ".join(near(d)))])
    per_source = lambda rows: {s: sum(len(words(r["text"])) for r in rows if r["source"] == s) for s in ("x", "y")}
    taken = {r["source"]: r["n"] for r in mixing.mix(docs).groupBy("source").sum("taken").withColumnRenamed("sum(taken)", "n").collect()}
    assert per_source(corpus_pipeline.mixture(spark, docs, SF).collect()) == taken
    one = docs.selectExpr("doc_id", "text", "lang", "'x' as source", "n_chars")  # the target of an only source is all of it
    assert Counter(map(tuple, corpus_pipeline.mixture(spark, one, SF).collect())) == Counter(map(tuple, one.collect()))
    none = docs.where("false")
    assert corpus_pipeline.near_duplicates(spark, none, SF).count() == 0 and corpus_pipeline.mixture(spark, none, SF).count() == 0


def test_stages_lose_nothing(spark):
    """Quality's rows and texts, mixing's words per source, and packing's ids, on the stage's own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = Counter((r["doc_id"], r["clean_text"]) for r in quality.judge(docs).collect() if r["kept"])
    assert want == Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.quality(spark, docs, SF).collect())
    target = {r["source"]: r["target"] for r in mixing.mix(docs).collect()}
    rows, mixed = {tuple(r) for r in docs.select(*corpus_pipeline.COLUMNS).collect()}, corpus_pipeline.mixture(spark, docs, SF).collect()
    assert {tuple(r) for r in mixed} <= rows
    for source, n in target.items():  # no further copy of the source's shortest document fits, unless all are taken thrice
        sizes = [x for r in rows if r[3] == source and (x := len(words(r[1])))]
        missing = n - sum(len(words(r["text"])) for r in mixed if r["source"] == source)
        assert -0.5 <= missing and (missing < min(sizes) + 0.5 or missing == n - 3 * sum(sizes)), (source, n, missing, min(sizes))
    model = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    pieces = {}
    for r in corpus_pipeline.packing(spark, docs, SF).collect():
        pieces.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    got = {k: [x for _, ids in sorted(p) for x in ids] for k, p in pieces.items()}
    assert got == {r["doc_id"]: [*model.encode(r["text"] or "", add_special_tokens=False).ids, 2] for r in docs.collect()}


def files_below(path):
    return {os.path.join(d, x) for d, _, names in os.walk(path) for x in names}


def test_stages_leave_neither_texts_nor_shuffle_files(spark):
    """What stays on disk between stages are tables of keys and counts; what a stage has shuffled goes with its query."""
    docs, tables = spark.read.parquet(f"{SF}/documents.parquet"), f"{common.checkpoint_dir(spark)}/tables"
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.substrings, corpus_pipeline.mixture):
        before = files_below(tables)
        stage(spark, docs, SF)
        left = [x for x in files_below(tables) - before if x.endswith(".parquet")]
        assert not [x for x in left if pq.read_schema(x).get_all_field_indices("text") or pa.binary() in pq.read_schema(x).types], left
        assert len({os.path.dirname(x) for x in left}) <= 5
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    spark.sparkContext._jvm.System.gc()
    before = disk.getAllFiles().size()
    kept = common.materialize(docs.repartition(3, "doc_id").select("doc_id"), "kept")
    deadline = time.monotonic() + 20
    while disk.getAllFiles().size() > before and time.monotonic() < deadline:
        time.sleep(0.1)
    assert kept.count() == docs.count() and disk.getAllFiles().size() <= before


def test_equal_rows_and_null_columns(spark):
    """Rows that agree in every column are one if they have words; where a null stands tells rows apart."""
    rows = [(1, "", "x", None, 0), (1, "", None, "x", 0), (1, "", "x", None, 0), (None, None, None, None, None), (None, None, None, None, None)]
    rows += [(5, "some words", "en", "s", 1)] * 3 + [(6, "other words", None, "en", 1), (7, "other words", "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert Counter(map(tuple, corpus_pipeline.near_duplicates(spark, docs, SF).collect())) == Counter([*rows[:6], rows[8]])


def test_mix_by_small_and_large_plans(spark, monkeypatch):
    """The same rows whether the plan is broadcast or joined."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("source", F.expr("if(doc_id % 5 = 0, null, source)")).withColumn("text", F.expr("if(doc_id % 7 = 0, null, if(doc_id % 3 = 0, 'five words in this text', text))"))
    want = {r["doc_id"]: (r["source"], r["taken"]) for r in mixing.mix(docs).collect()}
    monkeypatch.setattr(mixing, "SMALL_PLAN", 0)
    got = mixing.mix(docs).collect()
    assert {r["doc_id"]: (r["source"], r["taken"]) for r in got} == want and len(got) == docs.count()
