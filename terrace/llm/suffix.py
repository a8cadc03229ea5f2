"""Operator 4, suffix-array dedup on sparse suffix arrays of hashes.

Of all suffixes of all texts only those at minimiser positions are retained. A suffix stands as two hashes: of its first words, and of
all words that the minimiser's windows reach on either side. They are sorted by these, over ranges of the whole table, and compared
with their neighbours: equal reach on both sides is a repeat as a whole; equal first words only means that the windows of both
are looked up one by one. It is not the content that is sorted; the README says why.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.common import chunks, columns, materialize, record, table
from terrace.llm.spans import SPAN, classified, covered, keyed, repeated_places, scan_spans

#: Words of a passage that counts as repeated; first words by which suffixes are dealt and sorted.
PASSAGE, FIRST_WORDS = 50, 12


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From sorted suffixes: those whose first words a neighbour shares, the first and the last row (whose neighbours another task has), and settled rows."""
    held: pa.RecordBatch | None = None  # the last row of the batch before
    held_ok = True
    for batch in batches:
        if not batch.num_rows:
            continue
        fp, loc, settled = columns(batch, "fp"), columns(batch, "loc"), np.asarray(batch.column("settled"))
        same = fp[1:] == fp[:-1]
        ok = settled | (loc & 1 == 1)
        ok[1:] |= same
        ok[:-1] |= same
        if held is None:
            ok[0] = True
        else:
            touch = columns(held, "fp")[0] == fp[0]
            ok[0] |= touch
            if held_ok or touch:
                yield held
        held, held_ok = batch.slice(batch.num_rows - 1), bool(ok[-1])
        ok[-1] = False
        if ok.any():
            yield batch.filter(pa.array(ok))
    if held is not None:
        yield held


def _report(passage: int):
    spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_repeated", pa.int64()), ("spans", spans)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in chunks(batch):
                rows = []
                for text, locs in zip(texts, batch.column("locs").slice(first, len(texts)), strict=True):
                    n = 0 if text is None else len(text.split())
                    found = []
                    if locs.is_valid and len(locs):
                        hit = np.concatenate([[0], covered(n, np.asarray(locs.values), passage).astype(np.int8), [0]])
                        turn = np.flatnonzero(np.diff(hit))
                        found = [{"start": int(a), "length": int(b - a)} for a, b in zip(turn[::2], turn[1::2], strict=True)]
                    rows.append((n, sum(x["length"] for x in found), found))
                yield record(schema, batch.column("id").slice(first, len(texts)), *[list(x) for x in zip(*rows, strict=True)])

    return run


def repeated_passages(docs: DataFrame, text: str = "text", passage: int = PASSAGE, first_words: int = FIRST_WORDS) -> DataFrame:
    """doc_id, n_words, n_repeated, spans (start and length in words) for each row of ``docs``.

    A word is repeated if a stretch of ``passage`` words around it also starts anywhere else, in the same text or
    another. Overlapping and touching stretches are one span. Null and empty texts have no words and no spans. Rows that
    share a doc_id are documents of their own, equal rows too; rows with a null doc_id are documents and keep the null.
    Other columns are not read.
    """
    docs = keyed(docs, text)
    suffixes = docs.select("doc_id", "text").mapInArrow(scan_spans(passage, first_words), SPAN)
    # by ranges of both, so that many suffixes with the same first words are cut where what follows differs
    suffixes = suffixes.repartitionByRange(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp", "span").sortWithinPartitions("fp", "span", "doc_id", "loc")
    near = materialize(suffixes.mapInArrow(_neighbours, SPAN), "neighbours")
    hits = materialize(classified(near.where("not settled").drop("settled")), "hits")
    places = near.where("settled").select("doc_id", "loc").union(repeated_places(docs, hits, passage))
    places = places.groupBy("doc_id").agg(F.collect_list("loc").alias("locs"))
    return docs.join(places, "doc_id", "left").mapInArrow(_report(passage), "doc_id long, n_words long, n_repeated long, spans array<struct<start: long, length: long>>")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(table(spark, sf_dir, "documents"))
    listed = F.array_join(F.transform("spans", lambda x: F.concat_ws("+", x["start"], x["length"])), ",")
    return found.select("doc_id", "n_words", "n_repeated", listed.alias("spans"))
