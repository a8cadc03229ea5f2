"""Operator 10, substring dedup with a log-structured fingerprint index.

The index is a list of immutable runs in the checkpoint folder. A run has the fingerprints of one batch of documents, one row each
with how often it occurs, bucketed and sorted, so that runs are merge-joined bucket by bucket without a shuffle. Beside it lie the spans
(see spans.py) that the fingerprints stand for, as they came. Appending a batch writes both, merge-joins its fingerprints with each older run and
returns those that occur twice; where the index has too many runs, they are merged into one and the old files go. Spans of
repeated fingerprints are verified by hashes of all their words, and where a whole span doesn't repeat, window by window against the text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.common import checkpoint_dir, chunks, join_counted, materialize, record, remove, table
from terrace.llm.spans import SPAN, classified, covered, keyed, repeated_places, scan_spans

WINDOW, GRAM = 35, 12
#: Runs that an index has before they are merged into one.
FAN_IN = 1
BATCHES = 2


class FingerprintIndex:
    """Runs of fingerprints: ``append`` a batch of documents, then ask for ``repeated`` windows; ``compact`` merges runs, ``drop`` removes all files."""

    def __init__(self, spark: SparkSession, window: int = WINDOW, gram: int = GRAM, fan_in: int = FAN_IN, buckets: int | None = None):
        self.spark, self.window, self.gram, self.fan_in = spark, window, gram, fan_in
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"terrace_{uuid.uuid4().hex}"
        self.root = f"{checkpoint_dir(spark)}/runs/{self.name}"
        self.runs: list[str] = []
        self.spans: list[DataFrame] = []
        self.answers: list[DataFrame] = []  # tables that results read
        self.made = 0

    def _write(self, counted: DataFrame) -> str:
        """A run of (fp, n): the sum for each fingerprint."""
        name = f"{self.name}_{self.made}"
        self.made += 1
        rows = counted.groupBy("fp").agg(F.sum("n").alias("n")).repartition(self.buckets, "fp")
        rows.write.bucketBy(self.buckets, "fp").sortBy("fp").option("path", f"{self.root}/{name}").format("parquet").saveAsTable(name)
        return name

    def _remove(self, runs: list[str]) -> None:
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {run}")
            remove(self.spark, f"{self.root}/{run}")

    def append(self, docs: DataFrame) -> DataFrame:
        """Add a batch (doc_id, text); returns the fingerprints (fp) of the batch that it or an older run has too."""
        spans = materialize(docs.select("doc_id", "text").mapInArrow(scan_spans(self.window, self.gram), SPAN), "spans")
        run = self._write(spans.where("not settled").select("fp", F.expr("1 + (loc & 1)").alias("n")))
        own = self.spark.table(run)
        found = own.where("n > 1").select("fp")
        for old in self.runs:
            found = found.union(own.select("fp").join(self.spark.table(old).select("fp").hint("merge"), "fp"))
        found = materialize(found, "repeats")
        self.answers.append(found)
        self.runs.append(run)
        self.spans.append(spans)
        if len(self.runs) > self.fan_in:
            self.compact()
        return found.distinct()

    def compact(self) -> None:
        """Merge all runs into one and remove the old ones."""
        if len(self.runs) < 2:
            return
        old = self.runs
        self.runs = [self._write(self.spark.read.schema("fp long, n long").parquet(*[f"{self.root}/{run}" for run in old]))]  # as files: Spark takes a union of bucketed tables to be clustered as a whole, which it isn't
        self._remove(old)

    def drop(self) -> None:
        """Remove all that the index has written, what its answers read too."""
        self._remove(self.runs)
        remove(self.spark, self.root, *self.spans, *self.answers)
        self.runs, self.spans, self.answers = [], [], []

    @staticmethod
    def _union(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for x in frames[1:]:
            out = out.union(x)
        return out

    def repeated(self, docs: DataFrame) -> DataFrame:
        """(doc_id, loc) of every window of all batches that occurs twice or more. ``docs`` (doc_id, id, text) has the texts of all batches."""
        if not self.runs:
            return self.spark.createDataFrame([], "doc_id long, loc long")
        self.compact()
        spans = self._union(self.spans)
        repeats = self.spark.table(self.runs[0]).where("n > 1").select("fp", F.col("n").alias("held"))
        hits = join_counted(spans.where("not settled").drop("settled"), repeats, ["fp"], spans.count())
        hits = materialize(classified(hits), "hits")
        places = repeated_places(docs, hits, self.window)
        self.answers.append(places)
        return spans.where("settled").select("doc_id", "loc").union(places)


_WORD = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+")


def _cut(window: int, with_text: bool, keep: list[str]):
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    fields = [*fields, ("text", pa.string())] if with_text else fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in chunks(batch):
                rows = []
                for text, locs in zip(texts, batch.column("locs").slice(first, len(texts)), strict=True):
                    raw = text or b""
                    words = raw.split()
                    gone = covered(len(words), np.asarray(locs.values), window) if locs.is_valid and len(locs) else None
                    kept = words if gone is None else [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                    rows.append((len(words), len(words) - len(kept), sha256(b" ".join(kept)).hexdigest()))
                    if with_text:
                        rows[-1] += ((None if text is None else raw.decode("utf-8", "replace")) if len(kept) == len(words) else b"".join(x for x, g in zip(_WORD.findall(raw), gone.tolist(), strict=True) if not g).lstrip().decode("utf-8", "replace"),)
                schema = pa.schema([*fields, *[(c, batch.schema.field(c).type) for c in keep]])
                yield record(schema, batch.column("id").slice(first, len(texts)), *[list(x) for x in zip(*rows, strict=True)], *[batch.column(c).slice(first, len(texts)) for c in keep])

    return run


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, gram: int = GRAM, batches: int = BATCHES, fan_in: int = FAN_IN, with_text: bool = False, keep: list[str] | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and ``text`` without the removed words) for each row of ``docs``.

    Every occurrence of a window of ``window`` words that occurs twice or more is removed, the first included. Null and
    empty texts have 0 words and the digest of nothing. Rows that share a doc_id are documents of their own, equal rows too; rows
    with a null doc_id are documents and keep the null. Columns named in ``keep`` are returned as they are; others are not read.
    The documents enter the index in ``batches`` batches, by a hash of the row; it is removed when the windows are known.
    """
    keep = keep or []
    docs = keyed(docs, text, keep)
    index = FingerprintIndex(docs.sparkSession, window, gram, fan_in)
    for i in range(batches):
        index.append(docs.where(F.pmod("doc_id", F.lit(batches)) == i) if batches > 1 else docs)
    places = materialize(index.repeated(docs), "places")
    index.drop()
    places = places.groupBy("doc_id").agg(F.collect_list("loc").alias("locs"))
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", text string" if with_text else "")
    rest = [f"{c} {t}" for c, t in docs.select(*keep).dtypes]
    return docs.join(places, "doc_id", "left").mapInArrow(_cut(window, with_text, keep), ", ".join([out, *rest]))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
