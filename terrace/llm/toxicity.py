"""Operator 1, toxicity by compression distance.

Two zstandard dictionaries are made from windows of labelled texts: one of ordinary texts, as they are and then what zstandard's
trainer puts together from them; the other holds the same and goes on with what is trained on toxic texts, so that what both kinds of text share compresses alike under both. Of the toxic texts' windows
those train it that have a word which toxic texts hold significantly more often: few windows of a toxic text are toxic.
A window (four words in a row, one begins at every second word) is compressed under both; how much shorter it gets under the toxic
dictionary, given its length, has a log likelihood ratio counted on other labelled documents. The ratios of windows that share
words are summed. A document's evidence is its largest sums, of different places, and the logarithm of its length, as long texts
have larger ones by chance; a logistic curve fitted on those other documents turns it into a score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.common import chunks, materialize, record, table

#: Labelled documents that a model is fitted on, at most: two thirds for the dictionaries, a third to calibrate.
MOST_LABELLED = 12_000
#: Windows that train each dictionary, at most (those with the least hashes), and the bytes of each.
MOST_WINDOWS, ORDINARY_BYTES, TOXIC_BYTES = 30_000, 400_000, 3000
#: A word marks a window if its G-squared is this much and twice the logarithm of the number of words tried: chance alone would let less than one through.
MARGIN = 4.0
WINDOW, STRIDE = 4, 2
#: How zstandard searches for matches: of five bytes or more, a few places a string. The tables are as large as the dictionaries need.
SEARCH = {"window_log": 18, "hash_log": 18, "chain_log": 18, "search_log": 4, "min_match": 5, "strategy": zstandard.STRATEGY_LAZY}
#: Length of the segments that zstandard's trainer puts together, and of the strings that it counts.
SEGMENT, STRING = 32, 6
THRESHOLD = 0.7
#: zstandard doesn't look for matches in the last bytes of its input or dictionary; these fill them. A window is compressed with as many bytes of what follows.
TAIL, FILL = bytes(range(1, 13)), b"~" * 16
#: Lengths count in steps of eight bytes; lengths and savings are cut to these ranges.
STEP, LONGEST, SPREAD = 8, 10, (-8, 24)
#: Places of a document whose sums count.
PLACES = 3
#: Windows that are compressed at a time.
AT_A_TIME = 50_000


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    ratios: np.ndarray = field(default_factory=lambda: np.zeros((LONGEST + 1, SPREAD[1] - SPREAD[0] + 1)))
    slopes: np.ndarray = field(default_factory=lambda: np.zeros(PLACES + 1))
    offset: float = 0.0

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.slopes + self.offset, -40, 40)))


def words(text: str | bytes | None) -> list[bytes]:
    if isinstance(text, bytes):
        text = text.decode("utf-8", "replace")
    return [] if text is None else text.lower().encode("utf-8", "replace").split()


class Windows:
    """Windows of some texts: ``joined`` has their words, window i is joined[start[i]:start[i] + size[i]], of text owner[i]."""

    def __init__(self, texts: list[str | bytes | None]):
        lists = [words(t) for t in texts]
        self.joined = b"".join(b" " + b" ".join(x) + b" " + TAIL for x in lists)
        blanks = np.flatnonzero(np.frombuffer(self.joined, np.uint8) == 32)
        n = np.array([len(x) for x in lists], np.int64)
        held = np.where(n, n + 1, 2)  # an empty text has two blanks and no word
        count = np.where(n, np.maximum(n - WINDOW + STRIDE - 1, 0) // STRIDE + 1, 0)  # the last may have fewer words
        self.owner = np.repeat(np.arange(len(lists)), count)
        first = np.cumsum(held) - held
        at = STRIDE * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
        self.start = blanks[first[self.owner] + at]
        self.size = blanks[first[self.owner] + np.minimum(at + WINDOW, n[self.owner])] + 1 - self.start


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    kept = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    how = zstandard.ZstdCompressionParameters(**SEARCH, write_content_size=False, write_checksum=False, write_dict_id=False)
    kept.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=kept, compression_params=how)


class Savings:
    """Cells (length, bytes saved under the toxic dictionary) of windows."""

    def __init__(self, model: Model):
        self.under = [compressor(model.ordinary), compressor(model.toxic)]

    def __call__(self, w: Windows) -> tuple[np.ndarray, np.ndarray]:
        saved = np.empty(len(w.start), np.int64)
        for a in range(0, len(saved), AT_A_TIME):
            start, size = w.start[a : a + AT_A_TIME], w.size[a : a + AT_A_TIME] + len(TAIL)
            base = int(start[0])
            pieces = zstandard.BufferWithSegments(w.joined[base : int(start[-1] + size[-1])], np.stack([start - base, size], 1).astype(np.uint64).tobytes())
            ordinary, toxic = (np.fromiter(map(len, x.multi_compress_to_buffer(pieces, threads=1)), np.int64, len(start)) for x in self.under)
            saved[a : a + AT_A_TIME] = ordinary - toxic
        return np.minimum(w.size // STEP, LONGEST), np.clip(saved, *SPREAD) - SPREAD[0]


def evidence(model: Model, savings: Savings, texts: list[str | bytes | None]) -> np.ndarray:
    """For each text the PLACES largest sums of ratios of windows that share words, of windows that don't overlap (0 where there are
    fewer), and the logarithm of the number of its windows."""
    w = Windows(texts)
    out = np.zeros((len(texts), PLACES + 1))
    if not len(w.start):
        return out
    total = np.concatenate([[0.0], np.cumsum(model.ratios[savings(w)])])
    here, reach = np.arange(len(w.owner)), WINDOW // STRIDE
    sums = total[here + 1] - total[np.maximum(here + 1 - reach, np.searchsorted(w.owner, w.owner))]
    first = np.flatnonzero(np.diff(w.owner, prepend=-1))
    for text, a, b in zip(w.owner[first].tolist(), first.tolist(), np.append(first[1:], len(sums)).tolist(), strict=True):
        mine = sums[a:b]
        for k in range(PLACES):
            i = int(mine.argmax())
            if mine[i] == -np.inf:
                break
            out[text, k] = mine[i]
            mine[max(0, i - 2 * reach + 1) : i + 2 * reach] = -np.inf
        out[text, PLACES] = math.log(1 + b - a)
    return out


def in_fold(doc_id) -> F.Column:
    """Whether labels of this document may be learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 != 1


def _counted(model: Model):
    schema = pa.schema([("toxic", pa.int64()), ("length", pa.int64()), ("saved", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        savings, counts = Savings(model), np.zeros((2, *model.ratios.shape), np.int64)
        for batch in batches:
            for first, texts in chunks(batch):
                w = Windows(texts)
                toxic = batch.column("toxic").slice(first, len(texts)).to_numpy()[w.owner]
                np.add.at(counts, (toxic, *savings(w)), 1)
        yield record(schema, *np.nonzero(counts), counts[counts > 0])

    return run


def _evidence(model: Model):
    schema = pa.schema([("toxic", pa.int64()), ("evidence", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        savings = Savings(model)
        for batch in batches:
            for first, texts in chunks(batch):
                yield record(schema, batch.column("toxic").slice(first, len(texts)), list(evidence(model, savings, texts)))

    return run


def _samples(marks: set[bytes] | None):
    """Windows to train on: those with a marked word, or all that don't overlap."""
    schema = pa.schema([("window", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in chunks(batch):
                w = Windows(texts)
                step = WINDOW // STRIDE if marks is None else 1
                some = [w.joined[a:b] for a, b in zip(w.start[::step].tolist(), (w.start + w.size)[::step].tolist(), strict=True)]
                if marks is not None:
                    some = [x for x in some if not marks.isdisjoint(x.split())]
                if some:
                    yield record(schema, some)

    return run


def trained(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary of up to ``size`` bytes; the samples themselves where they are too few to train on."""
    if sum(map(len, samples)) > 2 * size:
        try:
            return zstandard.train_dictionary(size, samples, k=SEGMENT, d=STRING).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[:size]


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """counts[toxic, length, saved] to log likelihood ratios, shrunk towards that of ``saved`` alone; a saving never seen is like the nearest smaller one in size."""
    n = counts.sum((1, 2))
    if not n.all():
        return np.zeros(counts.shape[1:])
    by_saved = counts.sum(1) + 0.5
    base, seen = (by_saved[1] / (n[1] + 1)) / (by_saved[0] / (n[0] + 1)), counts.sum((0, 1)) > 0
    seen[-SPREAD[0]] = True  # nothing saved
    for i in range(-SPREAD[0] + 1, len(base)):
        base[i] = base[i] if seen[i] else base[i - 1]
    for i in range(-SPREAD[0] - 1, -1, -1):
        base[i] = base[i] if seen[i] else base[i + 1]
    weight, share = 5, n[0] / n[1]
    a, b = counts[1] + weight * base / (base + share), counts[0] + weight * share / (base + share)
    return np.log((a / n[1]) / (b / n[0]))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes and offset of a regularised logistic curve over the columns of ``x``, by Newton's steps."""
    none = np.zeros(x.shape[1])
    if not len(x) or y.min() == y.max():
        return none, -1e3 if not len(x) or not y.max() else 0.0
    center, scale = x.mean(0), np.where(x.std(0) > 0, x.std(0), 1.0)
    a = np.concatenate([(x - center) / scale, np.ones((len(x), 1))], 1)
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (p - y) + 0.01 * w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 0.01 * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1] / scale, float(w[-1] - (w[:-1] * center / scale).sum())


def marking_words(texts: DataFrame, n_toxic: int, n_ordinary: int) -> list[str]:
    """Words that significantly more of the toxic texts hold than of the ordinary ones (text, toxic)."""
    held = F.array_distinct(F.split(F.trim(F.regexp_replace(F.lower("text"), r"[\x20\x09-\x0D]+", " ")), " "))
    each = texts.select("toxic", F.explode(held).alias("w")).where("w <> ''").groupBy("w").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    each = materialize(each, "words")
    a, b, n1, n0 = F.col("a"), F.col("b"), F.lit(n_toxic), F.lit(n_ordinary)
    p = (a + b) / (n1 + n0)
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    g = 2 * (part(a, n1 * p) + part(b, n0 * p) + part(n1 - a, n1 * (1 - p)) + part(n0 - b, n0 * (1 - p)))
    least = MARGIN + 2 * math.log(each.count() + 1)
    return [r["w"] for r in each.where((a >= 2) & (a / n1 > b / n0) & (g >= least)).select("w").collect()]


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, most_windows: int = MOST_WINDOWS, ordinary_bytes: int = ORDINARY_BYTES, toxic_bytes: int = TOXIC_BYTES) -> Model:
    """Fit on (doc_id, text) and (doc_id, toxic): at most ``most`` labelled documents, those with the least hashes of doc_id, and
    at most ``most_windows`` of their windows for each dictionary (those with the least hashes), of ``ordinary_bytes`` and ``toxic_bytes``.

    A document with several labels is toxic if one says so. Null texts, labels and ids take no part; copies count once. Without
    toxic documents every score is 0, without ordinary ones 1/2."""
    order = F.xxhash64("doc_id")
    chosen = labels.where(in_fold(F.col("doc_id")) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("toxic").cast("long").alias("toxic"))
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(order, "doc_id").limit(most)
    sample = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # ``most`` rows of two numbers
    # copies count once, and copies are in one part
    sample = sample.groupBy(F.sha2("text", 256).alias("copy"), "toxic").agg(F.min("text").alias("text"))
    sample = materialize(sample.withColumn("part", F.pmod(F.xxhash64("copy"), F.lit(3))), "labelled")
    fold, rest = sample.where("part > 0"), sample.where("part = 0")
    n = {r["toxic"]: r["n"] for r in fold.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return Model(TAIL, TAIL, offset=-1e3 if not n.get(1) else 0.0)
    marks = {w.encode("utf-8", "replace") for w in marking_words(fold, n[1], n[0])}
    windows = lambda toxic, marks: [bytes(r["window"]) for r in fold.where(F.col("toxic") == toxic).select("text").mapInArrow(_samples(marks), "window binary").orderBy(F.xxhash64("window"), "window").limit(most_windows).collect()]
    plain = windows(0, None)
    ordinary = trained(plain, ordinary_bytes // 16)
    ordinary = b"".join(plain)[: ordinary_bytes - len(ordinary)] + ordinary
    model = Model(TAIL + ordinary + trained(windows(1, marks), toxic_bytes) + FILL, TAIL + ordinary + FILL)
    counts = np.zeros((2, *model.ratios.shape), np.int64)
    for r in rest.mapInArrow(_counted(model), "toxic long, length long, saved long, n long").groupBy("toxic", "length", "saved").agg(F.sum("n").alias("n")).collect():  # as many cells as the table has, at most
        counts[r["toxic"], r["length"], r["saved"]] = r["n"]
    model.ratios = log_ratios(counts)
    seen = rest.mapInArrow(_evidence(model), "toxic long, evidence array<double>").collect()  # a third of ``most`` rows
    model.slopes, model.offset = logistic(np.array([r["evidence"] for r in seen]).reshape(-1, PLACES + 1), np.array([r["toxic"] for r in seen], float))
    return model


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted for each row of ``docs``.

    Null, empty and blank texts score as texts without evidence. Rows are scored one by one and whole, so repeated rows
    score alike; a null doc_id stays null. Other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    held = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        savings = Savings(held.value)
        for batch in batches:
            for first, texts in chunks(batch):
                yield record(schema, batch.column("doc_id").slice(first, len(texts)), held.value.score(evidence(held.value, savings, texts)))

    scored = docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", (~in_fold(F.col("doc_id"))).alias("held_out"), "score", "predicted")
