"""Operator 7, packing along a space-filling curve.

A document's distinct words are hashed to a vector whose random projections give a point in a few dimensions; the
Hilbert key of the point orders the documents. Rows are range-partitioned (by bounds from a sample) and sorted by that key, and each partition
lays the token ids of its documents end to end and cuts them every 4096. What is left at the end of a partition is cut
into powers of two, which need no padding. A task holds the ids of one document and of one open sequence.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from collections.abc import Iterator
from math import erf

import numpy as np
import pyarrow as pa
import public_tokenizers
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from terrace.llm.common import U, chunks, mix, record, table

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
LENGTH = 4096
DIMS, BITS = 4, 12
#: Words that a worker keeps, in two halves; longer ones aren't kept.
CACHED_WORDS, CACHED_BYTES = 800_000, 64
#: Words up to so many bytes are hashed together, eight bytes at a time; longer ones one by one.
STEPPED_BYTES = 64
#: Rows that place the range bounds, about; what a row weighs beside its text.
SAMPLE_ROWS = 20_000
ROW_BYTES = 64

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
PIECE_SCHEMA = pa.schema([(x.split()[0], pa.int64()) for x in PIECE.split(", ")])
IDS_SCHEMA = pa.schema([*PIECE_SCHEMA, ("ids", pa.binary())])


#: Letters of plain words (Latin, in lower case, already composed) and the marks that may end one (ASCII's but the apostrophe,
#: which may begin a contraction). A run of marks is one piece to the tokenizer.
PLAIN = re.compile("([a-z\u00df-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]{0,8})")
KEPT_MARKS = 5000


class Encoder:
    """Token ids of whole texts, put together from those of their words.

    Strings of special tokens in a text are what the tokenizer's file makes of them: their ids. They hold no white space.
    The tokenizer drops white space before it splits, lower-cases and normalises, and none of its steps looks across
    a word end, so the ids of a text are those of its words in order. Characters that only Unicode counts as white
    space stay inside a word, which is encoded whole. The letters and the marks of a plain word (letters in any case, then marks)
    are pieces of their own and, in lower case, what they are to every normalising step: its ids are those of its letters, which
    are looked up or go to the same merges without those steps, and those of its marks.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.model = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.model.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.kind = np.dtype("<u2" if self.model.get_vocab_size() <= 1 << 16 else "<u4")
        self.marks = {"": b""}
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}  # the half before; its words come back when they are seen again

    def _cut(self, encoding, n: int) -> list[bytes]:
        ids, at = np.array(encoding.ids, self.kind), np.array(encoding.word_ids, np.int64)
        ends = np.searchsorted(at, np.arange(n + 1))
        return [ids[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def _whole(self, words: list[str]) -> list[bytes]:
        return self._cut(self.model.encode(words, is_pretokenized=True, add_special_tokens=False), len(words))

    def _missing(self, words: set[bytes]) -> list[bytes]:
        """Those of ``words`` that aren't known, after bringing back those of the half before."""
        words = words.difference(self.known)
        back = [*filter(self.old.__contains__, words)]
        self.known.update(zip(back, map(self.old.__getitem__, back)))
        return list(words.difference(back))

    def _learn(self, words: list[bytes]) -> None:
        folded = b" ".join(words).decode("utf-8", "replace").lower().split(" ")
        found = [PLAIN.fullmatch(x) if len(w) <= CACHED_BYTES else None for w, x in zip(words, folded)]
        plain = [w for w, m in zip(words, found) if m]
        if plain:
            cores, marks = zip(*[m.groups() for m in found if m])
            stems = [*map(str.encode, cores)]
            made = self._missing(set(stems))
            if made:
                self.known.update(zip(made, self._cut(self.plain.encode(b" ".join(made).decode(), add_special_tokens=False), len(made))))
            ends = [x for x in set(marks) if x not in self.marks]
            if ends:
                self.marks.update(zip(ends, self._whole(ends)))
            self.known.update(zip(plain, map(bytes.__add__, map(self.known.__getitem__, stems), map(self.marks.__getitem__, marks))))
            if len(self.marks) > KEPT_MARKS:
                self.marks = {"": b""}
        if len(plain) < len(words):
            rest = [w for w, m in zip(words, found) if not m]
            self.known.update(zip(rest, self._whole([w.decode("utf-8", "replace") for w in rest])))

    def __call__(self, texts: list[bytes | None]) -> list[np.ndarray]:
        lists = [[] if t is None else t.split() for t in texts]
        new = self._missing(set().union(*lists))
        if new:
            self._learn(new)
        end, known = np.array([END_ID], self.kind).tobytes(), self.known.__getitem__
        out = [np.frombuffer(b"".join([*map(known, x), end]), self.kind) for x in lists]
        for word in new:
            if len(word) > CACHED_BYTES:
                del self.known[word]
        if len(self.known) > CACHED_WORDS // 2:
            self.old, self.known = self.known, {}
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which keeps its words from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer points (rows; each below 2**bits), after Skilling's transposed form."""
    x = points.astype(np.int64).copy()
    n, dims = x.shape
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            high = (x[:, i] & q) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(high, low, swap)
            if i:
                x[:, i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    flip, q = np.zeros(n, np.int64), 1 << (bits - 1)
    while q > 1:
        flip ^= np.where(x[:, dims - 1] & q, q - 1, 0)
        q >>= 1
    x ^= flip[:, None]
    key = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[:, i] >> b) & 1
    return key


_erf = np.vectorize(erf, otypes=[float])


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words data[begin:end], over all their bytes; ``data`` has eight bytes after the last one."""
    size = end - begin
    h = mix(size.astype(U))
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)
    at = np.flatnonzero(size <= STEPPED_BYTES)
    for done in range(0, STEPPED_BYTES, 8):
        left = size[at] - done
        at, left = at[left > 0], left[left > 0]
        if not len(at):
            break
        part = eight[begin[at] + done].view("<u8").ravel() & (U(0xFFFFFFFFFFFFFFFF) >> (U(8) * (8 - np.minimum(left, 8)).astype(U)))
        h[at] = mix(h[at] * U(0x9E3779B97F4A7C15) ^ part)
    for i in np.flatnonzero(size > STEPPED_BYTES):
        h[i] = xxhash.xxh3_64_intdigest(data[begin[i] : end[i]].tobytes())
    return h


def curve_keys(texts: list[bytes | None], dims: int = DIMS, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of texts, from all distinct words of each (whole, A-Z in lower case).

    Words of a text are told apart by 64 bits of hash less those that number the texts of a call (10 000 texts: 50 bits).
    A text without words is a point in the middle of every axis."""
    n = len(texts)
    data = _FOLD[np.frombuffer(b" ".join(t or b"" for t in texts) + b" " * 9, np.uint8)]
    blank = _BLANK[data]
    begin = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    if not blank[0]:
        begin = np.append(0, begin)
    h = word_hashes(data, begin, np.flatnonzero(~blank[:-1] & blank[1:]) + 1)
    ends = np.searchsorted(begin, np.cumsum([len(t or b"") + 1 for t in texts]))
    # the number of the text above the hash: one sort of plain integers brings equal words of a text together
    room = max(n - 1, 1).bit_length()
    owned = np.repeat(np.arange(n).astype(U) << U(64 - room), np.diff(ends, prepend=0)) | h >> U(room)
    owned.sort()
    owned = owned[np.append(True, owned[1:] != owned[:-1])] if len(owned) else owned
    # a word's side of each axis is a bit of its hash, the highest ones
    sides = np.bincount((owned >> U(64 - room - dims)).astype(np.int64), minlength=n << dims).reshape(n, 1 << dims)
    axes = (np.arange(1 << dims)[:, None] >> np.arange(dims)[::-1] & 1) * 2 - 1
    z = sides @ axes / np.sqrt(np.maximum(sides.sum(axis=1), 1))[:, None]
    points = np.minimum((0.5 + 0.5 * _erf(z / np.sqrt(2))) * (1 << bits), (1 << bits) - 1).astype(np.int64)
    return hilbert(points, bits)


#: Bits of a hash of id and text below the curve's bits, so that copies can be told apart and spread.
SPREAD_BITS = 62 - DIMS * BITS


def _keyed(bounds: np.ndarray | None):
    """(doc_id, text, spread) to the same with place (Hilbert key, then bits of ``spread``) and part; without ``bounds`` only the place and the weight."""
    fields = [("place", pa.int64()), ("weight", pa.int64())] if bounds is None else [("doc_id", pa.int64()), ("text", pa.string()), ("place", pa.int64()), ("part", pa.int32())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spread = batch.column("spread").to_numpy() & ((1 << SPREAD_BITS) - 1)
            for first, texts in chunks(batch):
                s = slice(first, first + len(texts))
                place = curve_keys(texts) << SPREAD_BITS | spread[s]
                if bounds is None:
                    yield record(schema, place, [len(t or b"") + ROW_BYTES for t in texts])
                else:
                    yield record(schema, batch.column("doc_id")[s.start : s.stop], batch.column("text")[s.start : s.stop], place, np.searchsorted(bounds, place, "right").astype(np.int32))

    return run


def range_bounds(docs: DataFrame, n: int) -> np.ndarray:
    """n - 1 places that cut the curve into ranges of about as many bytes, from a sample of about SAMPLE_ROWS rows.

    They only say which task packs which stretch of the curve: every row is packed wherever they are."""
    rows = docs.count()
    if n < 2 or not rows:
        return np.zeros(0, np.int64)
    sample = docs.sample(min(1.0, SAMPLE_ROWS / rows), 7) if rows > SAMPLE_ROWS else docs
    found = np.array([tuple(r) for r in sample.mapInArrow(_keyed(None), "place long, weight long").collect()], np.int64).reshape(-1, 2)
    found = found[np.argsort(found[:, 0], kind="stable")]
    if not len(found):
        return np.zeros(0, np.int64)
    upto = np.cumsum(found[:, 1])
    return found[np.searchsorted(upto, np.arange(1, n) * (upto[-1] / n)), 0]


def _packer(path: str, length: int, with_ids: bool):
    schema = IDS_SCHEMA if with_ids else PIECE_SCHEMA

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        collects = gc.isenabled()
        gc.disable()  # words make millions of small objects and no cycles
        try:
            yield from pieces(batches)
        finally:
            if collects:
                gc.enable()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, base, sequence = encoder(path), TaskContext.get().partitionId() << 40, 0
        open_: list[tuple] = []  # pieces of the sequence that isn't full: doc_id, start, ids, doc_tokens, offset
        fill, done = 0, []

        def close(held, number):
            done.extend((d, s, len(i), zlib.crc32(i.astype("<u4").tobytes()), t, base + number, o, *([i.astype("<u4").tobytes()] if with_ids else [])) for d, s, i, t, o in held)

        def flush():
            out = record(schema, *[list(x) for x in zip(*done, strict=True)])
            done.clear()
            return out

        for batch in batches:
            for first, texts in chunks(batch):
                for doc, ids in zip(batch.column("doc_id").slice(first, len(texts)).to_pylist(), encode(texts), strict=True):
                    at = 0
                    while at < len(ids):
                        n = min(len(ids) - at, length - fill)
                        open_.append((doc, at, ids[at : at + n], len(ids), fill))
                        at, fill = at + n, fill + n
                        if fill == length:
                            close(open_, sequence)
                            open_, fill, sequence = [], 0, sequence + 1
                    if len(done) >= 5000:
                        yield flush()
        while fill:  # the rest in powers of two
            size, at, head, rest = 1 << (fill.bit_length() - 1), 0, [], []
            for doc, start, ids, total, _ in open_:
                n = max(0, min(len(ids), size - at))
                if n:
                    head.append((doc, start, ids[:n], total, at))
                if n < len(ids):
                    rest.append((doc, start + n, ids[n:], total, max(at + n - size, 0)))
                at += len(ids)
            close(head, sequence)
            open_, fill, sequence = rest, fill - size, sequence + 1
        if done:
            yield flush()

    return pack


def pack(docs: DataFrame, text: str = "text", tokenizer: str | None = None, length: int = LENGTH, with_ids: bool = False, partitions: int | None = None) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) in sequences of at most ``length`` ids (a power of two).

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids (little-endian uint32) if ``with_ids``.
    Every row is a document: a null or empty text is the end id alone, repeated rows are packed once each, a null doc_id
    stays null. Other columns of ``docs`` are not read. Sequences are full, or a power of two long at the end of a
    partition, so nothing needs padding. Ties of the key are broken by a hash of id and text, so many copies of a text spread over tasks.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.xxhash64("doc_id", text).alias("spread"))
    keyed = docs.mapInArrow(_keyed(range_bounds(docs, n)), "doc_id long, text string, place long, part int")
    keyed = keyed.repartitionById(n, F.col("part")).sortWithinPartitions("place", "doc_id")
    return keyed.select("doc_id", "text").mapInArrow(_packer(path, length, with_ids), PIECE + (", ids binary" if with_ids else ""))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
