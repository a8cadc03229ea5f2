"""Operator 12, alignment of two tokenizers.

Texts are cut where both tokenizers cut, so tokens of both end there, and the groups and links of a text are those of its stretches, one after the other. A worker
keeps what it has made of a stretch; new ones are tokenized and grouped many at a time, by whole arrays. What a text then needs is looked up and put together.
Spark counts the links of the corpus and weighs each row's.

Tokens that end together are linked, so one's bytes end the other's: each token has at most as many partners shorter than itself as it has bytes. The
pairs of a corpus of any size are therefore at most the bytes of both vocabularies (some 500 000), and their counts can be broadcast.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from terrace.llm.common import chunks, materialize, record, table
from terrace.llm.pieces import KEPT_CHARS, MODEL, SPACE, Vocabulary

BYTE_MODEL = "byte_bpe_50k.json"
#: Offsets have 32 bits.
MOST_BYTES = 1 << 30
#: Characters of text that are cut into stretches at a time: a worker holds all of these stretches beside those that it keeps.
CUT_CHARS = 500_000
#: New stretches that are tokenized at a time (the piece library is slower on longer texts), and tokens that are written at a time.
LEARNT, WRITTEN_TOKENS = 1000, 1 << 20
#: Stretches of text that a worker keeps.
KEPT_BOTH = 250_000
#: White space beside white space that only Unicode counts as such: what a run of it is cut into depends on the tokenizer, so such texts aren't cut here.
_OTHER_SPACES = "".join(c for c in map(chr, [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]))
UNCERTAIN = re.compile(f"[{_OTHER_SPACES}][ \t-\r]|[ \t-\r][{_OTHER_SPACES}]").search
#: Letters, digits and signs of Latin script: of one kind to all versions of Unicode.
LATIN = re.compile("[\x00-\u024f]*").fullmatch
#: Stretches that are cut off again when they stand one behind the other: no white space but the space in front.
JOINED = re.compile(f" [^ \t-\r{_OTHER_SPACES}]+").fullmatch
#: The tokenizer's own cuts at white space: the last of a run goes with the word behind it if it is a space, and is alone if not.
STRETCHES = re.compile("(?: ?[^ \t-\r]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+)").findall


def byte_contents(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary. Printable Latin-1 characters stand for themselves, the others for what comes from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    names = {i: name for name, i in given["model"]["vocab"].items()}
    added = {x["id"]: x["content"] for x in given["added_tokens"]}
    return [bytes(of[c] for c in names[i]) if i in names else added.get(i, "").encode() for i in range(max([*names, *added]) + 1)]


class Both:
    """Groups and links of the ids that the two tokenizers make of a text.

    The byte-level vocabulary is read from its file. Its merges are the ranks of what they make (each token is what its own bytes are merged into, so no other pair
    of neighbours makes it), by which tiktoken encodes stretches of Latin script; others and uncut texts go through the file's own tokenizer. Stretches are cut where
    both tokenizers cut, and keep what both make of them: (groups, links, number of ids of either). Groups are written as a1,a2|b1;a3|b2,b3; with a sign behind each
    id, links are 64-bit integers, a's id in the upper half.
    """

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.whole = Tokenizer.from_file(byte_path)
        self.whole.encode_special_tokens = True  # their strings are plain text
        self.library = SentencePieceProcessor(model_file=piece_path)
        self.pieces = Vocabulary(piece_path)
        self.contents = a, b = byte_contents(byte_path), self.pieces.content
        ranks = {x: i for i, x in enumerate(a) if i < self.whole.get_vocab_size(with_added_tokens=False)}
        self.latin = tiktoken.Encoding("byte level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.sizes = tuple(np.array([len(x) for x in c], np.int32) for c in (a, b))
        # digits of each id to the right, with room for a sign behind them
        ids = np.arange(max(len(a), len(b)))
        width = len(str(len(ids)))
        self.digits = np.stack([*(48 + ids // 10**k % 10 for k in reversed(range(width))), 0 * ids], axis=1).astype(np.uint8)
        self.written = 1 + np.array([len(str(i)) for i in ids])
        self.filled = np.arange(width + 1) > width - self.written[:, None]
        # runs of spaces are cut otherwise by either tokenizer, and some white space goes on in longer pieces
        longer = {c for x in self.pieces.ids if len(x) > 1 for c in x} & set("\t\n\v\f\r")
        self.unsure = ["  ", *sorted(longer)]
        self.known: dict[str, tuple[bytes, bytes, int, int]] = {}
        self.old: dict[str, tuple[bytes, bytes, int, int]] = {}  # the half before; its stretches come back when they are seen again

    def byte_ids(self, text: str) -> list[int]:
        return self.latin(text) if LATIN(text) else self.whole_ids(text)

    def whole_ids(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def grouped(self, data: bytes, stops: np.ndarray, *both: list[int]) -> list[tuple[bytes, bytes, int, int]] | None:
        """Of the ids that both tokenizers make of ``data``, what is kept for each of its stretches, which end at ``stops``. None where an id's bytes aren't those of ``data``."""
        if any(b"".join(map(c.__getitem__, i)) != data for c, i in zip(self.contents, both, strict=True)):
            return None
        ids = [np.array(i, np.int32) for i in both]
        ends = [np.cumsum(n[i], dtype=np.int32) for n, i in zip(self.sizes, ids, strict=True)]
        common = np.zeros((2, len(data) + 1), bool)
        for side, e in zip(common, ends, strict=True):
            side[e] = True
        common = common[0] & common[1]
        if not common[stops].all():
            raise ValueError("a stretch doesn't end where tokens of both end")
        # a group's tokens of a, then those of b: each token stands behind all of its own side and the other side's of the groups before (for b, of its own group too)
        last = [np.flatnonzero(common[e]) for e in ends]
        at = [np.arange(len(e)) + before[np.cumsum(c := common[e]) - c] for e, before in zip(ends, (np.append(0, last[1] + 1), last[0] + 1), strict=True)]
        tokens = np.empty(sum(map(len, ids)), np.int32)
        signs = np.full(len(tokens), ord(","), np.uint8)
        for i, where, closing, sign in zip(ids, at, last, b"|;", strict=True):
            tokens[where] = i
            signs[where[closing]] = sign
        text = b"".join(self._written(tokens[k : k + WRITTEN_TOKENS], signs[k : k + WRITTEN_TOKENS]) for k in range(0, len(tokens), WRITTEN_TOKENS))
        links = (ids[0][last[0]].astype("<i8") << 32 | ids[1][last[1]]).tobytes()
        n_a, n_b, n = (np.searchsorted(e, stops, "right") for e in (*ends, ends[0][last[0]]))
        to = np.cumsum(self.written[tokens])[n_a + n_b - 1]
        cuts = [np.append(0, x).tolist() for x in (to, n * 8)]
        counts = [np.diff(x, prepend=0).tolist() for x in (n_a, n_b)]
        return [*zip(*([x[i:j] for i, j in zip(c, c[1:])] for x, c in zip((text, links), cuts, strict=True)), *counts, strict=True)]

    def _written(self, tokens: np.ndarray, signs: np.ndarray) -> bytes:
        chars = self.digits[tokens]
        chars[:, -1] = signs
        return chars[self.filled[tokens]].tobytes()

    def _learn(self, new: list[str]) -> None:
        """Keep what both tokenizers make of new stretches. Those that are cut off again are tokenized as one text: either tokenizer takes longer to be called than to encode a stretch."""
        joined = [x for x in new if JOINED(x)]
        latin, other = (joined, []) if LATIN(text := "".join(joined)) else ([x for x in joined if LATIN(x)], [x for x in joined if not LATIN(x)])
        single = [x for x in new if not JOINED(x)] if len(joined) < len(new) else []
        if other:
            text = "".join([*latin, *other])
        a = [*self.latin("".join(latin)), *(self.whole_ids("".join(other)) if other else []), *chain.from_iterable(map(self.byte_ids, single))]
        # the library puts a space in front
        b = [*(self.library.encode(text[1:]) if text else []), *chain.from_iterable(self.library.encode(x[1:]) if x[0] == " " and len(x) > 1 else self.pieces.encoded(x) for x in single)]
        some = [*latin, *other, *single]
        stops = np.cumsum([len(x) if x.isascii() else len(x.encode()) for x in some])
        made = self.grouped("".join(some).encode(), stops, a, b)
        if made is None:
            raise ValueError(f"a tokenizer doesn't give back one of {some!r:.1000}")
        self.known.update(zip(some, made, strict=True))

    def __call__(self, texts: list[bytes | None]) -> Iterator[tuple[bytes, bytes, int, int]]:
        """(groups, links, number of ids of either tokenizer) of a space and each text; nothing and zeros where a tokenizer's bytes aren't the text's."""
        if any(len(t) >= MOST_BYTES for t in texts if t):
            raise ValueError("a text of over 2^30 bytes")
        plain = [t.decode() if t else "" for t in texts]
        # a visible space comes back as a space
        cut = [STRETCHES(" " + t) if t and SPACE not in t and not any(x in (" " + t) for x in self.unsure) and (t.isascii() or not UNCERTAIN(t)) else [] for t in plain]
        new = set(chain.from_iterable(cut)).difference(self.known)
        back = new.intersection(self.old)
        self.known.update((x, self.old[x]) for x in back)
        unseen = [*(new - back)]
        for k in range(0, len(unseen), LEARNT):
            self._learn(unseen[k : k + LEARNT])
        nothing = b"", b"", 0, 0
        for t, raw, stretches in zip(plain, texts, cut, strict=True):
            if stretches:
                groups, links, n_a, n_b = zip(*map(self.known.__getitem__, stretches))
                yield b"".join(groups)[:-1], b"".join(links), sum(n_a), sum(n_b)
            elif not t or SPACE in t:
                yield nothing
            else:
                made = self.grouped(b" " + raw, np.array([len(raw) + 1]), self.whole_ids(" " + t), self.library.encode(t))
                yield (made[0][0][:-1], *made[0][1:]) if made else nothing
        for x in new:
            if len(x) > KEPT_CHARS:
                del self.known[x]
        if len(self.known) > KEPT_BOTH // 2:
            self.old, self.known = self.known, {}


_both: dict[tuple[str, str], Both] = {}


def both(byte_path: str, piece_path: str) -> Both:
    """The tokenizers of this Python worker, which keep their stretches from task to task."""
    if (byte_path, piece_path) not in _both:
        _both[byte_path, piece_path] = Both(byte_path, piece_path)
    return _both[byte_path, piece_path]


ALIGNED = "doc_id long, n_a long, n_b long, groups string, links array<long>"
ALIGNED_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("groups", pa.string()), ("links", pa.list_(pa.int64()))])


def aligned(docs: DataFrame, text: str = "text", byte_model: str | None = None, piece_model: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, groups, links) of a space and each text: how many ids a byte-level and a piece tokenizer make of it; the ids between offsets at which tokens of
    both end, written as a1,a2|b1;a3|b2,b3; and the pairs of ids that end together, a's id in the upper 32 bits.

    Null and empty texts, and those that a tokenizer doesn't give back byte for byte, have no ids. Rows with a null or repeated doc_id are rows like all
    others. Other columns are not read."""
    paths = byte_model or public_tokenizers.path(BYTE_MODEL), piece_model or public_tokenizers.path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in chunks(batch, most=CUT_CHARS):
                groups, links, n_a, n_b = zip(*both(*paths)(texts), strict=True)
                starts = np.cumsum([0, *(len(x) // 8 for x in links)]).astype(np.int32)
                pairs = pa.ListArray.from_arrays(starts, np.frombuffer(b"".join(links), "<i8"))
                yield record(ALIGNED_SCHEMA, batch.column("doc_id").slice(first, len(texts)), n_a, n_b, pa.array(groups, pa.binary()).cast(pa.string()), pairs)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, ALIGNED)


def groups() -> Column:
    """array<struct<a: array<int>, b: array<int>>> of the written ``groups``, in order."""
    ids = lambda x: F.split(x, ",").cast("array<int>")
    pairs = F.transform(F.split("groups", ";"), lambda g: F.struct(ids(F.split_part(g, F.lit("|"), F.lit(1))).alias("a"), ids(F.split_part(g, F.lit("|"), F.lit(2))).alias("b")))
    return F.when(F.col("groups") != "", pairs).otherwise(F.array().cast("array<struct<a: array<int>, b: array<int>>>"))


def weighed(linked: DataFrame) -> DataFrame:
    """``linked`` (any columns, and ``links``) with ``n_best`` and ``count_sum`` in place of ``links``.

    The count of a pair of ids is how many links of all rows hold it. ``n_best`` is how many of a row's links have a pair whose count no other pair of its b exceeds, ``count_sum``
    the sum of its links' counts; 0 without links. A row's links are summed in the task that reads them; one row of sums goes into the shuffle."""
    kept = [c for c in linked.columns if c != "links"]
    rows = materialize(linked.withColumn("__row", F.monotonically_increasing_id()), "alignments")
    each = rows.select("__row", F.explode("links").alias("link"))
    counts = each.groupBy("link").agg(F.count("*").alias("n"))
    counts = counts.withColumn("best", (F.col("n") == F.max("n").over(W.partitionBy(F.col("link").bitwiseAND(F.lit(0xFFFFFFFF))))).cast("long"))
    sums = each.join(F.broadcast(counts), "link").groupBy("__row").agg(F.sum("best").alias("n_best"), F.sum("n").alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.drop("links").join(sums, "__row", "left").select(*kept, zero("n_best"), zero("count_sum"))


def align(docs: DataFrame, text: str = "text", byte_model: str | None = None, piece_model: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, groups, n_best, count_sum: one row per row of ``docs``. Texts without tokens have zeros and no groups."""
    return weighed(aligned(docs, text, byte_model, piece_model).withColumn("groups", groups()))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, digest = F.size("links").cast("long"), F.when(F.col("groups") != "", F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    found = aligned(table(spark, sf_dir, "documents"))
    return weighed(found.select("doc_id", "n_a", "n_b", n.alias("n_groups"), n.alias("n_links"), digest.alias("groups_sha256"), "links"))
