"""Operator 11, SentencePiece encoding and decoding by a table of prefixes.

The library merges pairs of neighbouring pieces, best score first and leftmost among equals, until no two neighbours are a piece
together. A sequence of pieces is what it returns if, and only if, that holds for every two neighbours: a merge across a border
is the first one there, and until then the two sides are merged as if nothing else were beside them. So each prefix of a text has
one last piece: the one match of an automaton of all pieces that ends there and is compatible with the last piece of the prefix
before it. The table is filled from left to right, and the ids are read off it backwards.

Two pieces are compatible if no merge crosses their border. What stands beside the border are the right edge of the left piece's
tree of merges and the left edge of the right one's. Where scores fall towards the roots of both trees, merges come in the order of their scores,
so the two edges are walked up together; other pairs (runs of spaces, whose scores are equal) are merged as they are.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from terrace.llm.common import chunks, table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Stretches of text and pairs of pieces that a worker keeps; longer stretches aren't kept.
KEPT_STRETCHES, KEPT_CHARS, KEPT_PAIRS = 700_000, 64, 1 << 20
#: The library's stand-in for an unknown piece.
UNKNOWN = " ⁇ "
NEVER = 1 << 62


class Pairs(dict):
    """left * size + right -> whether no merge crosses the border of the two pieces; forgets all when it is full."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.of = vocabulary

    def __missing__(self, pair: int) -> bool:
        if len(self) >= KEPT_PAIRS:
            self.clear()
        found = self[pair] = self.of.compatible(*divmod(pair, self.of.size))
        return found


class Vocabulary:
    """The pieces of a model, with the trees of merges that make them.

    ValueError for a model whose pieces can't be told from scores alone: one that isn't of pairs, with pieces of the user's, unused pieces, a normaliser other
    than a space in front, or pieces with characters that are none themselves.
    """

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        self.size = model.vocab_size()
        self.names = [model.id_to_piece(i).replace(SPACE, " ") for i in range(self.size)]
        kinds = [(model.is_byte(i), model.is_control(i), model.is_unknown(i)) for i in range(self.size)]
        self.bytes = {int(self.names[i][3:5], 16): i for i, k in enumerate(kinds) if k[0]}
        self.ids = {self.names[i]: i for i, k in enumerate(kinds) if not any(k)}
        self.begin, self.end = model.bos_id(), model.eos_id()
        odd = "a  ﬁ\tÁ "
        if model.normalize(odd) != SPACE + odd.replace(" ", SPACE) or any(model.is_unused(i) for i in range(self.size)) or len(self.bytes) < 256:
            raise ValueError(f"{path}: a normaliser, unused pieces or missing bytes")
        if set("".join(self.ids)) - set(self.ids):
            raise ValueError(f"{path}: pieces of characters that are no pieces")
        scores = [model.get_score(i) for i in range(self.size)]
        order = {s: k for k, s in enumerate(sorted({scores[i] for i in self.ids.values()}, reverse=True))}
        self.rank = {name: order[scores[i]] for name, i in self.ids.items()}
        self.length = [len(x) for x in self.names]
        self.automaton = ahocorasick.Automaton()
        #: By id, from the border inwards to outwards: (symbols, ranks of the merges that replace them); None where scores don't fall strictly.
        self.left: list = [None] * self.size
        self.right: list = [None] * self.size
        for name, i in self.ids.items():
            trees = self.merged(list(name))
            if len(trees) == 1:  # others never come out of merging
                self.automaton.add_word(name, (i, len(name)))
                if self._falls(trees[0]):
                    self.left[i], self.right[i] = self._edge(trees[0], 1), self._edge(trees[0], 2)
        self.automaton.make_automaton()
        self.pairs = Pairs(self)
        # a border that no piece crosses: before a run of spaces, and around characters that are in no longer piece
        if any(" " in x.lstrip(" ") for x in self.ids):
            raise ValueError(f"{path}: pieces that go on after a space")
        alone = "\n" if not any("\n" in x for x in self.ids if len(x) > 1) else ""
        self.stretches = re.compile(f" +[^ {alone}]*|[^ {alone}]+" + (f"|{alone}" if alone else "")).findall
        self.content = [b"" if k[1] else UNKNOWN.encode() if k[2] else bytes([int(x[3:5], 16)]) if k[0] else x.encode() for x, k in zip(self.names, kinds, strict=True)]
        self.silent = [i for i, k in enumerate(kinds) if k[1]]
        self.spaced = {i for x, i in self.ids.items() if x.startswith(" ")}
        sample = "Sample é中\U0001f600  x\nwords"
        if model.encode(sample) != self.encoded(" " + sample):
            raise ValueError(f"{path}: not a model of merged pairs")

    def merged(self, symbols: list) -> list:
        """Trees (name, left, right) after all merges of ``symbols``; a single character is its own tree."""
        trees = [(x, None, None) for x in symbols]
        while True:
            found = [(r, k) for k, (a, b) in enumerate(zip(trees, trees[1:])) if (r := self.rank.get(a[0] + b[0])) is not None]
            if not found:
                return trees
            k = min(found)[1]
            trees[k : k + 2] = [(trees[k][0] + trees[k + 1][0], trees[k], trees[k + 1])]

    def _falls(self, tree) -> bool:
        name, *parts = tree
        return parts[0] is None or all(self._falls(x) and (x[1] is None or self.rank[x[0]] < self.rank[name]) for x in parts)

    def _edge(self, tree, side: int) -> tuple[list[str], list[int]]:
        names, ranks, above = [], [], NEVER
        while tree is not None:
            names.append(tree[0])
            ranks.append(above)
            above, tree = self.rank[tree[0]], tree[side]
        return names[::-1], ranks[::-1]

    def compatible(self, left: int, right: int) -> bool:
        if self.right[left] is None or self.left[right] is None:
            return [x[0] for x in self.merged([*self.names[left], *self.names[right]])] == [self.names[left], self.names[right]]
        (a, a_until), (b, b_until), rank, i, j = self.right[left], self.left[right], self.rank.get, 0, 0
        while True:
            merge = rank(a[i] + b[j])
            if merge is not None and merge < a_until[i] and merge <= b_until[j]:  # of equals the leftmost comes first
                return False
            if a_until[i] <= b_until[j]:
                if a_until[i] == NEVER:
                    return True
                i += 1
            else:
                j += 1

    def encoded(self, text: str) -> list[int]:
        """Ids of a text with a space in front."""
        last, length, pairs, size = [-1] * (len(text) + 1), self.length, self.pairs, self.size  # the last entry stands before the text
        for end, (piece, n) in self.automaton.iter(text):
            if last[end] < 0:
                before = last[end - n]
                if before < 0 or pairs[before * size + piece]:  # nothing merges with a character that is no piece
                    last[end] = piece
        out, at = [], len(text) - 1
        while at >= 0:
            if (piece := last[at]) < 0:
                out.extend(self.bytes[x] for x in reversed(text[at].encode()))
                at -= 1
            else:
                out.append(piece)
                at -= length[piece]
        return out[::-1]


class Stretches(dict):
    """Stretch of text -> ids as little-endian integers; keeps ``most`` (KEPT_STRETCHES) in two halves, the older of which goes first."""

    def __init__(self, encode, kind: np.dtype, most: int | None = None):
        super().__init__()
        self.encode, self.kind, self.old, self.half = encode, kind, {}, (most or KEPT_STRETCHES) // 2

    def __missing__(self, stretch: str) -> bytes:
        found = self.old.get(stretch)
        if found is None:
            found = np.array(self.encode(stretch), self.kind).tobytes()
            if len(stretch) > KEPT_CHARS:
                return found
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[stretch] = found
        return found


class Pieces:
    """Ids of whole texts and texts of ids, as the library makes them."""

    def __init__(self, path: str, most: int | None = None):
        self.vocabulary = v = Vocabulary(path)
        self.kind = np.dtype("<u2" if v.size <= 1 << 16 else "<u4")
        self.known = Stretches(v.encoded, self.kind, most)

    def encode(self, text: str | None) -> np.ndarray:
        """Without begin and end."""
        if not text:
            return np.empty(0, self.kind)
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.vocabulary.stretches(" " + text.replace(SPACE, " ")))), self.kind)

    def decode(self, ids: np.ndarray) -> str:
        """The first piece that isn't silent loses the space in front; bytes that are no UTF-8 become U+FFFD, one each; bytes don't go on across a silent
        piece. IndexError for ids that aren't in the model."""
        v = self.vocabulary
        at = np.flatnonzero(np.isin(ids, v.silent))
        parts = [x.tolist() for x in np.split(ids, at)] if len(at) else [ids.tolist()]
        first = next((i for x in parts for i in x if i not in v.silent), None)
        text = "".join(b"".join(map(v.content.__getitem__, x)).decode("utf-8", "each_byte") for x in parts)
        return text[1:] if first in v.spaced else text


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


_models: dict[tuple[str, int | None], Pieces] = {}


def pieces(path: str, most: int | None = None) -> Pieces:
    """The model of this Python worker, which keeps its stretches (``most``) from task to task."""
    if (path, most) not in _models:
        import codecs

        codecs.register_error("each_byte", _each_byte)
        os.environ["OMP_NUM_THREADS"] = "1"
        _models[path, most] = Pieces(path, most)
    return _models[path, most]


def _added(batch: pa.RecordBatch, made: list, kind: pa.DataType, schema: pa.Schema, drop: str | None) -> pa.RecordBatch:
    held = [batch.column(i) for i, f in enumerate(batch.schema) if f.name != drop]
    return pa.RecordBatch.from_arrays([*held, pa.array(made, kind)], schema=schema)


def _mapped(df: DataFrame, source: str, target: str, kind: str, each, drop: bool) -> DataFrame:
    """``df`` with ``target`` = each(source), some megabytes of ``source`` at a time; without ``source`` if ``drop``."""
    if target in df.columns:
        raise ValueError(f"there is a column {target} already")
    arrow = {"binary": pa.binary(), "string": pa.string()}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = [f for f in batch.schema if not (drop and f.name == source)]
            schema = pa.schema([*fields, pa.field(target, arrow)])
            for first, some in chunks(batch, source):
                yield _added(batch.slice(first, len(some)), [*map(each, some)], arrow, schema, source if drop else None)

    kept = [f"`{n}` {t}" for n, t in df.dtypes if not (drop and n == source)]
    return df.mapInArrow(run, ", ".join([*kept, f"`{target}` {kind}"]))


def encode(df: DataFrame, text: str = "text", model: str | None = None, ids: str = "ids", begin: bool = True, end: bool = True, keep_text: bool = False) -> DataFrame:
    """``df`` with the column ``ids`` (little-endian 32-bit unsigned integers) in place of its text (beside it if ``keep_text``).

    A null or empty text has no ids but begin and end. Other columns stay as they are, whatever they are named; a column that is named as ``ids`` is an
    error. Every row is encoded by itself, whole.
    """
    path = model or public_tokenizers.path(MODEL)

    def each(data: bytes | None) -> bytes:
        p = pieces(path)
        v, found = p.vocabulary, p.encode(data.decode() if data else None).astype("<u4").tobytes()
        one = lambda i: i.to_bytes(4, "little")
        return (one(v.begin) if begin else b"") + found + (one(v.end) if end else b"")

    return _mapped(df, text, ids, "binary", each, not keep_text)


def decode(df: DataFrame, ids: str = "ids", model: str | None = None, text: str = "decoded", keep_ids: bool = True) -> DataFrame:
    """``df`` with the column ``text`` of ``ids``, which may be any ids of the model; null ids give an empty text."""
    path = model or public_tokenizers.path(MODEL)
    return _mapped(df, ids, text, "string", lambda data: pieces(path).decode(np.frombuffer(data or b"", "<u4")), not keep_ids)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
