"""Spans of repeated text: what operators 4 and 10 share.

A window is ``size`` consecutive words of one text. Its anchor is its smallest ``gram``-word hash, so equal windows have
equal anchors wherever they are. Consecutive windows with one anchor are a span: at most size - gram + 1 windows. Two
spans of equal words repeat each other as a whole; that settles nearly all repeated text at one row a span, about one
word in twelve. Where an anchor repeats and its span doesn't, the text is read again and single windows are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrace.llm.common import U, WordHashes, Words, chunks, columns, join_counted, made_of, materialize, mix, record, signed, sliding_min, window_hashes

#: Spans that a task gathers before it combines equal ones.
COMBINE = 1 << 20
SPAN = "fp long, span long, doc_id long, loc long, settled boolean"
SPAN_SCHEMA = pa.schema([("fp", pa.int64()), ("span", pa.int64()), ("doc_id", pa.int64()), ("loc", pa.int64()), ("settled", pa.bool_())])


def place(start, count, many):
    """One integer: first window, windows (under 256), whether the span is known to repeat."""
    return start << 9 | count << 1 | many


def text_spans(words: Words, size: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, fp, span, first window within the text, windows) of every span."""
    n = len(words.hashes)
    empty = np.zeros(0, np.int64)
    if n < size:
        return empty, empty.view(U), empty.view(U), empty, empty
    owner = words.owner()
    inside = owner[: n - size + 1] == owner[size - 1 :]
    grams = window_hashes(words.hashes, gram)
    low = U((1 << 24) - 1)
    at = np.arange(len(grams), dtype=np.int64)
    least = sliding_min((grams & ~low) | (at.view(U) & low), size - gram + 1)
    starts = np.flatnonzero(inside)
    if not len(starts):
        return empty, empty.view(U), empty.view(U), empty, empty
    anchor = starts + (((least[starts] & low).astype(np.int64) - starts) & ((1 << 24) - 1))
    whole = window_hashes(words.hashes, size)
    own = owner[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    a, b = starts[first], starts[first + count - 1]
    span = mix(whole[a] * U(0x9E3779B97F4A7C15) + mix(whole[b] + U(0x632BE5AB)) + count.astype(U))
    own = own[first]
    return own, mix(grams[anchor[first]] + U(0x2545F491)), span, a - words.starts[own], count


def scan_spans(size: int, gram: int):
    """mapInArrow over (doc_id, text): rows of spans. Equal spans of one gathering are combined: one row stands for them,
    marked as repeating, and each of their places is sent as a settled row, with a key of its own. So a passage in a third of all documents
    comes from each task a few times only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, held, total = WordHashes(), [], 0

        def combined():
            fp, span, doc, known, start, count = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((span, fp))
            fp, span, doc, known, start, count = (x[order] for x in (fp, span, doc, known, start, count))
            new = np.ones(len(fp), bool)
            new[1:] = (fp[1:] != fp[:-1]) | (span[1:] != span[:-1])
            group = np.cumsum(new) - 1
            many = np.bincount(group)[group] > 1
            yield from sent(fp[new], span[new], doc[new], known[new], place(start, count, many.astype(np.int64))[new], False)
            some = many & known
            if some.any():
                yield from sent(mix(doc[some].view(U) * U(31) + start[some].view(U)), span[some], doc[some], known[some], place(start, count, 1)[some], True)

        def sent(fp, span, doc, known, loc, settled):
            for i in range(0, len(fp), 100_000):
                s = slice(i, i + 100_000)
                yield record(SPAN_SCHEMA, signed(np.ascontiguousarray(fp[s])), signed(np.ascontiguousarray(span[s])), pa.array(doc[s], pa.int64(), mask=~known[s]), loc[s], np.full(len(fp[s]), settled))

        for batch in batches:
            ids, known = columns(batch, "doc_id"), np.asarray(batch.column("doc_id").is_valid())
            for first, texts in chunks(batch):
                own, fp, span, start, count = text_spans(Words(texts, cache), size, gram)
                held.append((fp, span, ids[first + own], known[first + own], start, count))
                total += len(fp)
                if total >= COMBINE:
                    yield from combined()
                    total = 0
        if held:
            yield from combined()

    return run


def classified(rows: DataFrame) -> DataFrame:
    """Rows of spans with ``total`` (times that the span is known to occur, 2 for many) and ``pick`` (1 on one row of each span).
    Equal spans come from each scanning task once, so no span has more rows than there are such gatherings."""
    one = W.partitionBy("fp", "span")
    return rows.withColumn("total", F.sum(F.expr("1 + (loc & 1)")).over(one)).withColumn("pick", F.row_number().over(one.orderBy("doc_id", "loc")))


def keyed(docs: DataFrame, text: str, keep: list[str] = []) -> DataFrame:  # noqa: B006
    """(doc_id, id, text): ``id`` is the doc_id as it came, ``doc_id`` a key of the row, from 64 bits of its id and text. Rows that agree in both share it,
    and as they have the same words, what is found in one is right for the other."""
    t = F.col(text).cast("string")
    return docs.select(F.xxhash64(F.col("doc_id").cast("long"), t).alias("doc_id"), F.col("doc_id").cast("long").alias("id"), t.alias("text"), *keep)


def _single_windows(size: int):
    """Rows (doc_id, id, text, asked: array of (fp, loc, once)) to (fp, window, doc_id, start, once)."""
    schema = pa.schema([("fp", pa.int64()), ("window", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("once", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for first, texts in chunks(batch):
                words = Words(texts, cache)
                whole = window_hashes(words.hashes, size)
                asked = batch.column("asked").slice(first, len(texts))
                for i, x in enumerate(asked):
                    if not x.is_valid or not len(x):
                        continue
                    doc, begin, end = batch.column("doc_id")[first + i].as_py(), words.starts[i], words.starts[i + 1]
                    fp, loc, once = (np.asarray(x.values.field(k)) for k in range(3))
                    count, start = loc >> 1 & 255, loc >> 9
                    at = np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())
                    ok = begin + at + size <= end
                    if ok.any():
                        at = at[ok]
                        yield record(schema, np.repeat(fp, count)[ok], signed(np.ascontiguousarray(whole[begin + at])), np.full(len(at), doc), at, np.repeat(once, count)[ok])

    return run


def repeated_places(docs: DataFrame, spans: DataFrame, size: int) -> DataFrame:
    """(doc_id, loc) of windows that occur twice or more, from ``classified`` rows of spans whose anchors repeat (a written table).

    One row of each span is asked for its windows where the anchor has another span, and one that occurs once. Anchors with very many
    spans, and windows in very many of them, are counted before anything is shuffled by them. ``remove`` deletes the table of windows that the result reads, and ``spans``."""
    whole = spans.where("total > 1 and loc & 1 = 0").select("doc_id", "loc")
    picked = spans.where("pick = 1").select("fp", "span", "doc_id", "loc", "total")
    anchors = picked.groupBy("fp").agg(F.min("span").alias("low"), F.max("span").alias("high"), F.min("total").alias("least"), F.count("*").alias("held"))
    asked = join_counted(picked, anchors.where("low <> high and least = 1").select("fp", "held"), ["fp"], spans.count())
    asked = asked.groupBy("doc_id").agg(F.collect_list(F.struct("fp", "loc", (F.col("total") == 1).alias("once"))).alias("asked"))
    # a left join, so that Spark can use the exchange of the texts again
    read = docs.join(asked, "doc_id", "left").withColumn("text", F.when(F.size("asked") > 0, F.col("text")))
    windows = materialize(read.mapInArrow(_single_windows(size), "fp long, window long, doc_id long, start long, once boolean"), "windows")
    twice = windows.groupBy("fp", "window").agg(F.count("*").alias("held")).where("held > 1")
    found = join_counted(windows.where("once"), twice, ["fp", "window"], windows.count())
    return made_of(whole.union(found.select("doc_id", F.expr("start << 9 | 2L"))), spans, windows)


def covered(n: int, locs: np.ndarray, size: int) -> np.ndarray:
    """Which of n words the windows at ``locs`` cover."""
    edge = np.zeros(n + 1, np.int64)
    start, count = locs >> 9, locs >> 1 & 255
    ok = start + count + size - 1 <= n
    np.add.at(edge, start[ok], 1)
    np.add.at(edge, start[ok] + count[ok] + size - 1, -1)
    return np.cumsum(edge[:-1]) > 0
