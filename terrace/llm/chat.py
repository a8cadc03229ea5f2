"""Operator 9, chat formatting by quotation linking.

Lines of a message that begin with ">" are quoted; the number of marks is the level. Runs of lines of one level are
passages. The words of a passage, without case and spacing, are hashed, as are the passages, paragraphs and lines that
messages wrote themselves. A quoted passage belongs to the last earlier message of its conversation that wrote it;
messages answer the one that they quote most words of at level 1, or the first of higher levels that is found. Answers and what they
answer are a thread; the result orders messages by thread and turn, without the quotes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrace.llm.common import materialize, record, table

QUOTED = re.compile(r"[ \t]{0,3}((?:>[ \t]?)+)(.*)", re.S)
#: Lines such as "X wrote:" right before a quote belong to it.
INTRODUCTION = re.compile(r"\b(?:wrote|schrieb|écrit|escribió)\s*:\s*$", re.I)


def parse(text: str | None) -> list[tuple[int, list[str]]]:
    """(level, lines) of runs of lines of one quote level, in order."""
    lines = []
    for line in (text or "").split("\n"):
        m = QUOTED.fullmatch(line)
        lines.append((m[1].count(">"), m[2]) if m else (0, line))
    return [(level, [x for _, x in run]) for level, run in groupby(lines, key=lambda x: x[0])]


def unquoted(text: str | None) -> str:
    """The message without quoted lines and without lines that introduce a quote."""
    runs, kept = parse(text), []
    for i, (level, lines) in enumerate(runs):
        if level:
            continue
        if i + 1 < len(runs) and runs[i + 1][0]:
            last = max((k for k, x in enumerate(lines) if x.strip()), default=None)
            if last is not None and INTRODUCTION.search(lines[last]):
                lines = lines[:last]
        kept.extend(lines)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(kept)).strip() if len(runs) > 1 or (runs and runs[0][0]) else (text or "")


def digest(lines: list[str]) -> tuple[int, int]:
    """(hash, words) of a passage, by its words in lower case."""
    words = " ".join(lines).lower().split()
    return xxhash.xxh3_64_intdigest(" ".join(words)) - (1 << 63), len(words)


def own_passages(text: str) -> set[tuple[int, int]]:
    """Digests of the whole, the paragraphs and the lines that a message wrote."""
    lines = text.split("\n")
    paragraphs = [list(run) for blank, run in groupby(lines, key=lambda x: not x.strip()) if not blank]
    return {d for part in [lines, *paragraphs, *([x] for x in lines)] if (d := digest(part))[1]}


MESSAGE = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("n_quoted", pa.int64())])
PASSAGE = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("level", pa.int64()), ("hash", pa.int64()), ("words", pa.int64())])


def _messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        quoted = [sum(len(lines) for level, lines in parse(t) if level) if t and ">" in t else 0 for t in texts]
        yield record(MESSAGE, batch.column("conv_id"), batch.column("turn"), batch.column("role"), [(unquoted(t) if q else t or "") for t, q in zip(texts, quoted, strict=True)], quoted)


def _passages(own: bool):
    """Level 0: what messages wrote; others: what they quote, passage by passage, each line by itself too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, turn, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "text")), strict=True):
                if conv is None or turn is None or not text:
                    continue
                if own:
                    rows.extend((conv, turn, 0, *d) for d in own_passages(unquoted(text)))
                elif ">" in text:
                    for level, lines in parse(text):
                        parts = [x for x in lines if x.strip()] if level else []
                        found = {digest(parts), *(digest([x]) for x in parts)} if parts else set()
                        rows.extend((conv, turn, level, *d) for d in found if d[1])
            if rows:
                yield record(PASSAGE, *[list(x) for x in zip(*rows, strict=True)])

    return run


def link_replies(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to) of messages that quote an earlier one of their conversation."""
    m = messages.select(*(F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")), F.col("text").cast("string").alias("text"))
    kinds = "conv_id long, turn long, level long, hash long, words long"
    quotes = m.where("text like '%>%'").mapInArrow(_passages(False), kinds).distinct()
    quotes = materialize(quotes, "quotes")
    wanted = quotes.select("conv_id", "hash").distinct()
    wrote = m.mapInArrow(_passages(True), kinds).join(wanted, ["conv_id", "hash"], "left_semi").select("conv_id", "hash", "turn").distinct()
    # the last earlier writer of each quoted passage: one pass over writers and quoters in the order of turns
    both = wrote.select("conv_id", "hash", "turn", F.lit(0).alias("level"), F.lit(0).alias("words"), F.col("turn").alias("writer")).unionByName(quotes.select("conv_id", "hash", "turn", "level", "words", F.lit(None).cast("long").alias("writer")))
    earlier = W.partitionBy("conv_id", "hash").orderBy("turn").rangeBetween(W.unboundedPreceding, -1)
    linked = both.withColumn("found", F.max("writer").over(earlier)).where("level > 0 and found is not null")
    by_level = linked.groupBy("conv_id", "turn", "level", "found").agg(F.sum("words").alias("words"))
    best = F.min(F.struct("level", (-F.col("words")).alias("w"), (-F.col("found")).alias("f"), "found"))
    return by_level.groupBy("conv_id", "turn").agg(best.alias("b")).select("conv_id", "turn", F.col("b.found").alias("reply_to"))


def threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, thread): the first message that a chain of replies leads to, by doubling the steps each round."""
    at = materialize(links.select("conv_id", "turn", F.col("reply_to").alias("thread")), "threads")
    while True:
        up = at.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("higher"))
        new = materialize(at.join(up, ["conv_id", "thread"], "left").select("conv_id", "turn", F.coalesce("higher", "thread").alias("thread"), F.col("higher").isNotNull().alias("moved")), "threads")
        at = new.drop("moved")
        if new.where("moved").isEmpty():
            return at


def build_conversations(messages: DataFrame) -> DataFrame:
    """conv_id, thread, turn, role, text (without quotes), reply_to, n_quoted (lines): one row per message.

    ``orderBy("conv_id", "thread", "turn")`` is the reply order: a thread is named by the turn it starts with, and an answer has
    a later turn than what it answers. A message that quotes nothing found has a null reply_to and its own thread. Null
    and empty texts become "" and link nothing; null conv_id or turn stay as they are and link nothing. Rows that share
    conv_id and turn are each kept and share links. Other columns are not read.
    """
    m = messages.select(*(F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")), *(F.col(c).cast("string").alias(c) for c in ("role", "text")))
    links = materialize(link_replies(m), "links")
    chains = links.join(threads(links), ["conv_id", "turn"])
    clean = m.mapInArrow(_messages, "conv_id long, turn long, role string, text string, n_quoted long")
    return clean.join(chains, ["conv_id", "turn"], "left").select("conv_id", F.coalesce("thread", "turn").alias("thread"), "turn", "role", "text", "reply_to", "n_quoted")


def op9_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_conversations(table(spark, sf_dir, "conversations"))
