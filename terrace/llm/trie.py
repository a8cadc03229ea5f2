"""Operator 13, a prefix trie of conversations.

A node is a sequence of turns; its key is a hash of 128 bits, made of its parent's key and its last turn. Each task walks its conversations turn by
turn and adds them up in a table of nodes of its own, a partial trie. Partial tries are merged by key, FAN of them at a time, round after
round: members are summed, end lists are gathered in blocks of ids. What concerns subtrees is rolled up in rounds that double their
reach, by ancestors at distances 1, 2, 4, ..., which a node knows from the walk. Nodes of a single conversation need no rolling up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrace.llm.common import join_counted, materialize, record, remove, table

#: Conversations share turns within families of so many ids; a conversation takes over fewer than INHERITED turns.
FAMILY, INHERITED = 5, 9
KEY = 16
ROOT = bytes(KEY)
#: Partial tries that a round merges; nodes and ends that a partial trie holds before it is put out; a block of ids is 2**BLOCK wide.
FAN, HELD, BLOCK = 256, 100_000, 14

PARTIAL = "part int, key binary, parent binary, depth long, size long, n long, least long, ends array<long>, ups array<binary>"
PARTIAL_SCHEMA = pa.schema([("part", pa.int32()), ("key", pa.binary()), ("parent", pa.binary()), *[(x, pa.int64()) for x in ("depth", "size", "n", "least")], ("ends", pa.list_(pa.int64())), ("ups", pa.list_(pa.binary()))])


def inherited(conv: Column) -> Column:
    """How many turns a conversation takes over at most."""
    return F.crc32(conv.cast("string").cast("binary")) % INHERITED


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, step, pos, role, text): each conversation with the first turns of its family's first one in place of as many of its own.

    Turns go by (turn, role, text), null first. step is 0 for a row that only begins a conversation, 1 for turns taken over, 2 for its own ones; rows are in no order. Null roles and
    texts are empty. Rows without a conv_id are left out. Columns beside conv_id, turn, role and text are not read."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
    pos = F.row_number().over(W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    own = turns.select("conv_id", pos.alias("pos"), "role", "text")
    ids = own.where("pos = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("first"), inherited(F.col("conv_id")).alias("h"))
    heads = own.where((F.col("pos") < INHERITED) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "first")
    step = lambda k: F.lit(k).alias("step")
    begin = ids.select("conv_id", step(0), F.lit(0).alias("pos"), F.lit("").alias("role"), F.lit("").alias("text"))
    over = ids.join(heads, "first").where("pos <= h").select("conv_id", step(1), "pos", "role", "text")
    return begin.unionByName(over).unionByName(own.where(F.col("pos") > inherited(F.col("conv_id"))).select("conv_id", step(2), "pos", "role", "text"))


def child_key(parent: bytes, role: bytes, text: bytes) -> bytes:
    return xxhash.xxh3_128_digest(b"%b%d:%b%b" % (parent, len(role), role, text))


class PartialTrie:
    """Nodes of some conversations: key -> [parent, depth, bytes of the last text, members, least member, ends, ancestors at 1, 2, 4, ...].

    They can be put out at any time, in the middle of a conversation too: what comes later adds up with what went out."""

    def __init__(self):
        self.nodes: dict[bytes, list] = {}
        self.path = bytearray()  # the keys from the root on
        self.conv: int | None = None
        self.size = self.ends = 0

    def _node(self) -> list:
        """The node that the path ends at."""
        key = bytes(self.path[-KEY:])
        node = self.nodes.get(key)
        if node is None:
            at = len(self.path) - KEY
            ups = [bytes(self.path[at - (KEY << k) : at - (KEY << k) + KEY]) for k in range((at // KEY).bit_length())]
            node = self.nodes[key] = [ups[0] if ups else None, at // KEY, self.size, 0, self.conv, [], ups]
        return node

    def _enter(self, key: bytes, size: int) -> None:
        self.path += key
        self.size = size
        node = self._node()
        node[3] += 1
        node[4] = min(node[4], self.conv)

    def begin(self, conv: int) -> None:
        self.finish()
        self.conv = conv
        self._enter(ROOT, 0)

    def turn(self, role: bytes, text: bytes) -> None:
        self._enter(child_key(bytes(self.path[-KEY:]), role, text), len(text))

    def finish(self) -> None:
        if self.path:
            self._node()[5].append(self.conv)
            self.ends += 1
            self.path = bytearray()

    def take(self) -> list[tuple]:
        out = [(k, *v) for k, v in self.nodes.items()]
        self.nodes, self.ends = {}, 0
        return out


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie, part = PartialTrie(), TaskContext.get().partitionId()

    def put_out():
        rows = trie.take()
        for at in range(0, len(rows), 10_000):
            some = rows[at : at + 10_000]
            yield record(PARTIAL_SCHEMA, [part] * len(some), *[list(x) for x in zip(*some, strict=True)])

    for batch in batches:
        role, text = (batch.column(c).cast(pa.binary()) for c in ("role", "text"))
        for i, (conv, step) in enumerate(zip(batch.column("conv_id").to_pylist(), batch.column("step").to_pylist(), strict=True)):
            if step:
                trie.turn(role[i].as_py(), text[i].as_py())
            else:
                trie.begin(conv)
            if len(trie.nodes) + trie.ends >= HELD:
                yield from put_out()
    trie.finish()
    yield from put_out()


def partial_tries(turns: DataFrame) -> DataFrame:
    """Nodes as each task has added them up, with the number of the task (part). A conversation's turns pass through one task in order; it holds a key of 16 bytes for each of them and at most HELD nodes
    besides."""
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return turns.repartition(n, "conv_id").sortWithinPartitions("conv_id", "step", "pos").drop("pos").mapInArrow(_partials, PARTIAL)


def merged(partials: DataFrame, parts: int) -> DataFrame:
    """One row per key: (key, parent, depth, size, n, least, n_ends, ups). Each round merges the tries of FAN neighbouring parts."""
    nodes = partials.withColumn("n_ends", F.size("ends").cast("long")).drop("ends")
    same = [F.first(c).alias(c) for c in ("parent", "depth", "size", "ups")]
    while True:
        nodes = nodes.withColumn("part", (F.col("part") / FAN).cast("int"))
        nodes = nodes.groupBy("key", "part").agg(*same, *[F.sum(c).alias(c) for c in ("n", "n_ends")], F.min("least").alias("least"))
        parts = -(-parts // FAN)
        if parts <= 1:
            return nodes.drop("part")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of ids in the order of key and ids to the hash of each key's list; a block at a time."""
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    key = digest = None
    for batch in batches:
        done = []
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            text = ",".join(map(str, ids)).encode()
            if k == key:
                digest.update(b"," + text)
                continue
            if key is not None:
                done.append((key, digest.hexdigest()))
            key, digest = k, hashlib.sha256(text)
        if done:
            yield record(schema, *[list(x) for x in zip(*done, strict=True)])
    if key is not None:
        yield record(schema, [key], [digest.hexdigest()])


def end_lists(partials: DataFrame) -> DataFrame:
    """(key, ends_sha256): the hash of the ids, in order, of the conversations that end at a node, without nodes where none ends. Lists are gathered in blocks of at most 2**BLOCK ids; a
    list of any length passes through a task block by block, as its hash can't be made of parts."""
    ends = partials.where(F.size("ends") > 0).select("key", F.explode("ends").alias("id"))
    blocks = ends.groupBy("key", F.shiftright("id", BLOCK).alias("block")).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return blocks.repartition("key").sortWithinPartitions("key", "block").select("key", "ids").mapInArrow(_hashed, "key binary, ends_sha256 string")


def rolled_up(nodes: DataFrame) -> DataFrame:
    """(key, n_leaves, saved) of ``nodes`` (key, ups, depth, n_leaves, saved) with those of all nodes below. Round k adds what stands 2**k below, which has
    by then gathered what is less than 2**k below it."""
    spark, deepest = nodes.sparkSession, nodes.agg(F.max("depth")).first()[0] or 0
    sums = ["n_leaves", "saved"]
    at = materialize(nodes.select("key", "ups", *sums), "rollup")
    for k in range(deepest.bit_length()):
        given = at.select(F.get("ups", F.lit(k)).alias("key"), *sums).where("key is not null").groupBy("key").agg(*[F.sum(c).alias(f"more_{c}") for c in sums])
        new = at.join(given, "key", "left").select("key", "ups", *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in sums])
        new = materialize(new, "rollup")
        remove(spark, at)
        at = new
    return at.drop("ups")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, key, parent: one row per node.

    The root is the empty sequence; a conversation of no turns is a member of it alone. Without conversations there are no nodes. Turns that agree in role and
    text are the same whatever their number; rows that agree in all of conv_id, turn, role and text are turns of their own, one after the other. Nulls and other columns: see ``rebuilt``.
    """
    partials = materialize(partial_tries(rebuilt(conversations)), "partials")
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nodes = materialize(merged(partials, parts), "nodes")
    # a node of one conversation: one child or none, one leaf below, nothing saved; of others the children are counted
    below = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"), F.count_if(F.col("n") == 1).alias("single"))
    shared = nodes.where("n > 1").join(below, "key", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_children", "single")})
    shared = materialize(shared.withColumns({"n_leaves": F.col("single") + (F.col("n_children") == 0).cast("long"), "saved": (F.col("n") - 1) * F.col("size")}), "shared")
    of_shared = shared.drop("n_leaves", "saved", "single", "size", "ups").join(rolled_up(shared), "key")
    alone = nodes.where("n = 1").drop("size", "ups").withColumns({"n_children": 1 - F.col("n_ends"), "n_leaves": F.lit(1).cast("long"), "saved": F.lit(0).cast("long")})
    columns = ["key", "parent", "depth", "n", "least", "n_children", "n_leaves", "saved"]
    counted = materialize(of_shared.select(*columns).unionByName(alone.select(*columns)), "counted")
    above = counted.where("n_children > 0").select(F.col("key").alias("parent"), F.col("least").alias("parent_conv_id"), F.col("n_children").alias("held"))
    named = join_counted(counted.where("parent is not null"), above, ["parent"], counted.count())
    named = named.unionByName(counted.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long")))
    nothing = F.lit(hashlib.sha256().hexdigest())
    return named.join(end_lists(partials), "key", "left").select(F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"), "key", "parent")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations")).drop("key", "parent")
