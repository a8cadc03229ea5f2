"""Operator 3, n-gram Jaccard join by prefix trees.

Documents link when their sets of word shingles have a Jaccard similarity of at least num/den; the result is each
document's connected component. Steps, each a table in the checkpoint folder:

1. sets: (doc_id, size, signature). Equal sets are one class from here on, with its smallest doc_id.
2. A partner of a set with n shingles shares at least need(n) = ceil(n * num / den) of them. A quarter of all hash values
   is watched: if more than n - need(n) of a set's watched shingles occur in no other document, it has no partner and
   leaves. That is exact, and takes out nearly all documents that have no near copy.
3. What stays is ordered by one global order (rarer by a fixed-size count sketch first, then by hash), and two sets can
   only link if they share a shingle among the first n - need(n) + 1 of both. Sets that share one and have compatible
   sizes are chained; connected chains are blocks, and blocks over a bound are cut into pairs of smaller ones.
4. In each block the sets go into a prefix tree, most common shingles first; each set walks the tree once, sharing
   partial overlaps, and leaves subtrees whose remaining lengths cannot reach the threshold or whose sets it is
   already connected to. The tree gives exact overlaps.

Shingles are 64-bit hashes and classes 128-bit digests with their size: results are exact but for collisions of these.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrace.llm.common import U, WordHashes, chunks, columns, join_counted, made_of, materialize, mix, record, remove, signed, table
from terrace.llm.components import Forest, connected_components
from terrace.llm.shingles import shingle_sets, signatures

#: Hash values below this are watched in step 2.
WATCHED = U(1 << 62)
#: Cells of the count sketch (4 bytes each) and bits of the filter of classes, whatever the input: 16 and 8 MB. Tables travel in chunks.
SKETCH_CELLS, FILTER_BITS, CHUNK_CELLS = 1 << 22, 1 << 26, 1 << 16
#: Shingles in a block.
BLOCK_SHINGLES = 1 << 18

SETS = "doc_id long, n_shingles long, sig long, sig2 long"
SETS_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("sig", pa.int64()), ("sig2", pa.int64())])


def need(n: int | np.ndarray, num: int, den: int):
    """Least overlap that a set of n shingles has with any set that it links with."""
    return -(-n * num // den)


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for first, texts in chunks(batch):
                h, starts = shingle_sets(texts, size, cache)
                yield record(SETS_SCHEMA, batch.column("doc_id").slice(first, len(texts)), np.diff(starts), *signatures(h, starts))

    return run


def _watched(size: int):
    """(shingle, signature of its set) of watched shingles; one that a chunk has in several rows is sent once, with a null sig."""
    schema = pa.schema([("shingle", pa.int64()), ("sig", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            known = np.asarray(batch.column("doc_id").is_valid())
            for first, texts in chunks(batch):
                h, starts = shingle_sets(texts, size, cache)
                sig = signatures(h, starts)[0]
                own = np.repeat(np.arange(len(texts)), np.diff(starts))
                some = h < WATCHED
                h, own = h[some], own[some]
                shingle, at, count = np.unique(h, return_index=True, return_counts=True)
                own = own[at]
                yield record(schema, signed(shingle), pa.array(sig[own], pa.int64(), mask=(count > 1) | ~known[first + own]))

    return run


def _lonely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by shingle: (sig, how many of its shingles have one row only). Such a shingle is in one set, of one row."""
    schema = pa.schema([("sig", pa.int64()), ("n", pa.int64())])
    last_key = last_sig = None  # the last row, if its shingle may go on
    last_alone = False

    def out(sigs):
        return record(schema, *np.unique(sigs, return_counts=True))

    for batch in batches:
        if not batch.num_rows:
            continue
        key, sig = batch.column("shingle").to_numpy(), columns(batch, "sig")
        valid = np.asarray(batch.column("sig").is_valid())
        same = key[1:] == key[:-1]
        alone = valid.copy()
        alone[1:] &= ~same
        alone[:-1] &= ~same
        if last_key is not None:
            if key[0] == last_key:
                alone[0] = False
            elif last_alone:
                yield out(np.array([last_sig]))
        last_key, last_sig, last_alone = int(key[-1]), int(sig[-1]), bool(alone[-1])
        alone[-1] = False
        if alone.any():
            yield out(sig[alone])
    if last_key is not None and last_alone:
        yield out(np.array([last_sig]))


MEMBER = "doc_id long, sig long, sig2 long, shingles binary"
MEMBER_SCHEMA = pa.schema([("doc_id", pa.int64()), ("sig", pa.int64()), ("sig2", pa.int64()), ("shingles", pa.binary())])


def _places(ids: np.ndarray) -> list[np.ndarray]:
    """Bits of a document in the filter of classes."""
    h = mix(ids.view(U) + U(0x9E3779B9))
    return [(h >> U(s) & U(FILTER_BITS - 1)).astype(np.int64) for s in (0, 32)]


def _passes(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([bits[p >> 3] >> (p & 7).astype(np.uint8) & 1 for p in _places(ids)]).astype(bool)


def _members(size: int, classes):
    """Sets of the documents that the filter of classes lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            batch = batch.filter(pa.array(_passes(classes.value, columns(batch, "doc_id"))))
            for first, texts in chunks(batch):
                h, starts = shingle_sets(texts, size, cache)
                parts = [h[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
                yield record(MEMBER_SCHEMA, batch.column("doc_id").slice(first, len(texts)), *signatures(h, starts), [x.tobytes() for x in parts])

    return run


def _cell(h: np.ndarray, cells: int) -> np.ndarray:
    return (mix(h) % U(cells)).astype(np.int64)


TABLE = "chunk long, cells binary"
TABLE_SCHEMA = pa.schema([("chunk", pa.int64()), ("cells", pa.binary())])


def _sent(cells: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(cells), CHUNK_CELLS):
        if (part := cells[i : i + CHUNK_CELLS]).any():
            yield record(TABLE_SCHEMA, [i // CHUNK_CELLS], [zlib.compress(part.tobytes(), 1)])


def _sketch(cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, np.uint32)
        for batch in batches:
            for x in batch.column("shingles"):
                np.add.at(counts, _cell(np.frombuffer(x.as_py(), U), cells), 1)
        yield from _sent(counts)

    return run


def _class_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for batch in batches:
        for p in _places(columns(batch, "doc_id")):
            np.bitwise_or.at(bits, p >> 3, (1 << (p & 7)).astype(np.uint8))
    yield from _sent(bits)


def _merged(kind, join):
    """Chunks of tables, sorted by chunk, joined to one of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for c, x in zip(batch.column("chunk").to_pylist(), batch.column("cells"), strict=True):
                part = np.frombuffer(zlib.decompress(x.as_py()), kind)
                if c != at and at is not None:
                    yield record(TABLE_SCHEMA, [at], [total.tobytes()])
                total = part if c != at else join(total, part)
                at = c
        if at is not None:
            yield record(TABLE_SCHEMA, [at], [total.tobytes()])

    return run


def _saturating(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.minimum(x.astype(np.uint64) + y, 0xFFFFFFFF).astype(np.uint32)


def fixed_table(rows: DataFrame, n: int, kind, join):
    """A broadcast array of n cells from tasks' tables (mapInArrow rows of TABLE): its size doesn't depend on the input."""
    joined = rows.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_merged(kind, join), TABLE)
    cells = np.zeros(n, kind)
    for row in joined.toLocalIterator():
        cells[row["chunk"] * CHUNK_CELLS : (row["chunk"] + 1) * CHUNK_CELLS] = np.frombuffer(row["cells"], kind)
    return rows.sparkSession.sparkContext.broadcast(cells)


def ordered(h: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Keys that sort shingles by the global order: rarity class by the sketch (six bits), then hash."""
    count = sketch[_cell(h, len(sketch))]
    return (np.ceil(np.log2(count + 1.0)).astype(U) << U(58)) | (h >> U(6))


POST_SCHEMA = pa.schema([("key", pa.int64()), ("doc_id", pa.int64())])


def _postings(sketch, num: int, den: int):
    """key: 40 bits of the shingle, then the size of the set in 24 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for batch in batches:
            keys, docs = [], []
            for doc, x in zip(batch.column("doc_id").to_pylist(), batch.column("shingles"), strict=True):
                h = np.frombuffer(x.as_py(), U)
                n = len(h)
                first = n - need(n, num, den) + 1
                o = ordered(h, counts)
                o = np.partition(o, first - 1)[:first] if first < n else o
                keys.append((mix(o) >> U(24) << U(24)) | U(min(n, (1 << 24) - 1)))
                docs.append(np.full(len(o), doc))
            if keys:
                yield record(POST_SCHEMA, signed(np.concatenate(keys)), np.concatenate(docs))

    return run


def _chains(num: int, den: int):
    """From postings sorted by key and doc_id: neighbours with one shingle and compatible sizes."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_doc = np.zeros(0, U), np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.concatenate([held_key, batch.column("key").to_numpy().view(U)])
            doc = np.concatenate([held_doc, batch.column("doc_id").to_numpy()])
            size = (key & U((1 << 24) - 1)).astype(np.int64)
            link = (key[1:] >> U(24) == key[:-1] >> U(24)) & (doc[1:] != doc[:-1]) & (np.minimum(size[1:], size[:-1]) * den >= np.maximum(size[1:], size[:-1]) * num)
            if link.any():
                a, b = doc[:-1][link], doc[1:][link]
                pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
                yield record(schema, pairs[0], pairs[1])
            held_key, held_doc = key[-1:], doc[-1:]

    return run


class Node:
    __slots__ = ("seg", "kids", "ends", "least", "most", "longest", "one", "mixed")

    def __init__(self, seg, size, length, member):
        self.seg, self.kids, self.ends = seg, {}, []
        self.least = self.most = size
        self.longest, self.one, self.mixed = length, member, False

    def holds(self, size, length, member, forest):
        self.least, self.most, self.longest = min(self.least, size), max(self.most, size), max(self.longest, length)
        self.mixed = self.mixed or forest.find(self.one) != forest.find(member)


def trie_links(sets: list[np.ndarray], num: int, den: int) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) of linked sets that together connect whatever links connect. Sets are arrays of distinct values.

    Values are ordered by how many of the sets hold them, most first. Values of a single set can't match and only
    count as length.
    """
    if len(sets) < 2:
        return
    every, back, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(every), np.int64)
    rank[np.lexsort((every, -count))] = np.arange(len(every))
    live = int((count > 1).sum())
    ids = rank[back]
    cuts = np.cumsum([len(x) for x in sets])[:-1]
    lists = [np.sort(x[x < live]) for x in np.split(ids, cuts)]
    forest, root = Forest(), None
    marked = np.zeros(live + 1, np.int64)
    for i in sorted(range(len(sets)), key=lambda i: (len(sets[i]), i)):
        y, size = lists[i], len(sets[i])
        if root is not None:
            marked[y] = 1
            stack = [(root, 0, 0)]
            while stack:
                node, overlap, depth = stack.pop()
                if not node.mixed and forest.find(node.one) == forest.find(i):
                    continue
                if node.most * den < size * num or size * den < node.least * num:
                    continue
                if len(node.seg):
                    overlap += int(marked[node.seg].sum())
                    depth += len(node.seg)
                    rest = len(y) - int(np.searchsorted(y, node.seg[-1], "right"))
                else:
                    rest = len(y)
                if (overlap + min(node.longest - depth, rest)) * (num + den) < num * (size + node.least):
                    continue
                for j in node.ends:
                    if forest.find(i) != forest.find(j) and overlap * (num + den) >= num * (size + len(sets[j])):
                        forest.union(i, j)
                        yield i, j
                stack.extend((kid, overlap, depth) for kid in node.kids.values())
            marked[y] = 0
        # insert
        if root is None:
            root = Node(y[:0], size, len(y), i)
        node, at = root, 0
        root.holds(size, len(y), i, forest)
        while True:
            if at == len(y):
                node.ends.append(i)
                break
            kid = node.kids.get(first := int(y[at]))
            if kid is None:
                node.kids[first] = leaf = Node(y[at:], size, len(y), i)
                leaf.ends.append(i)
                break
            n = min(len(kid.seg), len(y) - at)
            differ = np.flatnonzero(kid.seg[:n] != y[at : at + n])
            same = int(differ[0]) if len(differ) else n
            if same < len(kid.seg):
                upper = Node(kid.seg[:same], kid.least, kid.longest, kid.one)
                upper.most, upper.mixed = kid.most, kid.mixed
                kid.seg = kid.seg[same:]
                upper.kids[int(kid.seg[0])] = kid
                node.kids[first] = kid = upper
            kid.holds(size, len(y), i, forest)
            node, at = kid, at + same


def _join_blocks(num: int, den: int):
    """Rows sorted by block: one prefix tree for each."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, docs, sets, found = None, [], [], []

        def links():
            found.extend((docs[i], docs[j]) for i, j in trie_links(sets, num, den))

        for batch in batches:
            blocks = zip(batch.column("cluster").to_pylist(), batch.column("i").to_pylist(), batch.column("j").to_pylist(), strict=True)
            for block, doc, x in zip(blocks, batch.column("doc_id").to_pylist(), batch.column("shingles"), strict=True):
                if block != at:
                    links()
                    at, docs, sets = block, [], []
                docs.append(doc)
                sets.append(np.frombuffer(x.as_py(), U))
            if len(found) > 10000:
                yield record(schema, *np.array(found, np.int64).T)
                found.clear()
        links()
        if found:
            yield record(schema, *np.array(found, np.int64).T)

    return run


def _block_numbers(clusters: DataFrame, most: int, num: int, den: int) -> DataFrame:
    """(doc_id, cluster, i, j): a cluster of up to twice ``most`` shingles is one block (0, 0). A larger one is ordered by size and cut into parts of about ``most`` shingles; each pair of parts whose sizes can link is a block."""
    total = clusters.groupBy("cluster").agg(F.sum("n_shingles").alias("all"))
    whole = clusters.join(total.where(F.col("all") <= 2 * most), "cluster").select("doc_id", "cluster", F.lit(0).alias("i"), F.lit(0).alias("j"))
    large = clusters.join(total.where(F.col("all") > 2 * most), "cluster")
    before = F.sum("n_shingles").over(W.partitionBy("cluster").orderBy("n_shingles", "doc_id")) - F.col("n_shingles")
    large = large.withColumn("part", F.floor(before / F.lit(most)).cast("int"))
    parts = large.groupBy("cluster", "part").agg(F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"))
    first, second = parts.select("cluster", F.col("part").alias("i"), "high"), parts.select("cluster", F.col("part").alias("j"), "low")
    pairs = first.join(second, "cluster").where((F.col("i") <= F.col("j")) & (F.col("high") * den >= F.col("low") * num)).select("cluster", "i", "j")
    ends = pairs.withColumn("part", F.explode(F.array_distinct(F.array("i", "j"))))
    return whole.unionByName(large.join(ends, ["cluster", "part"]).select("doc_id", "cluster", "i", "j"))


def similar_sets(docs: DataFrame, text: str = "text", size: int = 5, num: int = 80, den: int = 100, block: int = BLOCK_SHINGLES, cells: int = SKETCH_CELLS) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs`` (doc_id, text).

    Documents without words (null, empty, white space) have n_shingles 0 and are components of their own. doc_id should
    be unique; rows that share one are each returned with the component of their own text, and texts whose smallest
    doc_id is the same are one class. Rows with a null doc_id are returned with a null component_id and link nothing.
    Other columns of ``docs`` are not read. Two small tables stay for the result to read; ``remove`` deletes them.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sets = materialize(docs.mapInArrow(_sets(size), SETS), "sets")
    watched = docs.mapInArrow(_watched(size), "shingle long, sig long")
    lonely = watched.repartition("shingle").sortWithinPartitions("shingle").mapInArrow(_lonely, "sig long, n long").groupBy("sig").agg(F.sum("n").alias("lonely"))
    equal = ["sig", "sig2", "n_shingles"]
    # what is counted for 64 bits of a digest only counts where one set has them
    left = sets.where("doc_id is not null and n_shingles > 0").groupBy(*equal).agg(F.min("doc_id").alias("doc_id")).withColumn("n", F.count("*").over(W.partitionBy("sig"))).join(lonely, "sig", "left")
    left = left.where((F.col("n") > 1) | (F.coalesce("lonely", F.lit(0)) <= F.col("n_shingles") - F.ceil(F.col("n_shingles") * num / F.lit(den))))
    reps = materialize(left.select(*equal, "doc_id"), "classes")
    # most documents have left: a filter of fixed size drops them before their texts are read, and what it lets through in vain goes in the join
    classes = fixed_table(reps.select("doc_id").mapInArrow(_class_bits, TABLE), FILTER_BITS // 8, np.uint8, np.bitwise_or)
    known = docs.where("doc_id is not null")
    members = known.mapInArrow(_members(size, classes), MEMBER).join(reps.select("doc_id", "sig", "sig2"), ["doc_id", "sig", "sig2"], "left_semi")
    members = materialize(members.dropDuplicates(["doc_id", "sig", "sig2"]).select("doc_id", "shingles"), "members")
    remove(spark, reps)
    held = fixed_table(members.mapInArrow(_sketch(cells), TABLE), cells, np.uint32, _saturating)
    postings = members.mapInArrow(_postings(held, num, den), "key long, doc_id long")
    chains = postings.repartition(F.shiftrightunsigned("key", 24)).sortWithinPartitions("key", "doc_id").mapInArrow(_chains(num, den), "a long, b long")
    chained = connected_components(chains)
    clusters = chained.withColumnsRenamed({"node": "doc_id", "component": "cluster"})
    sizes = members.select("doc_id", F.expr("length(shingles) div 8").alias("n_shingles")).groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
    clusters = materialize(clusters.join(sizes, "doc_id"), "clusters")
    remove(spark, chained)
    blocks = _block_numbers(clusters, block, num, den).join(members, "doc_id")
    blocks = blocks.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "doc_id").select("cluster", "i", "j", "doc_id", "shingles")
    links = blocks.mapInArrow(_join_blocks(num, den), "a long, b long")
    found = connected_components(links)
    remove(spark, members, clusters)
    # classes of equal sets, then what links connect; a row without either is alone
    some = sets.where("n_shingles > 0")
    same = some.groupBy(*equal).agg(F.min("doc_id").alias("rep"), F.count("*").alias("held"))
    same = same.join(found, same["rep"] == found["node"], "left").where("held > 1 or component is not null")
    same = materialize(same.select(*equal, F.coalesce("component", "rep").alias("component"), "held"), "same")
    remove(spark, found)
    out = join_counted(some, same, equal, sets.count(), "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component"))
    out = out.unionByName(sets.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component")))
    return made_of(out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id")), sets, same)


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_sets(table(spark, sf_dir, "documents"), size=4, num=85, den=100)
