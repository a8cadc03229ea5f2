"""Operator 2, approximate nearest neighbours on robust-pruned directed graphs, by largest inner product.

Vectors are dealt to shards by a hash of their id. In each shard equal vectors become one node. Edges are chosen by direction alone, so that
walks reach any direction, and walks follow the inner product. Nodes enter the graph in rounds
that double its size: a greedy beam search from the medoid proposes neighbours, robust pruning keeps a proposal unless a
kept neighbour is nearer to it by a factor alpha, and edges are added both ways. A query walks each shard's graph with a
beam and the shards' answers are merged. Each shard measures by brute force, with some of its own vectors, what a beam finds, and takes one
that finds enough: lengths that differ much need wider ones. A task holds one shard and one batch of queries.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrace.llm.common import materialize, record, table

TOP = 20
SHARD_ROWS = 8192
DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 32, 64, 96, 1.2
#: Longest vectors that walks begin at; vectors that the beam is tried with, and the share of their nearest that it has to find.
ENTRIES, TRIED, WANTED = 32, 64, 0.97
#: Edges that lead to a node at least; the widest beam that pays, as a share of the shard and in nodes.
IN_EDGES, WIDEST_SHARE, WIDEST = 4, 8, 1024
#: Queries that walk together; numbers that pruning holds at a time.
QUERIES_AT_A_TIME, PRUNED_AT_A_TIME = 256, 1 << 22


def beam_search(points: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, scores) of the ``beam`` nodes nearest to each query that a greedy walk from ``entries`` finds; -1 where there are fewer.

    All queries take their steps together. Scores are inner products; edges of -1 are none.
    """
    n, beam, start = len(queries), max(beam, len(entries)), len(entries)
    ids = np.full((n, beam), -1, np.int64)
    got = np.full((n, beam), -np.inf, np.float32)
    seen = np.ones((n, beam), bool)
    ids[:, :start], got[:, :start], seen[:, :start] = entries, queries @ points[entries].T, False
    visited = np.zeros((n, len(points)), bool)
    visited[:, entries] = True
    active = np.arange(n)
    while len(active):
        open_ = np.where(seen[active], -np.inf, got[active])
        best = open_.argmax(1)
        go = np.isfinite(open_[np.arange(len(active)), best])
        active, best = active[go], best[go]
        if not len(active):
            break
        seen[active, best] = True
        near = edges[ids[active, best]]
        ok = (near >= 0) & ~visited[active[:, None], near]
        visited[np.broadcast_to(active[:, None], near.shape)[ok], near[ok]] = True
        new = np.where(ok, np.einsum("qd,qrd->qr", queries[active], points[near]), -np.inf).astype(np.float32)
        all_got = np.concatenate([got[active], new], 1)
        keep = np.argpartition(-all_got, beam - 1, axis=1)[:, :beam]
        rows = np.arange(len(active))[:, None]
        got[active] = all_got[rows, keep]
        ids[active] = np.concatenate([ids[active], np.where(ok, near, -1)], 1)[rows, keep]
        seen[active] = np.concatenate([seen[active], ~ok], 1)[rows, keep]
    order = np.argsort(-got, axis=1, kind="stable")
    rows = np.arange(n)[:, None]
    return np.where(np.isfinite(got[rows, order]), ids[rows, order], -1), got[rows, order]


def robust_prune(points: np.ndarray, nodes: np.ndarray, proposed: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node those of its distinct proposed neighbours (a row each, -1 for none) that no nearer kept one is close to: rows of ``degree``, -1 for none."""
    out = np.full((len(nodes), degree), -1, np.int64)
    step = max(1, PRUNED_AT_A_TIME // max(1, proposed.shape[1] ** 2))
    for a in range(0, len(nodes), step):
        x, ids = nodes[a : a + step], proposed[a : a + step]
        ids = np.where(ids == x[:, None], -1, ids)
        p = points[ids] - points[x][:, None]  # seen from the node, so that near ones keep their digits
        d = np.where(ids >= 0, (p * p).sum(2), np.inf)
        order = np.argsort(d, axis=1, kind="stable")
        rows = np.arange(len(x))[:, None]
        ids, d, p = ids[rows, order], d[rows, order], p[rows, order]
        square = (p * p).sum(2)
        between = alpha * alpha * (square[:, :, None] + square[:, None] - 2 * (p @ p.transpose(0, 2, 1)))
        alive, count = ids >= 0, np.zeros(len(x), np.int64)
        for i in range(ids.shape[1]):
            pick = np.flatnonzero(alive[:, i] & (count < degree))
            out[a + pick, count[pick]] = ids[pick, i]
            count[pick] += 1
            alive[pick] &= between[pick, i] > d[pick]
    return out


class Graph:
    """One shard: distinct vectors, at most ``top`` + 1 ids of each (the smallest), edges, and the beam that finds enough."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top: int = TOP, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        _, first, group = np.unique(vectors.view([("", vectors.dtype)] * vectors.shape[1]).ravel(), return_index=True, return_inverse=True)
        self.vectors = vectors[first]
        members = np.argsort(group, kind="stable")
        cuts = np.cumsum(np.bincount(group))
        grouped = ids[members]
        self.ids = [grouped[a : min(a + top + 1, b)] for a, b in zip(np.append(0, cuts[:-1]), cuts, strict=True)]
        self.top = top
        x = self.vectors / np.abs(self.vectors).max()  # within what single precision holds, whatever the components
        square = (x * x).sum(1)
        length = np.maximum(np.sqrt(square), 1e-150)  # squares of a vector that is tiny beside the others may be 0
        self.points, self.scaled = (x / length[:, None]).astype(np.float32), (x / length.max()).astype(np.float32)
        n = len(x)
        middle = int(((self.points - self.points.mean(0)) ** 2).sum(1).argmin())
        # walks begin at the medoid and at the longest vectors, which answer most queries where lengths differ much
        longest = np.argsort(-length, kind="stable")[:ENTRIES]
        self.entries = np.append(middle, longest[longest != middle])
        self.edges = np.full((n, degree), -1, np.int64)
        order = np.random.default_rng(n).permutation(n)
        order = np.concatenate([[middle], order[order != middle]])
        done = 1
        while done < n:
            step = order[done : done + min(max(done, 16), QUERIES_AT_A_TIME)]
            found, _ = beam_search(self.points, self.edges, self.entries[:1], self.points[step], beam)
            kept = robust_prune(self.points, step, found, degree, alpha)
            self.edges[step] = kept
            self._back(np.repeat(step, degree)[kept.ravel() >= 0], kept.ravel()[kept.ravel() >= 0], degree, alpha)
            done += len(step)
        self._anchored(beam)
        self.beam = self._calibrated(max(SEARCH_BEAM, top + 1))

    def _back(self, new: np.ndarray, at: np.ndarray, degree: int, alpha: float) -> None:
        """Edges to ``new`` nodes from those that they chose."""
        order = np.argsort(at, kind="stable")
        new, at = new[order], at[order]
        nodes, begin, count = np.unique(at, return_index=True, return_counts=True)
        have = (self.edges[nodes] >= 0).sum(1)
        wide = have + count
        for most in sorted({degree, *(2 ** int(k).bit_length() for k in wide[wide > degree])}):  # nodes with about as many proposals together
            low = 0 if most == degree else max(degree, most // 2 - 1)
            some = np.flatnonzero((wide > low) & (wide <= most)) if most > degree else np.flatnonzero(wide <= degree)
            if not len(some):
                continue
            every = np.full((len(some), most), -1, np.int64)
            every[:, :degree] = self.edges[nodes[some]]
            row = np.repeat(np.arange(len(some)), count[some])
            rank = np.arange(len(row)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
            every[row, np.repeat(have[some], count[some]) + rank] = new[np.repeat(begin[some], count[some]) + rank]
            self.edges[nodes[some]] = every if most == degree else robust_prune(self.points, nodes[some], every, degree, alpha)

    def _reached(self) -> np.ndarray:
        """Which nodes some walk can come to."""
        out, at = np.zeros(len(self.points), bool), self.entries
        while len(at):
            out[at] = True
            near = self.edges[at]
            at = np.unique(near[near >= 0])
            at = at[~out[at]]
        return out

    def _anchored(self, beam: int) -> None:
        """Pruning can take the last edges to a node. Nodes that few edges or no walk leads to get some from the nearest nodes that a walk
        finds, in columns of their own, as many as a node has edges, or more where no node found has room."""
        degree = self.edges.shape[1]
        into = np.bincount(self.edges[self.edges >= 0], minlength=len(self.points))
        weak = np.flatnonzero((into < IN_EDGES) | ~self._reached())
        self.edges = np.concatenate([self.edges, np.full_like(self.edges, -1)], 1)
        load = np.zeros(len(self.points), np.int64)
        for a in range(0, len(weak), QUERIES_AT_A_TIME):
            some = weak[a : a + QUERIES_AT_A_TIME]
            found, _ = beam_search(self.points, self.edges, self.entries, self.points[some], beam)
            for node, near in zip(some, found, strict=True):
                near = near[(near >= 0) & (near != node)]
                room = near[load[near] < degree]
                for at in (room if len(room) else near)[:IN_EDGES]:
                    if degree + load[at] == self.edges.shape[1]:
                        self.edges = np.concatenate([self.edges, np.full_like(self.edges[:, :degree], -1)], 1)
                    self.edges[at, degree + load[at]] = node
                    load[at] += 1
        self.edges = np.ascontiguousarray(self.edges[:, : degree + int(load.max())])

    def _calibrated(self, beam: int) -> int:
        """The beam, doubled until it finds WANTED of the true nearest of some of the vectors; the whole shard where that takes a beam so
        wide that walks cost more than to score every node."""
        n = len(self.points)
        queries = self.points[np.random.default_rng(n + 1).permutation(n)[:TRIED]]
        k = min(self.top, n)
        scores = queries @ self.scaled.T
        least = np.partition(scores, n - k, axis=1)[:, n - k]
        while beam < n:
            _, got = beam_search(self.scaled, self.edges, self.entries, queries, beam)
            if (got[:, :k] >= least[:, None] - 1e-6 * np.abs(least[:, None])).mean() >= WANTED:
                break
            beam = beam * 2 if beam * 2 <= max(n // WIDEST_SHARE, WIDEST) else n
        return min(beam, max(n, self.top + 1))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, beam: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query_id, ids, scores in double precision) of each query's nearest here, at most ``top``."""
        beam = max(beam or self.beam, self.top + 1)
        unit = queries / np.abs(queries).max(1, keepdims=True)
        unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
        unit = unit.astype(np.float32)
        for a in range(0, len(queries), QUERIES_AT_A_TIME):
            b = a + QUERIES_AT_A_TIME
            if beam < len(self.points):
                found, _ = beam_search(self.scaled, self.edges, self.entries, unit[a:b], beam)
            else:  # no beam that pays finds enough: every node, and of these some more than wanted, as single precision may confuse near ones
                most = min(len(self.points), SEARCH_BEAM + self.top)
                found = np.argpartition(-(unit[a:b] @ self.scaled.T), most - 1, axis=1)[:, :most]
            for query_id, q, nodes in zip(query_ids[a:b].tolist(), queries[a:b], found, strict=True):
                nodes = nodes[nodes >= 0]
                with np.errstate(over="ignore", invalid="ignore"):
                    scores = np.array([float(np.dot(v, q)) for v in self.vectors[nodes].astype(np.float64)])
                ids = np.concatenate([np.zeros(0, np.int64), *[self.ids[k] for k in nodes]])
                scores = np.repeat(scores, [len(self.ids[k]) for k in nodes])
                other = ids != query_id
                ids, scores = ids[other], scores[other]
                order = np.lexsort((ids, -scores))[: self.top]
                yield query_id, ids[order], scores[order]


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v) without null, empty, zero or non-finite vectors."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & F.coalesce(~bad & some, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS, top: int = TOP) -> DataFrame:
    """(shard, graph) of ``usable`` vectors: about ``shard_rows`` vectors a shard, written to the checkpoint folder. All vectors have as many components."""
    shards = max(1, -(-vectors.count() // shard_rows))
    schema = pa.schema([("shard", pa.int32()), ("graph", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, rows = None, [], []

        def made():
            x = np.concatenate(rows)
            graph = Graph(np.concatenate(ids), x, top)
            return record(schema, [at], [pickle.dumps(graph)])

        for batch in batches:
            shard = batch.column("shard").to_numpy()
            v = batch.column("v")
            flat = v.flatten().to_numpy(zero_copy_only=False).reshape(len(shard), -1) if len(shard) else np.zeros((0, 1))
            for s in np.unique(shard):
                if s != at:
                    if rows:
                        yield made()
                    at, ids, rows = int(s), [], []
                ids.append(batch.column("id").to_numpy()[shard == s])
                rows.append(flat[shard == s])
        if rows:
            yield made()

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "id").select("shard", "id", "v")
    return materialize(dealt.mapInArrow(run, "shard int, graph binary"), "graphs")


def search_index(index: DataFrame, queries: DataFrame, top: int = TOP, beam: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score (``beam`` in place of the measured ones): each query's ``top`` nearest found (or all there are), ties to the smaller id."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, graph = None, None
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            blobs = batch.column("graph")
            ids, v = batch.column("id").to_numpy(zero_copy_only=False), batch.column("v")
            i = 0
            while i < len(shard):
                if blobs[i].is_valid:
                    at, graph = shard[i], pickle.loads(blobs[i].as_py())
                    i += 1
                    continue
                j = i
                while j < len(shard) and shard[j] == shard[i] and not blobs[j].is_valid:
                    j += 1
                if at == shard[i]:
                    found = list(graph.search(ids[i:j].astype(np.int64), np.array(v.slice(i, j - i).to_pylist(), np.float64), beam))
                    if any(len(x[1]) for x in found):
                        yield record(schema, np.repeat([x[0] for x in found], [len(x[1]) for x in found]), np.concatenate([x[1] for x in found]), np.concatenate([x[2] for x in found]))
                i = j

    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    every = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    rows = index.select("shard", F.lit(None).cast("long").alias("id"), F.lit(None).cast("array<double>").alias("v"), "graph").union(every.select("shard", "id", "v", F.lit(None).cast("binary")))
    rows = rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", F.col("graph").isNull(), "id").select("shard", "id", "v", "graph")
    found = rows.mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: DataFrame, top: int = TOP, shard_rows: int = SHARD_ROWS, beam: int | None = None) -> DataFrame:
    """Index all of ``vectors`` (vec_id, embedding) and search it for ``queries`` (the same columns).

    Vectors that are null, empty, zero or hold null or non-finite components take no part on either side; nor do null
    ids, and vectors of another length than most have. Of rows that share an id the least vector stands for all; other
    columns are not read. Empty tables give no rows.
    """
    vectors, queries = usable(vectors), usable(queries)
    width = vectors.groupBy(F.size("v").alias("k")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "k").first()
    one = lambda df: df.where(F.size("v") == (width["k"] if width else 0)).groupBy("id").agg(F.min("v").alias("v"))
    return search_index(build_index(one(vectors), shard_rows, top), one(queries), top, beam)


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))
