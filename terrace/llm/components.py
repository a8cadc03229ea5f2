"""Connected components of an edge table (a, b: long)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import made_of, materialize, record, remove

#: Up to this many edges (16 bytes each) one task holds all and finishes the job; before that, tasks empty their forests at so many nodes.
TASK_EDGES = 1 << 18
SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64())])


class Forest(dict):
    """Union-find in which the smallest member is the root."""

    def find(self, x: int) -> int:
        root = x
        while (up := self.get(root, root)) != root:
            root = up
        while (up := self.get(x, x)) != root:
            self[x] = root
            x = up
        return root

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        x, y = min(x, y), max(x, y)
        self.setdefault(x, x)
        self[y] = x
        return True


def _contract(most: int | None):
    """Edges to stars with the same components of what is held together: about ``most`` nodes at a time, or all edges of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()

        def out():
            pairs = [(x, r) for x in list(forest) if (r := forest.find(x)) != x]
            forest.clear()
            if pairs:
                yield record(SCHEMA, *np.array(pairs, np.int64).T)

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                forest.union(a, b)
            if most is not None and len(forest) >= most:
                yield from out()
        yield from out()

    return run


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of an edge; component is the smallest node reachable.

    Tasks contract what they hold to stars; what is left is joined by alternating large-star and small-star
    rounds, each written to the checkpoint folder, until it is few enough for one task or made of stars only.
    Null ends and loops are ignored. Nodes without edges aren't returned.
    """
    e = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a is not null and b is not null and a <> b")
    e = materialize(e.distinct().mapInArrow(_contract(TASK_EDGES), "a long, b long"), "edges")
    while True:
        n = e.count()
        if n <= TASK_EDGES:
            e, old = materialize(e.coalesce(1).mapInArrow(_contract(None), "a long, b long"), "stars"), e
            remove(edges.sparkSession, old)
            break
        both = e.union(e.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.a", "x.b").where("a <> b").distinct()
        e, old = materialize(small, "small"), e
        remove(edges.sparkSession, old, large)
        stars = e.agg(F.count("*").alias("n"), F.countDistinct("a").alias("d")).first()
        if stars["n"] == stars["d"] and e.join(e.select(F.col("a").alias("b")).distinct(), "b", "left_semi").isEmpty():
            break
    nodes = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return made_of(nodes.union(nodes.select(F.col("component").alias("node"), "component").distinct()), e)
