"""Graph operators over (child, parent) edges: roots, closure, forest."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.scratch import folder


def cut(df: DataFrame) -> DataFrame:
    """Write to the shared checkpoint folder and read again."""
    spark, path = df.sparkSession, folder(df.sparkSession, "graph")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._path = path
    return out


def drop(*made: DataFrame) -> None:
    """Remove tables of ``cut`` that nothing reads any more."""
    for df in made:
        p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def edges(triples: DataFrame, prop: str) -> DataFrame:
    """Distinct (child, parent) of one property; the filter reaches the scan."""
    return triples.where(F.col("prop") == prop).select(F.col("source").alias("child"), F.col("dest").alias("parent")).distinct()


def roots(e: DataFrame) -> DataFrame:
    """(node): parents that are nobody's child."""
    return e.select(F.col("parent").alias("node")).distinct().join(e.select(F.col("child").alias("node")).distinct(), "node", "left_anti")


def children(e: DataFrame) -> DataFrame:
    """(node, kids): adjacency lists, sorted."""
    return e.groupBy(F.col("parent").alias("node")).agg(F.array_sort(F.collect_list("child")).alias("kids"))


def descendants(e: DataFrame, start: DataFrame, most_rounds: int = 10_000) -> DataFrame:
    """(root, node): all below each root of ``start`` (root), itself excluded. Cycles end: a round takes only what is new to its root. ValueError if that takes more than ``most_rounds``.
    What the rounds have written is removed, but for the result."""
    e = cut(e.select("child", "parent"))
    seen = frontier = cut(start.select("root", F.col("root").alias("node")).distinct())
    made = [e, seen]
    for rounds in range(1, most_rounds + 1):
        new = frontier.join(e, frontier["node"] == e["parent"]).select("root", F.col("child").alias("node")).distinct()
        frontier = cut(new.join(seen, ["root", "node"], "left_anti"))
        made.append(frontier)
        if frontier.isEmpty():
            out = cut(seen.where("root <> node"))
            drop(*made)
            return out
        seen = seen.unionByName(frontier)
        if rounds % 8 == 0:
            seen = cut(seen)
            drop(*made[1:-1])
            made = [e, seen, frontier]
    drop(*made)
    raise ValueError(f"there is more below the roots after {most_rounds} rounds")


#: Between the ids of a path, and behind all that hangs below one. Ids hold neither.
STEP, BEHIND = "\x01", "\x02"


def least_paths(e: DataFrame, most_rounds: int = 10_000) -> DataFrame:
    """(node, path): of the paths of ids from a root to a node, without cycles, the one that comes first in the order of a tree walk with sorted children.

    That is the path by which a walk down the forest comes to a node first: what leads to a node's first path is itself first. Each round passes on the
    paths that got better in the round before, so there are about as many rounds as there are levels. A path takes as much room as its ids. ValueError after ``most_rounds``."""
    e = cut(e.select("child", "parent"))
    best = fresh = cut(roots(e).select("node", F.col("node").alias("path")))
    for _ in range(most_rounds):
        found = fresh.join(e, fresh["node"] == e["parent"]).where(~F.array_contains(F.split("path", STEP), F.col("child")))
        found = found.groupBy(F.col("child").alias("node")).agg(F.min(F.concat("path", F.lit(STEP), "child")).alias("new"))
        better = F.coalesce(F.col("new") < F.col("path"), F.col("path").isNull()) & F.col("new").isNotNull()
        joined = cut(best.join(found, "node", "full").select("node", F.least("path", "new").alias("path"), better.alias("better")))
        drop(best)
        best, fresh = joined.drop("better"), joined.where("better").drop("better")
        best._path = joined._path
        if fresh.isEmpty():
            drop(e)
            return best
    raise ValueError(f"paths still got better after {most_rounds} rounds")


def forest_lines(e: DataFrame, labels: DataFrame) -> DataFrame:
    """(path, line): an HTML tree of all that hangs below the roots; a node shown before is a link only. In the order of ``path`` the lines are the document; a row may have several lines.

    Each edge below a node's first place is one place in the tree, with a row where it begins and one where it ends. ``labels`` is (id, label). Nothing passes through the driver."""
    at = least_paths(e)
    below = at.join(e.select("child", "parent"), at["node"] == F.col("parent")).select(F.concat("path", F.lit(STEP), "child").alias("path"), F.col("child").alias("node"))
    places = below.unionByName(at.where(~F.contains("path", F.lit(STEP))).select("path", "node"))
    shown = places.join(at.select("path", F.lit(True).alias("first")), "path", "left").join(labels.select(F.col("id").alias("node"), "label"), "node", "left")
    depth = F.size(F.split("path", STEP)) - 1
    pad, above = F.repeat(F.lit(" "), depth * 4), F.repeat(F.lit(" "), (depth - 1) * 4)
    title = F.concat(F.lit("<b>"), "node", F.lit("</b> "), F.coalesce("label", F.lit("no label")))
    name = F.when(F.col("first"), F.concat(F.lit("  <a anchor='"), "node", F.lit("'/>"), title)).otherwise(F.concat(F.lit("  <a href='#"), "node", F.lit("'>"), title, F.lit("</a>")))
    inner = lambda tag: F.when(depth > 0, F.concat(above, F.lit(tag)))
    begins = F.concat_ws("\n", inner("  <ul>"), F.concat(pad, F.lit("<li>")), F.concat(pad, name))
    ends = F.concat_ws("\n", F.concat(pad, F.lit("</li>")), inner("  </ul>"))
    rows = F.array(F.struct(F.col("path").alias("path"), begins.alias("line")), F.struct(F.concat("path", F.lit(BEHIND)).alias("path"), ends.alias("line")))
    return shown.select(F.explode(rows).alias("r")).select("r.path", "r.line")


def write_forest(e: DataFrame, labels: DataFrame, path: str) -> None:
    """The tree as text files that are in order one after the other: range-sorted by path."""
    forest_lines(e, labels).orderBy("path").select("line").write.mode("overwrite").text(path)


def forest(e: DataFrame, labels: DataFrame) -> Iterator[str]:
    """The lines of the tree, to print; a partition at a time in the driver."""
    for row in forest_lines(e, labels).orderBy("path").toLocalIterator():
        yield from row["line"].split("\n")
