"""Operator 5, mixing sources to target weights: subset-sum budget fitting.

Documents are counted by (source, length). Each source takes whole passes over its documents as long as they fit
its target; for the rest of the budget a proportional number of documents of every length is set aside first, then
bounded-knapsack dynamic programming over what is left of the budget closes the gap. A seeded hash says which
documents of a length are taken. Only per-length counts, never documents, meet in one task. Texts are read once to count
and once to give the rows out; they aren't stored, and where the plan is small they aren't shuffled either.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrace.llm.common import WORD, computed, join_counted, materialize, table

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = 20240501
#: Words of budget that the dynamic programme works on, at least; more if the shortest documents are longer.
DP_BUDGET = 1 << 14
HASH_BUCKETS = 256
#: A plan of so many rows (one for each source and length) is broadcast.
SMALL_PLAN = 1 << 18


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size) to (source, source_size, target), one row per source.

    The limit of "stop at ``most`` times the size, share the excess by weight" is target = min(most * size, level * weight),
    with the level at which the targets add up to all sizes. Sources that stop have the least size for their weight, so
    one running sum in that order gives the level. Works on one row per source.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    picked = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("w", picked).withColumn("cap", (F.col("source_size") * most).cast("double"))
    by = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, all_ = by.rowsBetween(W.unboundedPreceding, -1), W.partitionBy(F.lit(0))
    s = s.withColumn("left", F.sum("source_size").over(all_) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    s = s.withColumn("level", F.col("left") / (F.sum("w").over(all_) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    s = s.withColumn("open", F.col("cap") > F.col("level") * F.col("w"))
    s = s.withColumn("level", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("w"), "level"))).over(all_)["level"])
    return s.select("source", "source_size", F.coalesce(F.least("cap", F.col("level") * F.col("w")), "cap").alias("target"))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, most: int = 1) -> np.ndarray:
    """How many of each length to take so that the sum is as near to ``budget`` as the programme gets; each up to ``most`` times, a second time only where a first doesn't reach."""
    take = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    if not total or budget <= 0:
        return take
    if budget >= total:
        return counts.copy()
    order = np.argsort(lengths)[::-1]
    take = (counts * (budget / total)).astype(np.int64)
    rest = budget - int((lengths * take).sum())
    reach = max(DP_BUDGET, 4 * int(lengths.min()))
    for i in order:  # longest first, until the dynamic programme can hold what is left
        if rest <= reach:
            break
        n = min(int(most * counts[i] - take[i]), (rest - reach) // int(lengths[i]) + 1, rest // int(lengths[i]))
        take[i] += max(n, 0)
        rest -= max(n, 0) * int(lengths[i])
    sums, steps, limit = 1, [], (1 << (rest + 1)) - 1
    for i in order[::-1]:  # bit b of sums: some documents have b words together
        n = min(int(most * counts[i] - take[i]), rest // int(lengths[i]))
        part = 1
        while n > 0 and not sums >> rest & 1:
            part_now = min(part, n)
            steps.append((sums, i, part_now))
            sums |= sums << part_now * int(lengths[i]) & limit
            n -= part_now
            part *= 2
        if sums >> rest & 1:
            break
    at = sums.bit_length() - 1
    for before, i, part in reversed(steps):
        if not before >> at & 1:
            take[i] += part
            at -= part * int(lengths[i])
    return take


def _fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size").reset_index(drop=True)
    size, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
    passes = min(int(target // size), MOST_EPOCHS) if size else 0
    budget = round(target - passes * size)
    n = rows["n"].to_numpy(np.int64)
    take = fit(rows["size"].to_numpy(np.int64), n, budget, MOST_EPOCHS - passes)
    rows["take"], rows["passes"] = take % n, passes + take // n
    return rows[["source", "size", "take", "passes"]]


def mix(docs: DataFrame, text: str = "text", weights: tuple[int, ...] = WEIGHTS, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken, and the columns of ``keep``.

    Null and empty texts have size 0 and are never taken (copies 0). A null source is one source of its own, last in
    order. Repeated rows are documents of their own; where they tie in everything any of them may be the one taken,
    which leaves the same rows. Equal inputs and seeds give equal rows. Only doc_id, source, the text and ``keep`` are read;
    with ``keep``, a hash of its columns breaks ties and stands for a null doc_id in the choice.
    """
    tie = [F.xxhash64(*keep)] if keep else []
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("long"), *tie) if keep else "doc_id")
    sized = docs.select("doc_id", "source", F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), *keep)
    sized = computed(sized.withColumn("key", key).withColumn("part", F.pmod("key", F.lit(HASH_BUCKETS)).cast("int")))
    parts = sized.groupBy("source", "size", "part").agg(F.count("*").alias("n"))
    parts = materialize(parts, "lengths")
    per_length = parts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    targets = materialize(source_targets(per_length.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))), "targets")
    p = per_length.where("size > 0").alias("p")
    fitted = p.join(targets.alias("t"), F.expr("p.source <=> t.source")).selectExpr("p.source", "p.size", "p.n", "t.source_size", "t.target")
    plan = fitted.groupBy("source").applyInPandas(_fit_source, "source string, size long, take long, passes long")
    # of each length the documents with the least hash parts are taken: whole parts up to one, and of the part at the edge those of the least rank
    run = W.partitionBy("source", "size").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    cuts = parts.withColumn("before", F.coalesce(F.sum("n").over(run), F.lit(0))).alias("c").join(plan.alias("f"), F.expr("c.source <=> f.source and c.size = f.size"), "left")
    cuts = cuts.selectExpr("c.source", "c.size", "c.part", "c.n", "c.before", "coalesce(f.take, 0) as take", "coalesce(f.passes, 0) as passes")
    upto, at = F.expr("max(if(before + n <= take, part, -1))").alias("upto"), F.expr("max(if(before < take and before + n > take, struct(part, take - before as quota), null))").alias("at")
    by = {"named": F.col("source").isNotNull(), "name": F.coalesce(F.col("source").cast("string"), F.lit(""))}
    cuts = materialize(cuts.groupBy("source", "size", "passes").agg(F.sum("n").alias("held"), upto, at).withColumns(by).drop("source"), "cuts")
    sized, on = sized.withColumns(by), [*by, "size"]
    d = sized.join(F.broadcast(cuts.drop("held")), on) if cuts.count() <= SMALL_PLAN else join_counted(sized, cuts, on, cuts.agg(F.sum("held")).first()[0])
    d = d.selectExpr("doc_id", "source", "size", "key", "part", "passes", "upto", "if(part = at.part, at.quota, 0) as quota", *keep)
    whole = d.where("quota = 0").withColumn("extra", (F.col("part") <= F.col("upto")).cast("long"))
    rank = F.row_number().over(W.partitionBy("source", "size", "part").orderBy("key", "doc_id", *tie))
    edge = d.where("quota > 0").withColumn("extra", (rank <= F.col("quota")).cast("long"))
    out = whole.unionByName(edge).withColumn("copies", F.col("passes") + F.col("extra")).alias("d")
    return out.join(targets.alias("t"), F.expr("d.source <=> t.source"), "left").selectExpr("d.doc_id", "d.source", "d.size", "t.source_size", "t.target", "d.copies", "d.copies * d.size as taken", *[f"d.{k}" for k in keep])


def op5_mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
