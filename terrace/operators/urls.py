"""URL-prefix aggregation and cross-pool rarity."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema


def prefix_counts(urls: DataFrame, url: str = "url", by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., prefix, descendants, direct) before any threshold, over distinct URLs."""
    return _counts(_distinct(urls, url, by), url, by)


def _distinct(urls: DataFrame, url: str, by: tuple[str, ...]) -> DataFrame:
    return urls.select(*by, url).where(F.col(url).isNotNull()).distinct()


def _folded(columns: int, schema: pa.Schema):
    """Sorted (by..., url) to (by..., prefix, descendants, direct): a stack has the prefixes that the last URL begins with. What hangs below a prefix is passed up
    when it is closed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list] = []  # prefix with its slash, URLs below its closed children, direct ones
        group, done = None, []

        def close(url: str) -> None:
            while stack and not url.startswith(stack[-1][0]):
                prefix, below, direct = stack.pop()
                done.append((*group, prefix[:-1], below + direct, direct))
                if stack:
                    stack[-1][1] += below + direct

        def put_out() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done), schema, strict=True)], schema=schema)
            done.clear()
            return out

        for batch in batches:
            for *by, url in zip(*(batch.column(i).to_pylist() for i in range(columns)), strict=True):
                if by != group:
                    close("")
                    group = by
                close(url)
                at = len(stack[-1][0]) if stack else url.find("/") + 1
                while (slash := url.find("/", at)) >= 0 and at:
                    at = slash + 1
                    stack.append([url[:at], 0, 0])
                if stack:
                    stack[-1][2] += 1
            if len(done) >= 10_000:
                yield put_out()
        close("")
        if done:
            yield put_out()

    return run


def _counts(distinct: DataFrame, url: str, by: tuple[str, ...]) -> DataFrame:
    """Each task folds a range of the sorted URLs; a prefix is put out once by each task that has URLs below it, and these counts are added up."""
    kept = distinct.select(*by, url)
    fields = [*to_arrow_schema(kept.schema)][:-1]
    schema = pa.schema([*fields, ("prefix", pa.string()), ("descendants", pa.int64()), ("direct", pa.int64())])
    kinds = ", ".join([*(f"`{n}` {t}" for n, t in kept.dtypes[:-1]), "prefix string, descendants long, direct long"])
    folded = kept.repartitionByRange(*by, url).sortWithinPartitions(*by, url).mapInArrow(_folded(len(kept.columns), schema), kinds)
    return folded.groupBy(*by, "prefix").agg(F.sum("descendants").alias("descendants"), F.sum("direct").alias("direct"))


def aggregate_urls(urls: DataFrame, url: str = "url", by: tuple[str, ...] = ()) -> DataFrame:
    """Prefixes with more than one descendant, more than a thousandth of the set, and direct children for more than half (integer divisions)."""
    distinct = _distinct(urls, url, by)  # read twice below; Spark uses its exchange again
    size = distinct.groupBy(*by).agg(F.count("*").alias("urls"))
    counts = _counts(distinct, url, by)
    counts = counts.join(size, list(by)) if by else counts.crossJoin(F.broadcast(size))  # one row
    return counts.where("descendants > 1 and descendants > urls div 1000 and direct > descendants div 2").drop("urls")


def ordered(aggregated: DataFrame) -> DataFrame:
    """By prefix, as a tree is listed: range-partitioned, so that files written from it are in order one after the other."""
    return aggregated.orderBy("prefix")


def rare_prefixes(aggregated: DataFrame, pools: int | Column) -> DataFrame:
    """Rows of prefixes that fewer than half of the pools have (integer division)."""
    half = F.lit(pools // 2) if isinstance(pools, int) else F.floor(pools / 2)
    return aggregated.withColumn("in_common", F.count("*").over(W.partitionBy("prefix"))).where(F.col("in_common") < half)
