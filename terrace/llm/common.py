"""Shared pieces: checkpoint tables, word hashing and chunked Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but space and \t \n \v \f \r; ``bytes.split()`` splits at the same characters.
WORD = r"[^\x20\x09-\x0D]+"
LOCAL_CHECKPOINTS = "/tmp/checkpoints/terrace"
#: A key is hot if it has one in so many of all rows, and so many rows at least. So there are never more hot keys than HOT_KEYS.
HOT_KEYS, HOT_ROWS = 1 << 16, 64
#: Characters of text that one step of a scan turns into words at a time.
CHUNK_CHARS = 2_000_000
#: Spark's setting by which a query's shuffle files go when it has ended; without it they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
U = np.uint64


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; a local one only where none is set and Spark runs on this machine alone."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(LOCAL_CHECKPOINTS)
        found = LOCAL_CHECKPOINTS
    return found.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the checkpoint folder and read it back: cuts lineage, survives lost executors, and leaves no shuffle files."""
    path, conf = f"{checkpoint_dir(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}", df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    return made_of(df.sparkSession.read.schema(df.schema).parquet(path), path)


def made_of(df: DataFrame, *tables: DataFrame | str) -> DataFrame:
    """``df``, which reads some tables of ``materialize``; ``remove`` deletes them."""
    df._paths = [p for x in tables for p in ([x] if isinstance(x, str) else x._paths)]
    return df


def remove(spark: SparkSession, *made: DataFrame | str) -> None:
    """Delete folders, and tables of ``materialize`` that nothing reads any more."""
    for x in (p for x in made for p in ([x] if isinstance(x, str) else x._paths)):
        path = spark._jvm.org.apache.hadoop.fs.Path(x)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def join_counted(left: DataFrame, counts: DataFrame, on: list[str], rows: int, how: str = "inner") -> DataFrame:
    """``left`` joined to ``counts``, which has one row for each key and how many rows of ``left`` hold it (``held``, dropped).

    Hot keys are at most HOT_KEYS, as ``left`` has ``rows`` rows: they are broadcast, and their rows stay where they are. The
    rest is joined by key. ``how`` is inner or left; keys are not null."""
    least = max(HOT_ROWS, -(-rows // HOT_KEYS))
    hot, others = counts.where(F.col("held") >= least), [c for c in counts.columns if c not in on]
    marked = left.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), on, "left")
    rest = marked.where("__hot is null").drop("__hot", *others).join(counts.where(F.col("held") < least), on, how)
    return marked.where("__hot").drop("__hot", "held").unionByName(rest.drop("held"))


def computed(df: DataFrame) -> DataFrame:
    """``df`` behind a generator of one row each: filters on its columns aren't pushed below, where Spark would repeat the expressions that they are made of."""
    return df.select(F.explode_outer(F.array(F.struct(*df.columns))).alias("__r")).select("__r.*")


class WordHashes(dict):
    """word (bytes) -> 64-bit hash; forgets everything when it is full, so its memory is bounded."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive entries, by doubling: log2(size) passes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, U)
    h, span = mix(words + U(size)), 1
    while span < size:
        step = min(span, size - span)
        h = mix(h[: len(h) - step] * U(0x9E3779B97F4A7C15) + (h[step:] ^ U(0xC2B2AE3D27D4EB4F + span)))
        span += step
    return h[:n]


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` consecutive entries, in time independent of ``size``."""
    n = len(x) - size + 1
    if n <= 0:
        return x[:0]
    if size == 1:
        return x
    pad = -len(x) % size
    blocks = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, size)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[size - 1 : size - 1 + n])


class Words:
    """Hashes of the words of some texts (UTF-8), one after the other; ``starts`` has where each text begins, and the end."""

    def __init__(self, texts: list[bytes | None], cache: WordHashes, fold: bool = False):
        lists = [[] if t is None else (t.lower() if fold else t).split() for t in texts]
        self.starts = np.zeros(len(lists) + 1, np.int64)
        np.cumsum([len(x) for x in lists], out=self.starts[1:])
        self.hashes = np.fromiter(map(cache.__getitem__, chain.from_iterable(lists)), U, int(self.starts[-1]))

    def owner(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def chunks(batch: pa.RecordBatch, text: str = "text", most: int = CHUNK_CHARS) -> Iterator[tuple[int, list[bytes | None]]]:
    """(first row, texts as UTF-8) of consecutive rows with about ``most`` bytes together; at least one row each."""
    first, held, size = 0, [], 0
    for i, t in enumerate(batch.column(text).cast(pa.binary())):
        t = t.as_py()
        held.append(t)
        size += len(t) if t else 0
        if size >= most:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def columns(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """An integer column as int64; null is -1 (callers drop nulls or treat -1 apart)."""
    return batch.column(name).cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def record(schema: pa.Schema, *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(arrays, schema, strict=True)], schema=schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
