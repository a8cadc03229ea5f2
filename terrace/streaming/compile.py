"""Compiling entity dumps as a stream of files: each batch is parsed once and fills all tables."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrace.functions.entities import relations
from terrace.operators.triples import label_index, triples
from terrace.sources.catalog import MARKERS, Catalog
from terrace.sources.entities import parse_entities, read_lines
from terrace.sources.framed import FramedSource, read_framed_lines
from terrace.sources.parts import PART, PartsSink, write_parts

#: Tables of a date, the one that makes it visible last.
TABLES = ("progress", "quarantine", "triples", "labels", "entities")
FILES = 1000
LISTED = "path string, modificationTime timestamp, length long, content binary"


def entity_lines(spark: SparkSession, files: list[str], partitions: int | None = None) -> DataFrame:
    """(value): lines of plain, .gz, .bz2 and framed .sz files. Those of a .gz file, which one task reads, are spread before they are parsed; few small .sz files are read
    in ranges, for as many tasks."""
    kinds = {kind: [x for x in files if x.rpartition(".")[2] == kind] for kind in ("sz", "gz")}
    plain = [x for x in files if x not in kinds["sz"] and x not in kinds["gz"]]
    spread = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = [read_lines(spark, kinds["gz"], spread)] if kinds["gz"] else []
    parts += [read_lines(spark, plain, partitions)] if plain else []
    parts += [read_framed_lines(spark, kinds["sz"], tasks=spread).select("value")] if kinds["sz"] else []
    lines = parts[0]
    for more in parts[1:]:
        lines = lines.unionByName(more)
    return lines


def compile_batch(catalog: Catalog, name: str, date: str, number: int, files: list[str], mode: str, partitions: int | None, part_bytes: int) -> None:
    """One batch's part of every table. It replaces what an earlier try has left, so a batch that is run again leaves the same rows. The dump is read by the first
    write alone; the other tables are made of what that has written, at the same time: a dump of many small files is many batches, whose cost is that of their jobs."""
    spark, at = catalog.spark, lambda state: f"{catalog.path(state, name, date)}/batch={number}"
    seen, bad = Observation(), F.col("corrupt").isNotNull()
    counts = F.count("*").alias("lines"), F.count_if(~bad).alias("entities"), F.count_if(bad).alias("corrupt"), F.coalesce(F.sum(F.when(~bad, F.size(relations()))), F.lit(0)).cast("long").alias("relations")
    parsed = parse_entities(entity_lines(spark, files, partitions), mode).observe(seen, *counts)
    write_parts(parsed, at("entities"), "parquet", part_bytes)
    stored = spark.read.schema(parsed.schema).parquet(at("entities"))  # no job to find out what is known
    good = stored.where(~bad)
    made = ("labels", label_index(good)), ("triples", triples(good)), ("quarantine", stored.where(bad).select("corrupt"))
    with ThreadPool(len(made)) as pool:
        pool.map(inheritable_thread_target(spark)(lambda x: x[1].write.mode("overwrite").parquet(at(x[0]))), made, 1)
    n = {"files": len(files)} | seen.get
    spark.range(0, 1, 1, 1).select(*[F.lit(n[x]).cast("long").alias(x) for x in ("files", "lines", "entities", "corrupt", "relations")]).write.mode("overwrite").parquet(at("progress"))


def compile_entities(catalog: Catalog, name: str, date: str, mode: str = "PERMISSIVE", partitions: int | None = None, files_per_batch: int = FILES, part_bytes: int = PART) -> None:
    """download/name/date (JSON lines, plain, .gz, .bz2 or framed .sz) to entities, labels, triples, quarantine and progress of that date.

    The stream's log fixes which files are in which batch. A job that was killed goes on with the batch that it was in when it is called again; one that has
    finished starts anew. Readers see nothing of the date until all tables are whole: their markers come last.
    """
    catalog.inputs(name, date)  # there must be some
    log = catalog.path("compiling", name, date)
    if not catalog.has(log):
        for state in reversed(TABLES):
            catalog.clear(state, name, date)
    for source in (FramedSource, PartsSink):  # the stream works in a copy of the session
        catalog.spark.dataSource.register(source)
    landed = catalog.spark.readStream.format("binaryFile").schema(LISTED).option("maxFilesPerTrigger", files_per_batch).load(catalog.path("download", name, date)).select("path")

    def one(batch: DataFrame, number: int) -> None:
        files = sorted(r["path"] for r in batch.collect() if r["path"].rpartition("/")[2] not in MARKERS)  # of files_per_batch files, at most
        if files:
            compile_batch(catalog, name, date, number, files, mode, partitions, part_bytes)

    landed.writeStream.foreachBatch(one).option("checkpointLocation", log).trigger(availableNow=True).start().awaitTermination()
    for state in TABLES:
        catalog.mark(state, name, date)
    catalog.clear("compiling", name, date)
