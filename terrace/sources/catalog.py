"""Snapshots under root/state/name/date: finished ones have a marker; the latest finished one is read by default."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrace.operators.triples import triples
from terrace.sources.parts import write_parts

MARKERS = ("_SUCCESS", "ok")


class Catalog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, state: str, name: str, date: str) -> str:
        return f"{self.root}/{state}/{name}/{date}"

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def dates(self, state: str, name: str) -> list[str]:
        """Finished snapshots, by any file system that Spark reads."""
        fs, p = self._fs(f"{self.root}/{state}/{name}")
        if not fs.exists(p):
            return []
        jvm = self.spark._jvm
        done = lambda x: any(fs.exists(jvm.org.apache.hadoop.fs.Path(x.getPath(), m)) for m in MARKERS)
        return sorted(x.getPath().getName() for x in fs.listStatus(p) if x.isDirectory() and done(x))

    def names(self, state: str) -> list[str]:
        fs, p = self._fs(f"{self.root}/{state}")
        return sorted(x.getPath().getName() for x in fs.listStatus(p) if x.isDirectory()) if fs.exists(p) else []

    def inputs(self, name: str, date: str) -> list[str]:
        """Landed files of a snapshot, largest first, without markers."""
        fs, p = self._fs(self.path("download", name, date))
        files = [x for x in (fs.listStatus(p) if fs.exists(p) else []) if x.isFile() and x.getPath().getName() not in MARKERS and not x.getPath().getName().startswith((".", "_"))]
        if not files:
            raise FileNotFoundError(f"nothing has landed in {self.path('download', name, date)}")
        return [x.getPath().toString() for x in sorted(files, key=lambda x: (-x.getLen(), x.getPath().getName()))]

    def latest(self, state: str, name: str) -> str | None:
        return max(self.dates(state, name), default=None)

    def write(self, df: DataFrame, state: str, name: str, date: str, part_bytes: int | None = None) -> None:
        """Replace a snapshot, in parts of about ``part_bytes`` where that is given; the marker comes last."""
        if part_bytes:
            write_parts(df, self.path(state, name, date), "parquet", part_bytes)
        else:
            df.write.mode("overwrite").parquet(self.path(state, name, date))

    def clear(self, state: str, name: str, date: str) -> None:
        """Remove a snapshot, its marker first."""
        for path in (f"{self.path(state, name, date)}/{MARKERS[0]}", self.path(state, name, date)):
            fs, p = self._fs(path)
            fs.delete(p, True)

    def mark(self, state: str, name: str, date: str) -> None:
        """Declare a snapshot finished."""
        fs, p = self._fs(f"{self.path(state, name, date)}/{MARKERS[0]}")
        fs.create(p).close()

    def has(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _read(self, state: str, name: str, date: str | None) -> DataFrame:
        date = date or self.latest(state, name)
        if date is None:
            raise FileNotFoundError(f"no finished snapshot of {state}/{name} under {self.root}")
        return self.spark.read.parquet(self.path(state, name, date)).drop("batch")

    def pages(self, wiki: str, date: str | None = None) -> DataFrame:
        return self._read("pages", wiki, date)

    def entities(self, date: str | None = None, name: str = "entities") -> DataFrame:
        """Entities; without a date the latest labels must be of the same date."""
        if date is None and (a := self.latest("labels", name)) is not None and a != self.latest("entities", name):
            raise ValueError(f"the latest labels are of {a}, the latest entities of {self.latest('entities', name)}")
        found = self._read("entities", name, date)
        return found.where("corrupt is null").drop("corrupt") if "corrupt" in found.columns else found

    def progress(self, date: str, name: str = "entities") -> DataFrame:
        """(batch, files, lines, entities, corrupt, relations) of the batches that a compile job has committed so far, finished or not."""
        return self.spark.read.parquet(self.path("progress", name, date))

    def labels(self, date: str | None = None, name: str = "entities") -> DataFrame:
        return self._read("labels", name, date)

    def triples(self, date: str | None = None, name: str = "entities") -> DataFrame:
        """Stored triples of the date (of the latest entities) where there are some, else those of the entities."""
        of = date or self.latest("entities", name)
        if of in self.dates("triples", name):
            return self._read("triples", name, of)
        return triples(self.entities(date, name))
