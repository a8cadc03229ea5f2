"""A sink of part files that are cut by bytes, in two phases: tasks write to a folder of their own, the job moves what they committed.

Nothing of a task that failed or ran twice gets into the target, and the marker comes last. Rows go from the tasks to the files; the driver only
sees their names.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from terrace.sources.files import located
from terrace.sources.framed import MAGIC, framed

#: Bytes of a part, about; bytes that are gathered before they are written and counted.
PART, GATHERED = 250_000_000, 8_000_000
MARKER = "_SUCCESS"


@dataclass
class Written(WriterCommitMessage):
    """What a task has written, below its folder."""

    folder: str
    names: list[str] = field(default_factory=list)


class _Framed:
    suffix = ".sz"

    def __init__(self, out, schema: pa.Schema):
        self.out, self.bytes = out, 0
        out.write(MAGIC)

    def add(self, table: pa.Table) -> None:
        data = b"".join((x or "").encode() + b"\n" for x in table.column(0).to_pylist())
        self.out.write(framed(data)[len(MAGIC) :])
        self.bytes += len(data)

    def close(self) -> None:
        self.out.close()


class _Parquet:
    suffix = ".parquet"

    def __init__(self, out, schema: pa.Schema):
        self.out, self.writer = out, pq.ParquetWriter(out, schema, compression="snappy")

    @property
    def bytes(self) -> int:
        return self.out.tell()

    def add(self, table: pa.Table) -> None:
        self.writer.write_table(table, row_group_size=max(1, len(table)))

    def close(self) -> None:
        self.writer.close()
        self.out.close()


KINDS = {"framed": _Framed, "parquet": _Parquet}


class PartsWriter(DataSourceArrowWriter):
    def __init__(self, path: str, kind: str, most: int, schema: pa.Schema, overwrite: bool):
        self.path, self.kind, self.most, self.schema, self.overwrite = path, kind, most, schema, overwrite
        self.job = posixpath.join(path.rstrip("/"), f"_temporary-{uuid.uuid4().hex}")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        number, attempt = task.partitionId(), task.taskAttemptId()
        done = Written(f"{self.job}/{number}-{attempt}")
        system, folder = located(done.folder)
        held, n, part, limit = [], 0, None, min(GATHERED, self.most)
        try:

            def flush():
                nonlocal held, n, part
                if not held:
                    return
                if part is None:
                    name = f"part-{number:05}-{attempt}-{len(done.names):05}{KINDS[self.kind].suffix}"
                    system.create_dir(folder)
                    part = KINDS[self.kind](system.open_output_stream(f"{folder}/{name}"), self.schema)
                    done.names.append(name)
                part.add(pa.Table.from_batches(held).cast(self.schema))
                held, n = [], 0
                if part.bytes >= self.most:
                    part.close()
                    part = None

            for batch in batches:
                for at in range(0, batch.num_rows, step := max(1, batch.num_rows * limit // max(batch.nbytes, 1))):
                    some = batch.slice(at, step)
                    held.append(some)
                    n += some.nbytes
                    if n >= limit:
                        flush()
            flush()
            if part is not None:
                part.close()
        except BaseException:
            if system.get_file_info(folder).type == fs.FileType.Directory:
                system.delete_dir(folder)
            raise
        return done

    def commit(self, messages: list[Written | None]) -> None:
        system, target = located(self.path)
        system.create_dir(target)
        if self.overwrite:  # what was there goes when all that replaces it is written; the marker first
            old = [x for x in system.get_file_info(fs.FileSelector(target)) if not x.path.endswith(posixpath.basename(self.job))]
            for x in sorted(old, key=lambda x: x.base_name != MARKER):
                (system.delete_dir if x.type == fs.FileType.Directory else system.delete_file)(x.path)
        for m in filter(None, messages):
            for name in m.names:
                system.move(f"{located(m.folder)[1]}/{name}", f"{target}/{name}")
        if self.kind == "parquet" and not any(m.names for m in messages if m):
            pq.write_table(self.schema.empty_table(), f"{target}/part-none.parquet", filesystem=system)
        self._clear(system)
        system.open_output_stream(f"{target}/{MARKER}").close()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(located(self.path)[0])

    def _clear(self, system: fs.FileSystem) -> None:
        inner = located(self.job)[1]
        if system.get_file_info(inner).type == fs.FileType.Directory:
            system.delete_dir(inner)


class PartsSink(DataSource):
    """Options: path, kind (framed or parquet), bytes."""

    @classmethod
    def name(cls) -> str:
        return "terrace_parts"

    def writer(self, schema, overwrite: bool) -> PartsWriter:
        arrow = to_arrow_schema(schema)
        return PartsWriter(self.options["path"], self.options["kind"], int(self.options["bytes"]), arrow, overwrite)


def write_parts(df: DataFrame, path: str, kind: str = "parquet", most: int = PART, mode: str = "overwrite") -> None:
    """``df`` as files of about ``most`` bytes in ``path``, each of one task; then ``_SUCCESS``. Rows keep their order within a task. Framed files have lines, of one
    column of strings; their bytes are counted before compression."""
    if kind not in KINDS:
        raise ValueError(f"no such kind: {kind}")
    df.sparkSession.dataSource.register(PartsSink)
    df.write.format("terrace_parts").mode(mode).options(kind=kind, bytes=most).save(path)
