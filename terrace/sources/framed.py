"""Files in the framed Snappy format (.sz), as raw bytes or lines: a data source that reads a file in ranges of bytes.

A range owns the frames that begin in it. Where its first frame begins is found by trying: the first place from which the bytes read
as a frame whose checksum is right. A range that ends before the file does goes on to the next frame and compares its place with what the next range
will find, so places that only look like frames are an error and never other rows. A line belongs to the range with the line end before it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from terrace.sources.files import listed, opened

MAGIC = b"\xff\x06\x00\x00sNaPpY"
#: Raw bytes of a frame, at most, and of a stored one with its checksum; frames whose checksums are worked out together.
FRAME, STORED, TOGETHER = 65536, 32 + 65536 + 65536 // 6 + 4, 512
#: Bytes read at a time; bytes of a range where Spark's setting isn't known.
READ, RANGE = 1 << 20, 128 << 20
#: Bytes of a range, at least, where small files are spread over tasks.
LEAST_RANGE = 1 << 16


def _crc_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ np.uint32(0x82F63B78), x >> 1)
    return x


CRC_TABLE = _crc_table()
#: Bytes of a part that are taken one after the other; the stretches of all parts go in step.
STRETCH = 256


def _over_zeros(states: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """States after as many zero bytes as ``tables`` stand for."""
    return tables[0][states & 0xFF] ^ tables[1][states >> 8 & 0xFF] ^ tables[2][states >> 16 & 0xFF] ^ tables[3][states >> 24]


def _zero_tables(most: int) -> list[np.ndarray]:
    """For each k up to ``most``: what 2**k zero bytes make of each byte of a state."""
    states = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    out = [CRC_TABLE[states & 0xFF] ^ states >> np.uint32(8)]
    for _ in range(most):
        out.append(_over_zeros(out[-1], out[-1]))
    return out


ZEROS = _zero_tables(32)


def checksums(parts: list[bytes]) -> list[int]:
    """The format's masked CRC-32C of each part. Zeros in front don't change a state of 0, so all parts are made equally long;
    what the first state, all ones, adds depends on a part's length only."""
    if not parts:
        return []
    sizes = np.array([len(x) for x in parts], np.int64)
    rows = max(1, -(-int(sizes.max()) // STRETCH))
    data = np.frombuffer(b"".join(x.rjust(rows * STRETCH, b"\0") for x in parts), np.uint8).reshape(-1, STRETCH).T.copy()
    state = np.zeros(data.shape[1], np.uint32)
    for column in data:
        state = CRC_TABLE[(state ^ column) & 0xFF] ^ state >> np.uint32(8)
    state = state.reshape(len(parts), rows).T
    crc, begun = np.zeros(len(parts), np.uint32), np.full(len(parts), 0xFFFFFFFF, np.uint32)
    for row in state:
        crc = _over_zeros(crc, ZEROS[STRETCH.bit_length() - 1]) ^ row
    for k in range(int(sizes.max()).bit_length()):
        begun = np.where(sizes >> k & 1, _over_zeros(begun, ZEROS[k]), begun)
    crc ^= begun ^ np.uint32(0xFFFFFFFF)
    masked = ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)
    return masked.tolist()


def _content(kind: int, body: bytes) -> bytes:
    """What a frame of data holds; ValueError where it can't be read."""
    if len(body) < 4:
        raise ValueError("a frame without a checksum")
    if kind == 0x01:
        return body[4:]
    length, shift = 0, 0
    for b in body[4:9]:  # the varint of the raw length
        length |= (b & 0x7F) << shift
        shift += 7
        if not b & 0x80:
            break
    if length > FRAME:
        raise ValueError("a frame of too many bytes")
    try:
        return pa.Codec("snappy").decompress(body[4:], length).to_pybytes() if length else b""
    except OSError as e:
        raise ValueError("a frame that can't be read") from e


class _Bytes:
    """A file read forwards from a place, READ bytes at a time."""

    def __init__(self, file, size: int, at: int):
        self.file, self.size, self.at, self.held, self.used = file, size, at, b"", 0
        file.seek(at)

    def take(self, n: int) -> bytes:
        while len(self.held) - self.used < n and (more := self.file.read(max(READ, n))):
            self.held, self.used = self.held[self.used :] + more, 0
        out = self.held[self.used : self.used + n]
        self.used += len(out)
        self.at += len(out)
        return out


def _stored(file, size: int, at: int) -> Iterator[tuple[int, int, bytes]]:
    """(place, checksum, content) of the frames of data from a frame's place on. ValueError at a cut-off frame or one of an unknown kind."""
    data = _Bytes(file, size, at)
    while head := data.take(4):
        place, n = data.at - len(head), int.from_bytes(head[1:], "little")
        body = data.take(n)
        if len(head) < 4 or len(body) < n:
            raise ValueError("the last frame is cut off")
        if head[0] in (0x00, 0x01):
            yield place, int.from_bytes(body[:4], "little"), _content(head[0], body)
        elif head[0] <= 0x7F:
            raise ValueError(f"frame of unknown kind {head[0]}")


def _checked(stored: Iterator[tuple[int, int, bytes]], end: int | None = None) -> Iterator[tuple[int, bytes]]:
    """(place, content) with their checksums compared, some at a time, but one at a time from ``end`` on."""
    held: list[tuple[int, int, bytes]] = []

    def out() -> Iterator[tuple[int, bytes]]:
        for (place, want, part), got in zip(held, checksums([x for *_, x in held]), strict=True):
            if want != got:
                raise ValueError("a frame's checksum is wrong")
            yield place, part
        held.clear()

    for frame in stored:
        held.append(frame)
        if len(held) >= TOGETHER or (end is not None and frame[0] >= end):
            yield from out()
    yield from out()


def frames(data: bytes) -> Iterator[bytes]:
    """Contents of the frames. ValueError where the data is cut off or damaged."""
    for _, part in _checked(_stored(pa.BufferReader(data), len(data), 0)):
        yield part


def first_frame(file, size: int, at: int) -> int | None:
    """The first place from ``at`` on where a frame of data begins, by its head and its checksum; None if there is none."""
    reach = STORED + 8
    while at < size:
        file.seek(at)
        some = np.frombuffer(file.read(READ + reach), np.uint8)
        last = len(some) - 3 if at + len(some) >= size else READ
        # kinds 0 and 1, and fewer than 131072 bytes
        for i in np.flatnonzero((some[: len(some) - 3] <= 1) & (some[3:] <= 1))[: len(some)]:
            if i >= last:
                break
            n = int(some[i + 1]) | int(some[i + 2]) << 8 | int(some[i + 3]) << 16
            body = some[i + 4 : i + 4 + n].tobytes()
            if not 4 <= n <= STORED or len(body) < n or (some[i] == 1 and n > FRAME + 4):
                continue
            try:
                content = _content(int(some[i]), body)
            except ValueError:
                continue
            if checksums([content])[0] == int.from_bytes(body[:4], "little"):
                return at + int(i)
        at += READ
    return None


def range_frames(file, size: int, start: int, end: int) -> Iterator[tuple[bool, int, bytes]]:
    """(owned, place, content): the frames of data that begin in start:end, then those behind, for as long as they are asked for."""

    def stored() -> Iterator[tuple[int, int, bytes]]:
        crossed = end >= size
        for frame in _stored(file, size, at):
            if not crossed and frame[0] >= end:
                crossed = True
                with_next = first_frame(again, size, end)
                if with_next != frame[0]:
                    raise ValueError(f"bytes at {with_next} look like a frame but aren't one: read the file in one range")
            yield frame

    at = start if start == 0 else first_frame(file, size, start)
    if at is None or at >= end:
        return
    again = file.beside()
    for place, part in _checked(stored(), end):
        yield place < end, place, part


def framed(data: bytes) -> bytes:
    """``data`` in the framed format."""
    parts = [data[i : i + FRAME] for i in range(0, len(data), FRAME)]
    codec, out = pa.Codec("snappy"), [MAGIC]
    for at in range(0, len(parts), TOGETHER):
        some = parts[at : at + TOGETHER]
        for part, crc in zip(some, checksums(some), strict=True):
            body = crc.to_bytes(4, "little") + codec.compress(part).to_pybytes()
            out.append(b"\0" + len(body).to_bytes(3, "little") + body)
    return b"".join(out)


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int
    size: int


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows, whose last values are strings or bytes, in batches of some megabytes."""
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += len(row[-1]) + 64
        if n >= 4 * READ:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema=schema)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema=schema)


def range_lines(file, size: int, start: int, end: int) -> Iterator[bytes]:
    """Lines whose line end before them is in a frame of the range; the first line is the first range's."""
    rest: list[bytes] | None = [] if start == 0 else None  # None until a line has begun
    for owned, _, part in range_frames(file, size, start, end):
        if not owned:
            if rest is None:
                return
            line, found, _ = part.partition(b"\n")
            rest.append(line)
            if found:
                yield b"".join(rest)
                return
            continue
        first, *lines = part.split(b"\n")
        if rest is not None:
            rest.append(first)
        if lines:
            if rest is not None:
                yield b"".join(rest)
            yield from lines[:-1]
            rest = [lines[-1]]
    if rest and (last := b"".join(rest)):
        yield last


def _joined(found: Iterator[tuple[bool, int, bytes]]) -> Iterator[tuple[int, bytes]]:
    """(place, content) of the range's own frames, joined to about READ bytes."""
    place, held, n = 0, [], 0
    for owned, at, part in found:
        if not owned:
            break
        place = place if held else at
        held.append(part)
        n += len(part)
        if n >= READ:
            yield place, b"".join(held)
            held, n = [], 0
    if held:
        yield place, b"".join(held)


class FramedReader(DataSourceReader):
    def __init__(self, options: dict[str, str], raw: bool):
        self.paths, self.step, self.raw = json.loads(options["paths"]), int(options.get("rangebytes", RANGE)), raw

    def partitions(self) -> list[Range]:
        return [Range(path, at, min(at + self.step, size), size) for path, size in listed(self.paths) for at in range(0, size, self.step)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        where = part.size, part.start, part.end
        with opened(part.path) as file:
            if self.raw:
                schema = pa.schema([("path", pa.string()), ("at", pa.int64()), ("content", pa.binary())])
                yield from _batches(((part.path, *x) for x in _joined(range_frames(file, *where))), schema)
            else:
                schema = pa.schema([("path", pa.string()), ("value", pa.string())])
                yield from _batches(((part.path, x.decode("utf-8", "replace")) for x in range_lines(file, *where)), schema)


class FramedSource(DataSource):
    """Options: paths (a JSON list; folders and names with * too), mode (lines or raw), rangeBytes."""

    @classmethod
    def name(cls) -> str:
        return "terrace_framed"

    def schema(self) -> str:
        return "path string, at long, content binary" if self.options.get("mode") == "raw" else "path string, value string"

    def reader(self, schema) -> FramedReader:
        return FramedReader(dict(self.options), self.options.get("mode") == "raw")


def _read(spark: SparkSession, paths: str | list[str], mode: str, range_bytes: int | None) -> DataFrame:
    spark.dataSource.register(FramedSource)
    size = range_bytes or spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return spark.read.format("terrace_framed").options(paths=json.dumps([paths] if isinstance(paths, str) else paths), mode=mode, rangeBytes=size).load()


def read_framed(spark: SparkSession, paths: str | list[str], range_bytes: int | None = None) -> DataFrame:
    """(path, at, content): raw bytes of some frames together and the place of the first in the file; in this order they are the file's content."""
    return _read(spark, paths, "raw", range_bytes)


def read_framed_lines(spark: SparkSession, paths: str | list[str], range_bytes: int | None = None, tasks: int | None = None) -> DataFrame:
    """(path, value): the lines of each file. Ranges are as large as Spark's (spark.sql.files.maxPartitionBytes) unless told otherwise; smaller if ``tasks`` have less to read."""
    if tasks and not range_bytes:
        each = -(-sum(n for _, n in listed([paths] if isinstance(paths, str) else paths)) // tasks)
        range_bytes = min(max(each, LEAST_RANGE), spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return _read(spark, paths, "lines", range_bytes)


def write_framed(lines: DataFrame, path: str, most: int = 250_000_000) -> None:
    """Lines (value) as .sz files of about ``most`` raw bytes; each task writes its own, and ``_SUCCESS`` comes last."""
    from terrace.sources.parts import write_parts

    write_parts(lines.select("value"), path, "framed", most)
