"""Landing zone: which files of a mirror make up a dump, and taking them over, unless they are there in the same size.

A mirror is a folder on any file system that Arrow reads; what its listing or its feed says is given as text or as names. Tasks copy the files, one each; the driver
only sees names and sizes.
"""

from __future__ import annotations

import fnmatch
import posixpath
import re
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime, timedelta

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession

from terrace.sources.files import located

MARKER = "ok"


def yesterday(now: datetime | None = None) -> str:
    return ((now or datetime.now(UTC)) - timedelta(days=1)).strftime("%Y%m%d")


def last_listed(listing: str, pattern: str = r'href="(\d{8})/?"') -> str | None:
    """The last date of a directory listing."""
    found = re.findall(pattern, listing)
    return found[-1] if found else None


def latest_entities(listing: str) -> str | None:
    """The last date of a listing of entity dumps, which are named by date."""
    return last_listed(listing, r'href="(\d*)\.json\.gz')


def latest_in_feed(feed: str) -> str | None:
    """The date that the first link of a feed ends with."""
    found = re.search(r"<link>.*/(20\d+)</link>", feed)
    return found[1] if found else None


def linked(listing: str) -> list[str]:
    """Names of the files that a listing links to, without their folders."""
    return [posixpath.basename(x) for x in re.findall(r'href="([^"\\]+)"', listing)]


def wiki_files(names: Iterable[str], wiki: str, date: str) -> list[str]:
    """The numbered parts of a page dump; the single file where there are none."""
    begin = f"{wiki}-{date}-pages-articles"
    found = [x for x in names if re.match(rf"{re.escape(begin)}\d", x)]
    return list(dict.fromkeys(found)) or [f"{begin}.xml.bz2"]


def entity_files(date: str) -> list[str]:
    return [f"{date}.json.gz"]


def pagecounts_folder(date: str) -> str:
    """Where a mirror keeps the page counts of a day: year/year-month."""
    return f"{date[:4]}/{date[:4]}-{date[4:6]}"


def pagecounts_files(names: Iterable[str], date: str) -> list[str]:
    return list(dict.fromkeys(x for x in names if re.fullmatch(rf"pagecounts-{date}-.*\.gz", x)))


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each file whole or not at all: it gets its name when all of it is there."""
    for batch in batches:
        for source, target in zip(batch.column("source").to_pylist(), batch.column("target").to_pylist(), strict=True):
            (here, at), (there, to) = located(source), located(target)
            part = f"{posixpath.dirname(to)}/_part-{posixpath.basename(to)}-{TaskContext.get().taskAttemptId()}"
            fs.copy_files(at, part, source_filesystem=here, destination_filesystem=there)
            there.move(part, to)
            yield pa.RecordBatch.from_arrays([pa.array([posixpath.basename(to)])], names=["name"])


def take_over(spark: SparkSession, source: str, target: str, names: Iterable[str]) -> list[str]:
    """Copy those files of a folder to another that aren't there in the same size, largest first; the names of those that were copied. FileNotFoundError for a file that isn't in ``source``."""
    (here, at), (there, to) = located(source.rstrip("/")), located(target.rstrip("/"))
    there.create_dir(to)
    found = {x: here.get_file_info(f"{at}/{x}") for x in names}
    missing = sorted(x for x, info in found.items() if info.type != fs.FileType.File)
    if missing:
        raise FileNotFoundError(f"not in {source}: {', '.join(missing)}")
    present = {x.base_name: x.size for x in there.get_file_info(fs.FileSelector(to))}
    todo = sorted((x for x, info in found.items() if present.get(x) != info.size), key=lambda x: (-found[x].size, x))
    if todo:
        rows = [(f"{source.rstrip('/')}/{x}", f"{target.rstrip('/')}/{x}") for x in todo]
        tasks = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "source string, target string")
        tasks.mapInArrow(_copies, "name string").collect()
    return todo


def import_snapshot(source: str, root: str, name: str, date: str, pattern: str = "*", spark: SparkSession | None = None, names: Iterable[str] | None = None) -> list[str]:
    """Take over the files of a folder (those named, or that match) as root/download/name/date, then mark it as finished; what was copied."""
    here, at = located(source.rstrip("/"))
    if names is None:
        names = [x.base_name for x in here.get_file_info(fs.FileSelector(at)) if x.type == fs.FileType.File and fnmatch.fnmatchcase(x.base_name, pattern)]
    target = f"{root.rstrip('/')}/download/{name}/{date}"
    copied = take_over(spark or SparkSession.active(), source, target, names)
    there, to = located(target)
    there.open_output_stream(f"{to}/{MARKER}").close()
    return copied
