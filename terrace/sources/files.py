"""Files by any file system that Arrow reads, for data sources that are written in Python."""

from __future__ import annotations

import fnmatch
import posixpath
import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, path in it) of a URI or a local path."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def listed(paths: list[str]) -> list[tuple[str, int]]:
    """(path, bytes) of files, of those in folders, and of those that a name with * stands for; hidden ones and markers are left out. FileNotFoundError for
    a path without anything."""
    out = []
    for path in paths:
        system, inner = located(path)
        above, name = posixpath.split(inner.rstrip("/"))
        if "*" in name:
            found = [x for x in system.get_file_info(fs.FileSelector(above)) if fnmatch.fnmatchcase(x.base_name, name)]
        else:
            found = [system.get_file_info(inner)]
        if not found or found[0].type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
        for x in found:
            some = system.get_file_info(fs.FileSelector(x.path)) if x.type == fs.FileType.Directory else [x]
            out += [(prefix + y.path, y.size) for y in some if y.type == fs.FileType.File and not y.base_name.startswith(("_", "."))]
    return sorted(out)


class Opened:
    """A file open for reading; ``beside`` opens it once more."""

    def __init__(self, path: str):
        self.path, self._more = path, []
        system, inner = located(path)
        self._open = lambda: system.open_input_file(inner)
        self._file = self._open()
        self.seek, self.read = self._file.seek, self._file.read

    def beside(self) -> Opened:
        self._more.append(Opened(self.path))
        return self._more[-1]

    def close(self) -> None:
        for x in (self._file, *self._more):
            x.close()


@contextmanager
def opened(path: str) -> Iterator[Opened]:
    file = Opened(path)
    try:
        yield file
    finally:
        file.close()
