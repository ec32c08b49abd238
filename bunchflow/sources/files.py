"""Files by path or URI, on any store that Arrow's file systems know."""

from __future__ import annotations

import re
from typing import BinaryIO

from pyarrow import fs


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path as Spark writes it, and the path in that store."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def opened(path: str):
    store, at = filesystem(path)
    return store.open_input_file(at)


class Range:
    """Bytes begin .. end of a seekable file, read in order; a read never takes more than it asks for."""

    def __init__(self, f: BinaryIO, begin: int = 0, end: int | None = None):
        f.seek(0, 2)
        size = f.tell()
        f.seek(begin)
        self.f, self.begin, self.at, self.end = f, begin, begin, size if end is None else end
        self.whole = begin == 0 and self.end == size

    def take(self, n: int) -> bytes:
        """The next n bytes, or what is left."""
        out = self.f.read(min(n, self.end - self.at))
        self.at += len(out)
        return bytes(out)

    def skip(self, n: int) -> bool:
        """Passes n bytes unread; whether there were so many."""
        self.at += n
        if self.at <= self.end:
            self.f.seek(self.at)
        return self.at <= self.end

    def peek(self, at: int, n: int) -> bytes:
        """n bytes from a place of the file, which may lie outside the range; the reading goes on where it was."""
        self.f.seek(at)
        out = bytes(self.f.read(n))
        self.f.seek(self.at)
        return out
