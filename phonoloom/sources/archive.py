"""A12, A13. Byte ranges of archive members as a data source.

An archive has an index beside it, ``<archive>.idx``: member, offset and size, parted by tabs. The driver only asks for
the sizes of the archives; an index is read by the tasks of its archive, and a large archive is parted by offset.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def _opened(path: str):
    """(file system, path) of a local path or a URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class _Slice(InputPartition):
    """The members of an archive whose offset lies in [lo, hi)."""

    def __init__(self, archive: str, lo: int, hi: int):
        super().__init__((archive, lo))
        self.archive, self.lo, self.hi = archive, lo, hi


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], split_bytes: int):
        self.paths, self.split_bytes = paths, split_bytes

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for p in self.paths:
            fs, at = _opened(p)
            size = fs.get_file_info(at).size or 0
            n = max(1, math.ceil(size / self.split_bytes))
            edges = [size * k // n for k in range(n)] + [1 << 62]
            out += [_Slice(p, lo, hi) for lo, hi in zip(edges, edges[1:])]
        return out

    def read(self, partition: _Slice) -> Iterator[tuple]:
        fs, at = _opened(partition.archive)
        members = []
        with fs.open_input_stream(at + ".idx") as f:
            for line in f.read().decode("utf-8").splitlines():
                match line.split("\t"):
                    case [name, offset, size] if offset.isdigit() and size.isdigit() and partition.lo <= int(offset) < partition.hi:
                        members.append((int(offset), int(size), name))
        with fs.open_input_file(at) as f:
            for offset, size, name in sorted(members):
                data = f.read_at(size, offset)
                if len(data) < size:
                    raise OSError(f"{partition.archive}: {name} is cut short")
                yield partition.archive, name, offset, size, data


class ArchiveSource(DataSource):
    """``spark.read.format("archive_members").option("paths", "a.tar,b.tar")``, paths local or as URIs.

    ``split_bytes`` (64 MB) bounds the stretch of an archive a task reads. Rows of an index without exactly three fields are left out.
    """

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return "archive string, member string, offset long, size long, data binary"

    def reader(self, schema) -> DataSourceReader:
        return _Reader([p for p in self.options.get("paths", "").split(",") if p], int(self.options.get("split_bytes", 64 << 20)))
