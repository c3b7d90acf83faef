"""A data source that reads the first bytes of each of many files, so that a header costs its own bytes and not the file's."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringContains, StringEndsWith, StringStartsWith

SCHEMA = "path string, size long, head binary"


class Files(InputPartition):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


class HeadReader(DataSourceReader):
    """Lists files below `path` whose name fits one of the globs in `glob` (joined by |) and deals them out `files_per_task` at a time; filters on the path are applied to the list, before anything is opened."""

    def __init__(self, options: dict):
        self.root, self.globs = options["path"], options.get("glob", "*").split("|")
        self.length, self.each = int(options.get("length", "127")), int(options.get("files_per_task", "1000"))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In, StringStartsWith, StringEndsWith, StringContains)) and f.attribute == ("path",):
                self.filters.append(f)
            else:
                yield f

    def _wanted(self, path: str) -> bool:
        for f in self.filters:
            v = f.value
            ok = {EqualTo: lambda: path == v, In: lambda: path in v, StringStartsWith: lambda: path.startswith(v), StringEndsWith: lambda: path.endswith(v), StringContains: lambda: v in path}[type(f)]()
            if not ok:
                return False
        return any(fnmatch.fnmatchcase(path.rpartition("/")[2], g) for g in self.globs)

    def _open(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.root if "://" in self.root or self.root.startswith("file:") else f"file://{self.root}")

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        system, base = self._open()
        found = system.get_file_info(fs.FileSelector(base, recursive=True))
        files = sorted((i.path, i.size) for i in found if i.type == fs.FileType.File and self._wanted(i.path))
        return [Files(files[k : k + self.each]) for k in range(0, len(files), self.each)] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        system, _ = self._open()
        for path, size in partition.files:
            with system.open_input_file(path) as f:
                yield path, size, bytes(f.read(self.length))


class Heads(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_heads"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> HeadReader:
        return HeadReader(dict(self.options))


def file_heads(spark: SparkSession, root: str, glob: str = "*", length: int = 127, files_per_task: int = 1000):
    """A8. (path, size, head): the first `length` bytes of each file below root whose name fits glob (several, joined by |). Comparisons of path with texts prune the list of files."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Heads)
    return spark.read.format("file_heads").option("glob", glob).option("length", str(length)).option("files_per_task", str(files_per_task)).load(root)
