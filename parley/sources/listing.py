"""A data source that lists files, in tasks.

``format("parley_files")`` lists folders with pyarrow's file systems: files of any length and any name (Spark's own listing
leaves out names that begin with ``_`` or ``.``, and zero-length files).  The driver walks down only until there are enough
folders to deal out; each task lists its folders with all that lies below them.  No file is opened.
"""

from __future__ import annotations

import fnmatch
import json
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, length long, modificationTime timestamp"
FOLDERS = 64        # the driver stops walking down when it has so many folders
NAMES = 10_000      # files that lie above them are dealt out in partitions of this size


def _open(uri: str):
    """The file system and path of a URI or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class _Part(InputPartition):
    def __init__(self, root: str, folders: list[str], files: list[tuple]):
        self.root, self.folders, self.files = root, folders, files


class FileListReader(DataSourceReader):
    def __init__(self, options):
        self.roots = json.loads(options["roots"])
        self.glob = options.get("glob") or None
        self.recursive = options.get("recursive", "true") == "true"

    def _children(self, system, folder: str, recursive: bool = False) -> tuple[list[str], list[tuple]]:
        from pyarrow import fs

        folders, files = [], []
        for info in system.get_file_info(fs.FileSelector(folder, recursive=recursive)):
            if info.type == fs.FileType.Directory:
                folders.append(info.path)
            elif info.type == fs.FileType.File and (not self.glob or fnmatch.fnmatchcase(info.base_name, self.glob)):
                files.append((info.path, info.size, info.mtime))
        return folders, files

    def partitions(self) -> list[_Part]:
        parts = []
        for root in self.roots:
            system, top = _open(root)
            from pyarrow import fs

            if system.get_file_info(top).type == fs.FileType.File:
                info = system.get_file_info(top)
                parts.append(_Part(root, [], [(info.path, info.size, info.mtime)]))
                continue
            open_folders, files = self._children(system, top)
            # one level at a time, while there are few folders and there is a level
            while self.recursive and open_folders and len(open_folders) < FOLDERS:
                below = [self._children(system, f) for f in open_folders]
                files += [x for _, own in below for x in own]
                open_folders = [x for own, _ in below for x in own]
            if self.recursive:
                step = -(-len(open_folders) // max(FOLDERS, 1)) or 1
                parts += [_Part(root, open_folders[n: n + step], []) for n in range(0, len(open_folders), step)]
            parts += [_Part(root, [], files[n: n + NAMES]) for n in range(0, len(files), NAMES)]
        return parts or [_Part("", [], [])]

    def read(self, part: _Part) -> Iterator[tuple]:
        files = list(part.files)
        if part.folders:
            system, _ = _open(part.root)
            for f in part.folders:
                files += self._children(system, f, recursive=True)[1]
        scheme = part.root.split(":", 1)[0] + ":" if ":" in part.root.split("/", 1)[0] else "file:"
        for path, size, time in files:
            yield (scheme + path if path.startswith("/") else f"{scheme}//{path}"), size, time


class FileList(DataSource):
    """Options: ``roots`` (JSON array of folders or files), ``glob`` (on the base name), ``recursive``."""

    @classmethod
    def name(cls) -> str:
        return "parley_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FileListReader:
        return FileListReader(self.options)


def file_list(spark: SparkSession, roots: list[str], glob: str | None, recursive: bool):
    spark.dataSource.register(FileList)
    reader = spark.read.format("parley_files").option("roots", json.dumps(roots)).option("recursive", str(recursive).lower())
    return (reader.option("glob", glob) if glob else reader).load()
