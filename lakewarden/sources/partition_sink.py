"""A sink of partition files: each is written once, under its own name, by all tasks together or not at all.

Tasks write under names of their own; the commit gives all files their names, and fails before the first one if any is
there already, for partition files never change. What a failed write leaves is deleted when the job is given up.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from .records import partition_files


def _opened(root: str):
    """File system and base path of a folder that all executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root if "://" in root else f"file://{os.path.abspath(root)}")


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class PartitionWriter(DataSourceWriter):
    def __init__(self, root: str):
        self.root, self.mark = root, f"{uuid.uuid4().hex}.tmp"

    def write(self, rows: Iterator) -> Written:
        files, base = _opened(self.root)
        done: list[tuple[str, str]] = []
        try:
            for r in rows:
                path = f"{base}/{r.day}/{r.name}"
                files.create_dir(f"{base}/{r.day}", recursive=True)
                done.append((f"{path}.{uuid.uuid4().hex}.{self.mark}", path))  # a second attempt of the task has others
                with files.open_output_stream(done[-1][0]) as out:
                    out.write(bytes(r.content))
        except BaseException:
            self._drop(files, [aside for aside, _ in done])
            raise
        return Written(done)

    @staticmethod
    def _drop(files, paths: list[str]) -> None:
        from pyarrow import fs

        for p in paths:
            if files.get_file_info(p).type == fs.FileType.File:
                files.delete_file(p)

    def commit(self, messages: list) -> None:
        from pyarrow import fs

        files, _ = _opened(self.root)
        pairs = [p for m in messages if m is not None for p in m.files]
        there = [f.path for f in files.get_file_info([path for _, path in pairs]) if f.type != fs.FileType.NotFound] if pairs else []
        if there:
            raise FileExistsError(f"partition files never change, and {len(there)} are there already: {there[0]}")
        named: list[str] = []
        try:
            for aside, path in pairs:
                if isinstance(files, fs.LocalFileSystem):
                    os.link(aside, path)  # fails if somebody was faster
                    os.remove(aside)
                else:
                    files.move(aside, path)
                named.append(path)
        except BaseException:
            self._drop(files, named)
            raise

    def abort(self, messages: list) -> None:
        from pyarrow import fs

        files, base = _opened(self.root)
        self._drop(files, [aside for m in messages if m is not None for aside, _ in m.files])
        if files.get_file_info(base).type == fs.FileType.Directory:  # of tasks that are lost there is no message
            self._drop(files, [f.path for f in files.get_file_info(fs.FileSelector(base, recursive=True)) if f.path.endswith(self.mark)])


class PartitionSink(DataSource):
    """Batch sink `partition_files` of rows (day, name, content). Option: root, a folder that all executors share."""

    @classmethod
    def name(cls) -> str:
        return "partition_files"

    def schema(self) -> str:
        return "day string, name string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("partition files never change")
        return PartitionWriter(self.options["root"])


def write_partitions(entries: DataFrame, root: str, compress: bool = False) -> None:
    """Write one file for each contiguous run of indices within a UTC day; fails, and changes nothing, if one is there."""
    entries.sparkSession.dataSource.register(PartitionSink)
    partition_files(entries, compress).write.format("partition_files").option("root", root).mode("append").save()
