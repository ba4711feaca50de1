"""A data source that writes lines of text, all or nothing.

Tasks write under names of their own in a hidden folder. Only when all tasks are done does the commit move what the
successful attempts have written to its place; a job that fails removes it. So a lost executor, a repeated or a failing
task leaves no half file and no second copy behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from seqtally.sources.records import _open_fs


class Written(WriterCommitMessage):
    """(number of the task, [(file it wrote, name of the key or None)])."""

    def __init__(self, task: int, files: list[tuple[str, str | None]]) -> None:
        self.task, self.files = task, files


class LineWriter(DataSourceArrowWriter):
    """Rows `key, value`: without keys a file per task, with keys a file per key, whose rows stand together."""

    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.suffix = options["path"].rstrip("/"), options.get("suffix", ".txt")
        self.header, self.where = options.get("header", ""), options.get("where", "each")
        self.overwrite = overwrite
        self.hidden = f"{self.path}/_writing-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get().partitionId()
        fs, folder = _open_fs(self.hidden)
        fs.create_dir(folder, recursive=True)
        files: list[tuple[str, str | None]] = []
        out, now, opened = None, None, False
        for batch in batches:
            for key, value in zip(batch.column("key").to_pylist(), batch.column("value").to_pylist()):
                if not opened or key != now:
                    if out is not None:
                        out.close()
                    name = f"{folder}/{task}-{uuid.uuid4().hex}"
                    out, now, opened = fs.open_output_stream(name), key, True
                    files.append((name, key))
                    if self.header and (self.where == "each"):
                        out.write(self.header.encode())
                out.write(f"{value or ''}\n".encode())
        if out is not None:
            out.close()
        return Written(task, files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = _open_fs(self.path)
        done = sorted((m.task, i, *f) for m in messages if m is not None for i, f in enumerate(m.files))
        keys = [key for *_, key in done if key is not None]
        if len(keys) != len(set(keys)):
            raise ValueError("the rows of a key stand in several places; sort them by key")
        old = [f.path for f in fs.get_file_info(pafs.FileSelector(folder)) if f.path.rsplit("/", 1)[-1][0] not in "._"]
        if old and not self.overwrite:
            raise FileExistsError(self.path)
        for path in old:
            fs.delete_file(path)
        if self.header and self.where == "first":  # a file that sorts before the others
            with fs.open_output_stream(f"{folder}/part-00000-header{self.suffix}") as out:
                out.write(self.header.encode())
        for number, (_, _, name, key) in enumerate(done, 1):
            fs.move(name, f"{folder}/{f'part-{number:05d}' if key is None else quote(key, safe=' |=,+')}{self.suffix}")
        self._clear(fs)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(_open_fs(self.path)[0])

    def _clear(self, fs: pafs.FileSystem) -> None:
        hidden = _open_fs(self.hidden)[1]
        if fs.get_file_info(hidden).type != pafs.FileType.NotFound:
            fs.delete_dir(hidden)


class LineSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "text_lines"

    def schema(self) -> str:
        return "key string, value string"

    def writer(self, schema, overwrite: bool) -> LineWriter:
        return LineWriter(dict(self.options), overwrite)


def write_lines(rows: DataFrame, path: str, header: str = "", where: str = "each", suffix: str = ".txt") -> None:
    """Write `key, value`: one file per key, or one per task where the key is null, numbered in order of the tasks.

    `where` the header stands: in front of `each` file, or before all as a file of its own that comes `first`.
    """
    rows.sparkSession.dataSource.register(LineSink)
    (rows.write.format("text_lines").mode("overwrite").option("path", path).option("header", header)
     .option("where", where).option("suffix", suffix).save())
