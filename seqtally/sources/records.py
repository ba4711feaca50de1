"""A data source for records of several lines that have no separator of their own.

Files are divided into byte ranges of a fixed size, whatever the session. The task that holds a range looks for the
first record that begins in it, by what the lines of a record look like, and reads on to the end of the record that
begins last: no line is shuffled or landed to meet its neighbours. A record is known by its file, range and number in
the range, which no other scan changes. Compressed files are one range each.
"""

from __future__ import annotations

import fnmatch
import gzip
import io
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from seqtally.operators.common import checked_broadcast
from seqtally.session import cut_lineage

RANGE_BYTES = 128 << 20


class Format(NamedTuple):
    """How many lines a record has, how many come before the first one, and where among some lines one begins.

    Without a number of lines, a record goes from one line with the mark in front to the next."""
    lines: int
    skipped: int
    begin: Callable[[list[str]], int | None] | None
    mark: bytes = b""


def _fastq_begin(lines: list[str]) -> int | None:
    """Only a header has an `@` in front and a `+` two lines on: behind a quality line there are a header and bases."""
    return next((i for i in range(len(lines) - 3) if lines[i].startswith("@") and lines[i + 2].startswith("+")), None)


def _ann_begin(lines: list[str]) -> int | None:
    """A record's second line is offset, length and a number, and the offset of the next goes on where it ends."""
    def place(line: str) -> tuple[int, int] | None:
        parts = line.split()
        return (int(parts[0]), int(parts[1])) if len(parts) == 3 and all(p.isdigit() for p in parts) else None

    for i in (0, 1):
        places = [place(v) for v in lines[i + 1::2]]
        if places and all(places) and all(a[0] + a[1] == b[0] for a, b in zip(places, places[1:])):
            return i
    return None


FORMATS = {"fastq": Format(4, 0, _fastq_begin), "ann": Format(2, 1, _ann_begin), "fasta": Format(0, 0, None, b">")}
LOOK = 12  # lines looked at for the first border


def _open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _hidden(path: str) -> bool:
    return path.rsplit("/", 1)[-1].startswith((".", "_"))


def listed_files(path: str) -> list[tuple[str, int]]:
    """(name, size) of a file, of the files of a folder, or of those that a pattern with `*` or `?` matches."""
    fs, inner = _open_fs(path)
    if "*" in inner or "?" in inner:
        parts = inner.split("/")
        fixed = next(i for i, p in enumerate(parts) if "*" in p or "?" in p)
        found = fs.get_file_info(pafs.FileSelector("/".join(parts[:fixed]) or "/", recursive=True))
        found = [f for f in found if len(f.path.split("/")) == len(parts)
                 and all(fnmatch.fnmatchcase(a, b) for a, b in zip(f.path.split("/"), parts))]
    else:
        found = [fs.get_file_info(inner)]
        if found[0].type == pafs.FileType.NotFound:
            raise FileNotFoundError(path)
        if found[0].type == pafs.FileType.Directory:
            found = fs.get_file_info(pafs.FileSelector(inner))
    scheme = path.split("://")[0] + "://" if "://" in path else ""
    files = [(f.path, f.size) for f in found if f.type == pafs.FileType.File and not _hidden(f.path)]
    host = path.split("://")[1].split("/")[0] if scheme and not scheme.startswith("file") else ""
    return sorted((f"{scheme}{host if not name.startswith(host) else ''}{name}", size) for name, size in files)


class Range(InputPartition):
    def __init__(self, file: str, start: int, end: int | None) -> None:
        self.file, self.start, self.end = file, start, end


class RecordReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.files = options["files"].split("\n")
        self.format = options["kind"]
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.count = options.get("count", "false") == "true"

    def partitions(self) -> list[Range]:
        out = []
        for path in self.files:
            for name, size in listed_files(path):
                if name.endswith(".gz"):
                    out.append(Range(name, 0, None))
                else:
                    out += [Range(name, b, min(size, b + self.range_bytes)) for b in range(0, size, self.range_bytes)]
        return out or [Range("", 0, 0)]

    def records(self, part: Range) -> Iterator[list[str]]:
        """The records that begin in the range, as their lines."""
        if not part.file:
            return
        kind = FORMATS[self.format]
        fs, inner = _open_fs(part.file)
        with fs.open_input_file(inner) as raw:
            if part.end is None:
                stream, at, end = io.BufferedReader(gzip.GzipFile(fileobj=raw)), 0, None
            else:
                raw.seek(max(0, part.start - 1))
                stream, at, end = io.BufferedReader(raw, 1 << 20), max(0, part.start - 1), part.end
            if part.start:
                at += len(stream.readline())  # what is left of the line before the range
            if kind.mark:
                yield from self._marked(stream, kind.mark, at, end)
                return
            if part.start:
                ahead = [stream.readline() for _ in range(LOOK)]
                first = kind.begin([v.decode().rstrip("\r\n") for v in ahead if v])
                if first is None:
                    return
                at += sum(map(len, ahead[:first]))
                ahead = ahead[first:]
            else:
                ahead = []
                for _ in range(kind.skipped):
                    at += len(stream.readline())
            lines = iter(lambda: ahead.pop(0) if ahead else stream.readline(), b"")
            while end is None or at < end:
                record, size = [], 0
                for line in lines:
                    size += len(line)
                    if record or line.strip():  # blank lines between records
                        record.append(line.decode().rstrip("\r\n"))
                    if len(record) == kind.lines:
                        break
                if len(record) < kind.lines:
                    return
                yield record
                at += size

    @staticmethod
    def _marked(stream: io.BufferedReader, mark: bytes, at: int, end: int | None) -> Iterator[list[str]]:
        """Records that begin with a marked line at a place below `end`, as one text each."""
        held: list[bytes] = []
        for line in stream:
            if line.startswith(mark):
                if held:
                    yield [b"".join(held).decode()]
                    held = []
                if end is not None and at >= end:
                    return
                held.append(line)
            elif held:
                held.append(line)
            elif end is not None and at >= end:
                return
            at += len(line)
        if held:
            yield [b"".join(held).decode()]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if self.count:
            n = sum(1 for _ in self.records(part))
            yield pa.RecordBatch.from_pydict({"file": [part.file], "block": [part.start], "n": [n]}, COUNTS)
            return
        held: list[list[str]] = []
        row = 0
        for record in self.records(part):
            held.append(record)
            if len(held) == 8192:
                yield self._batch(part, row, held)
                row, held = row + len(held), []
        if held:
            yield self._batch(part, row, held)

    @staticmethod
    def _batch(part: Range, row: int, held: list[list[str]]) -> pa.RecordBatch:
        n = len(held)
        return pa.RecordBatch.from_arrays([pa.array([part.file] * n), pa.array([part.start] * n, pa.int64()),
                                           pa.array(range(row, row + n), pa.int64()), pa.array(held, pa.list_(pa.string()))],
                                          ["file", "block", "row", "lines"])


COUNTS = pa.schema([("file", pa.string()), ("block", pa.int64()), ("n", pa.int64())])


class RecordSource(DataSource):
    """`file, block, row, lines`, or `file, block, n` with the option `count`."""

    @classmethod
    def name(cls) -> str:
        return "line_records"

    def schema(self) -> str:
        counted = self.options.get("count", "false") == "true"
        return "file string, block long, " + ("n long" if counted else "row long, lines array<string>")

    def reader(self, schema) -> RecordReader:
        return RecordReader(dict(self.options))


def read_records(spark: SparkSession, path: str | list[str], kind: str, range_bytes: int = RANGE_BYTES,
                 number: bool = False) -> DataFrame:
    """`lines, file, ord` for each record. `ord` is (file, range, number in the range), or, with `number`, the 0-based
    number of the record in its file: the records before its range, counted in a scan of their own, plus its own.

    Files have to be where both the driver, which lists them, and the tasks can open them.
    """
    spark.dataSource.register(RecordSource)
    reader = (spark.read.format("line_records").option("kind", kind).option("range_bytes", range_bytes)
              .option("files", path if isinstance(path, str) else "\n".join(path)))
    rows = reader.load()
    if not number:
        return rows.select("lines", "file", F.struct("file", "block", "row").alias("ord"))
    counts = reader.option("count", "true").load()
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(counts.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")))
    return (rows.join(checked_broadcast(offsets), ["file", "block"])
            .select("lines", "file", (F.col("_before") + F.col("row")).alias("ord")))
