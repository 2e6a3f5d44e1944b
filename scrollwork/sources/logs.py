"""Growing logs as a data source: files are cut into ranges of bytes, and every line belongs to the range it begins in.

    spark.dataSource.register(LogLines)
    spark.read.format("log_lines").option("path", folder).load()
    spark.readStream.format("log_lines").option("path", folder).load()

No file is ever held: a task reads blocks of its range and goes on past its end only to finish the last line. The stream
ends each batch at the last line feed of a file, so a line still being written is read once it is whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..functions.text import is_blank

#: Bytes of a range, and of a block that is read at once.
SPLIT, BLOCK = 64 << 20, 1 << 20
#: Lines that are handed on at once, and characters of them.
LINES, CHARACTERS = 10_000, 4 << 20
SCHEMA = "path string, range_start long, line_in_range int, offset long, line string, is_ended boolean"
_ARROW = pa.schema([("path", pa.string()), ("range_start", pa.int64()), ("line_in_range", pa.int32()), ("offset", pa.int64()), ("line", pa.string()), ("is_ended", pa.bool_())])


def file_sizes(path: str) -> dict[str, int]:
    """Files under a folder (or one file), with their sizes."""
    system, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        return {}
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root, recursive=True))
    hidden = lambda f: any(part[:1] in "._" for part in f.path[len(root) :].split("/") if part)
    return {f.path: f.size for f in sorted(found, key=lambda f: f.path) if f.type == fs.FileType.File and not hidden(f)}


def _system(path: str) -> fs.FileSystem:
    return fs.FileSystem.from_uri(path)[0] if "://" in path or path.startswith("file:") else fs.LocalFileSystem()


@dataclass
class Range(InputPartition):
    """Bytes of one file, from `start` up to `end`."""

    path: str
    start: int
    end: int


def ranges(path: str, start: int, end: int, size: int) -> list[Range]:
    return [Range(path, at, min(at + size, end)) for at in range(start, end, size)]


def lines_of(file, start: int, end: int) -> Iterator[tuple[int, bytes, bool]]:
    """Offset, bytes and whether it is ended of every line that begins from `start` up to `end`; blocks are read one by one."""
    at = max(start - 1, 0)  # the byte before tells whether a line begins at the start
    file.seek(at)
    skipping, begun, parts = start > 0, at, []
    while block := file.read(BLOCK):
        low = 0
        while (high := block.find(b"\n", low)) >= 0:
            if not skipping:
                yield begun, b"".join([*parts, block[low:high]]), True
            skipping, parts, low = False, [], high + 1
            begun = at + low
            if begun >= end:
                return
        at += len(block)
        if skipping and at >= end:
            return  # no line begins in this range
        if not skipping:
            parts.append(block[low:])
    if not skipping and any(parts):
        yield begun, b"".join(parts), False


def last_line_end(system: fs.FileSystem, path: str, size: int) -> int:
    """The byte after the last line feed; read backward, so only the tail is read."""
    with system.open_input_file(path) as file:
        to = size
        while to > 0:
            at = max(to - BLOCK, 0)
            file.seek(at)
            found = file.read(to - at).rfind(b"\n")
            if found >= 0:
                return at + found + 1
            to = at
    return 0


def read_range(system: fs.FileSystem, part: Range) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    with system.open_input_file(part.path) as file:
        for k, (offset, line, is_ended) in enumerate(lines_of(file, part.start, part.end)):
            rows.append((part.path, part.start, k, offset, line.decode("utf-8", "replace"), is_ended))
            size += len(line)
            if len(rows) >= LINES or size >= CHARACTERS:
                yield _batch(rows)
                rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


class _Options:
    def __init__(self, options: dict):
        self.path = options["path"]
        self.split = int(options.get("splitbytes", SPLIT))
        if self.split <= 0:
            raise ValueError("splitBytes is a positive number")


class LogReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = _Options(options)

    def partitions(self) -> list[Range]:
        return [r for path, size in file_sizes(self.options.path).items() for r in ranges(path, 0, size, self.options.split)]

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is not None:  # a folder without files has one partition without a range
            yield from read_range(_system(self.options.path), partition)


class LogStreamReader(DataSourceStreamReader):
    """Offsets are a number for each file: the byte after its last whole line. Files only grow."""

    def __init__(self, options: dict):
        self.options = _Options(options)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        system = _system(self.options.path)
        return {path: last_line_end(system, path, size) for path, size in file_sizes(self.options.path).items()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return [r for path, to in end.items() for r in ranges(path, start.get(path, 0), to, self.options.split)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read_range(_system(self.options.path), partition)


class LogLines(DataSource):
    """Options: path (a file or a folder, by a path or a URI that Arrow's file systems know), splitBytes."""

    @classmethod
    def name(cls) -> str:
        return "log_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LogReader:
        return LogReader(self.options)

    def streamReader(self, schema) -> LogStreamReader:
        return LogStreamReader(self.options)


def read_lines(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """SCHEMA's rows of all files."""
    spark.dataSource.register(LogLines)
    return spark.read.format("log_lines").option("path", path).option("splitBytes", split).load()


def stream_lines(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """The same as a stream; every line is whole."""
    spark.dataSource.register(LogLines)
    return spark.readStream.format("log_lines").option("path", path).option("splitBytes", split).load()


def checked(lines: DataFrame) -> DataFrame:
    """Lines with a value (a variant; null if it is no JSON), is_valid (an object) and is_tail (a last line that is neither
    ended nor valid). Blank lines are left out."""
    value = F.try_parse_json("line")
    valid = value.isNotNull() & F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    return lines.where(~is_blank(F.col("line"))).select("*", value.alias("value"), valid.alias("is_valid"), (~F.col("is_ended") & ~valid).alias("is_tail"))


def numbered(lines: DataFrame, found: DataFrame) -> DataFrame:
    """`found` (some of the rows of `lines`) with line_no, from 0 within each file. Lines are counted by range, and a range
    starts where those before it end; what is summed up is a row for each range."""
    counts = lines.groupBy("path", "range_start").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("range_start")) - F.col("n")
    starts = counts.select("path", "range_start", before.alias("lines_before"))
    return found.join(starts, ["path", "range_start"]).withColumn("line_no", F.col("lines_before") + F.col("line_in_range")).drop("lines_before")
