"""Stored pages of a paged API as a data source: batch, or a stream with a bookmark.

A page is a file of JSON lines. Names rise with the order in which pages came; the last one may
still grow, and is closed as soon as a page with a higher name exists. The bookmark is the last
page and the place in it up to which whole lines were taken, thus the order of arrival and not
the records' own times: a record that is late, or ties with one taken before, lies behind it.

Only lines are cut here, in the tasks, one page to a task; Spark parses them (``records``). The
driver lists the names and looks for the last line end of the last page.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "page_files"
LINES = T.StructType([
    T.StructField("line", T.StringType()),
    T.StructField("page", T.StringType()),
    T.StructField("place", T.LongType()),
])
# Bytes read at once, lines given on at once.
CHUNK = 1 << 20
ROWS = 4096


def _system(path: str) -> tuple[fs.FileSystem, str]:
    """File system and folder of a plain path or of a URI."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path.rstrip("/")
    system, folder = fs.FileSystem.from_uri(path)
    return system, folder.rstrip("/")


def _pages(path: str) -> list[tuple[str, int]]:
    """Name and size of the pages, lowest name first; hidden files are none.

    A page in a folder below, say that of a run, has the folder in its name.
    """
    system, folder = _system(path)
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=True))
    named = [(f.path[len(folder) :].lstrip("/"), f.size) for f in found if f.is_file]
    return sorted((name, size) for name, size in named if not any(p[0] in "._" for p in name.split("/")))


def _whole_lines(path: str, page: str, size: int) -> int:
    """Bytes of a page up to its last line end, looked for from its end on."""
    system, folder = _system(path)
    with system.open_input_file(f"{folder}/{page}") as file:
        end = size
        while end > 0:
            start = max(0, end - CHUNK)
            file.seek(start)
            at = file.read(end - start).rfind(b"\n")
            if at >= 0:
                return start + at + 1
            end = start
    return 0


@dataclass
class Span(InputPartition):
    """A page from a line start on: up to a line end, or the whole rest (``end`` None)."""

    page: str
    start: int
    end: int | None


def _lines(path: str, span: Span) -> Iterator[tuple[bytes, int]]:
    """The lines of a span with their places, read by chunks."""
    if not span.page:
        return
    system, folder = _system(path)
    with system.open_input_file(f"{folder}/{span.page}") as file:
        file.seek(span.start)
        end = file.size() if span.end is None else min(span.end, file.size())
        place, rest = span.start, b""
        while (at := file.tell()) < end:
            *whole, rest = (rest + file.read(min(CHUNK, end - at))).split(b"\n")
            for line in whole:
                yield line, place
                place += len(line) + 1
        if rest:
            yield rest, place


def _batches(path: str, span: Span) -> Iterator[pa.RecordBatch]:
    """A span's lines as Arrow batches; blank lines hold no record."""
    lines: list[str] = []
    places: list[int] = []

    def batch() -> pa.RecordBatch:
        pages = pa.array([span.page] * len(lines), pa.string())
        return pa.record_batch([pa.array(lines, pa.string()), pages, pa.array(places, pa.int64())],
                               names=LINES.fieldNames())

    for line, place in _lines(path, span):
        if line.strip():
            lines.append(line.decode("utf-8", "replace"))
            places.append(place)
        if len(lines) == ROWS:
            yield batch()
            lines, places = [], []
    if lines:
        yield batch()


class PageReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[Span]:
        # Spark asks for one partition at least.
        return [Span(name, 0, None) for name, _ in _pages(self.path)] or [Span("", 0, 0)]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        return _batches(self.path, partition)


class PageStreamReader(DataSourceStreamReader):
    def __init__(self, path: str, start: dict) -> None:
        self.path = path
        self.start = start

    def initialOffset(self) -> dict:
        return self.start

    def latestOffset(self) -> dict:
        pages = _pages(self.path)
        if not pages or pages[-1][0] < self.start["page"]:
            return self.start
        name, size = pages[-1]
        return {"page": name, "place": _whole_lines(self.path, name, size)}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        """The pages between two bookmarks; those before the last one are closed by now.

        A closed page may have grown since the first bookmark, and its last line needs no end.
        """
        spans = []
        for name, _ in _pages(self.path):
            if start["page"] <= name <= end["page"]:
                first = start["place"] if name == start["page"] else 0
                last = end["place"] if name == end["page"] else None
                if last is None or last > first:
                    spans.append(Span(name, first, last))
        return spans

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        return _batches(self.path, partition)


class PageFiles(DataSource):
    """Options: ``path``, and for a stream ``page`` and ``place`` of the bookmark to start from."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return LINES

    def reader(self, schema: T.StructType) -> PageReader:
        return PageReader(self.options["path"])

    def streamReader(self, schema: T.StructType) -> PageStreamReader:
        start = {"page": self.options.get("page", ""), "place": int(self.options.get("place", 0))}
        return PageStreamReader(self.options["path"], start)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all pages, with the page and the byte at which each starts."""
    spark.dataSource.register(PageFiles)
    return spark.read.format(FORMAT).load(path)


def stream_pages(spark: SparkSession, path: str, page: str = "", place: int = 0) -> DataFrame:
    """Lines as a stream, from a bookmark on; a checkpoint's own bookmark goes before it."""
    spark.dataSource.register(PageFiles)
    return spark.readStream.format(FORMAT).options(page=page, place=place).load(path)


def records(lines: DataFrame, record: T.StructType) -> DataFrame:
    """Lines parsed into the record's fields; ``_corrupt`` keeps a line that is no such record."""
    kept = T.StructType([*record.fields, T.StructField("_corrupt", T.StringType())])
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    parsed = F.from_json("line", kept, options).alias("_record")
    return lines.select(parsed, "page", "place").select("_record.*", "page", "place")
